import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gavelline.llm import bfd_packing, mix_packing
from gavelline.llm.tokens import tokens

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab A.'sé中\n\t\r \x1c\x85\xa0 <|endoftext|>1", max_size=40))
def test_tokens_equal_the_library(text):
    assert np.frombuffer(tokens("byte_bpe_50k").encode(text), "<u2").tolist() == ids(text)


def test_tokens_of_special_names():
    for text in ("a <|endoftext|>", "a  <|endoftext|> b", "<|endoftext|>", " <|endoftext|> x "):
        assert np.frombuffer(tokens("byte_bpe_50k").encode(text), "<u2").tolist() == ids(text)


@pytest.mark.parametrize("totals", [[5], [100, 1, 0, 37], [5000, 4999, 3, 20_000], [7, 0, 0], [123_456, 999, 70_001]])
@pytest.mark.parametrize("weights", [None, [3, 1, 2, 0]])
def test_turns_are_a_permutation(totals, weights):
    length = 8
    plan = mix_packing.phases(totals, length, None if weights is None else weights[: len(totals)])
    cutter = mix_packing.Pieces(plan, length)
    taken = np.zeros(sum(totals), bool)
    shares = defaultdict(lambda: [0] * len(totals))
    for s, n in enumerate(totals):
        at = 0
        for a, b, window, offset in cutter.of(s, 0, n):
            assert a == at and b > a and offset + b - a <= length
            at = b
            spot = slice(window * length + offset, window * length + offset + b - a)
            assert not taken[spot].any()
            taken[spot] = True
            shares[window][s] += b - a
        assert at == n
    assert taken.all()
    if weights is None:
        for window in list(shares)[:-1]:
            for s, n in enumerate(totals):
                assert abs(shares[window][s] - length * n / sum(totals)) < 2 + 0.02 * length


@pytest.mark.parametrize("totals", [[5000, 5000], [100_000, 100_000], [3_000_000, 3_000_000, 4_000_000], [40_000, 700, 9_000_000], [1, 1, 64]])
@pytest.mark.parametrize("weights", [[3, 1, 2], [1, 1, 0], [5, 2, 0.25]])
def test_shares_are_the_weights_until_a_source_ends(totals, weights):
    """Windows before a source's end hold every source's share to a token or two, and so do those after, of what is left."""
    length, weights = 512, weights[: len(totals)]
    plan = mix_packing.phases(totals, length, weights)
    served, left = [0.0] * len(totals), list(totals)
    for phase in plan:
        due = [w if n else 0 for n, w in zip(left, weights)]
        due = due if any(due) else left
        n = phase.rounds * sum(phase.quanta)
        if n > 200:
            for s, q in enumerate(phase.quanta):
                assert abs(phase.rounds * q / n - due[s] / sum(due)) <= 2 / sum(phase.quanta)
        served = [a + phase.rounds * q for a, q in zip(served, phase.quanta)]
        left = [t - int(a) for t, a in zip(totals, served)]
    assert served == totals and len(plan) <= 4 * len(totals)
    phase = max(plan, key=lambda p: sum(p.quanta))
    cutter = mix_packing.Pieces([phase], length)
    shares = defaultdict(lambda: [0] * len(totals))
    for s, q in enumerate(phase.quanta):
        for a, b, window, _ in cutter.of(s, phase.begins[s], phase.begins[s] + min(q, 30_000)):
            shares[window][s] += b - a
    taken = min(min(q, 30_000) / q for q in phase.quanta if q) * sum(phase.quanta)
    whole = [w for w in shares if w * length >= phase.first and (w + 2) * length <= phase.first + taken]
    for w in whole:
        for s, q in enumerate(phase.quanta):
            assert abs(shares[w][s] - length * q / sum(phase.quanta)) <= 2


def check_pieces(rows, documents, length):
    want = defaultdict(list)
    for r in documents.collect():
        want[r.doc_id].append(ids(r.text) + [1])
    fills, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        fills[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in fills.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
    totals = [sum(n for _, n in fills[k]) for k in range(len(fills))]
    assert all(n == length for n in totals[:-1]) and (not totals or 0 < totals[-1] <= length)
    assert sum(totals) == sum(len(x) for xs in want.values() for x in xs)
    assert set(pieces) == set(want)
    for doc_id, parts in pieces.items():
        if len(want[doc_id]) == 1:
            full, at = want[doc_id][0], 0
            for r in sorted(parts, key=lambda r: r.start):
                data = np.array(full[at : at + r.length], "<u4").tobytes()
                assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(data), len(full))
                at += r.length
            assert at == len(full)


def test_mixture_packing(awkward, nothing, corpus):
    check_pieces(mix_packing.pack(awkward).collect(), awkward, 2048)
    check_pieces(mix_packing.pack(awkward.repartition(5), length=64, weights={"a": 2, None: 1}).collect(), awkward, 64)
    assert mix_packing.pack(nothing).count() == 0
    documents = corpus([f"some words {k} " * (k % 13) for k in range(300)], sources=["a"] * 5 + ["b", None])
    rows = mix_packing.pack(documents.repartition(7), length=256, with_ids=True).collect()
    check_pieces(rows, documents, 256)
    for r in rows:
        piece = np.frombuffer(r.ids, "<u2").astype("<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit(lengths):
    rows = bfd_packing.best_fit(lengths, 64)
    assert sorted(k for row in rows for k in row) == list(range(len(lengths)))
    room, want = [], []  # the plain way: the fullest row that still has room
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in range(len(room)) if room[r] >= lengths[k]]
        if fits:
            row = min(fits, key=lambda r: room[r])
        else:
            row = len(room)
            room.append(64)
        room[row] -= lengths[k]
    assert len(rows) == len(room)
    assert sorted(64 - sum(lengths[k] for k in row) for row in rows) == sorted(room)


def test_bfd_packing_round_trip(awkward, nothing, tmp_path):
    packed = bfd_packing.pack(awkward, length=128, block=1000)
    bfd_packing.write(packed, str(tmp_path / "packed"))
    rows = awkward.sparkSession.read.parquet(str(tmp_path / "packed")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    found = defaultdict(list)
    for r in rows:
        row, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        edges = r.cumulative_lengths
        assert len(row) == len(positions) == 128 and edges[0] == 0 and edges[-1] == r.n_ids <= 128
        assert (row[r.n_ids :] == bfd_packing.END).all()
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            assert positions[a:b].tolist() == list(range(b - a))
            found[r.doc_ids[k]].append((r.starts[k], row[a:b].tolist()))
    want = defaultdict(list)
    for r in awkward.collect():
        full = ids(r.text) + [bfd_packing.END]
        want[r.doc_id] += [(a, full[a : a + 128]) for a in range(0, len(full), 128)]
    assert {d: sorted(p) for d, p in found.items()} == {d: sorted(p) for d, p in want.items()}
    assert bfd_packing.pack(nothing).count() == 0
