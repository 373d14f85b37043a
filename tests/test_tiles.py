"""Alike headlines found tile by tile, against every pair."""

import random

import numpy as np
import pytest

from gavelline.functions import similarity
from gavelline.operators import dedup
from tests.test_dedup import mutate

LETTERS = ["ab", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz é中ä", "".join(map(chr, range(0x4E00, 0x4F00)))]


def _texts(rng, letters, longest, n):
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))) for _ in range(8)]
    found = [mutate(rng, b, rng.randrange(0, 2 + len(b) // 6), letters) for b in (rng.choice(base) for _ in range(2 * n))]
    return [t for t in found[:n] if t], [t for t in found[n:] if t]


def _all_pairs(left, right, until, since):
    return {(i, j) for i, a in enumerate(left) for j, b in enumerate(right)
            if a != b and since[j] < until[i] and similarity.ratio(a, b) > 90}


@pytest.mark.parametrize("blocks", [(3, 5, 7), (2048, 4096, 8192)])
@pytest.mark.parametrize("longest", [6, 40, 100, 300])
def test_tile_equals_all_pairs(monkeypatch, blocks, longest):
    for name, n in zip(("LEFT_BLOCK", "RIGHT_BLOCK", "PAIRS"), blocks):
        monkeypatch.setattr(similarity, name, n)
    rng, seen = random.Random(longest), 0
    for letters in LETTERS * 2:
        left, right = _texts(rng, letters, longest, 40)
        until, since = np.array([rng.randrange(60) for _ in left]), np.sort([rng.randrange(60) for _ in right])
        want = _all_pairs(left, right, until, since)
        seen += len(want)
        for most in (1, 3, 10**9):
            i, j, met = similarity.alike_in_tile(left, right, until, since, most)
            got = set(zip(i.tolist(), j.tolist()))
            assert len(got) == len(i) and got <= want
            # all that a text has met are told, and it leaves with enough of them only
            assert all((x, y) in got for x, y in want if y < met[x])
            assert all(met[x] == len(right) or sum(a == x for a, _ in got) >= most for x in range(len(left)))
    assert seen


def test_long_texts_equal_all_pairs():
    """More than one word a row, pairs that leave early, lengths far apart in one batch."""
    rng = random.Random(8)
    base = ["".join(rng.choice("etaoin shrdlu") for _ in range(n)) for n in (150, 700, 720, 1500)]
    left = [mutate(rng, b, int(len(b) * x), "xyz ") for b in base for x in (0.02, 0.08, 0.1, 0.15)]
    right = [mutate(rng, b, int(len(b) * x), "etao ") for b in base for x in (0, 0.05, 0.09, 0.12)]
    until, since = np.ones(len(left)), np.zeros(len(right))
    i, j, _ = similarity.alike_in_tile(left, right, until, since, 10**9)
    want = _all_pairs(left, right, until, since)
    assert set(zip(i.tolist(), j.tolist())) == want and 4 < len(want) < len(left) * len(right) / 4


def test_parts_make_the_same_pairs(spark, monkeypatch):
    """Titles of few syllables share stretches with nearly all others; only alike ones come out, however they are cut."""
    rng = random.Random(2)
    syllables = "th er on an re he in ed nd ha at en es of".split()
    titles = ["".join(rng.choice(syllables) + rng.choice(["", "", " "]) for _ in range(22))[:60] for _ in range(400)]
    titles += [mutate(rng, t, 3, "aeiou ") for t in titles[:40]]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(titles)], "at bigint, headline string")
    texts = dedup.with_id(df).join(df.groupBy("headline").agg({"at": "min"}).withColumnRenamed("min(at)", "at"), "headline")
    texts = texts.select("id", "headline", "at")
    names = {bytes(r["id"]): r["headline"] for r in texts.collect()}
    first = {r["headline"]: r["at"] for r in texts.collect()}
    want = {(a, b) for a in first for b in first if first[b] < first[a] and similarity.ratio(a, b) > 90}
    for part in (1 << 21, 3000):
        monkeypatch.setattr(dedup, "PART", part)
        rows = dedup.alike_pairs(texts, texts, 1000).collect()
        assert {(names[bytes(r["a"])], names[bytes(r["b"])]) for r in rows} == want and len(rows) == len(want) >= 40


def test_no_headlines(spark):
    none = spark.createDataFrame([], "id binary, headline string, at bigint")
    assert dedup.alike_pairs(none, none, 1).collect() == []


def _prose(rng, n, words):
    text = ""
    while len(text) < n:
        text += rng.choice(words) + " "
    return text[:n]


@pytest.mark.parametrize("sizes", [(2, 3), (512, 1024)])
@pytest.mark.parametrize("wide, few", [(512, 4), (150, 0), (150, 10**6)])
def test_runs_of_long_texts_equal_all_pairs(monkeypatch, sizes, wide, few):
    """Pieces in one stretch or in several, pairs told at once or one by one, edits spread, moved, in blocks and at the ends."""
    for name, value in {"LEFT_GROUP": sizes[0], "RIGHT_GROUP": sizes[1], "WIDE": wide, "FEW": few, "STEP": 64}.items():
        monkeypatch.setattr(similarity, name, value)
    rng, seen = random.Random(wide + few), 0
    for letters in ("ab", "etaoin shrdlu", "".join(map(chr, range(0x4E00, 0x4F00)))):
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(30)]
        left = [_prose(rng, n, words) for n in (201, 260, 300, 420, 640, 900)] + [words[0] * 90, (words[0] + words[1]) * 60]
        left = [t for t in left if len(t) > similarity.LONG]
        right = []
        for t in left:
            right += [mutate(rng, t, int(len(t) * x), letters) for x in (0.02, 0.09, 0.1, 0.2)]
            right += [t[int(len(t) * x) :] for x in (0.1, 0.17, 0.18, 0.2)] + [t[: int(len(t) * 0.83)], "".join(words)[: len(t) // 10] + t]
            right += [t[len(t) // 11 :] + t[: len(t) // 11], t[: len(t) // 2] + t[len(t) * 3 // 5 :] + letters[0] * 12, _prose(rng, len(t), words)]
        right = [t for t in right if len(t) > similarity.LONG]
        until, since = np.array([rng.randrange(20, 60) for _ in left]), np.sort([rng.randrange(50) for _ in right])
        for a, b in ((left, right), (right, left)):
            want = _all_pairs(a, b, np.ones(len(a)), np.zeros(len(b)))
            i, j, _ = similarity.alike_in_tile(a, b, np.ones(len(a)), np.zeros(len(b)), 10**9)
            assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
            seen += len(want)
        want = _all_pairs(left, right, until, since)
        i, j, met = similarity.alike_in_tile(left, right, until, since, 2)
        got = set(zip(i.tolist(), j.tolist()))
        assert got <= want and all((x, y) in got for x, y in want if y < met[x])
        assert all(met[x] == len(right) or sum(a == x for a, _ in got) >= 2 for x in range(len(left)))
    assert seen > 100


def test_unlike_long_texts_leave_before_their_common_lengths(monkeypatch):
    """Lines of a thousand and more characters share most of their common runs of three; few pairs are told by the whole table."""
    told = []

    def counted(a, b, i, j, can_be_alike=similarity.can_be_alike):
        told.append(len(i))
        return can_be_alike(a, b, i, j)

    monkeypatch.setattr(similarity, "can_be_alike", counted)
    rng = random.Random(4)
    words = ["".join(rng.choice("eeettaaoiinnsshrrdllucmfwypvbgk") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    for size in (600, 1000, 3000):
        left, right = ([_prose(rng, size + rng.randrange(40), words) for _ in range(60)] for _ in range(2))
        right += [mutate(rng, t, size // 20, "aeiou ") for t in left[:5]]
        told.clear()
        i, j, _ = similarity.alike_in_tile(left, right, np.ones(60), np.zeros(65), 1)
        assert list(zip(i.tolist(), j.tolist())) == [(k, 60 + k) for k in range(5)]
        assert sum(told) < 60 * 65 / 4
