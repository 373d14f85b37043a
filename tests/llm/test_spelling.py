import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gavelline.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(rows):
    """Counts of words after some runs lost a code point."""
    n = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] = n.get(run, 0) + 1
    return {w: k for w, k in n.items() if k >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        form = min(near, key=lambda x: (-counts[x], x)) if near else None
        out[w] = [form if form and counts[form] >= 10 * n else None, n, len(near)]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return out


def as_dict(df):
    return {r.word: [r.form, r.n, r.n_near, r.root] for r in df.collect()}


def test_whole_corpus_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    counts = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    assert len(counts) > 300
    assert as_dict(spelling.variants(docs)) == plain(counts)


def test_chains_and_ties(spark):
    counts = {
        "accommodate": 5000, "acommodate": 400, "acomodate": 30, "acomodatee": 3, "lettere": 50, "letterf": 50, "letter": 900,
        "letters": 2, "aaaaaaa": 7, "aaaaaaaa": 70, "aaaaaaaaa": 700, "éàüöäßñ": 2, "éàüöäßñÿ": 20, "éàüöäßÿ": 20, "alonealone": 9,
    }
    counts = {w: n for w, n in counts.items() if len(w) >= 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = spelling.near_words(words).groupBy("word").agg(F.sum("n_near").alias("k")).collect()
    assert {r.word: r.k for r in found} == {w: k for w, (_, _, k, _) in plain(counts).items() if k}
    text = " ".join(" ".join([w] * n) for w, n in counts.items())
    # ids under which no run loses a code point
    free = next(i for i in range(10_000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in counts))
    docs = spark.createDataFrame([(free, text)], "doc_id long, text string")
    got = as_dict(spelling.variants(docs))
    assert got == plain(counts)
    assert got["acomodatee"] == ["acomodate", 3, 1, "accommodate"] and got["letters"][0] == "lettere"


@pytest.mark.parametrize("size", [8, 9, 11])
def test_large_tiles_are_cut(size):
    """Many words in few tiles: random words over two letters, far more than a block holds."""
    draw = np.random.default_rng(size)
    words = sorted({"".join(draw.choice(list("ab"), size - k)) + "x" * 3 for k in (0, 1) for _ in range(3000)})
    n = {w: int(k) for w, k in zip(words, draw.integers(2, 200, len(words)))}
    near, best = dict.fromkeys(words, 0), {}
    rows = []
    for w in words:
        for longer in (len(w), len(w) + 1):
            for start in range(0, longer, spelling.WINDOW):
                after = max(longer - start - spelling.WINDOW, 0)
                rows.append(((longer, start, w[:start], w[len(w) - after :]), longer, start, w))
    rows.sort()
    names = {key: k for k, key in enumerate(sorted({r[0] for r in rows}))}
    out = spelling.neighbours(
        np.array([names[r[0]] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]),
        pa.array([r[3].encode("latin-1") for r in rows], pa.binary()), np.array([n[r[3]] for r in rows]),
    )
    for w, k, m, other in zip(*out.values()):
        w = w.decode("latin-1")
        near[w] += int(k)
        best[w] = min(best.get(w, (0, "")), (-int(m), other.decode("latin-1")))
    for w in words:
        others = [x for x in words if one_edit(w, x)]
        assert near[w] == len(others)
        if others:
            assert best[w] == min((-n[x], x) for x in others)


def test_batches_may_cut_tiles(monkeypatch, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    expected = as_dict(spelling.variants(docs))
    rows = spelling.tile_rows(spelling.word_counts(docs)).toPandas().sort_values(["tile", "longer", "start"])
    monkeypatch.setattr(spelling, "TOGETHER", 50)
    near = {}
    batches = [pa.RecordBatch.from_pandas(rows[k : k + 37], preserve_index=False) for k in range(0, len(rows), 37)]
    for batch in spelling._of_batches(batches):
        for w, k in zip(batch.column("chars").to_pylist(), batch.column("n_near").to_pylist()):
            near[w.decode("latin-1")] = near.get(w.decode("latin-1"), 0) + k
    assert near == {w: v[2] for w, v in expected.items() if v[2]}


def test_awkward_rows(spark, awkward, nothing):
    counts = plain_words([(r.doc_id, r.text) for r in awkward.collect()])
    assert as_dict(spelling.variants(awkward)) == plain(counts)
    assert spelling.variants(nothing).collect() == []
    assert spelling.variants(nothing).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_a_spoilt_run_may_split_into_no_word(spark):
    doc_id = next(i for i in range(10_000) if zlib.crc32(f"{i}:sevenab".encode()) % 31 == 0)
    docs = spark.createDataFrame([(doc_id, "sevenab SEVENAB Sevenab"), (None, "÷×÷×÷×÷ ÷×÷×÷×÷")], "doc_id long, text string")
    assert as_dict(spelling.variants(docs)) == plain(plain_words([(None, "÷×÷×÷×÷ ÷×÷×÷×÷")]))
