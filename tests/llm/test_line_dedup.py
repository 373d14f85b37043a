import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from gavelline.llm.line_dedup import Cuckoo, LineStore, dedup_lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars, min_docs):
    """Per row: lines, lines dropped, text kept."""
    held = defaultdict(set)
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(LOWER)
    for r in rows:
        for line in (r.text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(r.doc_id)
    keeper = {k: max((d for d in ids if d is not None), default=None) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == r.doc_id]
        out.append((r.doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def cleaned(store, documents):
    rows = store.clean(documents).collect()
    return sorted(((r.doc_id, r._n_lines, r._n_dropped, r._kept or "") for r in rows), key=repr)


def test_awkward_rows(awkward, nothing):
    store = LineStore.of(awkward, 10, 3, shards=4)
    assert cleaned(store, awkward) == brute(awkward.collect(), 10, 3)
    own = store.clean(awkward, own=True)
    assert sorted(r._n_dropped for r in own.collect()) == sorted(x[2] for x in brute(awkward.collect(), 10, 3))
    assert dedup_lines(awkward).columns == awkward.columns and dedup_lines(awkward).count() == awkward.count()
    assert dedup_lines(nothing).count() == 0
    assert {r.text for r in dedup_lines(awkward).filter("doc_id = 7").collect()} == {None}


def test_insertions_and_deletions_are_reversible(corpus):
    line = "A line that goes from document to document."
    documents = corpus([f"{line}\nown line number {k}" + ("\nanother line of some few" if k % 2 else "") for k in range(12)])
    first, second = documents.filter("doc_id < 4"), documents.filter("doc_id >= 4")
    store = LineStore.of(first, 10, 3, shards=3)
    both = store.insert(second)
    assert cleaned(both, documents) == brute(documents.collect(), 10, 3)
    # Without the document that keeps the line, the next largest keeps it.
    fewer = both.delete(documents.filter("doc_id in (11, 3)"))
    left = documents.filter("doc_id not in (11, 3)")
    assert cleaned(fewer, left) == brute(left.collect(), 10, 3)
    back = fewer.delete(second)
    assert cleaned(back, first.filter("doc_id <> 3")) == brute(first.filter("doc_id <> 3").collect(), 10, 3)
    assert back.insert(documents.filter("doc_id = 3")).frequent.select("h1", "keeper").collect() == (
        store.frequent.select("h1", "keeper").collect()
    )
    assert back.delete(corpus(["x"]).selectExpr("doc_id + 99 as doc_id")).frequent.count() == back.frequent.count()


def test_filters_follow_the_exact_counts(corpus):
    documents = corpus([f"shared line number {k % 50} of some length" for k in range(200)])
    store = LineStore.of(documents, 10, 4, shards=2)
    gone = store.delete(documents.filter("doc_id < 30"))
    held = {(r.h1, r.h2) for r in gone.frequent.collect()}
    assert len(held) == 20
    all_keys = store.frequent.collect()
    filters = {r.shard: Cuckoo.unpack(r.data) for r in gone.filters.collect()}
    hit = {
        (r.h1, r.h2) for r in all_keys
        if filters[r.shard].may_hold(np.array([r.h1]).view(np.uint64), np.array([r.h2]).view(np.uint64))[0]
    }
    assert held <= hit and len(hit) < 25


@pytest.mark.parametrize("keys, size", [(5000, 5000), (400, 40)])
def test_cuckoo_holds_all_and_gives_back(keys, size):
    draw = np.random.default_rng(1)
    h1, h2 = (draw.integers(0, 1 << 63, keys, dtype=np.int64).view(np.uint64) for _ in range(2))
    made = Cuckoo.sized(size)
    made.put(h1, h2)
    made = Cuckoo.unpack(made.pack())
    assert made.may_hold(h1, h2).all()
    other = draw.integers(0, 1 << 63, (2, 20_000), dtype=np.int64).view(np.uint64)
    assert made.may_hold(*other).mean() < 0.02
    half = keys // 2
    made.take(h1[:half], h2[:half])
    assert made.may_hold(h1[half:], h2[half:]).all() and made.may_hold(h1[:half], h2[:half]).mean() < 0.02


def test_hash_of_what_is_kept(corpus):
    documents = corpus(["one\ntwo"])
    kept = LineStore.of(documents).clean(documents).first()._kept
    assert hashlib.sha256(kept.encode()).hexdigest() == hashlib.sha256(b"one\ntwo").hexdigest()


def test_hashes_are_independent(spark):
    """Neither hash follows from the other, so keys whose first hashes collide stay apart."""
    from pyspark.sql import functions as F

    from gavelline.llm.line_dedup import key_hashes

    h1, h2 = key_hashes(F.col("k"))
    rows = spark.createDataFrame([(f"line {k}",) for k in range(50)], "k string").select(h1.alias("h1"), h2.alias("h2"), F.xxhash64(h1, F.lit(1)).alias("x"), F.col("k"))
    seeded = rows.select("h2", F.xxhash64(F.lit(1), "k").alias("own"), F.xxhash64("k", F.lit(1)).alias("old")).collect()
    assert all(r.h2 == r.own != r.old for r in seeded)


def test_keys_with_one_first_hash_are_told_apart(corpus, monkeypatch):
    from pyspark.sql import functions as F

    from gavelline.llm import line_dedup

    monkeypatch.setattr(line_dedup, "key_hashes", lambda key: (F.lit(7).cast("long") + F.length(key) * 0, F.xxhash64(F.lit(1), key)))
    documents = corpus([f"a line that {'many' if k < 6 else 'some'} documents have\nown line number {k}" for k in range(9)])
    assert cleaned(LineStore.of(documents, 10, 5, shards=2), documents) == brute(documents.collect(), 10, 5)


def test_any_ids_and_column_names(awkward):
    from pyspark.sql import functions as F

    named = awkward.withColumns({"_kept": F.lit("k"), "_n_lines": F.lit(1), "keys": F.lit(2)}).withColumnRenamed("h1", "a.b")
    out = dedup_lines(named, min_chars=10, min_docs=3, shards=4)
    assert out.columns == named.columns and {r._kept for r in out.select("_kept").collect()} == {"k"}
    texts = awkward.withColumn("doc_id", F.concat(F.lit("id "), F.col("doc_id").cast("string")))
    rows = texts.collect()
    assert cleaned(LineStore.of(texts, 10, 3, shards=4), texts) == brute(rows, 10, 3)
