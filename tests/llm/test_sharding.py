import zlib
from collections import defaultdict
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from gavelline.llm import sharding


def smallest(sizes, shards):
    """The least capacity over ordered sizes, by trying all that can be one."""
    ends = [0, *accumulate(sizes)]
    best = [0] + [float("inf")] * (len(sizes))
    for _ in range(shards):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


@pytest.mark.parametrize("groups, shards, bits", [(60, 7, (2, 1)), (60, 7, (14, 8)), (5, 9, (1, 3)), (90, 4, (3, 2))])
def test_smallest_capacity(spark, monkeypatch, groups, shards, bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits[0])
    monkeypatch.setattr(sharding, "MORE_BITS", bits[1])
    rows = spark.range(groups).select(F.xxhash64("id").alias("_hash"), (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(50)) + 1).alias("_size"))
    least, starts = sharding.minimax_cuts(rows, shards)
    ordered = sorted((r._hash, r._size) for r in rows.collect())
    assert least == smallest([s for _, s in ordered], shards)
    filled = defaultdict(int)
    for h, s in ordered:
        filled[sum(h >= x for x in starts)] += s
    assert max(filled.values()) == least and len(starts) < shards


def check(documents, shards):
    rows = sharding.shard_documents(documents, shards).collect()
    assert len(rows) == documents.count()
    slots, texts = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        texts[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in texts.values()) and all(0 <= s < shards for s in slots)
    want = sorted((len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in documents.collect())
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    return rows


def test_awkward_rows(awkward, nothing):
    check(awkward, 24)
    check(awkward, 1)
    assert check(nothing, 24) == []


def test_large_groups_have_their_own_shard(corpus, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 20)
    documents = corpus(["copy " * 20] * 100 + [f"text {k} " * 5 for k in range(400)])
    rows = check(documents, 6)
    filled, hot = defaultdict(int), zlib.crc32(("copy " * 20).encode())
    for r in rows:
        filled[r.shard] += r.size
    assert {r.shard for r in rows if r.text_crc32 == hot} == {0} and all(r.text_crc32 == hot for r in rows if r.shard == 0)
    rest = [filled[s] for s in range(1, 6)]
    assert max(rest) - min(rest) < 0.05 * max(rest)


def test_no_python_in_the_plan(awkward):
    plan = sharding.shard_documents(awkward, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
