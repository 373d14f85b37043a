import pytest

from gavelline.llm import mixing


def targets(sizes, weights, most):
    """Share by weight, stop at the cap, share the excess again."""
    total, out = sum(sizes), [0.0] * len(sizes)
    stopped = [False] * len(sizes)
    while True:
        free = sum(w for w, s in zip(weights, stopped) if not s)
        left = total - sum(most * n for n, s in zip(sizes, stopped) if s)
        for k, (n, w) in enumerate(zip(sizes, weights)):
            out[k] = most * n if stopped[k] else left * w / free
        over = [k for k, n in enumerate(sizes) if not stopped[k] and out[k] > most * n]
        if not over:
            return out
        for k in over:
            stopped[k] = True


@pytest.mark.parametrize("sizes", [[5, 100, 3, 60], [0, 7, 1], [10], [1, 1, 1000, 1, 1, 2], [4, 4, 4, 4, 4, 4, 4]])
def test_targets(spark, sizes):
    names = [chr(97 + k) for k in range(len(sizes) - 1)] + [None]
    rows = spark.createDataFrame(list(zip(names, sizes)), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = targets(sizes, [(1, 2, 3)[k % 3] for k in range(len(sizes))], 3)
    assert [got[n] for n in names] == pytest.approx(want)


def test_awkward_rows(awkward, nothing):
    rows = mixing.mixed_sizes(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id: r["size"] for r in rows}[7] == 0 and {r.doc_id: r["size"] for r in rows}[10] == 80_000
    assert all(0 <= r.n_copies <= 3 for r in rows)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_sizes(nothing).count() == 0
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns and mixed.count() == sum(r.n_copies for r in rows)
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, mixing.mix(awkward).collect()))


def test_near_the_targets(corpus):
    documents = corpus([f"{'word ' * (k % 9 + 1)}" for k in range(6000)], sources=["a"] * 4 + ["b", None])
    sums = {}
    for r in mixing.mixed_sizes(documents).collect():
        taken, target = sums.get(r.source, (0, 0))
        sums[r.source] = (taken + r["size"] * r.n_copies, r.target)
    assert all(abs(taken - target) < 0.05 * target for taken, target in sums.values())


def test_rows_without_ids_or_with_one_id_come_near_the_targets(corpus):
    from pyspark.sql import functions as F

    documents = corpus([f"{'word ' * (k % 9 + 1)}{k}" for k in range(6000)], sources=["a", "b", None])
    for doc_id in (None, 5):
        sums = {}
        for r in mixing.mixed_sizes(documents.withColumn("doc_id", F.lit(doc_id).cast("long"))).collect():
            taken, target = sums.get(r.source, (0, 0))
            sums[r.source] = (taken + r["size"] * r.n_copies, r.target)
        assert all(abs(taken - target) < 0.1 * target for taken, target in sums.values())
    dotted = documents.withColumnRenamed("shard", "a.b")
    assert mixing.mix(dotted).columns == dotted.columns
