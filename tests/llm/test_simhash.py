import re
import tracemalloc

import numpy as np
import pytest
import xxhash

from gavelline.llm import simhash
from gavelline.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + shingle]).encode(), seed=42).intdigest()
        for i in range(max(1, len(words) - shingle + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        i, j = find(a), find(b)
        root[max(i, j)] = min(i, j)
    return {n: find(n) for n in nodes}


def near(values, radius):
    return [
        (a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b & 0xFFFFFFFFFFFFFFFF).bit_count() <= radius
    ]


@pytest.mark.parametrize("region_rows, slice_variants", [(10_000, 4_000_000), (20, 4_000_000), (40, 20_000)])
def test_links_lose_no_near_pair(spark, monkeypatch, region_rows, slice_variants):
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", slice_variants)
    draw = np.random.default_rng(7)
    values = set()
    for _ in range(25):
        center = int(draw.integers(0, 1 << 63)) * 2 + 1
        for _ in range(8):
            flipped = draw.choice(64, draw.integers(0, 7), replace=False)
            values.add(center ^ sum(1 << int(b) for b in flipped))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(v,) for v in signed], "print long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(rows, 4, region_rows).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert classes(found, values) == classes(near(values, 4), values)


CENTER = 0x9E3779B97F4A7C15


def cluster(n):
    """Distinct fingerprints at most 4 bits from one."""
    draw = np.random.default_rng(3)
    flipped = draw.integers(0, 64, (2 * n, 4)).astype(np.uint64)
    found = np.unique(np.uint64(CENTER) ^ np.bitwise_xor.reduce(np.uint64(1) << flipped, axis=1))
    return np.sort(draw.permutation(found)[:n])


def test_pieces_of_a_large_cluster_are_bounded():
    prints, bits, half = cluster(300_000), 10, 2
    assert len(prints) == 300_000
    region = CENTER >> 54
    ball = {k: len(simhash.flips(list(range(54)), half - k)) for k in range(half + 1)}
    away = np.bitwise_count((prints >> np.uint64(54)) ^ np.uint64(region))
    seen = 0
    for _, depth, near, flipped in simhash.pieces(region, prints, bits, half):
        inner = [len(simhash.flips(list(range(64 - depth)), half - k)) for k in range(half + 1)]
        made = sum(int((flipped == k).sum()) * inner[k] for k in range(half + 1))
        assert 0 < made <= simhash.SLICE_VARIANTS
        seen += made
    assert seen == sum(int((away == k).sum()) * ball[k] for k in range(half + 1)) > 90_000_000


def test_memory_of_a_region_does_not_grow_with_a_cluster(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", 200_000)
    prints = cluster(20_000)
    tracemalloc.start()
    for _ in simhash.region_links(CENTER >> 54, prints, 10, 4):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000  # about 7 million variants of 8 bytes in five arrays would be 280 MB


def test_links_of_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", 50_000)
    monkeypatch.setattr(simhash, "PAIRS", 100)
    values = cluster(1_500).tolist()
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(v,) for v in signed], "print long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(rows, 4, 200).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert classes(found, values) == classes(near(values, 4), values)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 150), (300, 301)] + [(500 + k, 499) for k in range(60)]
    rows = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(rows).collect()}
    nodes = {n for p in pairs for n in p}
    want = {n: r for n, r in classes(pairs, nodes).items() if n != r}
    assert got == want
    assert components(rows.limit(0)).count() == 0


def check(documents, rows):
    texts = documents.collect()
    assert len(rows) == len(texts)
    prints = sorted({plain(r.text) for r in texts})
    root = classes(near(prints, 4), prints)
    least = {}
    for r in texts:
        k = root[plain(r.text)]
        if r.doc_id is not None:
            least[k] = min(r.doc_id, least.get(k, r.doc_id))
    want = sorted(((r.doc_id, f"{plain(r.text):016x}", least.get(root[plain(r.text)])) for r in texts), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=repr) == want


def test_awkward_rows(awkward, nothing, corpus):
    check(awkward, simhash.near_duplicates(awkward).collect())
    assert simhash.near_duplicates(nothing).count() == 0
    base = [f"w{k * 31 % 97}" for k in range(300)]
    copies = [" ".join(base[:k] + [f"new{k}"] + base[k + 1 :]) for k in range(0, 300, 7)]
    documents = corpus([" ".join(base), *copies, " ".join(base).upper(), "quite another text", *["same"] * 50, None, ""])
    check(documents, simhash.near_duplicates(documents).collect())


def test_one_of_each(awkward, nothing):
    assert simhash.one_of_each(awkward.filter("doc_id = 12")).count() == 2  # one id, two classes
    awkward = awkward.filter("doc_id is null or doc_id <> 12")
    found = simhash.near_duplicates(awkward).collect()
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len({(r.component_id, r.component_id is None and r.fingerprint) for r in found})
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in found}
    assert simhash.one_of_each(nothing).count() == 0


def test_long_texts_in_chunks(monkeypatch):
    text = " ".join(f"w{k * 7 % 501}" for k in range(2000))
    want = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 13)
    assert simhash.fingerprint(text.encode()) == want == plain(text)


def test_many_rows_of_one_batch(corpus):
    documents = corpus([f"text {k % 700} of its own words w{k % 700} v{k % 700}" for k in range(1400)]).coalesce(1)
    check(documents, simhash.near_duplicates(documents).collect())
    kept = {r.doc_id: r.text for r in simhash.one_of_each(documents).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert all(texts[k] == t for k, t in kept.items())
    assert set(kept) == {r.component_id for r in simhash.near_duplicates(documents).collect()}
