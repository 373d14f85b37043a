"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most `radius` bits apart meet in a variant that is at most half the radius from both.  So each distinct
fingerprint emits all its variants within half the radius, the shuffle brings equal variants together, and fingerprints
that share a variant are deduplicated, verified by their bit distance and linked.

There are 2,081 variants of 64 bits within 2 flips, so they are shuffled by their leading bits and not one by one: a
fingerprint goes once to each region (a value of the `region_bits` leading bits of variants) that its variants reach, and
the variants of a region are made, sorted and compared where they meet, a slice of counted variants at a time.  That moves
1 + k + k(k-1)/2 rows per fingerprint for k leading bits, and every variant is still met with every equal one.  In a region,
all fingerprints of a variant are linked with its smallest one only, and a region passes on a spanning forest, so groups of
near copies never become pairs.

Defined results: a null text is empty; a text without words has fingerprint 0 and is linked like any other; fewer words than
a shingle are one shingle; a null document id counts as larger than all others; an empty table gives no rows.
"""

from array import array
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelline.llm.common import slices, text_of
from gavelline.llm.components import components
from gavelline.session import cut

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a region; more fingerprints make more regions.
REGION_ROWS = 8_000
#: Variants of a region that are held at a time.
SLICE_VARIANTS = 4_000_000
#: Pairs that are joined before those within one tree are left out.
PAIRS = 100_000
#: Shingles whose bits are counted at a time.
CHUNK = 50_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit by bit what over half of the hashes of the text's word shingles have."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends + 1 - sizes
    ends = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    counts, digest, view = np.zeros(64, np.int64), xxhash.xxh64_intdigest, memoryview(joined)
    for a in range(0, n, CHUNK):
        spans = zip(starts[a : min(a + CHUNK, n)].tolist(), ends[a : a + CHUNK].tolist())
        hashes = np.array([digest(view[i:j], SEED) for i, j in spans], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows with print, the fingerprint of their text, a column or a field of a column _row, as a signed 64-bit number.

    A text column goes.
    """
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches):
        for batch in slices(batches):
            texts = text_of(batch).cast(pa.binary()).to_pylist()
            values = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch({f.name: batch.column(f.name) for f in kept} | {"print": pa.array(values)})

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("print", T.LongType())]))


def flips(bits: list[int], most: int) -> np.ndarray:
    """Masks that flip up to `most` of these bits, with the number of flips as second column."""
    masks = [(sum(1 << b for b in c), k) for k in range(most + 1) for c in combinations(bits, k)]
    return np.array(masks, np.uint64).reshape(-1, 2)


@lru_cache(maxsize=64)
def _inside(depth: int, half: int) -> np.ndarray:
    """Masks that flip up to `half` of the bits below the `depth` leading ones, with the number of flips."""
    return flips(list(range(64 - depth)), half)


def pieces(region: int, prints: np.ndarray, bits: int, half: int):
    """Leading bits and their number that part the variants of a region, with the fingerprints that reach them and their flips.

    The variants of each are counted, and one that has more than SLICE_VARIANTS is split by its next bit.  Where all bits lead
    there is one variant, which the 2,081 distinct fingerprints around it share at most.
    """
    left = [(region, bits)]
    while left:
        head, depth = left.pop()
        leading = prints >> np.uint64(64 - depth) if depth else np.zeros(len(prints), np.uint64)
        away = np.bitwise_count(leading ^ np.uint64(head))
        near = np.flatnonzero(away <= half)
        away = away[near]
        of = np.bincount(_inside(depth, half)[:, 1].astype(np.int64), minlength=half + 1).cumsum()
        if depth < 64 and int(of[half - away].sum()) > SLICE_VARIANTS:
            left += [(head << 1 | 1, depth + 1), (head << 1, depth + 1)]
        elif len(near):
            yield head, depth, near, away


def region_links(region: int, prints: np.ndarray, bits: int, radius: int):
    """Linked pairs of a region's fingerprints (arrays of places): a spanning forest of those that share a variant there.

    The region is taken in pieces of SLICE_VARIANTS at most by the bits that follow the leading ones, so that memory stays
    bounded however close the fingerprints are to one another.
    """
    half = radius // 2
    root = array("q", range(len(prints)))
    for _, depth, near, away in pieces(region, prints, bits, half):
        masks, low = _inside(depth, half), np.uint64((1 << (64 - depth)) - 1)
        found, who = [], []
        for k in range(half + 1):
            of = near[away == k]
            kept = masks[masks[:, 1] <= half - k, 0]
            found.append(((prints[of] & low)[:, None] ^ kept).ravel())
            who.append(np.repeat(of, len(kept)))
        variants, owners = np.concatenate(found), np.concatenate(who)
        del found, who
        order = np.argsort(variants, kind="stable")
        variants, owners = variants[order], owners[order]
        del order
        first = np.diff(variants, prepend=~variants[:1]) != 0
        hubs = owners[np.flatnonzero(first)][np.cumsum(first) - 1]
        apart = hubs != owners
        pairs = np.unique(hubs[apart] * len(prints) + owners[apart])
        del variants, owners, first, hubs, apart
        yield _forest(pairs // len(prints), pairs % len(prints), prints, root, radius)


def _forest(a, b, prints, root, radius):
    """Of the pairs within the radius those that join two trees."""

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    tops, joined = np.frombuffer(root, np.int64), array("q")  # tops shares the memory of root
    for start in range(0, len(a), PAIRS):
        while not np.array_equal(up := tops[tops], tops):
            tops[:] = up
        x, y = a[start : start + PAIRS], b[start : start + PAIRS]
        apart = tops[x] != tops[y]
        x, y = x[apart], y[apart]
        close = np.bitwise_count(prints[x] ^ prints[y]) <= radius
        for one, other in zip(x[close].tolist(), y[close].tolist()):
            i, j = find(one), find(other)
            if i != j:
                root[max(i, j)] = min(i, j)
                joined.extend((one, other))
    found = np.array(joined, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def links(prints: DataFrame, radius: int = RADIUS, region_rows: int = REGION_ROWS) -> DataFrame:
    """Pairs (a, b) that connect all distinct fingerprints (a column print) at most `radius` bits apart; radius is even."""
    n = prints.count()
    bits = min(40, max(0, int(np.ceil(np.log2(max(1, n / region_rows))))))
    masks = flips(list(range(64 - bits, 64)), radius // 2)[:, 0].view(np.int64).tolist()
    reach = F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: F.col("print").bitwiseXOR(m))
    sent = prints.select("print", F.explode(reach).alias("reach"))
    region = F.shiftrightunsigned("reach", 64 - bits) if bits else F.lit(0)
    dealt = sent.select(region.cast("long").alias("region"), "print").repartition("region").sortWithinPartitions("region")

    def run(batches):
        def pairs(region, parts):
            values = np.concatenate(parts)
            for a, b in region_links(region, values.view(np.uint64), bits, radius):
                yield pa.record_batch({"a": values[a], "b": values[b]})

        at, parts = None, []
        for batch in batches:
            regions, values = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("region", "print"))
            edges = np.flatnonzero(np.diff(regions, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:]):
                if regions[a] != at:
                    if parts:
                        yield from pairs(at, parts)
                    at, parts = int(regions[a]), []
                parts.append(values[a:b])
        if parts:
            yield from pairs(at, parts)

    return dealt.mapInArrow(run, "a long, b long")


def classes(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per distinct print of (doc_id, print) rows: component_id and kept, the print of the row that stands for the class."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print"))
    distinct = cut(rows.groupBy("print").agg(first.alias("first")))
    roots = components(cut(links(distinct.select("print"), radius)))
    rooted = distinct.join(roots, F.col("print") == F.col("node"), "left")
    rooted = rooted.select("print", "first", F.coalesce("root", "print").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    found = rooted.join(lowest, "root")
    return found.select("print", F.col("lowest.doc_id").alias("component_id"), F.col("lowest.print").alias("kept"))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row doc_id, fingerprint (16 hex digits) and component_id, the smallest document id reachable over links."""
    slim = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = cut(fingerprints(slim, shingle))
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(cut(classes(rows, radius)), "print").select("doc_id", hexed, "component_id")


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each class: of the smallest document id, and of the rows with this id the first by print and row hash.

    Rows are known by two hashes of all their columns; texts are shuffled once, when rows are picked by them.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    hashes = F.xxhash64(nulls, *columns).alias("_a"), F.xxhash64(F.lit(1), nulls, *columns).alias("_b")
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *hashes, F.col("text").cast("string").alias("text"))
    rows = cut(fingerprints(slim, shingle))
    stands = classes(rows, radius).filter(F.col("print") == F.col("kept")).select("print", "component_id")
    first = rows.join(cut(stands), "print").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = cut(first.groupBy("print").agg(F.min(F.struct("_a", "_b")).alias("k")).select("k._a", "k._b"))
    same = Window.partitionBy("_a", "_b").orderBy(F.lit(0))  # equal rows
    keyed = documents.select(F.struct(*columns).alias("_row"), *hashes).withColumn("_n", F.row_number().over(same))
    return keyed.filter("_n = 1").join(kept, ["_a", "_b"], "left_semi").select("_row.*")
