"""Reversible line de-duplication: sharded cuckoo filters backed by an exact table of reference counts.

A line's key is the line without white space at both ends, A-Z lower-cased; it is held as two 64-bit hashes, the first of
which names its shard.  A store has

- a ledger, the exact reference counts: signed numbers of lines per key and document, one batch of rows per insertion or
  deletion, so that a deletion takes back what the insertion brought;
- a cuckoo filter per shard with the keys that at least `min_docs` documents hold now.  A batch changes the counts of its
  own keys only; keys that reach the limit are put into the filters, keys that fall below are taken out.

`clean` sends the lines' keys by shard to the filters.  Most keys miss and are done; those that hit are held against the
exact counts, so false positives lose no line.  Shards with many lines are split by document, each part with a copy of the
filter; filters and lines stream through a task in sorted order, so no group is held in memory.

Defined results: a null text has one empty line and stays null; a null document id is one document, smaller than all
others; rows with the same document id are one document and are cleaned alike; inserting a document again adds to its
lines; deleting an unknown document does nothing; an empty table gives no rows; ids may be of any type that has an order, and
other columns may have any name.
"""

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelline.llm.common import ascii_lower, whole
from gavelline.session import cut

MIN_CHARS = 40
MIN_DOCS = 5
SHARDS = 128
#: Lines of a shard that meet its filter in one sorted run.
PART_LINES = 200_000
KEY = ["shard", "h1", "h2"]
SLOTS = 4
KICKS = 500


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def key_of(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def key_hashes(key: Column) -> tuple[Column, Column]:
    """Two hashes of which neither follows from the other: the second begins with a constant."""
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


class Cuckoo:
    """A cuckoo filter: buckets of four 16-bit fingerprints, each key in one of two buckets.  Equal keys may not be put twice."""

    def __init__(self, buckets: int, table: np.ndarray | None = None, rest: np.ndarray | None = None):
        self.mask = np.uint64(buckets - 1)
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table
        #: What found no place: bucket and fingerprint.
        self.rest = np.zeros((0, 2), np.uint64) if rest is None else rest

    @classmethod
    def sized(cls, keys: int) -> "Cuckoo":
        return cls(1 << max(2, int(keys * 1.5 / SLOTS)).bit_length())

    def room_for(self, more: int) -> bool:
        return np.count_nonzero(self.table) + len(self.rest) + more <= 0.9 * self.table.size and len(self.rest) < 64

    def places(self, h1: np.ndarray, h2: np.ndarray):
        mark = (h2.astype(np.uint64) & np.uint64(0xFFFF)) | np.uint64(1)
        a = (h1.astype(np.uint64) >> np.uint64(20)) & self.mask
        return a, self.other(a, mark), mark

    def other(self, bucket, mark):
        return (bucket ^ (mark * np.uint64(0x5BD1E995))) & self.mask

    def put(self, h1: np.ndarray, h2: np.ndarray) -> None:
        buckets, _, marks = self.places(h1, h2)
        if not self.table.any():  # of a new filter, each bucket takes the first keys at once
            order = np.argsort(buckets, kind="stable")
            buckets, marks = buckets[order], marks[order]
            rank = np.arange(len(order)) - np.searchsorted(buckets, buckets)
            at_once = rank < SLOTS
            self.table[buckets[at_once], rank[at_once]] = marks[at_once]
            buckets, marks = buckets[~at_once], marks[~at_once]
        turn = 0
        for bucket, mark in zip(buckets, marks):
            for _ in range(KICKS):
                row = self.table[bucket]
                if len(free := np.flatnonzero(row == 0)):
                    row[free[0]] = mark
                    break
                bucket = self.other(bucket, mark)
                row = self.table[bucket]
                if len(free := np.flatnonzero(row == 0)):
                    row[free[0]] = mark
                    break
                turn = (turn + 1) % SLOTS
                row[turn], mark = np.uint16(mark), np.uint64(row[turn])
                bucket = self.other(bucket, mark)
            else:
                self.rest = np.vstack([self.rest, np.array([[bucket, mark]], np.uint64)])

    def take(self, h1: np.ndarray, h2: np.ndarray) -> None:
        for a, b, mark in zip(*self.places(h1, h2)):
            for bucket in (a, b):
                if len(held := np.flatnonzero(self.table[bucket] == mark)):
                    self.table[bucket, held[0]] = 0
                    break
            else:
                held = np.flatnonzero((self.rest[:, 1] == mark) & ((self.rest[:, 0] == a) | (self.rest[:, 0] == b)))
                self.rest = np.delete(self.rest, held[:1], axis=0)

    def may_hold(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        a, b, mark = self.places(h1, h2)
        found = ((self.table[a] == mark[:, None]) | (self.table[b] == mark[:, None])).any(axis=1)
        for bucket, held in self.rest:
            found |= (mark == held) & ((a == bucket) | (b == bucket))
        return found

    def pack(self) -> bytes:
        head = np.array([len(self.table), len(self.rest)], np.uint64)
        return head.tobytes() + self.table.tobytes() + self.rest.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> "Cuckoo":
        buckets, rest = (int(x) for x in np.frombuffer(data, np.uint64, 2))
        table = np.frombuffer(data, np.uint16, buckets * SLOTS, 16).reshape(buckets, SLOTS).copy()
        return cls(buckets, table, np.frombuffer(data, np.uint64, 2 * rest, 16 + table.nbytes).reshape(rest, 2).copy())


def references(documents: DataFrame, min_chars: int, shards: int) -> DataFrame:
    """Number of lines per key and document: shard, h1, h2, doc_id, n."""
    lines = documents.select("doc_id", F.explode(lines_of(F.col("text"))).alias("line"))
    keys = lines.select("doc_id", key_of(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    h1, h2 = key_hashes(F.col("key"))
    hashed = keys.select("doc_id", h1.alias("h1"), h2.alias("h2"))
    counted = hashed.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), "h1", "h2", "doc_id", "n")


def held_by(ledger: DataFrame) -> DataFrame:
    """Per key the number of documents that hold it and the largest of them."""
    held = ledger.groupBy(*KEY, "doc_id").agg(F.sum("n").alias("n")).filter("n > 0")
    return held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))


@dataclass(frozen=True)
class LineStore:
    """Reference counts and filters; insertions and deletions return a new store."""

    ledger: DataFrame
    frequent: DataFrame  # shard, h1, h2, n_docs, keeper of keys that enough documents hold
    filters: DataFrame  # shard, data
    min_chars: int
    min_docs: int
    shards: int

    @classmethod
    def of(cls, documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int = SHARDS):
        """A store of these documents."""
        ledger = cut(references(documents, min_chars, shards))
        counted = ledger.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
        frequent = cut(counted.filter(F.col("n_docs") >= min_docs))
        return cls(ledger, frequent, cut(_new_filters(frequent)), min_chars, min_docs, shards)

    def insert(self, documents: DataFrame) -> "LineStore":
        return self._with(references(documents, self.min_chars, self.shards))

    def delete(self, documents: DataFrame) -> "LineStore":
        """Take back all lines of the documents with these ids (a column doc_id)."""
        gone = documents.select("doc_id").distinct().withColumnRenamed("doc_id", "_gone")
        held = self.ledger.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_semi")
        back = held.groupBy(*KEY, "doc_id").agg((-F.sum("n")).alias("n"))
        return self._with(back.filter("n <> 0"))

    def _with(self, batch: DataFrame) -> "LineStore":
        batch = cut(batch)
        ledger = self.ledger.unionByName(batch)
        keys = batch.select(*KEY).distinct()
        now = held_by(ledger.join(keys, KEY, "left_semi")).filter(F.col("n_docs") >= self.min_docs)
        now = cut(now)
        before = self.frequent.join(keys, KEY, "left_semi")
        frequent = cut(self.frequent.join(keys, KEY, "left_anti").unionByName(now))
        put = now.join(before, KEY, "left_anti").select(*KEY, F.lit(2).alias("kind"))
        take = before.join(now, KEY, "left_anti").select(*KEY, F.lit(1).alias("kind"))
        filters = cut(_changed_filters(self.filters, put.unionByName(take), frequent))
        return replace(self, ledger=ledger, frequent=frequent, filters=filters)

    def dropped_lines(self, documents: DataFrame | None = None) -> DataFrame:
        """Per document of the store, or of these documents: the keys whose lines go (keys) and their number (n_dropped)."""
        refs = self.ledger if documents is None else references(documents, self.min_chars, self.shards)
        hits = _probe(refs, self.filters, self.shards)
        exact = hits.join(self.frequent.select(*KEY, "keeper"), KEY).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        key = F.struct("h1", "h2")
        found = exact.groupBy("doc_id").agg(F.collect_set(key).alias("keys"), F.sum("n").alias("n_dropped"))
        return found.filter("n_dropped > 0")

    def clean(self, documents: DataFrame, own: bool = False) -> DataFrame:
        """The documents with _n_lines, _n_dropped and _kept, the text of the lines that stay.

        own: these are exactly the documents that the store was made of, so their references need not be made again.
        """
        return self._cleaned(documents, own).select("_row.*", "_n_lines", "_n_dropped", "_kept")

    def _cleaned(self, documents: DataFrame, own: bool) -> DataFrame:
        """clean, with each document's own columns under _row, where no name clashes."""
        gone = self.dropped_lines(None if own else documents).withColumnRenamed("doc_id", "_doc")
        row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
        joined = documents.select(row).join(gone.hint("shuffle_hash"), F.col("_row.doc_id").eqNullSafe(F.col("_doc")), "left")
        text, lines = F.col("_row.text"), lines_of(F.col("_row.text"))

        def stays(line):
            key = key_of(line)
            h1, h2 = key_hashes(key)
            return (F.char_length(key) < self.min_chars) | ~F.array_contains(
                F.col("keys"), F.struct(h1.alias("h1"), h2.alias("h2"))
            )

        kept = F.when(F.col("keys").isNull(), text).otherwise(F.array_join(F.filter(lines, stays), "\n"))
        left = F.when(F.col("keys").isNull(), 0).otherwise(F.size(lines) - F.size(F.filter(lines, stays)))
        return joined.select(
            "_row", F.size(lines).cast("bigint").alias("_n_lines"), left.cast("bigint").alias("_n_dropped"), kept.alias("_kept")
        )


def _u64(c: pd.Series) -> np.ndarray:
    return c.to_numpy(np.int64).view(np.uint64)


def _new_filters(frequent: DataFrame) -> DataFrame:
    def build(key, keys: pd.DataFrame) -> pd.DataFrame:
        made = Cuckoo.sized(len(keys))
        made.put(_u64(keys["h1"]), _u64(keys["h2"]))
        return pd.DataFrame({"shard": [key[0]], "data": [made.pack()]})

    return frequent.select(*KEY).groupBy("shard").applyInPandas(build, "shard int, data binary")


def _changed_filters(filters: DataFrame, changes: DataFrame, frequent: DataFrame) -> DataFrame:
    """Filters after changes (kind 1: take, 2: put); one without enough room is made again from the exact table."""

    def change(key, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        held = Cuckoo.unpack(old["data"].iloc[0]) if len(old) else Cuckoo.sized(len(new))
        take, put = new[new["kind"] == 1], new[new["kind"] == 2]
        held.take(_u64(take["h1"]), _u64(take["h2"]))
        fits = held.room_for(len(put))
        if fits:
            held.put(_u64(put["h1"]), _u64(put["h2"]))
        return pd.DataFrame({"shard": [int(key[0])], "data": [held.pack() if fits else None]})

    changed = cut(filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, "shard int, data binary"))
    full = changed.filter("data is null").select("shard")
    return changed.filter("data is not null").unionByName(_new_filters(frequent.join(full, "shard", "left_semi")))


def _probe(refs: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The references whose key may be in the filter of its shard."""
    sizes = {r.shard: r["count"] for r in refs.groupBy("shard").count().collect()}  # at most one row per shard
    parts = F.array(*[F.lit(1 + sizes.get(s, 0) // PART_LINES) for s in range(shards)])
    of = F.element_at(parts, F.col("shard") + 1)
    part = F.pmod(F.xxhash64("doc_id"), of).cast("int").alias("part")
    held = filters.select("shard", F.explode(F.sequence(F.lit(0), of - 1)).alias("part"), "data")
    held = held.withColumns({"h1": F.lit(0).cast("long"), "h2": F.lit(0).cast("long")})
    mixed = held.unionByName(refs.select(*KEY, "doc_id", "n", part), allowMissingColumns=True)
    dealt = mixed.repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("data").asc_nulls_last())

    def probe(batches):
        at, filter_ = None, None
        for batch in batches:
            shard, part, h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "part", "h1", "h2"))
            hit = np.zeros(batch.num_rows, bool)
            names = shard.astype(np.int64) << 32 | part
            edges = np.flatnonzero(np.diff(names, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:]):
                if names[a] != at:
                    at, data = names[a], batch.column("data")[a].as_py()
                    filter_ = Cuckoo.unpack(data) if data else None
                    a += data is not None
                if filter_ and a < b:
                    hit[a:b] = filter_.may_hold(h1[a:b].view(np.uint64), h2[a:b].view(np.uint64))
            yield batch.filter(pa.array(hit)).select([*KEY, "doc_id", "n"])

    kind = refs.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(probe, f"shard int, h1 long, h2 long, doc_id {kind}, n long")


def dedup_lines(documents: DataFrame, **limits) -> DataFrame:
    """The documents without the lines that many documents share, and n_chars of what is left; other columns unchanged."""
    cleaned = LineStore.of(documents, **limits)._cleaned(documents, own=True)
    values = {"text": F.col("_kept"), "n_chars": F.char_length("_kept").cast("bigint")}
    return cleaned.select(*[values[c].alias(c) if c in values else F.col("_row").getField(c).alias(c) for c in documents.columns])
