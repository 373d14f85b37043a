"""Mixture-controlled packing: deficit round-robin over source queues fills windows to target token proportions.

Every source's documents form a queue of tokens.  The queues are served in rounds; in a round each source gives its quantum
of tokens, and the round's windows draw from the sources by weighted turns of one token: the k-th of q tokens of a source
has its turn at (2k + 1) / 2q of the round.  So each window gets every source's share to within one token, and what a source
is owed or ahead is carried to the next window.  Quanta are whole numbers; what rounding or a source that runs dry leaves is
served by further phases with new quanta, until all queues are empty.  Documents are cut where a window's share of their
source ends; no token is lost and only the last sequence is padded.

The turns are closed forms of a token's place in its queue, so a task cuts its documents alone once it knows where its
queues begin: documents are tokenised once, each task numbers the tokens of its rows per source, and the sums per task and
source (a small table) give the beginnings.  Deficits so carry across partitions as well.  Texts are never shuffled.

Defined results: a null text is empty; an empty text still has its end token; a null source is a source of its own; repeated
rows are separate documents; an empty table gives no sequences.  The sources' totals are held on the driver: they are as
many as the mixture has entries.
"""

import zlib
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelline.llm.common import slices
from gavelline.llm.tokens import tokens
from gavelline.session import cut

LENGTH = 2048
VOCABULARY = "byte_bpe_50k"
END = 1
#: Sequences of a full round.
ROUND = 512

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenised(documents: DataFrame, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """Per document its ids with the end token, and its place in its task's queue of its source; written out."""

    def encode(batches):
        encoder, block, ahead = tokens(vocabulary), TaskContext.get().partitionId(), {}
        last = np.array([end], "<u2").tobytes()
        for batch in slices(batches):
            sources = batch.column("source").to_pylist()
            ids = [encoder.encode(text or "") + last for text in batch.column("text").to_pylist()]
            n = [len(x) // 2 for x in ids]
            starts = []
            for source, k in zip(sources, n):
                starts.append(ahead.get(source, 0))
                ahead[source] = starts[-1] + k
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "source": batch.column("source"),
                "block": pa.array([block] * len(n), pa.int64()), "queued": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(n, pa.int64()), "ids": pa.array(ids, pa.binary()),
            })

    rows = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    schema = "doc_id long, source string, block long, queued long, n_tokens long, ids binary"
    return cut(rows.mapInArrow(encode, schema))


class Phase(NamedTuple):
    """Rounds with equal quanta, by source."""

    first: int  # the token of the whole output that comes first
    rounds: int
    quanta: list[int]
    begins: list[int]  # of the sources' queues


def apportioned(total: int, weights: list[float]) -> list[int]:
    """Whole numbers with the given total, near the weights' shares; running sums are rounded, so none is off by over 1."""
    scale = sum(weights)
    edges = [0, *(int(x * total // scale) for x in accumulate(weights))]
    edges[-1] = total
    return [b - a for a, b in zip(edges, edges[1:])]


def phases(totals: list[int], length: int = LENGTH, weights: list[float] | None = None) -> list[Phase]:
    """Serve queues of these totals by the weights, or by what is left in them; each token is served once.

    A phase ends when a queue could not give its share of another round; the last rounds before that are as short as the queue
    that ends first allows, so the shares hold up to its end, whatever the sizes.
    """
    left, first, plan = list(totals), 0, []
    while any(left):
        due = left if weights is None else [w if n else 0 for n, w in zip(left, weights)]
        due = due if any(due) else left
        until, ends = min((n / d, k) for k, (n, d) in enumerate(zip(left, due)) if d)  # the queue that ends first
        if until * sum(due) >= ROUND * length:
            quanta = apportioned(ROUND * length, due)
        else:
            quanta = [min(n, (2 * left[ends] * d + due[ends]) // (2 * due[ends])) for n, d in zip(left, due)]
            quanta = [int(q) for q in quanta]
        rounds = min(n // q for n, q in zip(left, quanta) if q)
        if not rounds or sum(quanta) % length:  # only rounds of whole windows are alike
            rounds, quanta = 1, [min(n, q) for n, q in zip(left, quanta)]
        plan.append(Phase(first, rounds, quanta, [t - n for t, n in zip(totals, left)]))
        first += rounds * sum(quanta)
        left = [n - rounds * q for n, q in zip(left, quanta)]
    return plan


def window_cuts(phase: Phase, length: int) -> np.ndarray:
    """How many tokens of each source come before each window's begin in a round: an array of windows + 1 by sources.

    The first window of a round may already hold tokens of the phase before.
    """
    quanta = np.array(phase.quanta, np.int64)
    total = int(quanta.sum())
    held = phase.first % length
    edges = np.minimum(np.arange(0, held + total + length, length) - held, total).clip(0)
    cuts = np.zeros((len(edges), len(quanta)), np.int64)
    for s, q in enumerate(quanta):
        if q:
            # Tokens before the k-th of source s: with equal turns the source named first goes first.
            low, high = np.zeros(len(edges), np.int64), np.full(len(edges), q)
            while (open_ := low < high).any():
                k = (low + high) // 2
                turn = 2 * k[:, None] + 1
                others = np.where(np.arange(len(quanta)) < s, (turn * quanta - q) // (2 * q) + 1, -((q - turn * quanta) // (2 * q)))
                others[:, s] = k
                rank = np.minimum(np.maximum(others, 0), quanta).sum(1)
                low, high = np.where(open_ & (rank < edges), k + 1, low), np.where(open_ & (rank >= edges), k, high)
            cuts[:, s] = low
    return cuts


class Pieces:
    """Cuts the token ranges of queues into the pieces of windows."""

    def __init__(self, plan: list[Phase], length: int):
        self.length = length
        self.plan = []
        for phase in plan:
            cuts = window_cuts(phase, length)
            taken = np.diff(cuts, axis=0)
            base = np.cumsum(taken, axis=1) - taken
            base[0] += phase.first % length
            self.plan.append((phase, cuts, base, sum(phase.quanta)))

    def of(self, source: int, start: int, end: int):
        """Begin and end in the queue, sequence and offset of each piece of a range."""
        for phase, cuts, base, total in self.plan:
            quantum, begin = phase.quanta[source], phase.begins[source]
            stop = min(end, begin + quantum * phase.rounds)
            while begin <= start < stop:
                turn, at = divmod(start - begin, quantum)
                edges = cuts[:, source]
                k = int(np.searchsorted(edges, at, "right")) - 1
                until = min(stop, begin + turn * quantum + int(edges[k + 1]))
                window = (phase.first + turn * total) // self.length + k
                yield start, until, window, int(base[k, source]) + at - int(edges[k])
                start = until


def pack(
    documents: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end: int = END,
    weights: dict[str | None, float] | None = None, with_ids: bool = False,
) -> DataFrame:
    """All documents in sequences of `length` tokens, a row per piece (PIECES).

    weights: target shares of the sources; without, each source's share of all tokens.  with_ids: also the piece's token ids,
    little-endian 16-bit numbers, in a column ids.
    """
    rows = tokenised(documents, vocabulary, end)
    sums = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"),
    )
    begins = cut(begins)
    totals = begins.groupBy("_source").agg(F.sum("n").alias("n")).orderBy(F.col("_source").asc_nulls_last()).collect()
    numbers = {r["_source"]: k for k, r in enumerate(totals)}
    shares = None if weights is None else [float(weights.get(s, 0)) for s in numbers]
    plan = phases([r["n"] for r in totals], length, shares)

    def pieces(batches):
        cutter = Pieces(plan, length)
        for batch in slices(batches):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "source", "begin", "queued", "n_tokens", "ids")]
            for doc_id, source, begin, queued, n, ids in zip(*columns):
                first = begin + queued
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                for a, b, window, offset in cutter.of(numbers[source], first, first + n):
                    crc = zlib.crc32(wide[4 * (a - first) : 4 * (b - first)])
                    part = ids[2 * (a - first) : 2 * (b - first)] if with_ids else None
                    out.append((doc_id, a - first, b - a, crc, n, window, offset, part))
            fields = [f.split()[0] for f in PIECES.split(", ")]
            *columns, parts = list(zip(*out)) or [[]] * (len(fields) + 1)
            made = {f: pa.array(c, pa.int64()) for f, c in zip(fields, columns)}
            yield pa.record_batch(made | ({"ids": pa.array(parts, pa.binary())} if with_ids else {}))

    placed = rows.join(
        begins.drop("n"), F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    )
    return placed.select("doc_id", "source", "begin", "queued", "n_tokens", "ids").mapInArrow(pieces, PIECES + (", ids binary" if with_ids else ""))
