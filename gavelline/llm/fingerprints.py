"""Document fingerprints by consistent weighted sampling.

A text is a bag of terms, the weight of a term is how often it occurs.  For each of `samples` samples a term has numbers of
its own: r and c from the Gamma(2, 1) distribution and b from 0 to 1.  A term of weight w has t = floor(ln w / r + b) and
a = c / exp(r (t - b + 1)); the sample of the text is the term with the least a, together with its t.  Two texts have the
same sample with a probability equal to their generalised Jaccard similarity, the sum of the terms' smaller weights over
the sum of the larger ones.  A fingerprint keeps 16 bits of each sample, and the likeness of two is the share of equal ones.

The numbers of a term come from tables by parts of its hash: the sum of two exponential variates is a Gamma(2, 1) variate,
and the fraction of the sum of two uniform ones is uniform.  So they depend on the term and the seed alone.

Terms are words; of a word of over 32 characters (as in scripts without spaces) all runs of four characters are terms.

Defined results: null and empty texts are one text without terms, whose fingerprint is all zeros; equal texts have equal
fingerprints; repeated rows and ties of document ids follow one another by text; null ids come last.
"""

import hashlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelline.llm.common import whole
from gavelline.session import cut

SAMPLES = 64
SEED = 1
LONG_WORD, RUN = 32, 4
#: Bits of a term's hash that choose an entry of a table; six such parts are used.
TABLE_BITS = 10
#: Terms, by weight, whose numbers a worker remembers, and those that it draws together.
REMEMBERED, TERMS = 150_000, 1024
#: Rows of a result batch.
TEXTS = 256

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class Sampler:
    """Samples of texts; remembers the numbers of terms it has met, up to a bounded number of them."""

    def __init__(self, samples: int, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        shape = (1 << TABLE_BITS, samples)
        self.exponential = [draw.standard_exponential(shape, np.float32) for _ in range(4)]
        self.uniform = [draw.random(shape, np.float32) for _ in range(2)]
        self.columns = np.arange(samples)
        self.place: dict = {}  # of a term that occurs once, or of a term and its weight
        self.a = np.zeros((REMEMBERED, samples), np.float32)
        self.marks = np.zeros((REMEMBERED, samples), np.uint16)

    def draw(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """For each term and weight the values a, of which the least wins, and marks of the term and t."""
        pairs = [(k, 1) if isinstance(k, str) else k for k in keys]
        digest = xxhash.xxh3_64_intdigest
        hashes = np.array([digest(w.encode("utf-8", "surrogatepass")) for w, _ in pairs], np.uint64)
        weights = np.array([n for _, n in pairs], np.float32)
        low = np.uint64((1 << TABLE_BITS) - 1)
        e1, e2, e3, e4, u1, u2 = (
            t[(hashes >> np.uint64(k * TABLE_BITS)) & low] for k, t in enumerate(self.exponential + self.uniform)
        )
        r = np.maximum(e1 + e2, np.float32(1e-9))
        b = u1 + u2
        b -= b >= 1
        a = np.log(np.maximum(e3 + e4, np.float32(1e-30))) - r * (1 - b)
        base = (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
        marks = np.repeat((base >> np.uint32(16)).astype(np.uint16)[:, None], len(self.columns), axis=1)
        often = np.flatnonzero(weights > 1)
        t = np.floor(np.log(weights[often])[:, None] / r[often] + b[often])
        a[often] -= r[often] * t
        turned = (base[often][:, None] + t.astype(np.int32).view(np.uint32)) * np.uint32(0x9E3779B1) >> np.uint32(16)
        marks[often] = np.where(t == 0, marks[often], turned.astype(np.uint16))
        return a, marks

    def remember(self, keys: list) -> None:
        for k in range(0, len(keys), TERMS):
            part = keys[k : k + TERMS]
            n = len(self.place)
            self.a[n : n + len(part)], self.marks[n : n + len(part)] = self.draw(part)
            self.place.update(zip(part, range(n, n + len(part))))

    def sample(self, text: str) -> np.ndarray:
        """The samples of a text, zeros where it has no term."""
        keys = [w if n == 1 else (w, n) for w, n in terms(text).items()]
        if not keys:
            return np.zeros(len(self.columns), np.uint16)
        new = [k for k in keys if k not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self.place.clear()
            new = keys
        least = np.full(len(self.columns), np.inf, np.float32)
        marks = np.zeros(len(self.columns), np.uint16)
        for first in range(0, len(keys), REMEMBERED):  # a single run unless a text has more terms than are remembered
            if first:
                self.place.clear()
            part = keys[first : first + REMEMBERED]
            self.remember(new if len(keys) <= REMEMBERED else part)
            at = np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))
            rows = self.a[at]
            low = rows.min(axis=0)
            own = self.marks[at[(rows == low).argmax(axis=0)], self.columns]
            marks = np.where(low < least, own, marks)
            least = np.minimum(low, least)
        return marks


@lru_cache(maxsize=2)
def sampler(samples: int, seed: int) -> Sampler:
    """The worker's sampler."""
    return Sampler(samples, seed)


def terms(text: str) -> Counter:
    words = Counter(text.split())
    if max(map(len, words), default=0) > LONG_WORD:
        for word in [w for w in words if len(w) > LONG_WORD]:
            n = words.pop(word)
            for run, k in Counter(word[i : i + RUN] for i in range(len(word) - RUN + 1)).items():
                words[run] += n * k
    return words


def signatures(texts: list[str], samples: int = SAMPLES, seed: int = SEED) -> list[np.ndarray]:
    """16-bit samples of each text."""
    return list(map(sampler(samples, seed).sample, texts))


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples."""
    return float((a == b).mean())


def edited(text: str, other: str) -> str:
    """The text with the last half of its characters replaced by the first as many of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _rows(entries: list[tuple], samples: int, seed: int) -> list[tuple]:
    """entries: (doc_id, text, signature or None), each followed by its next document; a result row for all but the last."""
    changed = [edited(a[1], b[1]) for a, b in zip(entries, entries[1:])]
    made = signatures(changed, samples, seed)
    return [
        (doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), written(own), written(other),
         likeness(own, other), likeness(own, entries[k + 1][2]))
        for k, ((doc_id, text, own), new, other) in enumerate(zip(entries, changed, made))
    ]


def _batch(rows: list[tuple], block: int, kind: str, texts: list | None = None) -> pa.RecordBatch:
    fields = [f.split() for f in RESULT.split(", ")]
    types = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    columns = list(zip(*rows)) or [[]] * len(fields)
    data = {name: pa.array(c, types[t]) for (name, t), c in zip(fields, columns)}
    n = len(rows)
    data |= {"_block": pa.array([block] * n, pa.int64()), "_kind": pa.array([kind] * n, pa.string()), "_text": pa.array(texts or [None] * n, pa.string())}
    return pa.record_batch(data)


def with_next(documents: DataFrame, samples: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness and that of the next document (RESULT).

    Documents are dealt by ranges of falling id and sorted, a task goes through its range once with the next document at
    hand, and the ends of the ranges, two documents per task, are joined afterwards.
    """
    rows = documents.select(F.col("doc_id").cast("long"), whole(F.col("text").cast("string")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        block, last, first = TaskContext.get().partitionId(), None, None
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for k in range(0, len(ids), TEXTS):
                part = texts[k : k + TEXTS]
                entries = list(zip(ids[k : k + TEXTS], part, signatures(part, samples, seed)))
                if first is None:
                    first = entries[0]
                yield _batch(_rows([last, *entries] if last else entries, samples, seed), block, "row")
                last = entries[-1]
        if first is not None:
            for kind, (doc_id, text, _) in (("first", first), ("last", last)):
                yield _batch([(doc_id, len(text), "", "", "", 0.0, 0.0)], block, kind, [text])

    done = cut(ranged.mapInArrow(run, f"{RESULT}, _block long, _kind string, _text string"))
    names = [f.split()[0] for f in RESULT.split(", ")]
    ends = done.filter("_kind <> 'row'").groupBy("_block").agg(
        F.max(F.when(F.col("_kind") == "last", F.col("doc_id"))).alias("doc_id"),
        F.max(F.when(F.col("_kind") == "last", F.col("_text"))).alias("text"),
        F.max(F.when(F.col("_kind") == "first", F.col("_text"))).alias("head"),
    )
    # One row per task: the next range's first text, after the last range the first range's.
    in_order = Window.orderBy("_block")
    wrapped = F.coalesce(F.lead("head").over(in_order), F.first("head").over(in_order))
    joints = ends.select("doc_id", "text", wrapped.alias("other"))

    def joint(batches):
        for batch in batches:
            out = []
            for doc_id, text, other in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "other"))):
                own, next_ = signatures([text, other], samples, seed)
                out += _rows([(doc_id, text, own), (None, other, next_)], samples, seed)
            yield _batch(out, 0, "row").select(names)

    return done.filter("_kind = 'row'").select(names).unionByName(joints.mapInArrow(joint, RESULT))
