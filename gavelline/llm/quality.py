"""Quality rules: base rules on document statistics, then gradient-boosted trees over them.

The statistics of all documents are made in tasks.  Trees are fitted on the driver to the labels of at most `most` labelled
documents, chosen by a hash of their id; only their statistics travel.  Splits on the monotone features keep the score from
rising with the feature.  The fitted trees are flat numpy arrays, and a batch walks through all of them at once.

A document fails the base rules with fewer than 50 words or with over half of its words in repeated 3-word windows.
The trees reject one whose score is below the threshold.  The threshold is at most 0.5 and low enough to keep
`spared` of the labelled good documents in the fit, so that clean documents stay.

Defined results: a null text has no words and fails; repeated rows get the same verdict; labels without a document and
documents without a label do no harm; several labels of a document count each; without both good and bad labels the
trees keep everything; an empty table gives no rows; document ids may be null.
"""

import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelline.llm.common import sampled, slices, text_of
from gavelline.session import cut

MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
WINDOW = 3
#: Labelled documents in a fit.
MOST_LABELLED = 20_000
SPARED = 0.995

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]
#: Rates that the trees see; -1: the score must not rise with it.
FEATURES = {
    "words": 0, "word_length": 0, "symbols": -1, "duplicate_lines": -1, "repeated": -1, "line_length": 0, "upper": 0,
    "digits": 0, "marks": 0, "distinct": 0,
}

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_UPPER, _DIGITS, _MARKS = (bytes(c) for c in (range(65, 91), range(48, 58), b".,;:!?"))


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def statistics(text: str) -> tuple[int, ...]:
    """BASE and MORE of a whole text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    repeated = 0
    if len(times) < len(windows):
        until = 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + WINDOW - max(i, until)
                until = i + WINDOW
    lines = data.split(b"\n")
    full = [line for line in lines if line.strip(_SPACE)] if len(set(lines)) < len(lines) else []
    return (
        n, len(text) - _count(data, _SPACE), _count(data, b"#*$%&|<>"), len(full) - len(set(full)), repeated,
        len(lines), _count(data, _UPPER), _count(data, _DIGITS), _count(data, _MARKS), len(set(words)),
    )


def with_statistics(rows: DataFrame) -> DataFrame:
    """The rows with the statistics of their text, a column or a field of a column _row; a text column goes."""
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches):
        for batch in slices(batches):
            values = [statistics(t or "") for t in text_of(batch).to_pylist()]
            columns = dict(zip(BASE + MORE, map(list, zip(*values)))) if values else dict.fromkeys(BASE + MORE, [])
            yield pa.record_batch(
                {f.name: batch.column(f.name) for f in kept} | {k: pa.array(v, pa.int64()) for k, v in columns.items()}
            )

    fields = [*kept, *(T.StructField(c, T.LongType()) for c in BASE + MORE)]
    return rows.mapInArrow(run, T.StructType(fields))


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """A row of FEATURES per document, from its statistics."""
    chars, words, lines = (np.maximum(s[c].astype(float), 1) for c in ("word_chars", "n_words", "n_lines"))
    return np.stack([
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines,
        s["n_repeat_words"] / words, s["n_words"] / lines, s["n_upper"] / chars, s["n_digits"] / chars, s["n_marks"] / words,
        s["n_distinct"] / words,
    ], axis=1)


class Trees(NamedTuple):
    """Trees as node arrays; the children of a leaf are itself."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of a good document, per row of features."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.limit[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def fit(
    x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
    least: int = 20, smooth: float = 1.0, spared: float = SPARED,
) -> Trees:
    """Boosted trees of logistic loss over histograms of the features.

    A split on a monotone feature needs its leaf values in the right order, and everything below it stays on its side of
    their middle.
    """
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    raw = np.full(len(y), base)
    nodes = {k: [] for k in ("feature", "limit", "left", "right", "value")}
    roots = []

    def new(value):
        k = len(nodes["value"])
        for name, v in (("feature", 0), ("limit", np.inf), ("left", k), ("right", k), ("value", value)):
            nodes[name].append(v)
        return k

    def grow(rows, g, h, level, low, high):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        value = float(np.clip(total_g / (total_h + smooth), low, high))
        k = new(value * rate)
        if level == depth or len(rows) < 2 * least:
            return k
        best, chosen = 1e-6, None
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            n, sg, sh = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (None, g[rows], h[rows]))
            a = np.clip(sg / (sh + smooth), low, high)
            c = np.clip((total_g - sg) / (total_h - sh + smooth), low, high)
            gain = _gain(sg, sh, a, smooth) + _gain(total_g - sg, total_h - sh, c, smooth) - _gain(total_g, total_h, value, smooth)
            fine = (n >= least) & (len(rows) - n >= least) & ((c - a) * signs[f] >= 0)
            gain = np.where(fine, gain, -np.inf)
            if gain.max() > best:
                best, chosen = gain.max(), (f, int(gain.argmax()), a[gain.argmax()], c[gain.argmax()])
        if chosen:
            f, at, a, c = chosen
            middle, side = (a + c) / 2, binned[rows, f] <= at
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            (l1, h1), (l2, h2) = bounds[signs[f]]
            nodes["feature"][k], nodes["limit"][k] = f, edges[f][at]
            nodes["left"][k] = grow(rows[side], g, h, level + 1, l1, h1)
            nodes["right"][k] = grow(rows[~side], g, h, level + 1, l2, h2)
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), 0, -np.inf, np.inf))
        one = _flat(nodes, roots[-1:], base, depth, 0.5)
        raw += np.log((s := np.clip(one.score(x), 1e-12, 1 - 1e-12)) / (1 - s)) - base
    made = _flat(nodes, roots, base, depth, 0.5)
    return made._replace(threshold=min(0.5, float(np.quantile(made.score(x[y == 1]), 1 - spared))))


def _gain(g, h, value, smooth):
    return g * value - 0.5 * (h + smooth) * value * value


def _flat(nodes, roots, base, depth, threshold) -> Trees:
    return Trees(np.array(roots), *(np.array(nodes[k]) for k in ("feature", "limit", "left", "right", "value")), base, depth, threshold)


def label_sample(labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(_doc, _good) rows, at most `most` of them."""
    marked = labels.select(F.col("doc_id").cast("long").alias("_doc"), F.col("quality").cast("int").alias("_good"))
    return cut(sampled(marked.filter("_doc is not null and _good in (0, 1)"), "_doc", most))


def fitted(stats: DataFrame, sample: DataFrame, most: int = MOST_LABELLED) -> Trees | None:
    """Trees for a sample of labels, from statistics by doc_id; None if there is nothing to tell apart.

    The sample is broadcast: it has at most `most` rows of two numbers.
    """
    found = stats.join(F.broadcast(sample), F.col("doc_id") == F.col("_doc")).select("_good", "doc_id", *BASE, *MORE)
    sample = found.orderBy(F.xxhash64("doc_id"), "doc_id", "_good", *BASE).limit(most).toPandas()
    y = sample["_good"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    return fit(features({c: sample[c].to_numpy() for c in BASE + MORE}), y, list(FEATURES.values()))


def judged(stats: DataFrame, trees: Trees | None) -> DataFrame:
    """Adds base_failed, score and kept to statistics."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(trees.score(features({c: v.to_numpy() for c, v in zip(BASE + MORE, columns)})))

    value = F.lit(1.0) if trees is None else score(*BASE, *MORE)
    marked = stats.withColumn("base_failed", failed).withColumn("score", value)
    limit = 0.0 if trees is None else trees.threshold
    return marked.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= limit))


def rules(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Per row doc_id, its statistics, base_failed, score and kept."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    stats = cut(with_statistics(rows))
    return judged(stats, fitted(stats, label_sample(labels, most), most))


def kept_documents(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """The documents that the rules keep, all their columns unchanged."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    sample = label_sample(labels, most)
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = slim.join(F.broadcast(sample.select("_doc").distinct()), F.col("doc_id") == F.col("_doc"), "left_semi")
    trees = fitted(with_statistics(labelled), sample, most)
    return judged(with_statistics(documents.select(row)), trees).filter("kept").select("_row.*")
