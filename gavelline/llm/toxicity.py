"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A bag holds all runs of 3 to 6 bytes of a text's words, word ends included, A-Z lower-cased, hashed into buckets.  The
average of the runs' embeddings goes through a linear softmax that tells toxic from clean; embeddings and softmax are
trained together.  A misspelt word shares most runs with the word, so it is found without having been seen.

Insults are few words of a long text, and an average over all of it would drown them.  So the average is taken over each
stretch of a text (the runs that begin in `STRETCH` bytes, one stretch every `STEP` bytes, so that they overlap), and the text's
score is that of the stretch that looks most toxic, in training as in scoring; only the first epoch averages whole texts, so that
later ones know where to look.  Whole texts are read.

The model is fitted on the driver to at most `most` labelled documents of each class, chosen by a hash of their id.  As the
softmax is linear in the average, the fitted embeddings fold into one number per bucket, which is what scoring tasks get.

Defined results: null and empty texts get the score of an average of nothing, the bias; repeated rows get the same score;
labels without a document and documents without a label do no harm; without labels of both classes all get 0; an empty table
gives no rows; document ids may be null.
"""

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.llm.common import sampled
from gavelline.session import cut

#: Bytes of a run.
SHORT, LONG = 3, 6
BITS = 17
STRETCH, STEP = 16, 8
WIDTH = 8
EPOCHS, RATE, DOCUMENTS = 8, 0.1, 32
#: Labelled documents in a fit: toxic and clean.
MOST = (1500, 3000)

_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every run of a text, and the step in which it begins."""
    data = np.frombuffer(b" " + text.encode("utf-8", "surrogatepass").translate(_NORMAL) + b" ", np.uint8)
    spaces = np.concatenate([[0], np.cumsum(data == 32, dtype=np.int32)])
    wide = data.astype(np.uint32)
    code = wide[:-1] * np.uint32(0x01000193) ^ wide[1:]
    found, step = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for n in range(SHORT, min(LONG, len(data)) + 1):
        code = code[: len(data) - n + 1] * np.uint32(0x01000193) ^ wide[n - 1 :]
        inside = np.flatnonzero(spaces[n - 1 : len(data)] == spaces[1 : len(data) - n + 2])  # no space but at the ends
        mixed = (code[inside] ^ code[inside] >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
        found.append((mixed >> np.uint32(32 - BITS)).astype(np.int32))
        step.append(inside // STEP)
    return np.concatenate(found), np.concatenate(step)


def stretches(per_step: np.ndarray) -> np.ndarray:
    """Sums over each stretch, which begins at a step; those at the end hold fewer steps."""
    sums = np.concatenate([[0], np.cumsum(per_step)])
    begin = np.arange(len(per_step))
    return sums[np.minimum(begin + STRETCH // STEP, len(per_step))] - sums[begin]


class Model(NamedTuple):
    """What is left of embeddings and softmax for scoring: a number per bucket and the bias."""

    weight: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        found, step = runs(text)
        if not len(found):
            return _chance(self.bias)
        n = stretches(np.bincount(step))
        sums = stretches(np.bincount(step, self.weight[found]))
        return _chance(float((sums[n > 0] / n[n > 0]).max()) + self.bias)


def _chance(logit: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def fit(texts: list[str], toxic: np.ndarray, seed: int = 1) -> Model:
    """Joint training by stochastic gradients with adapted steps and softmax loss."""
    bags = []
    for text in texts:
        found, step = runs(text)
        order = np.argsort(step, kind="stable")
        bags.append((found[order], np.bincount(step)))
    usable = [k for k, (found, _) in enumerate(bags) if len(found)]
    draw = np.random.default_rng(seed)
    embedding = draw.normal(0, 0.1, (1 << BITS, WIDTH)).astype(np.float32)
    softmax = draw.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2)
    step_e, step_s = np.full(1 << BITS, 1e-6), np.full((WIDTH, 2), 1e-6)
    for epoch in range(EPOCHS):
        order = draw.permutation(usable)
        for k in range(0, len(order), DOCUMENTS):
            apart = softmax[:, 1] - softmax[:, 0]
            weight = embedding @ apart
            chosen, slope = [], []
            for i in order[k : k + DOCUMENTS]:
                found, per_step = bags[i]
                if epoch:
                    n, ends = stretches(per_step), np.cumsum(per_step)
                    sums = np.concatenate([[0], np.cumsum(weight[found], dtype=float)])
                    first, last = ends - per_step, ends - per_step + n
                    top = np.where(n > 0, (sums[last] - sums[first]) / np.maximum(n, 1), -np.inf).argmax()
                    found = found[first[top] : last[top]]
                chosen.append(found)
                slope.append(_chance(weight[found].mean() + bias[1] - bias[0]) - toxic[i])
            slope, n = np.array(slope), np.array([len(c) for c in chosen])
            used = np.concatenate(chosen)
            means = np.add.reduceat(embedding[used], np.cumsum(n) - n) / n[:, None]
            rows, place = np.unique(used, return_inverse=True)
            change = np.bincount(place, np.repeat(slope / n, n))[:, None] * apart
            step_e[rows] += (change**2).mean(axis=1)
            embedding[rows] -= RATE * change / np.sqrt(step_e[rows])[:, None]
            turn = means.T @ slope / len(n)
            turn = np.stack([-turn, turn], axis=1)
            step_s += turn**2
            softmax -= (RATE * turn / np.sqrt(step_s)).astype(np.float32)
            bias += np.array([1, -1]) * RATE / 2 * slope.mean()
    return Model((embedding @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fitted(documents: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST) -> Model | None:
    """A model of (doc_id, toxic) labels; None without labels of both classes."""
    marked = labels.select(F.col("doc_id").cast("long").alias("_doc"), F.col("toxic").cast("int").alias("_toxic"))
    marked = marked.filter("_doc is not null and _toxic in (0, 1)").distinct()
    toxic, clean = (sampled(marked.filter(f"_toxic = {k}"), "_doc", n) for k, n in ((1, most[0]), (0, most[1])))
    sample = cut(toxic.unionByName(clean))  # a bounded number of rows of two numbers
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_doc"))
    # Several rows of a document are cut down to one, so that the bound holds.
    rows = found.groupBy("_doc", "_toxic").agg(F.min("text").alias("text"))
    rows = rows.orderBy(F.xxhash64("_doc"), "_doc", "_toxic").toPandas()
    toxic = rows["_toxic"].to_numpy(float)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    return fit([t or "" for t in rows["text"]], toxic)


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """Per row doc_id and score, from 0 (clean) to 1 (toxic)."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: model.score(t or ""))

    value = F.lit(0.0) if model is None else score(F.col("text").cast("string"))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("score"))
