"""Language identification: unigram pieces per language, a text's probability summed over all its segmentations.

The vocabulary is a fixed public one of byte-level pieces (its name is a parameter; it is never trained).  Each language has a
probability for every piece.  A text's words are its runs of letters, lower-cased, with a space in front, as the vocabulary's
pieces have it; longer runs are read in stretches of `STRETCH` letters.  The probability of a word is the sum, over all ways to
cut its bytes into pieces, of the product of the pieces' probabilities: a forward algorithm over the lattice of all pieces that
occur in it.  All single bytes are pieces, so every word has a segmentation.  Whole texts are scored; the language with the
largest product over all words is the answer, and its share of all languages' likelihoods is the score.

The probabilities are fitted by expectation and maximisation: tasks run the forward and the backward pass over the counted words
of a language and add up, in whole units, how often each piece is expected; the driver gets one number per language and piece,
which the vocabulary and the number of languages bound.  The fit sees the words of at most `most` documents of each language,
chosen by a hash of the document id; their texts never leave Spark.

Defined results: null texts and texts without a letter are `und` with score 0, as is everything where there is no labelled
document; ties go to the first language in code-point order; documents without an id or language do not teach; repeated rows get
the same answer; rows of an id that is held out are never read by the fit; an empty table gives no rows; document ids may be
null; further columns are not read.
"""

import base64
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelline.llm.common import slices
from gavelline.session import cut

VOCABULARY = "byte_bpe_multi_50k"
UNKNOWN = "und"
#: Letters of a stretch; longer runs of letters are cut.
STRETCH = 64
WORD = r"\p{L}[\p{L}\p{M}]*+"
#: Documents of a language in a fit, rounds of the fit, and occurrences that every piece has in every language beforehand.
MOST, ROUNDS, BEFORE = 1000, 3, 0.1
#: Expected counts are added up in such parts of one, so that sums do not depend on their order.
UNITS = 1 << 20
#: Numbers that a worker holds: log probabilities of words it remembers, and of lattice edges at a time.
REMEMBERED, EDGES = 1_600_000, 2_000_000


class Lattice(NamedTuple):
    """All pieces that occur in some words: edges between places, which are the words' bytes one after the other."""

    word: np.ndarray  # of each edge
    piece: np.ndarray
    start: np.ndarray  # its places
    end: np.ndarray
    reach: np.ndarray  # the end's distance from the word's first place
    first: np.ndarray  # first and last place of each word
    last: np.ndarray


class Pieces:
    """The pieces of a vocabulary that words can hold, as a tree of bytes in one matrix, walked for all places at a time."""

    def __init__(self, name: str):
        import public_tokenizers

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            found = [base64.b64decode(line.split()[0]) for line in lines]
        inside = bytes([*range(ord("a"), ord("z") + 1), *range(128, 256)])
        found = [p for p in found if not p[p[:1] == b" " :].translate(None, inside)]
        self.number = {piece: k for k, piece in enumerate(found)}
        self.kind = np.zeros(256, np.int32)  # of a byte; the first one ends every walk
        self.kind[list(b" " + inside)] = np.arange(1, len(inside) + 2)
        nodes: dict[tuple[int, int], int] = {}
        ends = {}
        for piece, k in self.number.items():
            node = 0
            for byte in piece:
                node = nodes.setdefault((node, byte), len(nodes) + 1)
            ends[node] = k
        self.child = np.zeros((len(nodes) + 1, len(inside) + 2), np.int32)
        for (node, byte), below in nodes.items():
            self.child[node, self.kind[byte]] = below
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())
        self.size = len(self.number)

    def lattice(self, words: list[bytes]) -> Lattice:
        kind = self.kind[np.frombuffer(b"\n".join(words) + b"\n", np.uint8)]
        size = np.fromiter(map(len, words), np.int64, len(words))
        last = np.cumsum(size + 1) - 1
        first = last - size
        at, node = np.flatnonzero(kind), 0
        edges, depth = [], 0
        while len(at):
            node = self.child[node, kind[at + depth]]
            at, node, depth = at[node > 0], node[node > 0], depth + 1
            here = self.piece[node] >= 0
            edges.append(np.stack([at[here], at[here] + depth, self.piece[node[here]]]))
        start, end, piece = np.concatenate(edges, axis=1)
        word = np.repeat(np.arange(len(words)), size + 1)[start]
        reach = end - first[word]
        order = np.lexsort((end, reach))
        return Lattice(word[order], piece[order], start[order], end[order], reach[order], first, last)


@lru_cache(maxsize=2)
def pieces(name: str) -> Pieces:
    """The worker's tree of a vocabulary, by its file name without ending."""
    return Pieces(name)


def _steps(by: np.ndarray, to: np.ndarray):
    """Slices of edges that are sorted by `by` and `to`: one per value of `by`, with the places in `to` and where each begins."""
    bounds = np.append(np.flatnonzero(np.diff(by, prepend=-1)), len(by))
    for a, b in zip(bounds[:-1], bounds[1:]):
        starts = np.flatnonzero(np.diff(to[a:b], prepend=-1))
        yield slice(a, b), to[a:b][starts], starts


def _log_sum(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Logarithms of the sums of exponentials of each run of rows."""
    most = np.maximum.reduceat(values, starts)
    n = np.diff(np.append(starts, len(values)))
    return most + np.log(np.add.reduceat(np.exp(values - np.repeat(most, n, axis=0)), starts))


def forward(lattice: Lattice, weight: np.ndarray) -> np.ndarray:
    """Per place the log probability of all segmentations of the word up to it; `weight` has a row per edge."""
    at = np.zeros((int(lattice.last[-1]) + 1, weight.shape[1]))
    for edges, places, starts in _steps(lattice.reach, lattice.end):
        at[places] = _log_sum(at[lattice.start[edges]] + weight[edges], starts)
    return at


def backward(lattice: Lattice, weight: np.ndarray) -> np.ndarray:
    """Per place the log probability of all segmentations of the word from it on."""
    at = np.zeros((int(lattice.last[-1]) + 1, weight.shape[1]))
    left = lattice.last[lattice.word] - lattice.start
    order = np.lexsort((lattice.start, left))
    end, weight = lattice.end[order], weight[order]
    for edges, places, starts in _steps(left[order], lattice.start[order]):
        at[places] = _log_sum(at[end[edges]] + weight[edges], starts)
    return at


def log_probabilities(words: list[bytes], table: np.ndarray, vocabulary: str) -> np.ndarray:
    """A row per word, a column per language: log probability of the word, summed over its segmentations."""
    out, step = np.zeros((len(words), table.shape[1])), max(1, EDGES // (40 * table.shape[1]))
    for k in range(0, len(words), step):
        lattice = pieces(vocabulary).lattice(words[k : k + step])
        out[k : k + step] = forward(lattice, table[lattice.piece])[lattice.last]
    return out


def expected_pieces(words: list[bytes], lang: np.ndarray, n: np.ndarray, table: np.ndarray, vocabulary: str) -> np.ndarray:
    """Occurrences of each piece to be expected in words of given languages and counts, in whole units; a column per language."""
    total = np.zeros(table.shape, np.int64)
    step = EDGES // 40
    for k in range(0, len(words), step):
        lattice = pieces(vocabulary).lattice(words[k : k + step])
        column = lang[k : k + step][lattice.word]
        weight = table[lattice.piece, column][:, None]
        before, after = forward(lattice, weight), backward(lattice, weight)
        chance = before[lattice.start] + weight + after[lattice.end] - before[lattice.last[lattice.word]]
        units = np.rint(np.exp(chance[:, 0]) * UNITS).astype(np.int64) * n[k : k + step][lattice.word]
        np.add.at(total, (lattice.piece, column), units)
    return total


def as_bytes(word: str) -> bytes:
    return (" " + word).encode("utf-8", "surrogatepass")


class Model(NamedTuple):
    """Languages in order and a log probability per piece and language."""

    langs: list[str]
    table: np.ndarray
    vocabulary: str


def words_of(text: str | None, pattern, part: int = 1 << 17):
    """The words of a text as lists, several for a text that is very long; long runs are cut into stretches."""
    text = (text or "").lower()
    found = (m.group() for m in pattern.finditer(text)) if len(text) > 8 * part else iter([])
    words = list(islice(found, part)) or pattern.findall(text)
    while words:
        if max(map(len, words)) > STRETCH:
            words = [w[k : k + STRETCH] for w in words for k in range(0, len(w), STRETCH)]
        yield words
        words = list(islice(found, part))


class Reader:
    """A worker's memory of words while it scores texts."""

    def __init__(self, model: Model):
        import regex

        self.model, self.words = model, regex.compile(WORD)
        self.most = max(1000, REMEMBERED // len(model.langs))
        self.forget()

    def forget(self):
        self.place, self.known = _Places(), np.zeros((1024, len(self.model.langs)))

    def likelihoods(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Log likelihood per language of each text, None without a letter."""
        if len(self.place) > self.most:
            self.forget()
        waiting, out = [], [None] * len(texts)
        for k, text in enumerate(texts):
            for part in words_of(text, self.words):
                waiting.append((k, np.fromiter(map(self.place.__getitem__, part), np.int32, len(part))))
                if len(self.place.new) > self.most:  # a very long text
                    self._add(waiting, out)
                    self.forget()
        self._add(waiting, out)
        return out

    def _add(self, waiting: list, out: list) -> None:
        """Look at the words that are new, then add up what waits."""
        if new := self.place.new:
            end = len(self.place)
            if end > len(self.known):
                more = np.zeros((max(end, 2 * len(self.known)) - len(self.known), self.known.shape[1]))
                self.known = np.concatenate([self.known, more])
            self.known[end - len(new) : end] = log_probabilities([as_bytes(w) for w in new], self.model.table, self.model.vocabulary)
            self.place.new = []
        for k, places in waiting:
            if len(places):
                sums = self.known[places].sum(axis=0)
                out[k] = sums if out[k] is None else out[k] + sums
        waiting.clear()


class _Places(dict):
    """Numbers of words in the order in which they were first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


def answer(model: Model, likelihood: np.ndarray | None) -> tuple[str, float]:
    """Language and score."""
    if likelihood is None:
        return UNKNOWN, 0.0
    best = int(likelihood.argmax())
    return model.langs[best], float(1 / np.exp(likelihood - likelihood[best]).sum())


def word_counts(documents: DataFrame, langs: list[str]) -> DataFrame:
    """(lang, word, n): how often each word occurs in the documents of each language, by its place among the languages."""
    places = F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))])

    def of_batches(batches):
        import regex

        pattern = regex.compile(WORD)
        for batch in batches:
            for part in slices([batch]):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    for words in words_of(text, pattern):
                        word = pa.array(map(as_bytes, words), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.int32()), word], names=["lang", "word"])

    rows = documents.select(F.element_at(places, F.col("lang")).alias("lang"), "text")
    return rows.mapInArrow(of_batches, "lang int, word binary").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def _maximised(counts: np.ndarray) -> np.ndarray:
    part = counts / UNITS + BEFORE
    return np.log(part / part.sum(axis=0))


def fitted(documents: DataFrame, teaches: Column, most: int = MOST, rounds: int = ROUNDS, vocabulary: str = VOCABULARY) -> Model:
    """A model of the languages of the documents that teach."""
    known = documents.filter(teaches & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
    )
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    langs, size = sorted(sizes), pieces(vocabulary).size
    if not langs:
        return Model([], np.zeros((size, 0)), vocabulary)
    # A limit on the hash lets somewhat more through than are taken, so that few texts are moved.
    space = 1 << 40
    limits = F.create_map(*[F.lit(x) for lang in langs for x in (lang, int(space * min(1.0, 1.25 * (most + 100) / sizes[lang])))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(space)).alias("place")
    near = known.select("*", place).filter(F.col("place") < F.element_at(limits, F.col("lang")))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "text"))
    counts = cut(word_counts(near.select("*", turn.alias("turn")).filter(F.col("turn") <= most), langs))
    table = np.full((size, len(langs)), -np.log(size))
    for _ in range(rounds):
        table = _maximised(_expected(counts, table, vocabulary))
    return Model(langs, table.astype(np.float32), vocabulary)


def _expected(counts: DataFrame, table: np.ndarray, vocabulary: str) -> np.ndarray:
    shared = counts.sparkSession.sparkContext.broadcast(table)

    def of_batches(batches):
        total = None
        for batch in batches:
            lang, n = (batch.column(c).to_numpy() for c in ("lang", "n"))
            found = expected_pieces(batch.column("word").to_pylist(), lang, n, shared.value, vocabulary)
            total = found if total is None else total + found
        if total is not None:
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "units"])

    rows = counts.mapInArrow(of_batches, "piece bigint, lang bigint, units bigint")
    rows = rows.groupBy("piece", "lang").agg(F.sum("units").alias("units")).toPandas()  # at most pieces times languages
    out = np.zeros(table.shape)
    out[rows["piece"], rows["lang"]] = rows["units"]
    return out


def labelled(documents: DataFrame, model: Model) -> DataFrame:
    """Per row doc_id, lang_pred and score."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    if not model.langs:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches):
        reader = Reader(shared.value)
        for part in slices(batches):
            told = [answer(reader.model, x) for x in reader.likelihoods(part.column("text").to_pylist())]
            columns = [part.column("doc_id"), pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(of_batches, f"doc_id {kind}, lang_pred string, score double")
