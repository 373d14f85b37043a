"""Spelling variant grouping: words that differ by one edit are found by dense prefix-suffix tiling.

Two different words differ by exactly one inserted, deleted or replaced code point if the length of their common prefix plus
that of their common suffix reaches the longer length minus one.  The words of a tile are padded code-point matrices, once
aligned to the left and once to the right; comparing the blocks of a tile gives both lengths for all pairs of the tile.

Which words meet in a tile: let L be the longer length of a pair.  The places 0 to L-1 are cut into windows of `WINDOW` places.
The first place where the words differ lies in one window, and outside of it the words agree: they share the code points before
and those after the window.  So each word goes to the tiles named by (L, window, code points before, code points after) for
L = its length and its length + 1, and every pair is found in exactly one of them, the one whose window holds the end of its
common prefix.  A tile holds at most |alphabet|^WINDOW words, whatever the size of the corpus; large ones are cut once more, into
windows of one place, before they are compared.  Tasks add up neighbours; pairs are never written.

A word's form is its near word of largest count, if that is `RATIO` times its own; its root is the end of the chain of forms,
which has at most log(largest count) / log(RATIO) links and is followed by doubling.

Defined results: null texts hold no words; a null document id counts as an empty one; repeated rows count again; texts without a
word and an empty table give no rows; a word without a near word has n_near 0, no form and itself as root; ties of the largest
count go to the smaller word in code-point order; other columns of the documents are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelline.llm.common import ascii_lower, whole
from gavelline.session import cut

#: Letters of a run; all of them are below code point 256.
LETTER = r"[A-Za-zÀ-ÿ]"
#: Code points a word has at least, and how often it occurs.
SHORTEST, FEWEST = 7, 2
#: One run in so many loses a code point.
SPOILT = 31
#: How much more frequent than a word its form is.
RATIO = 10
#: Places of a window, words of a block, bytes of the comparisons held at a time, rows that a task looks at together.
WINDOW, BLOCK, TILE_BYTES, TOGETHER = 3, 64, 1 << 22, 50_000


def runs_of(documents: DataFrame) -> DataFrame:
    """(doc_id, run) of every run of at least SHORTEST letters, A-Z lower-cased; shorter ones cannot become words."""
    found = F.regexp_extract_all(whole(F.col("text").cast("string")), F.lit(LETTER + "{%d,}" % SHORTEST), F.lit(0))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    return rows.select("id", ascii_lower(F.col("run")).alias("run"))


def spoilt(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where the hash of id and run says so."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    place = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), place), F.substr(run, place + 2))
    return F.when(h % SPOILT == 0, shorter).otherwise(run)


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) of the words of a corpus that occur often enough."""
    words = runs_of(documents).select(spoilt(F.col("id"), F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= FEWEST)


def tile_rows(words: DataFrame) -> DataFrame:
    """(tile, longer, start, chars, n): each word in the tiles where it can meet near words; chars has a byte per code point."""
    size = F.length("word")
    starts = F.flatten(F.transform(F.array(size, size + 1), lambda L: F.transform(
        F.sequence(F.lit(0), L - 1, F.lit(WINDOW)), lambda i: F.struct(L.alias("longer"), i.alias("start"))
    )))
    rows = words.select("word", "n", F.explode(starts).alias("at")).select("word", "n", "at.*")
    after = F.greatest(F.col("longer") - F.col("start") - WINDOW, F.lit(0))
    before, behind = F.substr("word", F.lit(1), F.col("start")), F.substr(F.col("word"), F.length("word") - after + 1, after)
    return rows.select(
        F.xxhash64("longer", "start", before, behind).alias("tile"), "longer", "start",
        F.encode("word", "ISO-8859-1").alias("chars"), "n",
    )


def padded(data: np.ndarray, offsets: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Rows of bytes as one matrix, filled up with zeros; the last byte of every row comes first where `right` is set."""
    size = np.diff(offsets)
    place = np.arange(width)
    at = (offsets[1:, None] - 1 - place) if right else (offsets[:-1, None] + place)
    inside = place < size[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8)


class _Words:
    """Rows of a task: words as padded matrices, their lengths, counts and order among candidates for a form."""

    def __init__(self, chars: pa.Array, n: np.ndarray):
        data = np.frombuffer(chars.buffers()[2], np.uint8)
        offsets = np.frombuffer(chars.buffers()[1], np.int32)[chars.offset : chars.offset + len(chars) + 1].astype(np.int64)
        self.size = np.diff(offsets)
        width = int(self.size.max()) + 1  # a zero ends every word
        self.left, self.right = (padded(data, offsets, width, r) for r in (False, True))
        text = np.ascontiguousarray(self.left).view(f"S{width}").ravel()
        place = np.empty(len(text), np.int64)
        place[np.argsort(text, kind="stable")] = np.arange(len(text))
        self.text, self.n = text, n
        self.better = np.empty(len(text), np.int64)  # 1 for the least wanted form: smaller counts, then later words
        self.better[np.lexsort((-place, n))] = np.arange(1, len(text) + 1)


def compare(words: _Words, rows: np.ndarray, others: np.ndarray, longer, start, window) -> tuple[np.ndarray, np.ndarray]:
    """Near words and best near word of blocks of rows [tiles, a] among blocks [tiles, b]; -1 marks padding.

    Counts only pairs whose longer word has length `longer` and whose common prefix ends inside the tile's window.
    """
    a, b = np.maximum(rows, 0), np.maximum(others, 0)
    differ = words.left[a][:, :, None, :] != words.left[b][:, None, :, :]
    prefix = differ.argmax(axis=3)
    distinct = differ.any(axis=3)
    suffix = (words.right[a][:, :, None, :] != words.right[b][:, None, :, :]).argmax(axis=3)
    longest = np.maximum(words.size[a][:, :, None], words.size[b][:, None, :])
    L, i = longer[:, None, None], start[:, None, None]
    near = (prefix + suffix >= longest - 1) & distinct & (longest == L) & (prefix >= i) & (prefix < i + window)
    near &= (rows >= 0)[:, :, None] & (others >= 0)[:, None, :]
    best = np.where(near, words.better[b][:, None, :], 0).max(axis=2)
    return near.sum(axis=2), best


class _Found:
    def __init__(self, words: _Words):
        self.words = words
        self.near = np.zeros(len(words.n), np.int64)
        self.best = np.zeros(len(words.n), np.int64)

    def add(self, rows, others, longer, start, window):
        near, best = compare(self.words, rows, others, longer, start, window)
        real = rows >= 0
        np.add.at(self.near, rows[real], near[real])
        np.maximum.at(self.best, rows[real], best[real])


def _groups(key_changes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each run of equal keys, from the flags of rows that begin one."""
    starts = np.flatnonzero(key_changes)
    return starts, np.diff(np.append(starts, len(key_changes)))


def tiles(found: _Found, order: np.ndarray, starts, sizes, longer, start, window: int) -> None:
    """Compare the members order[s : s + size] of each group; groups of like size are compared as one stack of matrices."""
    width = found.words.left.shape[1]
    block = 2
    while block <= BLOCK:
        chosen = np.flatnonzero((sizes <= block) & (sizes > (block // 2 if block > 2 else 1)))
        step = max(1, TILE_BYTES // (block * block * width))
        for k in range(0, len(chosen), step):
            part = chosen[k : k + step]
            place = np.arange(block)
            at = np.where(place < sizes[part, None], starts[part, None] + place, 0)
            rows = np.where(place < sizes[part, None], order[at], -1)
            found.add(rows, rows, longer[part], start[part], window)
        block *= 2
    for g in np.flatnonzero(sizes > BLOCK):  # pairs of blocks
        members = order[starts[g] : starts[g] + sizes[g]]
        members = np.append(members, np.full(-len(members) % BLOCK, -1)).reshape(-1, BLOCK)
        for a in members:
            for b in members:
                found.add(a[None], b[None], longer[g : g + 1], start[g : g + 1], window)


def _narrow(found: _Found, members: np.ndarray, longer: int, start: int) -> None:
    """Cut a large tile into tiles of one place: words that are equal without it, those of the shorter length being so already."""
    words = found.words
    for place in range(start, min(start + WINDOW, longer)):
        full = words.size[members] == longer
        rest = words.left[members].copy()
        rest[full, place:-1] = rest[full, place + 1 :]
        text = np.ascontiguousarray(rest).view(words.text.dtype).ravel()
        by = np.argsort(text, kind="stable")
        text = text[by]
        starts, sizes = _groups(np.append(True, text[1:] != text[:-1]))
        tiles(found, members[by], starts, sizes, np.full(len(starts), longer), np.full(len(starts), place), 1)


def neighbours(tile: np.ndarray, longer: np.ndarray, start: np.ndarray, chars: pa.Array, n: np.ndarray) -> dict:
    """Per word with a near word in these tiles: n_near, and count and characters of the best one.  Rows are sorted by tile."""
    words = _Words(chars, n)
    found = _Found(words)
    changes = np.append(True, (tile[1:] != tile[:-1]) | (longer[1:] != longer[:-1]) | (start[1:] != start[:-1]))
    starts, sizes = _groups(changes)
    large = sizes > 4 * BLOCK
    for g in np.flatnonzero(large):
        _narrow(found, np.arange(starts[g], starts[g] + sizes[g]), int(longer[starts[g]]), int(start[starts[g]]))
    small = starts[~large]
    tiles(found, np.arange(len(tile)), small, sizes[~large], longer[small], start[small], WINDOW)
    rows = np.flatnonzero(found.near)
    by_better = np.empty(len(n) + 1, np.int64)
    by_better[words.better] = np.arange(len(n))
    best = by_better[found.best[rows]]
    return {"chars": words.text[rows].tolist(), "n_near": found.near[rows], "best_n": n[best], "best": words.text[best].tolist()}


_NEIGHBOURS = "chars binary, n_near bigint, best_n bigint, best binary"


def _of_batches(batches):
    """Neighbours of rows sorted by tile, some tiles at a time; a tile is never cut."""
    kept = []
    rows = 0

    def done(table: pa.Table):
        cols = {c: table.column(c).combine_chunks() for c in ("tile", "longer", "start", "chars", "n")}
        number = {c: cols[c].to_numpy(zero_copy_only=False) for c in ("tile", "longer", "start", "n")}
        out = neighbours(number["tile"], number["longer"], number["start"], cols["chars"], number["n"])
        types = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows += batch.num_rows
        if rows < TOGETHER:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        tile = table.column("tile").combine_chunks().to_numpy()
        end = int(np.searchsorted(tile, tile[-1]))  # the last tile may go on in the next batch
        if end:
            yield done(table.slice(0, end).combine_chunks())
        kept = table.slice(end).combine_chunks().to_batches()
        rows = len(tile) - end
    if rows:
        yield done(pa.Table.from_batches(kept).combine_chunks())


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) partial rows of (word, n): near words found in some tiles, and the best of them."""
    rows = tile_rows(words).repartition("tile").sortWithinPartitions("tile", "longer", "start")
    found = rows.mapInArrow(_of_batches, _NEIGHBOURS)
    def text(c):
        return F.decode(c, "ISO-8859-1")

    return found.select(text("chars").alias("word"), "n_near", "best_n", text("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each word's chain of forms."""
    found = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        rows = found.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        rows = cut(rows)
        found = rows.select("word", "root")
        if rows.filter("moved").isEmpty():
            return found


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of a corpus."""
    words = cut(word_counts(documents))
    none = [F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("bigint").alias("best_n"), F.lit(None).cast("string").alias("best")]
    rows = words.select("word", "n", *none).unionByName(near_words(words), allowMissingColumns=True)
    best = F.when(F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("below"), "best"))
    grouped = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("found"))
    is_form = -F.col("found.below") >= RATIO * F.col("n")
    grouped = cut(grouped.select(
        "word", "n", "n_near", F.when(is_form, F.col("found.best")).alias("form"), F.when(is_form, -F.col("found.below")).alias("form_n"),
    ))
    ends = roots(grouped.filter("form is not null"))
    return grouped.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
