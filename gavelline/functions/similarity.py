"""Headline similarity: a whole-number ratio from 0 to 100, and the alike pairs of two lists of texts.

The ratio of a and b is round(100 * (1 - indel / (len(a) + len(b)))), where indel counts inserted and deleted
characters.  Two texts count as alike above 90, which means indel < 0.095 * (len(a) + len(b)).
"""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# executors get these helpers with the task, they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 90


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character of b."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> int:
    total = len(a) + len(b)
    if not total or a == b:
        return 100
    if not a or not b:
        return 0
    return round(100 * (2 * common_length(a, b) / total))


def whole_edits(a: int, b: int) -> int:
    """How many characters texts of these lengths can differ by at most, inserted and deleted, if they are alike."""
    return (19 * (a + b) - 1) // 200


def cuts(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the segments of a text: one more than a text that is not longer can differ by.

    So one of them is left whole in every alike text that is not longer.
    """
    n = whole_edits(size, size) + 1
    length = size // n + (np.arange(n) >= n - size % n)
    return np.cumsum(length) - length, length


def segment_lengths(size: int) -> np.ndarray:
    """Lengths of the segments of all texts that are alike to one of this size and not shorter."""
    sizes = np.arange(size, (219 * size - 1) // 181 + 1)
    n = (38 * sizes - 1) // 200 + 1
    return np.unique(np.concatenate([sizes // n, sizes[sizes % n > 0] // n[sizes % n > 0] + 1]))


def _scatter(codes: np.ndarray) -> np.ndarray:
    """Spread numbers over 64 bits, one to one."""
    x = (codes ^ (codes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Classes of characters that the common length is told by before the characters themselves.
SYMBOLS = 128
#: Texts that are compared at once, and bits of rows that are held at once.
LEFT_BLOCK, RIGHT_BLOCK, PAIRS, BITS = 2048, 4096, 8192, 1 << 23
#: Texts longer than LONG are told by runs of RUN characters, counted by bucket, in pieces of some PIECE characters; a piece is
#: looked for in stretches of WIDE characters at most, or in several whose starts are STEP apart if they would be wider.
LONG, RUN, BUCKETS, PIECE, WIDE, STEP = 200, 3, 2048, 128, 512, 128
#: Texts that are compared piece by piece at once, and the factor that their lengths differ by, if one stretch a piece is enough and if not.
LEFT_GROUP, RIGHT_GROUP, LIKE, LESS_LIKE = 512, 1024, 1.03, 1.15
#: Pairs by word of a text's places below which they are told one by one, and the part of a text that is looked at before the whole.
FEW, AHEAD = 4, 0.3


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype("uint64")


def sketches(texts: list[str], buckets: int, levels: int) -> np.ndarray:
    """For each text and bucket of runs of three characters, whether it holds one, two or more of them, up to `levels`."""
    out = np.zeros((len(texts), levels, buckets), np.uint8)
    for k, text in enumerate(texts):
        points = _points(text)
        if len(points) > 2:
            triples = _scatter(points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:])
            counts = np.bincount((triples % np.uint64(buckets)).astype(np.int64), minlength=buckets)
            for level in range(levels):
                out[k, level] = counts > level
    return out.reshape(len(texts), levels * buckets)


def _scored(sketched: np.ndarray, sizes: np.ndarray, left: bool) -> np.ndarray:
    """Vectors whose product is below zero where sketches differ by more than five runs per character that alike texts may differ by.

    An inserted or deleted character changes at most five of the runs of three.
    """
    own = 2.5 * 0.095 * sizes - sketched.sum(axis=1, dtype=np.int64) / 2
    ones = np.ones(len(sizes))
    ends = np.stack([own, ones] if left else [ones, own], axis=1)
    return np.concatenate([sketched, ends], axis=1, dtype=np.float32)


class Runs:
    """The texts of a tile as buckets of their runs, by place; each of the most common runs has a bucket of its own, nearly."""

    def __init__(self, left: list[str], right: list[str]):
        points = _points("".join(left) + "".join(right))
        codes = np.zeros(len(points), np.uint64)
        for k in range(RUN):
            codes[: len(points) - k] = _scatter((codes[: len(points) - k] << np.uint64(1)) + points[k:] + np.uint64(1))
        codes = (codes >> np.uint64(48)).astype(np.int64)
        common = np.argsort(-np.bincount(codes, minlength=1 << 16), kind="stable")
        buckets = np.arange(1 << 16) % (BUCKETS // 2) + BUCKETS // 2
        buckets[common[: BUCKETS // 2]] = np.arange(BUCKETS // 2)
        self.buckets = buckets[codes]
        self.sizes = np.array([len(t) for t in [*left, *right]], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def counts(self, which: np.ndarray, first: int, last: int) -> np.ndarray:
        """For each text and bucket, how many runs begin at the places from `first` to before `last`, which all texts have."""
        found = self.buckets[self.starts[which][:, None] + np.arange(first, last)]
        found += np.arange(len(which))[:, None] * BUCKETS
        return np.bincount(found.ravel(), minlength=len(which) * BUCKETS).reshape(len(which), BUCKETS).astype(np.float32)

    def held(self, which: np.ndarray, first: int, last: int, out: np.ndarray) -> None:
        """For each text and bucket, 1 if a run begins at the places from `first` to before `last`, as far as the text has them."""
        out[:] = 0
        place = np.arange(max(first, 0), last)
        runs = self.sizes[which][:, None] - RUN + 1
        if len(place):
            at = np.minimum(place, runs - 1)  # a place beyond the end counts as the last one, which can only find more
            out[np.arange(len(which))[:, None], self.buckets[self.starts[which][:, None] + at]] = 1

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether texts can be alike by their runs, for each of `a` with each of `b`; all are longer than RUN.

        A deleted character breaks RUN runs at most and an inserted one a run less.  What alike texts have in common is moved by at
        most so many places, so a run of a piece of the one that is not to be found in a stretch of the other is broken.  If there
        are several stretches, the piece is near one of them, or it has more than `slack` edits.
        """
        n, m = self.sizes[a], self.sizes[b]
        most = int(whole_edits(n.max(), m.max()))
        far, back = min(most, int(n.max() - m.min())), max(-most, int(n.min() - m.max()))
        if far < back:
            return np.zeros((len(a), len(b)), bool)
        size, moved = int(n.min()), ((back - most) // 2, (far + most + 1) // 2)
        pieces = max(1, size // PIECE)
        length = size // pieces
        slack, step = most, moved[1] - moved[0] + 1
        if step + length > WIDE:
            pieces = max(1, size // (2 * PIECE))
            length = size // pieces
            slack, step = length * 3 // 10, STEP
        differ = n[:, None] - m[None, :]
        edits = whole_edits(n[:, None], m[None, :])
        allowed = ((2 * RUN - 1) * edits + differ) / 2
        broken = np.zeros((len(a), len(b)), np.float32)
        held = np.empty((len(b), BUCKETS), np.float32)
        for k in range(pieces):
            at, end = k * length, k * length + length
            counts = self.counts(a, at, end - RUN + 1)
            found = np.zeros_like(broken)
            for first in range(at - moved[1], at - moved[0] + 1, step):
                last = min(first + step - 1 + length + slack, end - moved[0])
                self.held(b, first, last - RUN + 1, held)
                np.maximum(found, counts @ held.T, out=found)
            found = length - RUN + 1 - found
            broken += found if slack >= most else np.minimum(found, (RUN - 1) * (slack + 1))
            if k % 4 == 3 and (broken > allowed).all():
                break
        return (broken <= allowed) & (np.abs(differ) <= edits)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts of `a` and `b` that can be alike by their runs, in order."""
        found = [np.zeros((2, 0), np.int64)]
        others = self.groups(b, RIGHT_GROUP)
        for mine in self.groups(a, LEFT_GROUP):
            for theirs in others:
                i, j = np.nonzero(self.near(mine, theirs))
                found.append(np.stack([mine[i], theirs[j]]))
        i, j = np.concatenate(found, axis=1)
        order = np.lexsort([j, i])
        return i[order], j[order]

    def groups(self, which: np.ndarray, most: int) -> list[np.ndarray]:
        """Texts by rising size, `most` of like size together."""
        which, out = which[np.argsort(self.sizes[which], kind="stable")], []
        while len(which):
            size = self.sizes[which[0]]
            like = LIKE if PIECE + 0.25 * size <= WIDE else LESS_LIKE
            n = min(most, int(np.searchsorted(self.sizes[which], size * like, side="right")))
            out.append(which[:n])
            which = which[n:]
        return out


class Symbols:
    """Texts as classes of characters, by place; each character of an alphabet that is small enough is a class."""

    def __init__(self, texts: list[str], alphabet: np.ndarray):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        points = _points("".join(texts))
        if len(alphabet) <= SYMBOLS:
            self.all = np.searchsorted(alphabet, points).astype(np.uint8)
        else:
            self.all = ((points ^ (points >> np.uint64(7))) % np.uint64(SYMBOLS)).astype(np.uint8)

    def of(self, which: int) -> np.ndarray:
        return self.all[self.ends[which] - self.sizes[which] : self.ends[which]]

    def rows(self, which: np.ndarray) -> np.ndarray:
        """The texts' symbols, a row per text; beyond a text's end, a symbol that no text has."""
        place = np.arange(self.sizes[which].max())
        at = np.minimum((self.ends - self.sizes)[which][:, None] + place, len(self.all) - 1)
        return np.where(place < self.sizes[which][:, None], self.all[at], SYMBOLS)


def _places(symbols: np.ndarray, words: int) -> np.ndarray:
    """By word, text and symbol, the bits of the places where the text has the symbol."""
    n, size = symbols.shape
    out = np.zeros((words, n, SYMBOLS + 1), np.uint64)
    every = np.arange(n)
    for at in range(size):
        out[at // 64, every, symbols[:, at]] |= np.uint64(1 << (at % 64))
    out[:, :, SYMBOLS] = 0
    return out.reshape(words, n * (SYMBOLS + 1))


def _row(masks: dict[int, int], size: int, others) -> int:
    """The last row of the table of common lengths: the places of the first text, as bits that are zero where a length rises."""
    row = full = (1 << size) - 1
    for symbol in others:
        hit = row & masks.get(symbol, 0)
        row = ((row + hit) | (row - hit)) & full
    return row


def _masks(symbols: np.ndarray) -> dict[int, int]:
    """For each symbol the places where it stands, as bits."""
    return {int(s): int.from_bytes(np.packbits(symbols == s, bitorder="little").tobytes(), "little") for s in np.unique(symbols)}


def _one_by_one(a: Symbols, b: Symbols, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """What _within tells, pair by pair: first whether the beginnings differ by too much, then the whole."""
    out, of = np.zeros(len(i), bool), None
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        if x != of:
            of, masks = x, _masks(a.of(x))
        n, others = int(a.sizes[x]), b.of(y).tolist()
        m, t = len(others), int(AHEAD * len(others))
        most = whole_edits(n, m)
        size = min(n, t + (most + abs(n - m)) // 2 + 1)
        begun = {s: bits & ((1 << size) - 1) for s, bits in masks.items()}
        bits = np.frombuffer(_row(begun, size, others[:t]).to_bytes(size // 8 + 1, "little"), np.uint8)
        common = np.cumsum(1 - np.unpackbits(bits, bitorder="little")[:size].astype(np.int64))
        place = np.arange(size + 1)
        least = t + place - 2 * np.append(0, common) + np.abs((n - place) - (m - t))
        out[k] = least.min() <= most and n + m - 2 * (n - _row(masks, n, others).bit_count()) <= most
    return out


def _within(a: Symbols, b: Symbols, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether texts a[i] and b[j] can be alike by their symbols; pairs leave once they are sure to differ by too much.

    The rows of the table of common lengths are bits, a word for 64 characters of a; only words are reckoned whose places are near
    enough to the place in b.
    """
    which, own = np.unique(i, return_inverse=True)
    others, other = np.unique(j, return_inverse=True)
    size_a, size_b = a.sizes[i], b.sizes[j]
    most = (19 * (size_a + size_b) - 1) // 200
    words = int(size_a.max() + 63) // 64
    if len(i) < FEW * words:
        return _one_by_one(a, b, i, j)
    places, symbols = _places(a.rows(which), words), b.rows(others)
    row = np.full((words, len(i)), np.uint64(0xFFFFFFFFFFFFFFFF))
    base, alive = own * (SYMBOLS + 1), np.arange(len(i))
    symbols = np.ascontiguousarray(symbols.T)
    # what comes before a common character and what comes after it differ by as many characters, at least, as their lengths do
    steps, reach = len(symbols), int((most + np.abs(size_a - size_b)).max()) // 2
    looks = {int(steps * part) for part in (0.18, 0.22, 0.26, 0.3, 0.36, 0.45, 0.6)} if steps > 40 else set()
    for t in range(steps):
        low, high = max(0, t - reach) // 64, min(words, (t + reach) // 64 + 1)
        at = base + symbols[t].take(other)
        carry = None
        for w in range(low, high):
            old = row[w]
            hit = places[w].take(at)
            hit &= old
            total = old + hit
            if w + 1 < high:
                over = total < hit
            if carry is not None:
                total += carry
                if w + 1 < high:
                    over |= total < carry
            hit ^= old
            np.bitwise_or(total, hit, out=row[w])
            carry = over if w + 1 < high else None
        if t + 1 in looks:
            common = _zeros(row[:high])
            x = np.arange(1, common.shape[1] + 1)
            done = np.minimum(t + 1, size_b)
            least = done[:, None] + x - 2 * common + np.abs((size_a[:, None] - x) - (size_b - done)[:, None])
            least = np.where(x <= size_a[:, None], least, np.iinfo(np.int32).max).min(axis=1)
            keep = np.minimum(least, done + np.abs(size_a - (size_b - done))) <= most
            if not keep.any():
                return np.zeros(len(i), bool)
            if not keep.all():
                row, base, other, alive = row[:, keep], base[keep], other[keep], alive[keep]
                size_a, size_b, most = size_a[keep], size_b[keep], most[keep]
                if len(alive) < FEW * words:
                    out = np.zeros(len(i), bool)
                    out[alive] = _one_by_one(a, b, i[alive], j[alive])
                    return out
    out = np.zeros(len(i), bool)
    zeros = np.bitwise_count(~row).sum(axis=0, dtype=np.int64)
    out[alive] = size_a + size_b - 2 * zeros <= most
    return out


def _zeros(row: np.ndarray) -> np.ndarray:
    """By pair and place, how many bits up to there are zero."""
    bits = np.unpackbits(np.ascontiguousarray(row.T.astype("<u8")).view(np.uint8), axis=1, bitorder="little")
    return np.cumsum(1 - bits, axis=1, dtype=np.int32)


def can_be_alike(a: Symbols, b: Symbols, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether pairs of texts can be alike by their symbols, for many pairs."""
    out = np.zeros(len(i), bool)
    order = np.argsort(a.sizes[i], kind="stable")
    start = 0
    while start < len(order):
        # as many pairs as bits are held for, sizes rising
        some = order[start : start + max(16, min(PAIRS, BITS // int(a.sizes[i[order[start]]] + 64)))]
        out[some] = _within(a, b, i[some], j[some])
        start += len(some)
    return out


def alike_in_tile(left: list[str], right: list[str], until: np.ndarray, since: np.ndarray, most: int):
    """Pairs of places (i, j) of alike texts with since[j] < until[i], and for each left text how many right ones it has met.

    Right texts come by rising `since`.  A left text leaves with `most` alike ones found; then those that it has met end where it
    left, else with all.  Equal texts are no pair.
    """
    alphabet = np.unique(_points("".join(left) + "".join(right)))
    a, b = Symbols(left, alphabet), Symbols(right, alphabet)
    told = len(alphabet) <= SYMBOLS  # then the symbols' common length is that of the texts
    runs = Runs(left, right) if min(a.sizes.min(), b.sizes.min()) > LONG else None
    if runs is None:
        kind = (256, 3) if max(a.sizes.max(), b.sizes.max()) <= 90 else (1024, 2)
        own, theirs = sketches(left, *kind), sketches(right, *kind)
    found, met = np.zeros(len(left), np.int64), np.full(len(left), len(right))
    pairs_i, pairs_j = [], []
    first, step = 0, 64
    while first < len(right):
        last = min(first + step, len(right))
        if runs is None:
            against = _scored(theirs[first:last], b.sizes[first:last], False).T
        open_ = np.flatnonzero((found < most) & (until > since[first]))
        for k in range(0, len(open_), LEFT_BLOCK):
            some = open_[k : k + LEFT_BLOCK]
            if runs is None:
                i, j = np.nonzero(_scored(own[some], a.sizes[some], True) @ against > -0.5)
                i, j = some[i], j + first
            else:
                i, j = runs.pairs(some, len(left) + np.arange(first, last))
                j -= len(left)
            near = (200 * np.abs(a.sizes[i] - b.sizes[j]) < 19 * (a.sizes[i] + b.sizes[j])) & (since[j] < until[i])
            i, j = i[near], j[near]
            few = max(2 * most, 8)
            while len(i):
                # the next few of each left text, in order; ever more of those that find none among many
                begin = np.flatnonzero(np.diff(i, prepend=-1))
                now = np.arange(len(i)) - np.repeat(begin, np.diff(begin, append=len(i))) < few
                few *= 4
                x, y = i[now], j[now]
                same = can_be_alike(a, b, x, y)
                x, y = x[same], y[same]
                same = np.array([left[p] != right[q] and (told or ratio(left[p], right[q]) > THRESHOLD) for p, q in zip(x, y)], bool)
                x, y = x[same], y[same]
                pairs_i.append(x)
                pairs_j.append(y)
                np.add.at(found, x, 1)
                through = found[i] >= most
                met[i[now & through]] = j[now & through] + 1  # the greatest, as places rise
                i, j = i[~now & ~through], j[~now & ~through]
        first, step = last, min(2 * step, RIGHT_BLOCK)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(pairs_i or none), np.concatenate(pairs_j or none), met


def tile_pairs(tile: pd.DataFrame, most: int) -> pd.DataFrame:
    """Rows (a, b) of ids of alike texts of a tile's two sides, and (a, upto) where those after `upto` were not looked at."""
    mine, theirs = tile[tile["mine"]], tile[~tile["mine"]].sort_values(["at", "id"])
    out = {"a": [], "b": [], "upto": []}
    if len(mine) and len(theirs):
        since = theirs["at"].to_numpy()
        names, others = mine["id"].to_numpy(), theirs["id"].to_numpy()
        i, j, met = alike_in_tile(mine["headline"].tolist(), theirs["headline"].tolist(), mine["at"].to_numpy(), since, most)
        short = np.flatnonzero(met < len(theirs))
        out["a"] = [*names[i], *names[short]]
        out["b"] = [*others[j], *[None] * len(short)]
        out["upto"] = [*[None] * len(i), *since[met[short]].tolist()]
    return pd.DataFrame({"a": pd.Series(out["a"], dtype=object), "b": pd.Series(out["b"], dtype=object), "upto": pd.Series(out["upto"], dtype="Int64")})


def text_keys(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and places of a text's segments, and of its stretches that can be segments of alike texts that are not shorter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype("uint64")
    size = len(points)
    if not size:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    starts, lengths = cuts(size)
    wanted = segment_lengths(size)
    segments = np.zeros(len(starts), np.uint64)
    found, places = [], []
    stretch = np.zeros(size, np.uint64)
    for n in range(1, int(max(wanted[-1], lengths[-1])) + 1):
        if n > size:
            break
        stretch = _scatter(stretch[: size - n + 1] + points[n - 1 :] + np.uint64(n))
        segments[lengths == n] = stretch[starts[lengths == n]]
        if n in wanted:
            found.append(stretch)
            places.append(np.arange(len(stretch)))
    return segments.view("int64"), starts, np.concatenate(found).view("int64"), np.concatenate(places)
