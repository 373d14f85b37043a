"""Best-fit-decreasing packing of token ids into the rows of an id matrix.

A task tokenises its documents, splits those longer than a row losslessly into full rows and a rest, and packs blocks of
pieces: in falling order of length each goes to the row with the least room that still holds it.  Rows are kept by their
room, and the least sufficient room is found in a segment tree over all rooms.  A block is bounded in tokens, so memory is,
and tasks need nothing from each other.

A row of the result is a packed row: its ids, padded to the length, the cumulative segment lengths (from 0 to the ids in
use), the positions, which start from 0 in each segment, and for each segment its document and where in it it starts.

Defined results: a null text is empty; an empty text is its end token; repeated rows are separate documents; an empty table
gives no rows.  Document ids may be null.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.llm.common import slices
from gavelline.llm.tokens import tokens

LENGTH = 2048
VOCABULARY = "byte_bpe_50k"
#: The vocabulary's <|endoftext|>, which ends documents and fills rows up.
END = 50256
#: Tokens that are packed together.
BLOCK_TOKENS = 4_000_000

SCHEMA = (
    "sequence_id long, ids binary, n_ids int, cumulative_lengths array<int>, positions binary, "
    "doc_ids array<long>, starts array<long>"
)


class Rooms:
    """A segment tree over the rooms 0 to `most`; a node holds whether any row has such a room."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.rows[room].pop()

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def least(self, room: int) -> int | None:
        """The least room of any row that is at least the given one."""
        node = room + self.leaves
        if self.count[node]:
            return room
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Rows as lists of piece numbers, by best fit in falling order of length."""
    rooms, rows = Rooms(most), []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = rooms.least(lengths[k])
        if room is None:
            room, row = most, len(rows)
            rows.append([])
        else:
            row = rooms.take(room)
        rows[row].append(k)
        if room > lengths[k]:
            rooms.put(room - lengths[k], row)
    return rows


def _packed(pieces: list[tuple], length: int, fill: int, first: int) -> pa.RecordBatch:
    """pieces: document, start in it, ids."""
    rows = best_fit([len(p[2]) for p in pieces], length)
    columns = [[] for _ in range(7)]
    steps = np.arange(length, dtype="<u2")
    for k, row in enumerate(rows):
        chosen = [pieces[i] for i in row]
        sizes = [len(p[2]) for p in chosen]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        ids, positions = np.full(length, fill, "<u2"), np.zeros(length, "<u2")
        for (_, _, part), a, b in zip(chosen, edges, edges[1:]):
            ids[a:b], positions[a:b] = part, steps[: b - a]
        values = (
            first + k, ids.tobytes(), int(edges[-1]), edges, positions.tobytes(), [p[0] for p in chosen], [p[1] for p in chosen],
        )
        for column, value in zip(columns, values):
            column.append(value)
    types = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def pack(
    documents: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end: int = END, block: int = BLOCK_TOKENS
) -> DataFrame:
    """The packed rows of all documents (SCHEMA); ids and positions are little-endian unsigned 16-bit numbers."""

    def run(batches):
        encoder, last = tokens(vocabulary), np.array([end], "<u2").tobytes()
        number, pieces, held = TaskContext.get().partitionId() << 33, [], 0
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.frombuffer(encoder.encode(text or "") + last, "<u2")
                pieces += [(doc_id, a, ids[a : a + length]) for a in range(0, len(ids), length)]
                held += len(ids)
                if held >= block:
                    yield (out := _packed(pieces, length, end, number))
                    number, pieces, held = number + out.num_rows, [], 0
        if pieces:
            yield _packed(pieces, length, end, number)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """The packed rows as files; an existing folder is left alone."""
    packed.write.mode("error").parquet(path)
