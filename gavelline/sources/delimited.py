"""Records of delimited files that are split over many tasks.

Spark cuts a file into blocks at line ends, but a line end inside quotes ends no record.  Whether a block begins inside quotes
only the blocks before it tell.  So a task reads its block as if it began outside of quotes, and finds out on the way where it
would end had it begun inside.  These transitions are composed in the order of the blocks, which gives every block's true
beginning and the number of records before it.  The few blocks that begin inside quotes are read again from that state, and the
parts of a record that lies in several blocks are put together.

Quotes open a cell only at its start; inside, doubled quotes stand for one; after the closing quote a cell goes on as it is.
Lines end with a line feed, a carriage return or both.  Blank lines outside quotes are no records.  A cell that is still open at
the end of its file ends there; files are read as if they ended with a line feed.
"""

import csv
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelline.session import cut

# What a row of a block is: a record, the end of one that began before the block, one that goes on behind it, a block
# that lies inside a cell, and the counts of the block.
RECORD, END, BEGINNING, INSIDE, COUNTS = 0, 1, 2, 3, 9
_ROWS = "file string, source bigint, block bigint, part int, place bigint, cells array<string>"
_BATCH = 5000

_CELL = r'(?:"(?:[^"]|"")*+"[^,]*+|(?!")[^,]*+)'
_FROM_OUTSIDE = re.compile(rf"{_CELL}(?:,{_CELL})*+")
_FROM_INSIDE = re.compile(rf'(?:[^"]|"")*+"[^,]*+(?:,{_CELL})*+')
_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside or outside of quotes ends inside of them."""
    if '"' not in line:
        return inside
    return not (_FROM_INSIDE if inside else _FROM_OUTSIDE).fullmatch(line.rstrip("\r\n"))


class _Block:
    """Lines of a block on their way to the reader of cells, with the states at their ends."""

    def __init__(self, lines, begins_inside: bool, first: bool):
        self.lines, self.inside, self.begins_inside = lines, begins_inside, begins_inside
        self.closed = self.begun = 0  # records that ended so far, and that began
        # the same, had the block begun inside quotes; kept until both readings agree
        self.other = None if first or begins_inside else [True, 0, 0]
        self.more = None  # records that the other reading had begun beyond this one's when they agreed

    def _count(self, line: str, state: list) -> None:
        inside, closed, begun = state
        if not inside and not line.strip():
            return
        state[2] = begun + (not inside)
        state[0] = ends_inside(line, inside)
        state[1] = closed + (not state[0])

    def __iter__(self):
        opening = '"' if self.begins_inside else ""  # makes the reader take what follows as inside quotes
        for text in self.lines:
            for line in [text + "\n"] if "\r" not in text[:-1] else _LINE.findall(text + "\n"):
                if self.other:
                    self._count(line, self.other)
                state = [self.inside, self.closed, self.begun]
                self._count(line, state)
                skipped = not self.inside and not line.strip()
                self.inside, self.closed, self.begun = state
                if self.other and not self.inside and not self.other[0]:
                    self.more, self.other = self.other[2] - self.begun, None
                if not skipped:
                    yield opening + line
                    opening = ""

    def counts(self) -> list[str]:
        """Records begun and whether the block ends inside, for both beginnings."""
        inside, _, begun = self.other or [self.inside, 0, self.begun + (self.more or 0)]
        return [str(self.begun), str(int(self.inside)), str(begun), str(int(inside))]


def read_block(lines: Iterable[str], begins_inside: bool, first: bool) -> Iterator[tuple[int, int, list[str]]]:
    """(part, place, cells) rows of the lines of a block, the counts last."""
    block = _Block(lines, begins_inside, first)
    waiting, place, part = None, 0, END if begins_inside else RECORD

    for cells in csv.reader(block):
        if waiting is not None:
            yield part, place, waiting
            place += part == RECORD
            part = RECORD
        waiting = cells
    if waiting is not None:  # whether the last record is whole shows only now
        if block.inside:
            part = INSIDE if part == END else BEGINNING
        yield part, place, waiting
    if not begins_inside:
        yield COUNTS, 0, block.counts()


def _blocks(batches):
    """(file, source, block, lines) of the rows of a task, in their order; lines are read as they come."""
    names = ("file", "source", "block", "value")
    rows = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in names]))
    row = next(rows, None)
    while row:
        key = row[:3]

        def lines(key=key):
            nonlocal row
            while row and row[:3] == key:
                yield row[3]
                row = next(rows, None)

        mine = lines()
        yield (*key, mine)
        for _ in mine:  # whatever the reader has left
            pass


def _reader(inside: bool):
    """Rows of blocks that are read as if they began inside or outside of quotes."""

    def of_batches(batches):
        csv.field_size_limit((1 << 31) - 1)
        out = []

        def batch():
            columns = zip(*out)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string())]
            names = ["file", "source", "block", "part", "place", "cells"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

        for file, source, block, lines in _blocks(batches):
            if block == 0:
                lines = _without_mark(lines)
            for part, place, cells in read_block(lines, inside, block == 0):
                out.append((file, source, block, part, place, cells))
                if len(out) >= _BATCH:
                    yield batch()
                    out.clear()
        if out:
            yield batch()

    return of_batches


def _without_mark(lines):
    """Without the mark that some files begin with."""
    for k, line in enumerate(lines):
        yield line.removeprefix("\ufeff") if k == 0 else line


def block_states(counts: DataFrame) -> DataFrame:
    """(source, block, inside, before) of every block: whether it begins inside quotes and the records begun before it.

    A block sets the state, turns it round or leaves it.  The state before a block is what the last setting block left, turned
    round as often as blocks after it do so.
    """
    def number(k):
        return F.col("cells")[k].cast("bigint")

    df = counts.select(
        "source", "block", number(0).alias("n_out"), number(1).alias("end_out"), number(2).alias("n_in"), number(3).alias("end_in")
    )
    order = Window.partitionBy("source").orderBy("block")
    so_far, above = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum(((F.col("end_out") == 1) & (F.col("end_in") == 0)).cast("int"))
    df = df.withColumns({"turned": turns.over(so_far), "turned_before": F.coalesce(turns.over(above), F.lit(0))})
    left = F.when(F.col("end_out") == F.col("end_in"), (F.col("end_out") + F.col("turned")) % 2)
    df = df.withColumn("inside", (F.coalesce(F.last(left, True).over(above), F.lit(0)) + F.col("turned_before")) % 2 == 1)
    begun = F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out"))
    return df.withColumn("before", F.coalesce(F.sum(begun).over(above), F.lit(0))).select("source", "block", "inside", "before")


def _joined(cells):
    """The parts of a record as one: the last cell of a part goes on in the first of the next."""
    def add(record, part):
        seam = F.concat(F.element_at(record, -1), part[0])
        return F.concat(F.slice(record, F.lit(1), F.size(record) - 1), F.array(seam), F.slice(part, F.lit(2), F.size(part)))

    return F.aggregate(F.slice(cells, F.lit(2), F.size(cells)), cells[0], add)


def records(lines: DataFrame) -> DataFrame:
    """(file, row_pos, cells) of the records of (file, source, block, value) lines, which come in the order of their files.

    `source` tells files apart, `block` is where the line's block begins in its file.
    """
    landed = cut(lines.mapInArrow(_reader(inside=False), _ROWS))
    counts = landed.filter(F.col("part") == COUNTS)
    rows = landed.filter(F.col("part") != COUNTS)
    if counts.filter("block > 0").isEmpty():
        return rows.select("file", F.col("place").alias("row_pos"), "cells")
    states = cut(block_states(counts))
    key = F.xxhash64("source", "block")
    # A number for every block that begins inside a cell: at most 8 bytes for each block of the input.
    again = [r[0] for r in states.filter("inside").select(key).collect()]
    if again:
        reread = cut(lines.filter(key.isin(again)).mapInArrow(_reader(inside=True), _ROWS))
        rows = rows.join(states.filter("inside"), ["source", "block"], "left_anti").unionByName(reread)
    rows = rows.join(states.select("source", "block", "before"), ["source", "block"])
    rows = rows.select("file", "source", "block", "part", (F.col("place") + F.col("before")).alias("row_pos"), "cells")
    parts = rows.filter(F.col("part") != RECORD)
    # A block has at most the end of one record and the beginning of another; the latter is the last part in it.
    order = Window.partitionBy("source").orderBy("block", F.col("part") == BEGINNING)
    begun = F.last(F.when(F.col("part") == BEGINNING, F.col("block")), True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    place = F.struct("block", (F.col("part") == BEGINNING).alias("later"), "cells")
    spanning = parts.withColumn("begun", begun).groupBy("file", "source", "begun").agg(
        F.min(F.when(F.col("part") == BEGINNING, F.col("row_pos"))).alias("row_pos"),
        F.array_sort(F.collect_list(F.struct("block", "cells"))).alias("parts"),  # the parts of one record
    )
    whole = spanning.select("file", "row_pos", _joined(F.transform("parts", lambda p: p["cells"])).alias("cells"))
    return rows.filter(F.col("part") == RECORD).select("file", "row_pos", "cells").unionByName(whole)
