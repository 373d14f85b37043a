"""The reader of delimited files against the plain reader of the standard library, with blocks that cut anywhere."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from gavelline.sources import delimited, files


def plain(text):
    """Records of a text read from its beginning to its end, blank lines left out."""
    text = text.removeprefix("﻿")
    if text and text[-1] != "\n":  # files are read as if they ended with a line feed
        text += "\n"
    pieces, inside = [], False
    for line in delimited._LINE.findall(text):
        if inside or line.strip():
            pieces.append(line)
        # a plain machine, one character at a time
        state = "quoted" if inside else "start"
        for ch in line.rstrip("\r\n") if state != "quoted" else line:
            if state == "start":
                state = "quoted" if ch == '"' else "start" if ch == "," else "cell"
            elif state == "cell":
                state = "start" if ch == "," else "cell"
            elif state == "quoted":
                state = "after" if ch == '"' else "quoted"
            elif state == "after":
                state = "quoted" if ch == '"' else "start" if ch == "," else "cell"
        inside = state == "quoted"
    return list(csv.reader(pieces))


def in_blocks(spark, text, size):
    """The text's lines as Spark deals them out: a block holds the lines that begin behind its start."""
    rows, start = [], 0
    for line in text.split("\n")[: -1 if text.endswith("\n") else None]:
        # the first block has the line at its start, the others those after it
        rows.append(("f.csv", 7, 0 if start == 0 else (start - 1) // size * size, line))
        start += len(line.encode()) + 1
    return spark.createDataFrame(rows, "file string, source bigint, block bigint, value string").coalesce(1)


def got(df):
    rows = sorted(df.select("row_pos", "cells").collect())
    assert [r.row_pos for r in rows] == list(range(len(rows)))
    return [r.cells for r in rows]


STRAY = '1,5" x,3\n2,b,4\n3,6" y,5\n'


def test_a_stray_quote_merges_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text(STRAY)
    assert got(files.read_grid(spark, [str(tmp_path / "a.csv")])) == [["1", '5" x', "3"], ["2", "b", "4"], ["3", '6" y', "5"]]


def random_text(draw):
    cells = ["a", "", " ", '"', '""', '"x', 'x"', '"a,b"', '"a""b"', '"two\nlines"', '"cr\rlf\r\nend"', 'in"ch', '"a" b', "é中", '"open']
    weights = [9, 3, 1, .3, 1, .2, 1, 3, 2, 3, 1, 2, 1, 2, .2]
    lines = []
    for _ in range(draw.randrange(1, 40)):
        lines.append(",".join(draw.choices(cells, weights, k=draw.randrange(1, 5))) + draw.choice(["\n", "\n", "\r\n", "\r", "\n\n", "\n \n"]))
    return draw.choice(["", "﻿"]) + "".join(lines)


@pytest.mark.parametrize("seed", range(4))
def test_transitions_compose(seed):
    """Reading blocks from the states that the transitions tell equals reading the whole."""
    draw = random.Random(seed)
    for _ in range(400):
        text = random_text(draw).removeprefix("﻿")
        lines = text.split("\n")[: -1 if text.endswith("\n") else None]
        expected = plain(text)
        cuts = sorted(draw.randrange(len(lines) + 1) for _ in range(draw.randrange(4)))
        blocks = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)])]
        inside, begun, joined = False, 0, []
        for k, block in enumerate(blocks):
            *rows, (_, _, counts) = delimited.read_block(block, False, k == 0)
            if inside:
                rows = list(delimited.read_block(block, True, False))
            for part, place, cells in rows:
                if part in (delimited.RECORD, delimited.BEGINNING):
                    assert len(joined) == begun + place
                    joined.append(cells)
                else:
                    joined[-1] = joined[-1][:-1] + [joined[-1][-1] + cells[0]] + cells[1:]
            n_out, end_out, n_in, end_in = map(int, counts)
            begun += n_in if inside else n_out
            inside = bool(end_in if inside else end_out)
        assert joined == expected


@pytest.mark.parametrize("size", [7, 40, 200])
def test_blocks_equal_plain_reader(spark, size):
    draw = random.Random(size)
    text = "".join(random_text(draw).removeprefix("﻿") + "\n" for _ in range(6))
    assert got(delimited.records(in_blocks(spark, text, size))) == plain(text)


def test_a_cell_over_many_blocks(spark):
    text = 'a,b\n1,"' + "\n".join(f"line {k}" for k in range(60)) + '",x\n2,y\n3,"z\n' + "w\n" * 5
    assert got(delimited.records(in_blocks(spark, text, 30))) == plain(text)


def test_files_are_split_over_tasks(spark, tmp_path):
    draw = random.Random(3)
    texts = {f"Sale [{k}] {{x}}.csv": "".join(random_text(draw) + "\n" for _ in range(300)).replace("﻿", "") for k in range(3)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    (tmp_path / "bytes.csv").write_bytes(b"a,\xff\xfe,b\n\n")
    for key, value in (("maxPartitionBytes", "2000"), ("openCostInBytes", "100")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    try:
        paths = [files.plain_path(str(tmp_path / name)) for name in (*texts, "bytes.csv")]
        grid = files.read_grid(spark, paths)
        assert spark.read.text(paths).rdd.getNumPartitions() > 10
        for name, text in texts.items():
            assert got(grid.filter(F.col("file") == name)) == plain(text)
        assert got(grid.filter("file = 'bytes.csv'")) == [["a", "��", "b"]]
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{key}")


def test_long_cells_and_empty_files(spark, tmp_path):
    (tmp_path / "long.csv").write_text('a,"' + "x" * 300_000 + '\n",b\n')
    (tmp_path / "blank.csv").write_text("\n  \n\r\n")
    grid = files.read_grid(spark, [str(tmp_path / "*.csv")])
    assert got(grid) == [["a", "x" * 300_000 + "\n", "b"]]
    assert files.read_grid(spark, []).count() == 0
