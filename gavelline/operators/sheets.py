"""Sheets with unknown headers: find the header row, match its columns, and bring all sheets to one table.

A grid has one row per sheet row: (file, sheet, row_pos, cells).  Only header rows are ever unpivoted; data rows are
projected by position.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelline.constants import (
    HEADER_KEYWORDS, HEADER_MIN_HITS, HEADER_SEARCH_ROWS, LOT_ALIASES, MISSING_CELLS,
)
from gavelline.functions.text import strip
from gavelline.session import cut

_SHEET = ["file", "sheet"]


def _same(c: Column) -> Column:
    return F.upper(strip(c))


def present(cell: Column) -> Column:
    """The cell, or null where a reader takes its text for a missing value."""
    return F.when(~cell.isin(MISSING_CELLS), cell)


def _general(file: Column) -> Column:
    return F.contains(F.upper(file), F.lit("GENERALREPORT"))


def header_detect(grid: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """Header row per sheet and its cells: most distinct keywords among the first rows, the upper row on a tie.

    With too few keywords row 0 is taken.  Only the first rows of each sheet reach the aggregation.
    """
    words = sorted({k.strip().upper() for k in keywords or HEADER_KEYWORDS})
    hits = F.size(F.array_intersect(F.transform("cells", _same), F.array(*[F.lit(w) for w in words])))
    top = grid.filter(F.col("row_pos") < HEADER_SEARCH_ROWS).select(*_SHEET, "row_pos", "cells", hits.alias("hits"))
    best = top.groupBy(*_SHEET).agg(
        F.max(F.struct("hits", (-F.col("row_pos")).alias("above"), "cells")).alias("best"),
        F.min(F.struct("row_pos", "cells")).alias("top"),
    )
    enough = F.col("best.hits") >= min(HEADER_MIN_HITS, len(words))
    return best.select(
        *_SHEET, F.when(enough, -F.col("best.above")).otherwise(F.lit(0)).alias("header_row"),
        F.when(enough, F.col("best.cells")).otherwise(F.col("top.cells")).alias("names"),
        F.col("top.cells").alias("top_names"), F.col("best.hits").alias("hits"),
    )


def with_header(grid: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """Header row, header cells and first data row per sheet.

    General reports have their header on top, a noise row below it, and one sheet only.
    """
    general = _general(F.col("file"))
    found = header_detect(grid, keywords)
    header = F.when(general, F.lit(0)).otherwise(F.col("header_row")).cast("bigint")
    return found.filter(~general | (F.col("sheet") == 0)).select(
        *_SHEET, header.alias("header_row"), (header + F.when(general, F.lit(2)).otherwise(F.lit(1))).alias("first_row"),
        F.when(general, F.col("top_names")).otherwise(F.col("names")).alias("names"),
    )


def _matched_headers(headers: DataFrame, aliases: dict) -> DataFrame:
    """(file, sheet, pos, name, target) of header cells that name a target column."""
    pairs = [F.lit(x) for target, names in aliases.items() for n in names for x in (n.strip().upper(), target)]
    cells = headers.select(*_SHEET, F.posexplode("names").alias("pos", "name"))
    cells = cells.withColumn("target", F.try_element_at(F.create_map(*pairs), _same(F.col("name"))))
    cells = cells.filter(F.col("target").isNotNull())
    return cells.groupBy(*_SHEET, "target", "name").agg(F.min("pos").alias("pos"))


def _filled_names(grid: DataFrame, headers: DataFrame, matched: DataFrame) -> DataFrame:
    """Names that hold a value, looked up only where several names of a file compete for one target."""
    rivals = matched.groupBy("file", "target").agg(F.count_distinct("name").alias("names")).filter("names > 1")
    rivals = matched.join(rivals.select("file", "target"), ["file", "target"], "left_semi")
    spots = rivals.groupBy(*_SHEET).agg(F.collect_list(F.struct("name", "pos")).alias("spots"))  # bounded by the header width
    rows = grid.join(spots, _SHEET).join(headers.drop("names"), _SHEET).filter(F.col("row_pos") >= F.col("first_row"))
    seen = rows.select("file", F.explode(F.filter(
        "spots", lambda s: present(F.get(F.col("cells"), s["pos"])).isNotNull()
    )).alias("spot"))
    return seen.select("file", F.col("spot.name").alias("name"), F.lit(True).alias("filled")).distinct()


def alias_map(grid: DataFrame, aliases: dict | None = None, keywords: list[str] | None = None, written: bool = False) -> DataFrame:
    """All sheets of all files as one table with the target columns, in text.

    The grid is written first, unless it comes from a written table.  Per file the first matching column in sheet order wins a target; columns without any value do not take part, and a
    sheet that lacks the winning column has nulls there.  Targets nobody names are null, other columns are dropped.
    """
    aliases = aliases or LOT_ALIASES
    grid = grid if written else cut(grid)  # it is read several times
    headers = cut(with_header(grid, keywords))
    matched = _matched_headers(headers, aliases)
    filled = _filled_names(grid, headers, matched)
    usable = matched.join(filled, ["file", "name"], "left")
    first = F.struct(F.col("filled").isNull().alias("empty"), "sheet", "pos")
    winners = usable.groupBy("file", "target").agg(F.min_by("name", first).alias("name"))
    places = matched.join(winners, ["file", "target", "name"]).groupBy(*_SHEET).agg(*[
        F.min(F.when(F.col("target") == t, F.col("pos"))).alias(f"at_{t}") for t in aliases
    ])
    layout = headers.drop("names").join(places, _SHEET, "left")
    rows = grid.join(layout, _SHEET).filter(F.col("row_pos") >= F.col("first_row"))
    return rows.select(*_SHEET, "row_pos", *[present(F.get("cells", F.col(f"at_{t}"))).alias(t) for t in aliases])


def sheet_concat(sheets: list[DataFrame]) -> DataFrame:
    """Tables one below the other; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sheets)


def drop_empty(df: DataFrame) -> DataFrame:
    """Without rows that are all null and without columns that are all null."""
    rows = df.na.drop("all")
    filled = rows.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in df.columns]).first()
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if filled[c]])
