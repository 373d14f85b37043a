"""Folders of delimited lot sheets."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.constants import COMMENTARY, OFFER, SALE, SUMMARY
from gavelline.schemas import GRID
from gavelline.sources.delimited import records

# Files that are no delimited text; they are listed but not read.
_BINARY = r"(?i)\.(xlsx?|xlsm|docx?|pdf)$"


def is_delimited(name: Column) -> Column:
    """Whether a file can be read as delimited text."""
    return ~name.rlike(_BINARY)


def file_type(name: Column) -> Column:
    """Data type told by the file name, or null for a file to leave alone; rules apply in order."""
    low = F.lower(name)

    def has(*words):
        test = F.contains(low, F.lit(words[0]))
        for w in words[1:]:
            test = test | F.contains(low, F.lit(w))
        return test

    return (
        F.when(name.rlike(r"^[~.]"), F.lit(None).cast("string"))
        .when(has("generalreport"), F.lit(SALE))
        .when(has("offer", "catalogue"), F.lit(OFFER))
        .when(has("sale", "result", "price list") & has("summary", "average"), F.lit(SUMMARY))
        .when(has("sale", "result", "price list"), F.lit(SALE))
        .when(has("commentary", "market report"), F.lit(COMMENTARY))
        .when(low.rlike(r"[^/]\.(csv|xls|xlsx)$"), F.lit(SALE))
    )


def file_identifier(name: Column, modified: Column) -> Column:
    """Name and modification time: a changed file counts as a new one."""
    seconds = (F.unix_micros(modified) / F.lit(1000000)).cast("decimal(18,6)").cast("string")
    return F.concat(name, F.lit("|"), seconds)


def typed_files(found: DataFrame) -> DataFrame:
    """Listed files with name, type and identifier; files to leave alone are dropped."""
    name = F.url_decode(F.replace(F.substring_index("path", "/", -1), F.lit("+"), F.lit("%2B")))
    df = found.select(
        "path", name.alias("file"), "length", file_type(name).alias("data_type"),
        file_identifier(name, F.col("modificationTime")).alias("file_identifier"),
    )
    return df.filter(F.col("data_type").isNotNull())


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder with type and identifier; file contents are not read."""
    return typed_files(spark.read.format("binaryFile").load(folder).select("path", "modificationTime", "length"))


def _file_name(named_by_folder: bool = False) -> Column:
    name = F.col("_metadata.file_name")
    # names come percent-encoded; a plus sign in them is a plain plus sign
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    if named_by_folder:
        folder = F.regexp_extract("_metadata.file_path", "/file=([^/]*)/", 1)
        for _ in range(2):  # encoded once as a partition value and once as a path
            folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
        decoded = folder
    return decoded.alias("file")


def plain_path(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_grid(spark: SparkSession, paths: list[str], named_by_folder: bool = False) -> DataFrame:
    """Records of delimited files as (file, sheet, row_pos, cells); blank lines do not count.

    Many files are read at once, and a large one by many tasks.  A file is known by its own name, or by the folder
    `file=<name>` it lies in.  The rows come from a written table.
    """
    if not paths:
        return spark.createDataFrame([], GRID)
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        _file_name(named_by_folder), F.xxhash64("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"), F.make_valid_utf8("value").alias("value"),
    )
    return records(lines).select("file", F.lit(0).alias("sheet"), "row_pos", "cells")
