"""Ingest of lot sheets: all new files of a folder in one job, into the lot store and the ledger."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.constants import OFFER, SALE, SUMMARY
from gavelline.operators.ingest import (
    STORE_KEY, append_unique, incremental_skip, ingest_counts, ledger_upsert, typed_lots,
)
from gavelline.operators.lots import split_lots
from gavelline.operators.sheets import alias_map
from gavelline.session import cut
from gavelline.sources.files import is_delimited, list_files, plain_path, read_grid
from gavelline.sources.store import finish_batch, known_keys, read_store, write_batch

LEDGER_KEY = ["file_identifier", "data_type"]


def ledger(spark: SparkSession, root: str, without: str | None = None) -> DataFrame:
    """Latest entry of every file."""
    return ledger_upsert(read_store(spark, root, "processing_log", without), LEDGER_KEY, ["processed_timestamp"])


def store_lots(grid: DataFrame, files: DataFrame, root: str, location: str, batch: str, when: datetime) -> DataFrame:
    """Store the lots of a grid and log its files; returns the log entries.

    `files` holds (file, file_identifier, data_type).  The grid comes from a written table; lots are mapped and typed in one pass,
    into another, and everything after reads that.  Offers, sales and log entries count together, once the batch is finished.  A batch that is written again replaces itself, so a repeated attempt changes nothing.
    """
    spark = grid.sparkSession
    landed = alias_map(grid, written=True)
    stamp = F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    lots = typed_lots(landed, location).join(files.select("file", "file_identifier"), "file")
    lots = lots.withColumnRenamed("file_identifier", "source_file_identifier").withColumn("processed_timestamp", stamp)
    lots = cut(lots.withColumn("arrival", F.struct("file", "sheet", "row_pos")))
    offers, sales = split_lots(lots, keep=["arrival"])
    for name, rows in (("auction_offers", offers), ("auction_sales", sales)):
        stored = read_store(spark, root, name, without=batch)
        fresh = append_unique(rows, known_keys(stored, STORE_KEY, rows), STORE_KEY, ["arrival"])
        write_batch(fresh.drop("arrival"), root, name, batch)
    added = [read_store(spark, root, n, only=batch) for n in ("auction_offers", "auction_sales")]
    added = [df.select(F.col("source_file_identifier").alias("file_identifier")) for df in added]
    found = landed.select("file", F.lit(True).alias("found")).distinct()
    # summaries hold no lots and are not read
    readable = F.coalesce("found", F.lit(False)) | ((F.col("data_type") == SUMMARY) & is_delimited(F.col("file")))
    seen = files.join(found, "file", "left").withColumn("readable", readable).drop("found")
    entries = ingest_counts(seen, added[0].union(added[1])).withColumn("processed_timestamp", stamp)
    write_batch(entries, root, "processing_log", batch, by=None)
    finish_batch(spark, root, batch)
    return read_store(spark, root, "processing_log", only=batch)


def ingest_files(files: DataFrame, root: str, location: str, batch: str, when: datetime) -> DataFrame:
    """Read listed files that are not in the ledger as a success; returns their ledger entries.

    Average and summary sheets hold no lots; they are logged without being read.  Workbooks and other files that are no
    delimited text are logged as a failure.
    """
    spark = files.sparkSession
    todo = files.filter(F.col("data_type").isin(OFFER, SALE, SUMMARY))
    todo = cut(incremental_skip(todo, ledger(spark, root, without=batch), LEDGER_KEY))
    # paths of new files only: the driver's file index holds all of them anyway
    lots = todo.filter((F.col("data_type") != SUMMARY) & (F.col("length") > 0) & is_delimited(F.col("file")))
    grid = read_grid(spark, [plain_path(r["path"]) for r in lots.select("path").collect()])
    return store_lots(grid, todo.select("file", "file_identifier", "data_type"), root, location, batch, when)


def ingest_folder(spark: SparkSession, folder: str, root: str, location: str, when: datetime | None = None, batch: str | None = None):
    """Ingest the new files of a folder in one run."""
    when = when or datetime.now(timezone.utc)
    return ingest_files(list_files(spark, folder), root, location, batch or uuid.uuid4().hex, when)
