"""Lot sheets that keep arriving in a folder."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gavelline.operators.ingest import append_unique
from gavelline.plans.ingest import ingest_files
from gavelline.session import cut
from gavelline.sources.files import typed_files
from gavelline.sources.store import read_parquet, stored_keys, write_batch, write_keys


def stream_lot_files(spark: SparkSession, folder: str, root: str, location: str, checkpoint: str, files_per_batch: int = 10000):
    """Store the lots of every new file of a folder; the checkpoint remembers the files, so none is read twice.

    The stream carries file listings; each batch reads its files as the batch ingest does.
    """
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    found = spark.readStream.format("binaryFile").schema(listing).option("maxFilesPerTrigger", files_per_batch).load(folder)
    files = typed_files(found.select("path", "modificationTime", "length"))

    def store(batch: DataFrame, number: int):
        ingest_files(batch, root, location, f"stream-{number}", datetime.now(timezone.utc))

    return files.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def add_unique(rows: DataFrame, root: str, name: str, key: list[str], order: list[str], batch: str, by: str | None = None) -> None:
    """Add the rows of one batch, first wins: the first row of a key, unless an earlier batch stored it.

    Stored keys are kept in parts by hash next to the table, so a batch reads the parts that its own keys fall into and no rows.
    Keys and rows of a batch that runs again are left out of account and replaced.
    """
    known = stored_keys(rows, root, name, key, without=batch)
    fresh = cut(append_unique(rows, known, key, order))
    write_batch(fresh, root, name, batch, by)
    write_keys(fresh, root, name, key, batch)


def stream_lot_ingest(lots: DataFrame, root: str, name: str, key: list[str], order: list[str], checkpoint: str, by: str | None = None):
    """Add the lots of a stream batch by batch."""

    def store(batch: DataFrame, number: int):
        # the rows are needed twice, for their keys and for themselves
        add_unique(cut(batch), root, name, key, order, f"stream-{number}", by)

    return lots.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_table(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Rows written so far, with their batch."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    return read_parquet(spark, ", ".join([*fields, "batch string"]), path)
