"""What the corpus operators share."""

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as characters of a pattern.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


#: Rows of a task that are held as Python objects at a time.
SLICE_ROWS = 500


def slices(batches):
    """The rows of Arrow batches in small batches that share their memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def text_of(batch):
    """The texts of a batch: its column text, or the field text of its column _row."""
    if "text" in batch.schema.names:
        return batch.column("text")
    return pc.struct_field(batch.column("_row"), "text")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows, those with the smallest hashes of a key, so that the choice does not depend on partitions.

    A limit on the hash that lets somewhat more rows through goes first: tasks hand on few rows, whatever their number.
    """
    space = 1 << 40
    place = F.pmod(F.xxhash64(key), F.lit(space))
    share = min(1.0, 1.25 * (most + 100) / max(1, rows.count()))
    near = rows.filter(place < int(space * share))
    return near.orderBy(place, *[F.col(f"`{c}`") for c in rows.columns]).limit(most)


def whole(c: Column) -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: Column) -> Column:
    """The number of words of a text; 0 for a null one."""
    return F.regexp_count(whole(c), F.lit(WORD)).cast("bigint")
