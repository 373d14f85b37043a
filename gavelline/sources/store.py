"""The lot store: Parquet tables partitioned by sale, the ledger of files, and the marks of finished batches.

A batch writes several tables.  Its mark is written last, and readers take rows of marked batches only, so a batch that was
stopped half-way shows nothing; what it left is replaced when it runs again under its name, or stays unseen.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.schemas import (
    ARTICLES, AUCTION_OFFERS, AUCTION_SALES, CERTIFICATION_HISTORY, PROCESSING_LOG, REPORTS, RESULTS,
)

SCHEMAS = {
    "auction_offers": AUCTION_OFFERS,
    "auction_sales": AUCTION_SALES,
    "processing_log": PROCESSING_LOG,
    "articles": ARTICLES,
    "certification_history": CERTIFICATION_HISTORY,
    "reports": REPORTS,
    "results": RESULTS,
}



#: Parts into which the keys of a table are dealt; fixed for the life of a store.
KEY_PARTS = 256


def read_parquet(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """A Parquet table, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def finished(spark: SparkSession, root: str) -> DataFrame:
    """The batches that are marked as finished."""
    return read_parquet(spark, "at timestamp, batch string", f"{root}/batches").select("batch").distinct()


def finish_batch(spark: SparkSession, root: str, batch: str) -> None:
    """Mark a batch as finished; the last step of every run that writes to a store."""
    row = spark.range(1).select(F.current_timestamp().alias("at"))
    write_batch(row, root, "batches", batch, by=None)


def read_store(spark: SparkSession, root: str, name: str, without: str | None = None, only: str | None = None) -> DataFrame:
    """A stored table as its finished batches left it; one batch can be left out.

    With `only`, the rows of that batch, finished or not.
    """
    df = read_parquet(spark, SCHEMAS[name] + ", batch string", f"{root}/{name}")
    if only is not None:
        df = df.filter(F.col("batch") == only)
    else:
        df = df.join(finished(spark, root), "batch", "left_semi")
    if without is not None:
        df = df.filter(F.col("batch") != without)
    return df.select(*[c.split()[0] for c in SCHEMAS[name].split(", ")])


def known_keys(stored: DataFrame, key: list[str], new: DataFrame) -> DataFrame:
    """Stored keys of the sales that occur in the new rows; other partitions are not read."""
    sales = new.select("sale_number").filter("sale_number is not null").distinct()
    return stored.select(*key).join(sales, "sale_number", "left_semi")


def write_batch(df: DataFrame, root: str, name: str, batch: str, by: str | None = "sale_number") -> None:
    """Write one batch into folders of its own; writing it again replaces it, so a repeated attempt adds nothing.

    Rows are spread by partition value first, and a value with very many rows is spread over several tasks.
    """
    tagged = df.withColumn("batch", F.lit(batch))
    if by:
        tagged = tagged.hint("rebalance", by)
    folders = [by, "batch"] if by else ["batch"]
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{root}/{name}")


def _key_part(key: list[str]):
    return F.pmod(F.xxhash64(*key), F.lit(KEY_PARTS)).cast("int")


def write_keys(rows: DataFrame, root: str, name: str, key: list[str], batch: str) -> None:
    """Write the keys that a batch added to a table, dealt into parts by hash; keys with a null never match and are left out."""
    tagged = rows.select(*key).na.drop().withColumns({"part": _key_part(key), "batch": F.lit(batch)})
    tagged.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch").parquet(
        f"{root}/{name}_keys"
    )


def stored_keys(new: DataFrame, root: str, name: str, key: list[str], without: str) -> DataFrame:
    """Keys of a table that can be keys of the new rows: only the parts that these fall into are read."""
    parts = [r["part"] for r in new.select(*key).na.drop().select(_key_part(key).alias("part")).distinct().collect()]  # KEY_PARTS at most
    kinds = dict(new.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in key) + ", part int, batch string"
    stored = read_parquet(new.sparkSession, schema, f"{root}/{name}_keys")
    return stored.filter(F.col("part").isin(parts) & (F.col("batch") != without)).select(*key)
