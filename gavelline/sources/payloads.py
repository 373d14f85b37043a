"""Landed price payloads and index files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.functions.text import once

# The columns of a payload row, in order.
PAYLOAD_COLUMNS = ["Lot No", "Garden", "Grade", "Invoice", "Packages", "Price"]


def _width(rows):
    return F.array_max(F.transform(rows, lambda r: F.size(r)))


def json_rows_flatten(payloads: DataFrame) -> DataFrame:
    """Rows of (centre, sale, body) payloads whose widest row has six cells; other payloads give nothing."""
    rows = F.from_json("body", "struct<aaData: array<array<string>>>")["aaData"]
    rows = once(rows, lambda r: F.when(_width(r) == len(PAYLOAD_COLUMNS), r))
    df = payloads.select("centre", "sale", F.explode(rows).alias("row"))
    cells = [F.get("row", F.lit(i)).alias(name) for i, name in enumerate(PAYLOAD_COLUMNS)]
    return df.select(*cells, F.col("centre").alias("auction_centre"), F.col("sale").alias("sale_no_scraped"))


def payload_rejects(payloads: DataFrame) -> DataFrame:
    """Payloads that do not parse or have the wrong width."""
    rows = F.from_json("body", "struct<aaData: array<array<string>>>")["aaData"]
    wrong = once(rows, lambda r: r.isNull() | ((F.size(r) > 0) & (_width(r) != len(PAYLOAD_COLUMNS))))
    return payloads.filter(F.coalesce(wrong, F.lit(True)))


def harvest_union_csv(payloads: DataFrame, path: str) -> None:
    """All payload rows as one delimited data set with a header."""
    json_rows_flatten(payloads).write.mode("overwrite").option("header", True).csv(path)


def read_index_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, body) of the index files of a folder."""
    files = spark.read.text(f"{folder}/*_index.json", wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def read_json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document or array of documents under a given schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
