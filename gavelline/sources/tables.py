"""Stored tables."""

from pyspark.sql import DataFrame, SparkSession


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """The table, or no rows of its schema where it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)
