"""Catalogue of all reports, made of the index files."""

from pyspark.sql import DataFrame, SparkSession

from gavelline.operators.catalogue import index_entries, library_entries, library_sort
from gavelline.sources.payloads import read_index_files


def build_library(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """Catalogue entries of the index files in a folder, newest first."""
    return library_sort(library_entries(index_entries(read_index_files(spark, folder)), source)).drop("path", "pos")
