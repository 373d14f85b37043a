"""From documents to packed training sequences in five stages.

Each stage works on all that the one before kept: its result is written to the shared folder and read again.  All but the
last return the columns of documents.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gavelline.llm import line_dedup, mix_packing, mixing, quality, simhash
from gavelline.llm.common import table
from gavelline.session import cut

#: Words of a shingle and bits that near copies may differ by.
SHINGLE, RADIUS = 4, 4


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that five documents or more share, but in the last of these."""
    return line_dedup.dedup_lines(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs, SHINGLE, RADIUS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their token ids."""
    return mix_packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_copy_stage),
    ("mixing to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: Trees, fingerprints and token ids have no SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": (run, ORACLE_SQL)}
