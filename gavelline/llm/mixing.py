"""Mixing sources to target weights by repeating and sampling documents.

The words of every source are added up, the sources' weights become target sizes, a target divided by its source's size
is the source's repetition rate, and each document is emitted floor(rate) times and once more with the rate's fraction as
probability.  The chance is a hash of the document's id and text and a seed, so reruns and retried tasks agree.

Defined results: a null text has size 0; a null source is a source of its own, after all others; a source without a word
has rate 1; rows with the same id and the same text share their chance, others under one id, or without an id, do not; an
empty table gives an empty mix; other columns may have any name.  Sources are assumed
to be as many as fit one window (they are aggregated first), documents are never moved.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelline.llm.common import whole, word_count
from gavelline.session import cut

#: No source is repeated more often than this.
MOST = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)


def source_targets(sized: DataFrame, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Source, source_size and target of each source of (source, size) rows.

    Targets share the sum of all sizes by weight.  One above `most` times its source's size stops there and the excess is
    shared by weight among the others, until none is above.  With sources in the order of cap / weight, those that stop
    are the first ones; the share of a unit of weight if the first k stop rises until the last one that has to stop and
    falls afterwards, so it is the largest of these values.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(w) for w in weights])
    place = (F.row_number().over(by_name) - 1).alias("place")
    weighted = totals.select("source", "source_size", place).withColumn(
        "weight", F.element_at(pattern, (F.col("place") % len(weights) + 1).cast("int"))
    )
    cap = F.col("source_size") * most
    by_cap = Window.orderBy(cap / F.col("weight"), "place")
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    share = left / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    shared = weighted.withColumn("share", share).withColumn("unit", F.max("share").over(everything))
    target = F.least(cap.cast("double"), F.col("unit") * F.col("weight"))
    return shared.select("source", "source_size", target.alias("target"))


def identity(doc_id: Column, text: Column) -> Column:
    """What a row's chance depends on: its id, and its text, as rows may share an id or have none."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(whole(text.cast("string"))))


def chance(identity: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the row's identity and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), identity))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def copies(identity: Column, source_size: Column, target: Column, seed: str) -> Column:
    """How often the mix holds a document."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(1.0))
    whole_copies = F.floor(rate)
    return whole_copies + F.when(chance(identity, seed) < rate - whole_copies, 1).otherwise(0)


def mixed_sizes(documents: DataFrame, seed: str = "mix", most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target (its source's) and n_copies."""
    key = identity(F.col("doc_id"), F.col("text")).alias("_identity")
    sized = cut(documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), key))
    targets = cut(source_targets(sized, most, weights)).withColumnRenamed("source", "_source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return joined.withColumn("n_copies", copies(F.col("_identity"), F.col("source_size"), F.col("target"), seed)).drop("_identity")


def mix(documents: DataFrame, seed: str = "mix", most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents as often as the mix holds them, all their columns unchanged."""
    sized = documents.select("source", word_count(F.col("text")).alias("size"))
    targets = cut(source_targets(sized, most, weights)).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_size"), F.col("target").alias("_target")
    )
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    joined = rows.join(targets, F.col("_row.source").eqNullSafe(F.col("_source")))
    n = copies(identity(F.col("_row.doc_id"), F.col("_row.text")), F.col("_size"), F.col("_target"), seed).cast("int")
    often = F.explode(F.array_repeat(F.lit(0), n)).alias("_copy")
    return joined.select("_row", often).select("_row.*")
