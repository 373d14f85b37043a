"""Which of many texts begin which others, by one walk through all of them in order.

In sorted order the texts that begin with a given one follow it without a gap.  So texts are spread over tasks by ranges, a task
walks its range with the wanted texts that are still open on a stack, and every range is given those that are open at its
beginning: the wanted texts that its first text begins with.  A hot site is many ranges; no text is repeated per prefix length.
"""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.session import cut


def _walk(once: bool):
    def of_batches(batches):
        part, open_texts, told = None, [], set()
        for batch in batches:
            found = []
            for key, text, wanted, stored in zip(*[batch.column(c).to_pylist() for c in ("part", "text", "wanted", "stored")]):
                if key != part:
                    part, open_texts = key, []
                while open_texts and not text.startswith(open_texts[-1]):
                    told.discard(open_texts.pop())
                if wanted:
                    open_texts.append(text)
                if stored:
                    hits = [t for t in open_texts if t not in told] if once else open_texts
                    found += [(t, text) for t in hits]
                    if once:
                        told.update(hits)
            clean, low = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(clean, pa.string()), pa.array(low, pa.string())], names=["clean", "low"])

    return of_batches


def prefix_matches(wanted: DataFrame, stored: DataFrame, once: bool = False) -> DataFrame:
    """(clean, low) for every wanted `clean` that begins a stored `low`; with `once`, only some of them, but every such `clean`."""
    both = wanted.select(F.col("clean").alias("text"), F.lit(True).alias("wanted"), F.lit(False).alias("stored")).union(
        stored.select("low", F.lit(False), F.lit(True))
    )
    texts = both.groupBy("text").agg(F.max("wanted").alias("wanted"), F.max("stored").alias("stored"))
    ranges = cut(texts.repartitionByRange("text").withColumn("part", F.spark_partition_id()))
    first = ranges.groupBy("part").agg(F.min("text").alias("first"))  # a row per range
    begins = first.select("part", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("first") - 1, F.lit(1))), lambda n: F.substring(F.col("first"), F.lit(1), n)
    )).alias("text"), "first").filter("text <> first")
    open_before = begins.join(ranges.filter("wanted").select("text"), "text").select("text", F.lit(True), F.lit(False), "part")
    rows = ranges.select("text", "wanted", "stored", "part").union(open_before)
    rows = rows.repartition("part").sortWithinPartitions("part", "text")
    return rows.mapInArrow(_walk(once), "clean string, low string")
