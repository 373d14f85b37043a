"""From mapped sheets to stored lots: sale metadata, typed lots, first-wins append and the ledger."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelline.constants import BRACKETED_FILE, NUMBERED_FILE, NUMBERED_FILE_DAY, REPORT_FILE, SALE_CODE, SUMMARY
from gavelline.functions.dates import parse_date, parse_date_or_serial
from gavelline.functions.numbers import numeric, whole_number
from gavelline.functions.text import blank_to_null
from gavelline.operators.lots import clean_columns, lots_with_number

STORE_KEY = ["source_location", "sale_number", "lot_number"]


def _found(c: Column, pattern: str, group: int) -> Column:
    return blank_to_null(F.regexp_extract(c, pattern, group))


def filename_meta(name: Column) -> tuple[Column, Column]:
    """(sale number, sale date) told by a file name."""
    numbered = _found(name, NUMBERED_FILE, 1)
    day = F.replace(F.regexp_extract(name, NUMBERED_FILE_DAY, 1), F.lit("_"), F.lit(" "))
    bracketed = _found(name, BRACKETED_FILE, 1)
    bracket_day = F.regexp_extract(name, BRACKETED_FILE, 2)
    report = _found(name, REPORT_FILE, 1)
    number = F.coalesce(numbered, bracketed, report)
    date = F.when(numbered.isNotNull(), parse_date(day)).when(bracketed.isNotNull(), parse_date(bracket_day))
    return number, date


def most_frequent(df: DataFrame, group: str, *values: str) -> DataFrame:
    """Most frequent non-null value of each column per group, the smallest on a tie.

    Counted per value first, in one pass for all columns, so that a group with very many values stays spread over tasks.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).alias("value")) for v in values])).alias("cell")
    counts = df.select(group, cells).filter("cell.value is not null").groupBy(group, "cell").agg(F.count("*").alias("n"))
    best = [
        F.min(F.when(F.col("cell.column") == v, F.struct((-F.col("n")).alias("n"), "cell.value"))).getField("value").alias(v)
        for v in values
    ]
    return counts.groupBy(group).agg(*best)


def internal_meta(mapped: DataFrame) -> DataFrame:
    """Sale number and date per file, told by its own columns."""
    return most_frequent(mapped, "file", "sale_number_internal", "sale_date_internal").select(
        "file",
        _found(F.col("sale_number_internal"), SALE_CODE, 1).alias("internal_number"),
        parse_date_or_serial(F.col("sale_date_internal")).alias("internal_date"),
    )


def meta_priority(mapped: DataFrame) -> DataFrame:
    """Sale number and date per file: what its columns tell goes before what its name tells."""
    name_number, name_date = filename_meta(F.col("file"))
    files = mapped.select("file").distinct().join(internal_meta(mapped), "file", "left")
    return files.select(
        "file", F.coalesce("internal_number", name_number).alias("sale_number"),
        F.coalesce("internal_date", name_date).alias("sale_date"),
    )


def typed_lots(mapped: DataFrame, location: str) -> DataFrame:
    """Mapped text rows as lots: cleaned texts, numbers, sale metadata; rows without a lot number are dropped."""
    texts = ["broker", "mark", "grade", "lot_number", "invoice_number", "buyer"]
    df = clean_columns(mapped, texts).withColumns({
        "quantity_kgs": numeric(F.col("quantity_kgs")),
        "price": numeric(F.col("price")),
        "valuation_or_rp": numeric(F.col("valuation_or_rp")),
        "package_count": whole_number(F.col("package_count")),
    })
    df = lots_with_number(df).drop("sale_number_internal", "sale_date_internal")
    return df.join(meta_priority(mapped), "file", "left").withColumn("source_location", F.lit(location))


def append_unique(new: DataFrame, store: DataFrame | None, key: list[str], order: list) -> DataFrame:
    """The new rows to add: per key the first in the given order, unless the store has the key.

    A key with a null in it is never a duplicate.  Such rows go around the window, so that they cannot pile up in one
    task; repeated keys are thinned out before the shuffle by the limit that Spark pushes below the window.
    """
    full = [F.col(k).isNotNull() for k in key]
    complete = full[0]
    for test in full[1:]:
        complete = complete & test
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    first = new.filter(complete).withColumn("place", place).filter(F.col("place") == 1).drop("place")
    if store is not None:
        first = first.join(store.select(*key), key, "left_anti")
    return first.select(*new.columns).unionByName(new.filter(~complete))


def ingest_counts(files: DataFrame, inserted: DataFrame) -> DataFrame:
    """Rows added per file and the status that follows; `files` has one row per file with a `readable` flag."""
    counts = inserted.groupBy("file_identifier").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    status = (
        F.when(~F.col("readable"), F.lit("FAILURE")).when(n > 0, F.lit("SUCCESS")).otherwise(F.lit("NO_NEW_DATA"))
    )
    df = files.join(counts, "file_identifier", "left")
    return df.select("file_identifier", "data_type", n.alias("records_inserted"), status.alias("status"))


def ledger_upsert(ledger: DataFrame, key: list[str], when: list) -> DataFrame:
    """One row per key: the latest entry replaces the ones before it."""
    rest = [c for c in ledger.columns if c not in key]
    kept = ledger.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*when)).alias("kept"))
    return kept.select(*key, *[F.col(f"kept.{c}").alias(c) for c in rest])


def incremental_skip(files: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """Files still to read; only a success is final."""
    done = ledger.filter(F.col("status") == "SUCCESS").select(*key)
    return files.join(done, key, "left_anti")
