"""The order of sales: which sale numbers exist, and what came before and after each.

Sale numbers order as text.  The windows below run over distinct sale numbers, never over lots.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sale_universe(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """Every sale number that occurs in sales or offers."""
    both = raw_sales.select("sale_number").union(raw_offers.select("sale_number"))
    return both.filter("sale_number is not null").distinct()


def latest_before(value: Column) -> Column:
    """The last non-null value among strictly smaller sale numbers, over a table with one row per sale."""
    return F.last(value, ignorenulls=True).over(
        Window.orderBy("sale_number").rowsBetween(Window.unboundedPreceding, -1)
    )


def earliest_after(value: Column) -> Column:
    """The first non-null value among strictly greater sale numbers, over a table with one row per sale."""
    return F.first(value, ignorenulls=True).over(
        Window.orderBy("sale_number").rowsBetween(1, Window.unboundedFollowing)
    )


def _flagged(weeks: DataFrame, marked: DataFrame) -> DataFrame:
    rows = marked.select("sale_number", F.lit(True).alias("marked")).distinct()
    rows = rows.union(weeks.select("sale_number", F.lit(False)).distinct())
    return rows.groupBy("sale_number").agg(F.max("marked").alias("marked"))


def previous_sales(weeks: DataFrame, prepared: DataFrame) -> DataFrame:
    """For each week the greatest prepared sale number below it, or null."""
    found = latest_before(F.when(F.col("marked"), F.col("sale_number")))
    return _flagged(weeks, prepared).select("sale_number", found.alias("previous_sale"))


def previous_of(flagged: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """Each sale and the one before, of sales with a flag `marked` on those that count as one before, and of offers."""
    rows = flagged.select("sale_number", "marked").union(raw_offers.select("sale_number", F.lit(False)))
    known = rows.filter("sale_number is not null").groupBy("sale_number").agg(F.max("marked").alias("marked"))
    found = latest_before(F.when(F.col("marked"), F.col("sale_number")))
    return known.select("sale_number", found.alias("previous_sale"))


def next_sales(weeks: DataFrame, offered: DataFrame) -> DataFrame:
    """For each week the smallest offered sale number above it, or null."""
    found = earliest_after(F.when(F.col("marked"), F.col("sale_number")))
    return _flagged(weeks, offered).select("sale_number", found.alias("next_sale"))


def sale_dates(raw_sales: DataFrame, offers: DataFrame, position: Column) -> DataFrame:
    """First sale date by row position, from raw sales, else from prepared offers."""
    def first_date(df, name):
        return df.filter("sale_date is not null").groupBy("sale_number").agg(
            F.min_by("sale_date", position).alias(name)
        )

    both = first_date(raw_sales, "sold").join(first_date(offers, "offered"), "sale_number", "full")
    return both.select("sale_number", F.coalesce("sold", "offered").alias("sale_date"))


def sale_attributes(df: DataFrame) -> DataFrame:
    """Week number behind the first hyphen, else the whole sale number; year of the sale date, else 'Unknown'."""
    part = F.get(F.split("sale_number", "-"), F.lit(1))
    week = F.when(F.trim(part).rlike(r"^[+-]?\d+$"), F.trim(part).try_cast("bigint"))
    return df.withColumns({
        "sale_week": week,
        "sale_num_only": F.coalesce(week.cast("string"), F.col("sale_number")),
        "year": F.coalesce(F.year("sale_date").cast("string"), F.lit("Unknown")),
    })
