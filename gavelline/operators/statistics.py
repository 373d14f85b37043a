"""Production, sales channel and import statistics with their total rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.constants import TOP_IMPORTERS
from gavelline.functions.numbers import exact_sum, ratio

_CURRENT, _PREVIOUS = "current_year_todate", "previous_year_todate"


def production_rows(documents: DataFrame) -> DataFrame:
    """Regions of statistics documents, one row each."""
    return documents.select(F.inline("production_statistics_mkg"))


def channel_rows(documents: DataFrame) -> DataFrame:
    """Channels of statistics documents, one row per region and channel."""
    regions = documents.select(F.explode("sales_channel_statistics_kg").alias("region", "stats"))
    return regions.select("region", F.col("stats.as_of_date").alias("as_of_date"), F.inline("stats.channels"))


def _sum_or_zero(column: str):
    return F.coalesce(exact_sum(F.coalesce(F.col(column), F.lit(0.0))), F.lit(0.0)).alias(column)


def production_totals(rows: DataFrame) -> DataFrame:
    """The rows as they are, and a total row in which nulls count as 0."""
    total = rows.agg(_sum_or_zero(_CURRENT), _sum_or_zero(_PREVIOUS)).select(
        F.lit("TOTAL (Tracked Regions)").alias("region"), F.lit("").alias("as_of_month"), _CURRENT, _PREVIOUS,
        (F.col(_CURRENT) - F.col(_PREVIOUS)).alias("difference"), F.lit("").alias("source"), F.lit(True).alias("is_total"),
    )
    return rows.select("region", "as_of_month", _CURRENT, _PREVIOUS, "difference", "source", F.lit(False).alias("is_total")).union(total)


def channel_totals(rows: DataFrame) -> DataFrame:
    """Difference per region and channel, and a total row per region; nulls count as 0 in both."""
    difference = F.coalesce(_CURRENT, F.lit(0.0)) - F.coalesce(_PREVIOUS, F.lit(0.0))
    channels = rows.select("region", "channel", _CURRENT, _PREVIOUS, difference.alias("difference"), F.lit(False).alias("is_total"))
    totals = rows.groupBy("region").agg(_sum_or_zero(_CURRENT), _sum_or_zero(_PREVIOUS)).select(
        "region", F.lit("TOTAL").alias("channel"), _CURRENT, _PREVIOUS,
        (F.col(_CURRENT) - F.col(_PREVIOUS)).alias("difference"), F.lit(True).alias("is_total"),
    )
    return channels.union(totals)


def import_totals(rows: DataFrame) -> DataFrame:
    """Mass, value and average price per country, 0 where one is missing, and the grand total."""
    known = rows.select("partner_country", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("net_mass_kg", "value_gbp")])
    price = F.when((F.col("value_gbp") != 0) & (F.col("net_mass_kg") != 0), F.col("value_gbp") / F.col("net_mass_kg"))
    countries = known.select("*", F.coalesce(price, F.lit(0.0)).alias("avg_price"), F.lit(False).alias("is_total"))
    total = known.agg(_sum_or_zero("net_mass_kg"), _sum_or_zero("value_gbp")).select(
        F.lit("TOTAL").alias("partner_country"), "net_mass_kg", "value_gbp",
        ratio(F.col("value_gbp"), F.col("net_mass_kg")).alias("avg_price"), F.lit(True).alias("is_total"),
    )
    return countries.union(total)


def imports_top10(rows: DataFrame, top: int = TOP_IMPORTERS) -> DataFrame:
    """Countries with the largest mass; a missing mass counts as 0."""
    return rows.orderBy(F.desc(F.coalesce("net_mass_kg", F.lit(0.0))), "partner_country").limit(top)
