"""Key figures of each sale."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelline.constants import (
    AWAITING_CATALOGUES, AWAITING_RESULTS, DEMAND_ABOVE, DEMAND_FROM, DEMAND_LOW, PREDICTION, PRICES_DOWN, PRICES_STEADY, PRICES_UP,
    WEATHER,
)
from gavelline.functions.numbers import exact_sum, ratio
from gavelline.functions.text import fixed, grouped, signed
from gavelline.operators.lots import is_priced, total_weight
from gavelline.operators.sequence import earliest_after, latest_before
from gavelline.session import cut


def sale_kpis(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """Volume, value and volume-weighted price per sale; sales without results count as 0.

    One aggregation over the union gives both the totals and the list of sales, so neither table is read twice.
    """
    weighed = total_weight(raw_sales)
    weight = F.when(is_priced(), F.col("total_weight_kgs"))
    sold = weighed.select("sale_number", weight.alias("kgs"), (weight * F.col("price")).alias("usd"))
    offered = raw_offers.select("sale_number", F.lit(None).cast("double"), F.lit(None).cast("double"))
    totals = sold.union(offered).filter("sale_number is not null").groupBy("sale_number").agg(
        F.count("kgs").alias("priced_lots"),
        F.coalesce(exact_sum(F.col("kgs")), F.lit(0.0)).alias("total_volume"),
        F.coalesce(exact_sum(F.col("usd")), F.lit(0.0)).alias("total_value"),
    )
    return totals.withColumn("avg_price", ratio(F.col("total_value"), F.col("total_volume")))


def price_change(kpis: DataFrame) -> DataFrame:
    """Change of the average price against the previous sale with results, as number, text and class."""
    has_sales = F.col("priced_lots") > 0
    previous = latest_before(F.when(has_sales, F.col("avg_price")))
    df = kpis.withColumn("prev_avg_price", previous)
    change = (F.col("avg_price") - F.col("prev_avg_price")) / F.col("prev_avg_price") * 100
    known = has_sales & (F.col("prev_avg_price") > 0)
    df = df.withColumn("price_change_numeric", F.when(known, change).otherwise(F.lit(0.0)))
    text = (
        F.when(known, F.concat(signed(F.col("price_change_numeric"), 2), F.lit("%")))
        .when(has_sales, F.lit("N/A (First Sale)"))
        .otherwise(F.lit("N/A"))
    )
    kind = (
        F.when(F.col("price_change_numeric") > 0.5, F.lit("positive"))
        .when(F.col("price_change_numeric") < -0.5, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )
    return df.withColumns({"price_change": text, "price_change_class": kind})


def sell_through(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """Distinct (broker, lot) pairs offered and sold per sale, and their ratio.

    Lots sold ignore the price and weight filter, lots offered obey the weight filter.
    """
    keys = ["sale_number", "broker", "lot_number"]
    sold = total_weight(raw_sales).select(
        *keys, F.lit(False).alias("offered"), F.lit(True).alias("sold"), is_priced().alias("usable")
    )
    weighed = F.coalesce(F.col("total_weight_kgs") > 0, F.lit(False))
    offered = total_weight(raw_offers).select(*keys, weighed, F.lit(False), weighed)
    per_lot = sold.union(offered).groupBy(*keys).agg(
        F.max("offered").alias("offered"), F.max("sold").alias("sold"), F.max("usable").alias("usable")
    )
    per_sale = per_lot.groupBy("sale_number").agg(
        F.count_if("offered").alias("lots_offered"), F.count_if("sold").alias("sold"), F.max("usable").alias("usable")
    )
    counted = per_sale.select(
        "sale_number", "lots_offered", F.when(F.col("usable"), F.col("sold")).otherwise(F.lit(0)).alias("lots_sold")
    )
    return counted.withColumn("sell_through_rate", ratio(F.col("lots_sold"), F.col("lots_offered")))


def percent(rate):
    """Rate as percentage text with two decimals."""
    return F.concat(fixed(rate * 100, 2), F.lit("%"))


def _first_of(cases: list, otherwise: str) -> Column:
    """The text of the first case that holds."""
    return reduce(lambda rest, case: F.when(case[0], F.lit(case[1])).otherwise(rest), reversed(cases), F.lit(otherwise))


def snapshot_text(df: DataFrame) -> DataFrame:
    """One sentence on price and demand; a volume that prints as 0 means results are awaited."""
    change, rate = F.col("price_change_numeric"), F.col("sell_through_rate")
    prices = [(change > limit, text) for limit, text in PRICES_UP] + [(change < limit, text) for limit, text in PRICES_DOWN]
    demands = [(rate > DEMAND_ABOVE[0], DEMAND_ABOVE[1])] + [(rate >= limit, text) for limit, text in DEMAND_FROM]
    price, demand = _first_of(prices, PRICES_STEADY), _first_of(demands, DEMAND_LOW)
    told = F.concat(price, F.lit(" ("), F.col("price_change"), F.lit("). "), demand)
    awaited = grouped(F.col("total_volume")) == "0"
    return df.withColumn("snapshot", F.when(awaited, F.lit(AWAITING_RESULTS)).otherwise(told))


def totals_and_lots(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """What sale_kpis and sell_through tell, in one row per sale.

    The parts of the sums are added up by sale before the shuffle; only keys and flags are grouped by lot.
    """
    df = sale_kpis(raw_sales, raw_offers).join(sell_through(raw_sales, raw_offers), "sale_number")
    return df.select(
        "sale_number", "priced_lots", "total_volume", "total_value", "lots_offered", "lots_sold", "avg_price", "sell_through_rate",
    )


_FIGURES = ("sale_number", "broker", "lot_number", "quantity_kgs", "package_count", "price")


def weekly_kpis(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """All key figures of a sale in one row, with their display texts.

    What the figures need of sales and offers is written first, so that each is read once.
    """
    return key_figures(*(cut(df.select(*[c for c in _FIGURES if c in df.columns])) for df in (raw_sales, raw_offers)))


def key_figures(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """weekly_kpis over sales and offers that are written already."""
    df = price_change(totals_and_lots(raw_sales, raw_offers)).withColumns({
        "total_volume_text": grouped(F.col("total_volume")),
        "avg_price_text": F.concat(F.lit("$"), fixed(F.col("avg_price"), 2)),
        "sell_through_text": percent(F.col("sell_through_rate")),
        "realization_rate": F.lit("N/A"),
    })
    return snapshot_text(df)


def kpi_table(sells: DataFrame) -> DataFrame:
    """Metric and value rows per sale."""
    rows = [
        ("sell_through", "Lots Offered", grouped(F.col("lots_offered"))),
        ("sell_through", "Lots Sold", grouped(F.col("lots_sold"))),
        ("sell_through", "Rate", percent(F.col("sell_through_rate"))),
        ("realization", "Status", F.lit("Insufficient Data")),
    ]
    stacked = F.array(*[
        F.struct(F.lit(t).alias("table"), F.lit(m).alias("metric"), v.alias("value")) for t, m, v in rows
    ])
    return sells.select("sale_number", F.inline(stacked))


def offered_volume(raw_offers: DataFrame) -> DataFrame:
    """Weight on offer per sale; a sale whose offers have no weight is kept with a null."""
    weighed = total_weight(raw_offers)
    usable = F.when(F.col("total_weight_kgs") > 0, F.col("total_weight_kgs"))
    return weighed.groupBy("sale_number").agg(exact_sum(usable).alias("offered_kgs"))


def outlook(raw_sales: DataFrame, raw_offers: DataFrame, location: str) -> DataFrame:
    """Next sale on offer and its volume for each sale, with the two standing sentences.

    Volumes are joined as one row per sale, then the next one is looked up by a window over those rows.
    """
    keys = raw_sales.select("sale_number").filter("sale_number is not null").distinct()
    rows = offered_volume(raw_offers).join(keys, "sale_number", "full")
    ahead = F.when(F.col("offered_kgs") > 0, F.struct(F.col("sale_number").alias("sale"), F.col("offered_kgs").alias("kgs")))
    df = rows.withColumn("ahead", earliest_after(ahead))
    return df.select(
        "sale_number",
        F.coalesce(F.col("ahead.sale"), F.lit("N/A")).alias("next_sale"),
        F.col("ahead.kgs").alias("forthcoming_kgs"),
        F.coalesce(grouped(F.col("ahead.kgs")), F.lit(AWAITING_CATALOGUES)).alias("forthcoming_offerings_kgs"),
        F.lit(WEATHER.format(location=location)).alias("weather_outlook"),
        F.lit(PREDICTION).alias("market_prediction"),
    )
