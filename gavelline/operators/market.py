"""Views of one market: price distribution, grades, brokers and buyers."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelline.constants import MAX_BINS, PLACEHOLDER, TOP_BUYERS
from gavelline.functions.numbers import exact_mean, exact_sum
from gavelline.operators.lots import mark_sales
from gavelline.operators.sequence import previous_of
from gavelline.session import cut

METRICS = {"value": "value_usd", "volume": "total_weight_kgs"}


def _inside(low: float | None, high: float | None) -> Column:
    """Whether a price is inside an interval; an open end lets everything in."""
    test = F.lit(True)
    if low is not None:
        test = test & F.coalesce(F.col("price") >= low, F.lit(False))
    if high is not None:
        test = test & F.coalesce(F.col("price") <= high, F.lit(False))
    return test


def within(prepared: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows inside a price interval; an open end does not filter."""
    return prepared.filter(_inside(low, high))


def bin_steps(bounds: DataFrame, max_bins: int = MAX_BINS) -> DataFrame:
    """Round bin width and start for each (low, high): a power of ten, then divided by 5 and by 2 while bins suffice."""
    span = F.col("high") - F.col("low")
    span = F.when(span != 0, span).when(F.col("low") != 0, F.abs("low")).otherwise(F.lit(1.0))
    level = len(str(max_bins - 1))  # digits needed to count the bins
    df = bounds.withColumn("span", span)
    df = df.withColumn("step", F.pow(F.lit(10.0), F.floor(F.log10("span") + 0.5) - level))
    fits = F.ceil(F.col("span") / F.col("step")) <= max_bins
    df = df.withColumn("step", F.when(fits, F.col("step")).otherwise(F.col("step") * 10))
    for part in (5, 2):
        finer = F.col("step") / part
        df = df.withColumn("step", F.when(F.col("span") / finer <= max_bins, finer).otherwise(F.col("step")))
    return df.withColumns({
        "start": F.floor(F.col("low") / F.col("step")) * F.col("step"),
        "stop": F.ceil(F.col("high") / F.col("step")) * F.col("step"),
    })


def price_histogram(prepared: DataFrame, max_bins: int = MAX_BINS) -> DataFrame:
    """Lots per price bin and sale, bins as wide as that sale needs.

    The bounds, one row per sale, are written first, so that the lots are counted where they are read.
    """
    bounds = prepared.groupBy("sale_number").agg(F.min("price").alias("low"), F.max("price").alias("high"))
    steps = cut(bin_steps(bounds, max_bins).select("sale_number", "step", "start", "stop"))
    inside = F.least(F.col("price"), F.col("stop") - F.col("step"))
    place = F.floor((inside - F.col("start")) / F.col("step") + F.lit(1e-14))
    binned = prepared.join(steps, "sale_number").withColumn("bin_start", F.col("start") + F.col("step") * place)
    return binned.groupBy("sale_number", "bin_start", "step").agg(F.count(F.lit(1)).alias("lots"))


def grade_performance(prepared: DataFrame, low=None, high=None) -> DataFrame:
    """Mean price and volume per grade, best price first."""
    df = within(prepared, low, high).groupBy("sale_number", "grade").agg(
        exact_mean(F.col("price")).alias("avg_price"), exact_sum(F.col("total_weight_kgs")).alias("volume")
    )
    return df.orderBy("sale_number", F.desc("avg_price"), "grade")


def broker_performance(prepared: DataFrame, low=None, high=None) -> DataFrame:
    """Value and mean price per broker, highest value first."""
    df = within(prepared, low, high).groupBy("sale_number", "broker").agg(
        exact_sum(F.col("value_usd")).alias("total_value"), exact_mean(F.col("price")).alias("avg_price")
    )
    return df.orderBy("sale_number", F.desc("total_value"), "broker")


def prev_grade_mean(prepared: DataFrame, previous: DataFrame) -> DataFrame:
    """Mean price per grade of the sale before each week."""
    means = prepared.groupBy("sale_number", "grade").agg(exact_mean(F.col("price")).alias("prev_avg_price"))
    return _as_previous(means, previous)


def prev_broker_total(prepared: DataFrame, previous: DataFrame) -> DataFrame:
    """Value per broker of the sale before each week."""
    totals = prepared.groupBy("sale_number", "broker").agg(exact_sum(F.col("value_usd")).alias("prev_total_value"))
    return _as_previous(totals, previous)


def _as_previous(figures: DataFrame, previous: DataFrame) -> DataFrame:
    weeks = previous.select(F.col("sale_number").alias("week"), F.col("previous_sale").alias("sale_number"))
    return figures.join(weeks, "sale_number").drop("sale_number").withColumnRenamed("week", "sale_number")


def grade_lookup(prepared: DataFrame, previous: DataFrame) -> DataFrame:
    """Lots with the previous mean price of their grade, null where it was not sold."""
    return prepared.join(prev_grade_mean(prepared, previous), ["sale_number", "grade"], "left")


def broker_lookup(prepared: DataFrame, previous: DataFrame) -> DataFrame:
    """Lots with the previous value of their broker, null where there was none."""
    return prepared.join(prev_broker_total(prepared, previous), ["sale_number", "broker"], "left")


def _with_previous(raw_sales: DataFrame, raw_offers: DataFrame, lookup) -> DataFrame:
    """A lookup over stored sales and offers; the sales are written once with their values, all else derives from that."""
    marked = cut(mark_sales(raw_sales))
    previous = previous_of(marked.select("sale_number", F.col("priced").alias("marked")), raw_offers)
    return lookup(marked.filter("priced").drop("priced"), previous)


def grade_lookup_of(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """grade_lookup over stored sales and offers, each read once."""
    return _with_previous(raw_sales, raw_offers, grade_lookup)


def broker_lookup_of(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """broker_lookup over stored sales and offers, each read once."""
    return _with_previous(raw_sales, raw_offers, broker_lookup)


# Figures of one axis per sale: those shown obey the interval, those that the next sale compares with do not.
_AXES = {
    "grade": lambda shown, priced: {
        "avg_price": exact_mean(F.col("price"), shown), "volume": exact_sum(F.col("total_weight_kgs"), shown),
        "prev_avg_price": exact_mean(F.col("price"), priced),
    },
    "broker": lambda shown, priced: {
        "total_value": exact_sum(F.col("value_usd"), shown), "avg_price": exact_mean(F.col("price"), shown),
        "prev_total_value": exact_sum(F.col("value_usd"), priced),
    },
}


def _axis_figures(marked: DataFrame, axis: str, low, high) -> DataFrame:
    shown = F.col("priced") & _inside(low, high)
    figures = _AXES[axis](shown, F.col("priced"))
    return marked.groupBy("sale_number", axis).agg(
        F.count_if("priced").alias("priced"), F.count_if(shown).alias("shown"), *[c.alias(n) for n, c in figures.items()]
    )


def _layer(figures: DataFrame, previous: DataFrame, axis: str) -> DataFrame:
    now, before = ([c for c in figures.columns[4:] if c.startswith("prev_") == old] for old in (False, True))
    current = figures.filter("shown > 0").select("sale_number", axis, *now)
    earlier = _as_previous(figures.filter("priced > 0").select("sale_number", axis, *before), previous)
    return current.join(earlier, ["sale_number", axis], "full")


def _layer_of_prepared(prepared: DataFrame, previous: DataFrame, axis: str, low, high) -> DataFrame:
    return _layer(cut(_axis_figures(prepared.withColumn("priced", F.lit(True)), axis, low, high)), previous, axis)


def _layer_of_stored(raw_sales: DataFrame, raw_offers: DataFrame, axis: str, low, high) -> DataFrame:
    figures = cut(_axis_figures(mark_sales(raw_sales), axis, low, high))
    return _layer(figures, previous_of(figures.select("sale_number", (F.col("priced") > 0).alias("marked")), raw_offers), axis)


def grade_layer(prepared: DataFrame, previous: DataFrame, low=None, high=None) -> DataFrame:
    """Current and previous figures of all grades on one axis; only the current ones obey the interval."""
    return _layer_of_prepared(prepared, previous, "grade", low, high)


def broker_layer(prepared: DataFrame, previous: DataFrame, low=None, high=None) -> DataFrame:
    """Current and previous figures of all brokers on one axis; only the current ones obey the interval."""
    return _layer_of_prepared(prepared, previous, "broker", low, high)


def grade_layer_of(raw_sales: DataFrame, raw_offers: DataFrame, low=None, high=None) -> DataFrame:
    """grade_layer over stored sales and offers, each read once."""
    return _layer_of_stored(raw_sales, raw_offers, "grade", low, high)


def broker_layer_of(raw_sales: DataFrame, raw_offers: DataFrame, low=None, high=None) -> DataFrame:
    """broker_layer over stored sales and offers, each read once."""
    return _layer_of_stored(raw_sales, raw_offers, "broker", low, high)


def buyer_totals(prepared: DataFrame, metric: str = "value") -> DataFrame:
    """Value, volume and the chosen metric per named buyer and sale."""
    named = prepared.filter(F.col("buyer") != PLACEHOLDER)
    df = named.groupBy("sale_number", "buyer").agg(
        exact_sum(F.col("value_usd")).alias("total_value"), exact_sum(F.col("total_weight_kgs")).alias("total_volume")
    )
    return df.withColumn("metric_sum", F.col("total_value" if metric == "value" else "total_volume"))


def buyer_ranking(prepared: DataFrame, metric: str = "value", top: int = TOP_BUYERS) -> DataFrame:
    """Buyers up to a rank; ties share a rank, so a tie at the end brings more rows."""
    order = Window.partitionBy("sale_number").orderBy(F.desc("metric_sum"))
    ranked = buyer_totals(prepared, metric).withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= top)
    return ranked.withColumn("avg_price", F.col("total_value") / F.col("total_volume"))


def buyer_grade_breakdown(prepared: DataFrame, buyers: list[str] | None = None, metric: str = "value") -> DataFrame:
    """What the chosen buyers (all, if none is chosen) bought by grade, largest first."""
    df = prepared if not buyers else prepared.filter(F.col("buyer").isin(buyers))
    df = df.groupBy("sale_number", "grade").agg(
        exact_sum(F.col("value_usd")).alias("total_value"),
        exact_sum(F.col("total_weight_kgs")).alias("total_volume"),
        exact_sum(F.col(METRICS[metric])).alias("metric_sum"),
    )
    return df.orderBy("sale_number", F.desc("metric_sum"), "grade")


def buyer_grades(prepared: DataFrame) -> DataFrame:
    """What every buyer bought by grade."""
    return prepared.groupBy("sale_number", "buyer", "grade").agg(
        exact_sum(F.col("value_usd")).alias("total_value"), exact_sum(F.col("total_weight_kgs")).alias("total_volume")
    )
