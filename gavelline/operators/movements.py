"""Price movement of each mark and grade against the previous sale."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelline.constants import (
    FALL_COLOUR, FALLERS_HEADING, FELL, FIRST_SALE, FROM, MIN_MOVER_KGS, NO_COMMON_ITEMS, NO_CURRENT_DATA, PLACEHOLDER,
    RISE_COLOUR, RISERS_HEADING, ROSE, STABLE_PRICES, TO, TOP_MOVERS,
)
from gavelline.functions.numbers import exact_mean, exact_sum
from gavelline.functions.text import fixed
from gavelline.operators.lots import mark_sales
from gavelline.operators.sequence import previous_of, previous_sales
from gavelline.session import cut


def ohlc(prepared: DataFrame) -> DataFrame:
    """Close (unweighted mean), high, low and volume per sale, mark and grade."""
    return prepared.groupBy("sale_number", "mark", "grade").agg(
        exact_mean(F.col("price")).alias("close"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        exact_sum(F.col("total_weight_kgs")).alias("volume"),
    )


def movement_join(prepared: DataFrame) -> DataFrame:
    """Prices of marks and grades that were also sold in the sale before; open is the mean of that sale.

    The previous price comes from a window over the aggregated rows of one mark and grade (at most one row per sale)
    instead of a self-join; it counts only if it belongs to the directly preceding sale.
    """
    return joined_movements(cut(ohlc(prepared)))


def joined_movements(bars: DataFrame) -> DataFrame:
    """Movements from the bars of all sales."""
    sales = bars.select("sale_number").distinct()
    order = Window.partitionBy("mark", "grade").orderBy("sale_number")
    rows = bars.withColumns({
        "open": F.lag("close").over(order), "open_sale": F.lag("sale_number").over(order),
    })
    rows = rows.filter("open_sale is not null").join(previous_sales(sales, sales), "sale_number")
    return rows.filter(F.col("open_sale") == F.col("previous_sale")).select(
        "sale_number", "previous_sale", "mark", "grade", "open", "close", "high", "low", "volume"
    )


def movement_metrics(moves: DataFrame) -> DataFrame:
    """Absolute and relative change, and the colour of the candle."""
    change = F.col("close") - F.col("open")
    return moves.withColumns({
        "change": change,
        "change_pct": change / F.col("open") * 100,
        "color": F.when(change >= 0, F.lit(RISE_COLOUR)).otherwise(F.lit(FALL_COLOUR)),
    })


def movement_marks(moves: DataFrame) -> DataFrame:
    """Marks to choose from per sale, one row each; the first by name is the default choice."""
    marks = moves.filter(F.col("mark") != PLACEHOLDER).select("sale_number", "mark").distinct()
    first = F.min("mark").over(Window.partitionBy("sale_number"))
    return marks.select("sale_number", "mark", (F.col("mark") == first).alias("is_default"))


def movement_by_mark(moves: DataFrame, mark: str | None = None) -> DataFrame:
    """Movements of one mark; without a choice, of the first mark of each sale."""
    if mark is not None:
        return moves.filter(F.col("mark") == mark)
    named = F.min(F.when(F.col("mark") != PLACEHOLDER, F.col("mark"))).over(Window.partitionBy("sale_number"))
    return moves.withColumn("_first", named).filter("mark = _first").drop("_first")


def top_movers(metrics: DataFrame) -> DataFrame:
    """The three strongest and the three weakest changes per sale; their sign is not looked at."""
    named = metrics.filter((F.col("volume") > MIN_MOVER_KGS) & (F.col("mark") != PLACEHOLDER))

    def ranked(direction, order):
        w = Window.partitionBy("sale_number").orderBy(order, "mark", "grade")
        return named.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= TOP_MOVERS).select(
            "sale_number", F.lit(direction).alias("direction"), "place", "mark", "grade", "open", "close", "change_pct",
            "volume",
        )

    return ranked("riser", F.desc("change_pct")).union(ranked("faller", F.asc("change_pct")))


def insights_of(raw_sales: DataFrame, raw_offers: DataFrame) -> DataFrame:
    """insights_text over stored sales and offers, each read once."""
    marked = mark_sales(raw_sales)
    bars = cut(marked.groupBy("sale_number", "mark", "grade").agg(
        F.count_if("priced").alias("n"), exact_mean(F.col("price"), F.col("priced")).alias("close"),
        F.max(F.when(F.col("priced"), F.col("price"))).alias("high"), F.min(F.when(F.col("priced"), F.col("price"))).alias("low"),
        exact_sum(F.col("total_weight_kgs"), F.col("priced")).alias("volume"),
    ))
    earlier = previous_of(bars.select("sale_number", (F.col("n") > 0).alias("marked")), raw_offers)
    bars = bars.filter("n > 0").drop("n")
    return insights_from(bars, cut(joined_movements(bars)), earlier)


def insights_text(prepared: DataFrame, weeks: DataFrame) -> DataFrame:
    """The written insights of every week, fixed sentences where there is nothing to tell.

    The bars are written first; all that is told derives from them.
    """
    bars = cut(ohlc(prepared))
    return insights_from(bars, cut(joined_movements(bars)), previous_sales(weeks, bars))


def insights_from(bars: DataFrame, moves: DataFrame, earlier: DataFrame) -> DataFrame:
    """The insights from bars and movements that are there already."""
    movers = top_movers(movement_metrics(moves))
    rising = F.col("direction") == "riser"
    line = F.concat(
        F.lit("- "), F.col("mark"), F.lit(" ("), F.col("grade"),
        F.when(rising, F.lit(ROSE)).otherwise(F.lit(FELL)),
        fixed(F.col("change_pct"), 1), F.lit(FROM), fixed(F.col("open"), 2), F.lit(TO),
        fixed(F.col("close"), 2), F.lit(")."),
    )

    def bullets(direction):  # at most three rows of a sale
        rows = F.collect_list(F.when(F.col("direction") == direction, F.struct("place", line.alias("line"))))
        return F.array_join(F.transform(F.array_sort(rows), lambda r: r["line"]), "\n")

    said = movers.groupBy("sale_number").agg(bullets("riser").alias("up"), bullets("faller").alias("down"))
    told = said.select("sale_number", F.concat(
        F.lit(RISERS_HEADING + "\n"), F.col("up"), F.lit("\n\n\n" + FALLERS_HEADING + "\n"), F.col("down")
    ).alias("told"))
    sold = bars.select("sale_number", F.lit(True).alias("sold")).distinct()
    compared = moves.select("sale_number", F.lit(True).alias("compared")).distinct()
    df = earlier.join(sold, "sale_number", "left").join(compared, "sale_number", "left").join(told, "sale_number", "left")
    text = (
        F.when(F.col("sold").isNull(), F.lit(NO_CURRENT_DATA))
        .when(F.col("previous_sale").isNull(), F.lit(FIRST_SALE))
        .when(F.col("compared").isNull(), F.lit(NO_COMMON_ITEMS))
        .otherwise(F.coalesce(F.col("told"), F.lit(STABLE_PRICES)))
    )
    return df.select("sale_number", text.alias("insights"))
