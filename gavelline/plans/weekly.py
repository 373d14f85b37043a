"""Weekly reports: every sale at once, grouped by sale number; there is no loop over sales."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.operators import kpis, lots, market, movements, sequence
from gavelline.session import cut, freed_shuffles
from gavelline.sources.documents import write_documents
from gavelline.sources.store import read_store


def arrival(df: DataFrame) -> list[str]:
    """Order in which stored rows count as first: by time of storing, then by content, as far as it decides on the date."""
    return [c for c in ("processed_timestamp", "source_file_identifier", "sale_date") if c in df.columns]


def first_dates(sales: DataFrame, offers: DataFrame) -> DataFrame:
    """The date of each sale by its first row.  A file holds few dates, so few rows are left to be put in order."""
    order = arrival(sales)
    return sequence.sale_dates(*(df.select("sale_number", *order).distinct() for df in (sales, offers)), F.struct(*order))


def report_tables(sales: DataFrame, offers: DataFrame, location: str) -> dict[str, DataFrame]:
    """The parts of all reports as tables with a sale_number column, from stored sales and offers.

    Sales and offers are cleaned and written once; all parts derive from those two tables.  Sales are written by sale, so that the
    rows of a sale meet in few tasks before they are added up or written; weights and values follow from them and are not stored.
    """
    with freed_shuffles(sales.sparkSession):
        raw_sales = lots.mark_sales(cut(lots.stored_lots(sales).hint("rebalance", "sale_number")))
        raw_offers = lots.stored_lots(offers)
        needed = {"sale_number", *lots.KEYS, "quantity_kgs", "package_count", *arrival(raw_sales)}
        raw_offers = cut(raw_offers.select(*[c for c in raw_offers.columns if c in needed]))
        sold = raw_sales.filter("priced").drop("priced")
        figures = cut(kpis.key_figures(raw_sales, raw_offers))
        weeks = figures.select("sale_number")
        previous = sequence.previous_sales(weeks, sold)
        bars = cut(movements.ohlc(sold))
        joined = cut(movements.joined_movements(bars))
        moves = movements.movement_metrics(joined)
        insights = movements.insights_from(bars, joined, previous)
        dates = first_dates(raw_sales, lots.prepare_offers(raw_offers))
        return {
            "documents": documents(figures, dates, insights, kpis.outlook(raw_sales, raw_offers, location), location),
            "raw_sales_data": lots.raw_export(sold),
            "source_sales_week": sold,
            "source_prev_grade_metrics": market.prev_grade_mean(sold, previous),
            "source_prev_broker_metrics": market.prev_broker_total(sold, previous),
            "source_movement_data": moves.drop("previous_sale"),
            "movement_marks": movements.movement_marks(moves),
            "price_distribution": market.price_histogram(sold),
            "grade_performance": market.grade_layer(sold, previous),
            "broker_performance": market.broker_layer(sold, previous),
            "top_buyers_by_value": market.buyer_ranking(sold, "value"),
            "top_buyers_by_volume": market.buyer_ranking(sold, "volume"),
            "buyer_grades": market.buyer_grades(sold),
        }


def documents(figures: DataFrame, dates: DataFrame, insights: DataFrame, outlook: DataFrame, location: str) -> DataFrame:
    """One row per sale with the nested report: metadata, key figures, insights, small tables and outlook.

    Row data of a sale has no upper limit and is written as tables of its own next to the documents.
    """
    df = figures.join(dates, "sale_number", "left").join(insights, "sale_number").join(outlook, "sale_number")
    df = sequence.sale_attributes(df)
    date = F.coalesce(F.col("sale_date").cast("string"), F.lit("Unknown"))
    def row(metric, value):
        return F.struct(F.lit(metric).alias("Metric"), value.alias("Value"))

    return df.select(
        "sale_number",
        F.concat(F.lit(location.lower() + "_"), F.replace("sale_number", F.lit("-"), F.lit("_")), F.lit(".json")).alias("filename"),
        F.struct(
            "sale_number", date.alias("sale_date"), F.lit(location).alias("location"), "year", "sale_num_only",
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("generated_at"),
        ).alias("metadata"),
        F.struct(
            F.col("total_volume_text").alias("TOTAL_VOLUME"), F.col("avg_price_text").alias("AVG_PRICE"),
            F.col("price_change").alias("PRICE_CHANGE"), F.col("price_change_class").alias("PRICE_CHANGE_CLASS"),
            F.col("price_change_numeric").alias("PRICE_CHANGE_NUMERIC"), F.col("sell_through_text").alias("SELL_THROUGH_RATE"),
            F.col("sell_through_rate").alias("SELL_THROUGH_RATE_RAW"), F.col("realization_rate").alias("REALIZATION_RATE"),
            F.col("snapshot").alias("SNAPSHOT"),
        ).alias("kpis"),
        "insights",
        F.struct(
            F.array(
                row("Lots Offered", F.format_number("lots_offered", 0)), row("Lots Sold", F.format_number("lots_sold", 0)),
                row("Rate", F.col("sell_through_text")),
            ).alias("sell_through"),
            F.array(row("Status", F.lit("Insufficient Data"))).alias("realization"),
        ).alias("tables"),
        F.struct("next_sale", "forthcoming_offerings_kgs", "weather_outlook", "market_prediction").alias("outlook"),
    )


def report_index(docs: DataFrame) -> DataFrame:
    """Index entries of the reports, the greatest sale number first."""
    return docs.select(
        "sale_number", F.col("metadata.sale_num_only").alias("sale_num_only"), F.col("metadata.sale_date").alias("sale_date"),
        F.col("metadata.year").alias("year"), "filename", F.col("metadata.location").alias("location"),
        F.col("kpis.SNAPSHOT").alias("snapshot"),
    ).orderBy(F.desc("sale_number"))


def with_manifest(docs: DataFrame, names: list[str]) -> DataFrame:
    """Documents with data_sources: for each row table of the report its name and the folder of the sale's rows."""
    folders = [F.struct(F.lit(n).alias("name"), F.concat(F.lit(f"{n}/sale_number="), "sale_number").alias("folder")) for n in names]
    return docs.withColumn("data_sources", F.array(*folders))


#: The chart tables, whose rows per sale are bounded by its bins, grades, brokers and ranks, and the order of their rows.
CHARTS = {
    "price_distribution": ["bin_start"], "grade_performance": ["grade"], "broker_performance": ["broker"],
    "top_buyers_by_value": ["rank", "buyer"], "top_buyers_by_volume": ["rank", "buyer"], "movement_marks": ["mark"],
}


def with_charts(docs: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Documents with charts: the rows of each chart table that belong to the sale."""
    for name, order in CHARTS.items():
        rows = tables[name]
        rest = [c for c in rows.columns if c != "sale_number" and c not in order]
        per_sale = rows.groupBy("sale_number").agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))
        docs = docs.join(per_sale, "sale_number", "left")
    charts = F.struct(*[F.coalesce(F.col(name), F.array().cast(docs.schema[name].dataType)).alias(name) for name in CHARTS])
    return docs.withColumn("charts", charts).drop(*CHARTS)


#: Row tables of lots, which are read by sale as they were written and need not be dealt out again.
BY_SALE = {"raw_sales_data", "source_sales_week"}


def report_json_sink(tables: dict[str, DataFrame], out: str, location: str) -> None:
    """Write the reports as JSON: a file per sale with its charts, row tables by sale, and the index that the catalogue reads.

    Nulls and NaN leave no field.  A sale with very many rows is written by several tasks.  The index comes last.
    Chart tables are worked out once, for their own files and for the documents.  Row tables are compressed: they are texts
    that repeat their names and values, many times as large as what they are made of.
    """
    with freed_shuffles(tables["documents"].sparkSession):
        tables = tables | {name: cut(tables[name]) for name in CHARTS}
        docs = cut(with_charts(with_manifest(tables["documents"], sorted(set(tables) - {"documents"})), tables))
        # the largest tables come last, when what the others shuffle has gone
        for name in sorted(set(tables) - {"documents"}, key=lambda name: (name in BY_SALE, name)):
            df = tables[name] if name in BY_SALE else tables[name].hint("rebalance", "sale_number")
            df.write.mode("overwrite").partitionBy("sale_number").json(f"{out}/{name}", compression="gzip")
        body = F.to_json(F.struct(*[c for c in docs.columns if c not in ("sale_number", "filename")]))
        write_documents(docs.select("filename", body.alias("body")), f"{out}/documents")
        entries = report_index(docs)
        fields = F.struct(F.col("sale_number").alias("key"), F.struct(*entries.columns).alias("entry"))
        listed = F.transform(F.sort_array(F.collect_list(fields), asc=False), lambda e: e["entry"])  # an entry per sale
        index = entries.agg(F.to_json(listed).alias("body")).withColumn("filename", F.lit(f"{location.lower()}_index.json"))
        write_documents(index, out)


def build_reports(spark: SparkSession, root: str, out: str, location: str) -> None:
    """Reports of all sales in a lot store."""
    sales, offers = (read_store(spark, root, n) for n in ("auction_sales", "auction_offers"))
    report_json_sink(report_tables(sales, offers, location), out, location)
