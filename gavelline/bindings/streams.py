"""Streaming queries over the supplied tables and whole runs over files that Spark derives from them."""

from pyspark.sql import functions as F

from gavelline.bindings.base import KPIS_SQL, MOVES_SQL, offered_lots, sold_lots, table, total, with_lots
from gavelline.bindings.ingest import _APPEND
from gavelline.bindings.news import GREEDY_SQL
from gavelline.bindings.sales import _AHEAD, _INSIGHTS, _MOVERS, _TEXTS
from gavelline.operators.catalogue import index_entries
from gavelline.plans import weekly
from gavelline.plans.library import build_library
from gavelline.session import run_folder
from gavelline.sources.payloads import read_index_files
from gavelline.sources.store import read_store
from gavelline.streaming import kpis, lots, news


#: Files of a micro-batch.
FILES = 4


def _stream(spark, sf, name, part):
    """The rows of a table as a stream; those with a smaller value of `part` arrive first.

    The rows of a part are written by all tasks, FILES of them, and a micro-batch takes that many files.
    """
    df = table(spark, sf, name).withColumn("part", part)
    landed = run_folder(spark, name)
    for row in df.select("part").distinct().orderBy("part").collect():  # two or three values
        mine = df.filter(F.col("part").eqNullSafe(row["part"])).drop("part")
        mine.repartition(FILES).write.mode("append").parquet(landed)
    return spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", FILES).parquet(landed)


def stream_lot_ingest(spark, sf):
    """Line items of two flags arrive as a stream after those of the first are stored."""
    root = run_folder(spark, "store")
    key, order = ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    line = F.nullif("l_linenumber", F.lit(7))
    old = table(spark, sf, "lineitem").withColumn("l_linenumber", line).select(*columns).filter("l_returnflag = 'A'")
    lots.add_unique(old, root, "lots", key, order, "old")
    new = _stream(spark, sf, "lineitem", F.col("l_returnflag")).withColumn("l_linenumber", line).select(*columns).filter("l_returnflag <> 'A'")
    lots.stream_lot_ingest(new, root, "lots", key, order, run_folder(spark, "offsets")).awaitTermination()
    df = lots.read_table(spark, new.schema, f"{root}/lots").filter("batch <> 'old'")
    return df.select("l_orderkey", F.coalesce("l_linenumber", F.lit(-1)).alias("l_linenumber"), "l_partkey", "l_suppkey", "l_quantity")


def stream_news_dedup(spark, sf):
    """Pages arrive in three batches; one whose link starts a stored link, or whose title is like a stored one, is known."""
    root = run_folder(spark, "articles")
    third = table(spark, sf, "pages").agg(F.max("page_id") / 3).scalar()
    pages = _stream(spark, sf, "pages", F.floor(F.col("page_id") / third)).select(
        F.col("page_id").alias("seq"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("headline"),
        F.lit("").alias("snippet"), F.lit("Wire").alias("source"), F.concat("url", F.lit("&ref=x")).alias("link"),
        F.lit("").alias("article_date"),
    )
    news.stream_news_dedup(pages, root, run_folder(spark, "offsets")).awaitTermination()
    return read_store(spark, root, "articles").select("seq", "link")


def stream_sale_kpis(spark, sf):
    """Events as sales: one sale per event type, a window per day; every batch but the first is late."""
    out = run_folder(spark, "totals")
    events = _stream(spark, sf, "events", F.col("event_id") % 3).select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("sale_number"),
        (F.col("user_id") + 1).cast("double").alias("total_weight_kgs"), F.col("value").alias("value_usd"),
    )
    kpis.stream_sale_kpis(events, out, run_folder(spark, "offsets"), "ts", "1 day").awaitTermination()
    df = kpis.latest_totals(spark, out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))
    return df.select("window_start", "sale_number", "lots", "total_volume", "total_value", "avg_price", (F.col("late") > 0).alias("corrected"))


def report_documents(spark, sf):
    """The nested report of every sale, with its texts taken apart again for the check."""
    tables = weekly.report_tables(sold_lots(spark, sf, "mark", "buyer"), offered_lots(spark, sf, "mark"), "Harbour")
    return tables["documents"].select(
        "filename", F.col("metadata.sale_date").alias("sale_date"), F.col("metadata.year").alias("year"),
        F.col("metadata.sale_num_only").alias("sale_num_only"), F.col("kpis.TOTAL_VOLUME").alias("volume"),
        F.col("kpis.SNAPSHOT").alias("snapshot"), F.element_at("tables.sell_through", 3)["Value"].alias("rate"),
        F.col("outlook.next_sale").alias("next_sale"), "insights",
    )


def report_json_sink(spark, sf):
    """All reports written as JSON files; files, index, catalogue and two row tables read back."""
    out = run_folder(spark, "reports")
    tables = weekly.report_tables(sold_lots(spark, sf, "mark", "buyer"), offered_lots(spark, sf, "mark"), "Harbour")
    weekly.report_json_sink(tables, out, "Harbour")
    listed = build_library(spark, out, "Weekly Desk").select(F.substring_index("report_link", "/", -1).alias("filename"), "report_link")
    index = index_entries(read_index_files(spark, out)).select("sale_number", "filename", "snapshot")
    chart = "price_distribution array<struct<lots: bigint>>, top_buyers_by_value array<struct<rank: int>>, broker_performance array<struct<broker: string>>"
    docs = spark.read.schema(f"charts struct<{chart}>").json(f"{out}/documents").select(
        F.col("_metadata.file_name").alias("filename"),
        F.aggregate("charts.price_distribution", F.lit(0).cast("bigint"), lambda n, b: n + b["lots"]).alias("in_bins"),
        F.size("charts.top_buyers_by_value").cast("bigint").alias("buyers"), F.size("charts.broker_performance").cast("bigint").alias("brokers"),
    )
    moves = spark.read.schema("mark string, grade string, sale_number string, change_pct double").json(f"{out}/source_movement_data")
    moves = moves.groupBy("sale_number").agg(F.count("*").alias("moves"), F.max("change_pct").alias("best"))
    lots = spark.read.schema("sale_number string").json(f"{out}/raw_sales_data").groupBy("sale_number").agg(F.count("*").alias("lots"))
    df = index.join(docs, "filename").join(listed, "filename").join(moves, "sale_number", "left").join(lots, "sale_number", "left")
    return df.select(
        "sale_number", "filename", "report_link", "snapshot", F.coalesce("moves", F.lit(0)).alias("moves"), "best",
        F.coalesce("lots", F.lit(0)).alias("lots"), "in_bins", "buyers", "brokers",
    )


QUERIES = {
    "stream_lot_ingest": (stream_lot_ingest, _APPEND + """
        select l_orderkey, coalesce(line, -1) as l_linenumber, l_partkey, l_suppkey, l_quantity from added"""),
    "stream_news_dedup": (stream_news_dedup, GREEDY_SQL.format(stored="false")),
    # the first third of the rows sets the watermark; a window that ended before it is corrected by the rows after
    "stream_sale_kpis": (stream_sale_kpis, f"""
        with marked as (select *, (select max(ts) - interval 1 day from events where event_id % 3 = 0) as first_mark,
                               (select max(ts) - interval 1 day from events where event_id % 3 < 2) as second_mark,
                               date_trunc('day', ts) + interval 1 day as ends from events)
        select *, total_value / total_volume as avg_price from (
          select strftime(ts, '%Y-%m-%d') as window_start, event_type as sale_number, count(*) as lots,
                 {total("user_id + 1")} as total_volume, {total("value")} as total_value,
                 bool_or(event_id % 3 = 1 and ends <= first_mark or event_id % 3 = 2 and ends <= second_mark) as corrected
          from marked group by 1, 2)"""),
    "report_documents": (report_documents, with_lots(_TEXTS + _AHEAD + _MOVERS + f"""
        , told as ({_INSIGHTS.replace(", lines as", "with lines as", 1)}),
        days as (select sale_number, min(sale_date) as d from raw_sales group by 1),
        offer_days as (select sale_number, min(sale_date) as d from offers group by 1)
        select 'harbour_' || replace(sale_number, '-', '_') || '.json' as filename,
               cast(coalesce(days.d, offer_days.d) as varchar) as sale_date, substr(sale_number, 1, 4) as year,
               cast(cast(split_part(sale_number, '-', 2) as integer) as varchar) as sale_num_only,
               total_volume_text as volume, snapshot, sell_through_text as rate, next_sale, insights
        from texts join told using (sale_number) join forthcoming using (sale_number) left join days using (sale_number)
             left join offer_days using (sale_number)""", KPIS_SQL, MOVES_SQL)),
    "report_json_sink": (report_json_sink, with_lots(_TEXTS + """
        , counted as (select sale_number, count(*) as moves, max(change_pct) as best from moves group by 1),
        sold_lots as (select sale_number, count(*) as lots from sales group by 1),
        ranked as (
          select sale_number, buyer, rank() over (partition by sale_number order by """ + total("value_usd") + """ desc) as place
          from sales where buyer <> 'N/A (Pending)' group by sale_number, buyer),
        first_buyers as (select sale_number, count(*) as buyers from ranked where place <= 15 group by 1),
        sellers as (select distinct sale_number, broker from sales union select p.sale_number, s.broker from previous p join sales s
                    on s.sale_number = p.previous_sale),
        sides as (select sale_number, count(*) as brokers from sellers group by 1)
        select sale_number, 'harbour_' || replace(sale_number, '-', '_') || '.json' as filename,
               'report_viewer.html?data=report_data/harbour_' || replace(sale_number, '-', '_') || '.json' as report_link, snapshot,
               coalesce(counted.moves, 0) as moves, best, coalesce(sold_lots.lots, 0) as lots, coalesce(sold_lots.lots, 0) as in_bins,
               coalesce(buyers, 0) as buyers, coalesce(brokers, 0) as brokers
        from texts left join counted using (sale_number) left join sold_lots using (sale_number)
             left join first_buyers using (sale_number) left join sides using (sale_number)""", KPIS_SQL, MOVES_SQL)),
}
