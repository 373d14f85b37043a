"""Running totals of sales that keep arriving, late rows included.

The state is a table: per window and sale the parts of its exact sums.  A batch adds up its own rows, reads the totals of the
windows they fall into, and writes these anew, so its cost follows the windows it touches and nothing is held between batches.
The watermark is the latest event time seen so far less a delay.  Windows behind it are settled: readers that wait for settled
totals take those, and a late row corrects the total of its settled window, which is marked with how many rows came late.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.functions.numbers import exact_parts, exact_total, ratio
from gavelline.session import cut
from gavelline.sources.store import read_parquet

_KEY = ["window_start", "sale_number"]
_VALUES = {"volume": "total_weight_kgs", "value": "value_usd"}
_PARTS = {
    f"{name}_{part}": "double" if part in ("tail", "beyond") else "bigint"
    for name in _VALUES for part in ("high", "low", "first", "second", "tail", "beyond")
}
_STATE = (
    "window_start timestamp, window_end timestamp, sale_number string, lots bigint, late bigint, "
    + ", ".join(f"{name} {kind}" for name, kind in _PARTS.items()) + ", day string, update bigint"
)
_SEEN = "latest timestamp, update bigint"


def _added(rows: DataFrame) -> DataFrame:
    sums = [F.sum(name).alias(name) for name in ("lots", "late", *_PARTS)]
    return rows.groupBy("window_start", "window_end", "sale_number").agg(*sums)


def batch_totals(sales: DataFrame, time: str, width: str, settled: F.Column) -> DataFrame:
    """Totals of the rows of one batch; rows of a window that ended before the watermark count as late."""
    window = F.window(time, width)
    parts = {f"{name}_{part}": c for name, value in _VALUES.items() for part, c in exact_parts(F.col(value)).items()}
    rows = sales.select("sale_number", window.alias("w"), *[c.alias(n) for n, c in parts.items()])
    late = F.coalesce((F.col("w.end") <= settled).cast("bigint"), F.lit(0))
    rows = rows.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sale_number", F.lit(1).cast("bigint").alias("lots"),
        late.alias("late"), *parts,
    )
    return _added(rows)


def _latest(state: DataFrame) -> DataFrame:
    rest = [c for c in state.columns if c not in _KEY]
    last = state.groupBy(*_KEY).agg(F.max_by(F.struct(*rest), "update").alias("s"))
    return last.select(*_KEY, "s.*")


def watermark(spark: SparkSession, out: str, delay: str, before: int | None = None):
    """The latest event time of the updates (before one of them) less the delay; None before the first."""
    seen = read_parquet(spark, _SEEN, f"{out}/seen")
    seen = seen if before is None else seen.filter(F.col("update") < before)
    return seen.agg((F.max("latest") - F.expr(f"interval {delay}")).alias("w")).first()["w"]


def add_sales(batch: DataFrame, number: int, out: str, time: str, width: str, delay: str) -> None:
    """Bring the totals up to date with one batch; a batch that runs again replaces its own update."""
    spark = batch.sparkSession
    batch = cut(batch)
    settled = F.lit(watermark(spark, out, delay, before=number)).cast("timestamp")
    mine = cut(batch_totals(batch, time, width, settled).withColumn("day", F.date_format("window_start", "yyyy-MM-dd")))
    days = [r["day"] for r in mine.select("day").distinct().collect()]  # those that the batch touches
    state = read_parquet(spark, _STATE, f"{out}/totals").filter(F.col("day").isin(days) & (F.col("update") < number))
    touched = _latest(state).join(mine.select(*_KEY), _KEY, "left_semi")
    merged = _added(touched.unionByName(mine, allowMissingColumns=True).select(*mine.columns))
    merged = merged.withColumns({"day": F.date_format("window_start", "yyyy-MM-dd"), "update": F.lit(number)})
    options = {"partitionOverwriteMode": "dynamic"}
    merged.write.mode("overwrite").options(**options).partitionBy("day", "update").parquet(f"{out}/totals")
    seen = batch.agg(F.max(F.col(time).cast("timestamp")).alias("latest")).withColumn("update", F.lit(number))
    seen.write.mode("overwrite").options(**options).partitionBy("update").parquet(f"{out}/seen")


def stream_sale_kpis(sales: DataFrame, out: str, checkpoint: str, time: str, width: str, delay: str = "1 day"):
    """Keep the totals of a stream of prepared sales up to date, batch by batch."""

    def store(batch: DataFrame, number: int):
        add_sales(batch, number, out, time, width, delay)

    return sales.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_totals(spark: SparkSession, out: str, delay: str = "1 day") -> DataFrame:
    """Volume, value and average price of every window and sale, whether it is settled, and its late rows."""
    state = _latest(read_parquet(spark, _STATE, f"{out}/totals"))

    def total(name):
        return exact_total({part: F.col(f"{name}_{part}") for part in exact_parts(F.lit(0.0))})

    mark = F.lit(watermark(spark, out, delay)).cast("timestamp")
    df = state.select(
        *_KEY, "lots", total("volume").alias("total_volume"), total("value").alias("total_value"), "late",
        F.coalesce(F.col("window_end") <= mark, F.lit(False)).alias("settled"),
    )
    return df.withColumn("avg_price", ratio(F.col("total_value"), F.col("total_volume")))
