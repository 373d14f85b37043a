"""News: landed articles into the article store, and the list of the newest."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.operators.dedup import news_dedup_greedy
from gavelline.operators.news import date_display, news_latest500
from gavelline.session import cut
from gavelline.sources.store import finish_batch, read_store, write_batch


def update_news(articles: DataFrame, root: str, batch: str | None = None, when: datetime | None = None, fuzzy: bool = True) -> None:
    """Add the articles that the store does not have; `seq` tells their order and grows from run to run."""
    spark = articles.sparkSession
    when = when or datetime.now(timezone.utc)
    batch = batch or uuid.uuid4().hex
    store = read_store(spark, root, "articles", without=batch)
    stamp = F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    fresh = news_dedup_greedy(cut(articles), store, fuzzy).withColumn("scraped_date", stamp)
    columns = ["seq", "headline", "snippet", "source", "link", "scraped_date", "article_date"]
    write_batch(fresh.select(*columns), root, "articles", batch, by=None)
    finish_batch(spark, root, batch)


def newest_news(spark: SparkSession, root: str) -> DataFrame:
    """The newest articles with the date to show."""
    return date_display(news_latest500(read_store(spark, root, "articles")))
