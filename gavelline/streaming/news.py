"""Articles that keep arriving."""

from pyspark.sql import DataFrame

from gavelline.operators.dedup import clean_key
from gavelline.plans.news import update_news


def stream_first_links(articles: DataFrame, time: str, delay: str) -> DataFrame:
    """One article per canonical link; links are forgotten after a delay, so that the state stays bounded.

    Where no link may come again, however late, use stream_news_dedup: its memory is the store.
    """
    return clean_key(articles).withWatermark(time, delay).dropDuplicatesWithinWatermark(["clean"])


def stream_news_dedup(articles: DataFrame, root: str, checkpoint: str, fuzzy: bool = True):
    """Add new articles batch by batch; links and headlines are tested against the store."""

    def store(batch: DataFrame, number: int):
        update_news(batch, root, f"stream-{number}", fuzzy=fuzzy)

    return articles.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
