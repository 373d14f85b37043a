"""News articles out of landed pages, and the lists made of them."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelline.constants import ARTICLE_TYPE, LIST_TYPE, NEWEST_ARTICLES, PARTNER_NOTE, SESSION_ARTICLES, SPONSORED
from gavelline.functions.dates import display_date
from gavelline.functions.links import resolve_link
from gavelline.functions.text import blank_to_null, plain_text, strip


def sponsor_filter(items: DataFrame, partner_note: str = PARTNER_NOTE) -> DataFrame:
    """Items that are no advertisement and have a title and a link."""
    text = F.coalesce("text", F.lit(""))
    paid = text.rlike(SPONSORED) | F.contains(F.lower(text), F.lit(partner_note.lower()))
    named = (F.coalesce("title", F.lit("")) != "") & (F.coalesce("link", F.lit("")) != "")
    return items.filter(~paid & named)


def snippet_clean(snippet: Column) -> Column:
    """Snippet without a leading NEWS."""
    return strip(F.regexp_replace(strip(snippet), "(?i)^NEWS", ""))


_LIST = "struct<`@type`: string, itemListElement: array<string>>"
_ITEM = "struct<`@type`: string, name: string, url: string, description: string, datePublished: string>"


def jsonld_articles(pages: DataFrame, source: str) -> DataFrame:
    """Articles of the first item list of a page that names any; an article needs a name and a url.

    Entries are parsed one by one, so an entry of another shape does not spoil its list.
    """
    bodies = F.regexp_extract_all("html", F.lit(r'(?s)<script type="application/ld\+json">(.*?)</script>'), F.lit(1))
    lists = F.transform(bodies, lambda b: F.from_json(strip(b), _LIST))
    lists = F.filter(lists, lambda d: d["@type"] == LIST_TYPE)
    found = F.transform(lists, lambda d: F.filter(
        F.transform(d["itemListElement"], lambda e: F.from_json(F.from_json(e, "struct<item: string>")["item"], _ITEM)),
        lambda a: (a["@type"] == ARTICLE_TYPE) & (a["name"] != "") & (a["url"] != ""),
    ))
    first = F.get(F.filter(found, lambda a: F.size(a) > 0), F.lit(0))
    rows = pages.select("page_id", F.posexplode(first).alias("pos", "a"))
    return rows.select(
        "page_id", "pos", strip(F.col("a.name")).alias("headline"),
        F.coalesce(strip(F.col("a.description")), F.lit("")).alias("snippet"), F.lit(source).alias("source"),
        strip(F.col("a.url")).alias("link"), F.coalesce(strip(F.col("a.datePublished")), F.lit("")).alias("article_date"),
    )


def _inner(block: Column, tags: str) -> Column:
    return F.regexp_extract(block, rf"(?is)<({tags})\b[^>]*>(.*?)</\1>", 2)


def page_cards(pages: DataFrame) -> DataFrame:
    """Cards of a page: title, link, first paragraph and date of every article block.

    A block without a link of its own links to its page; relative links are resolved against the page.
    """
    blocks = F.regexp_extract_all("html", F.lit(r"(?is)<article\b[^>]*>(.*?)</article>"), F.lit(1))
    cards = pages.select("page_id", "url", F.posexplode(blocks).alias("pos", "block"))
    href = F.regexp_extract("block", r"""(?is)<a\b[^>]*\bhref=["']([^"']*)["']""", 1)
    stamp = F.regexp_extract("block", r"""(?is)<time\b[^>]*\bdatetime=["']([^"']*)["']""", 1)
    return cards.select(
        "page_id", "pos", plain_text(_inner(F.col("block"), "h1|h2|h3")).alias("title"),
        resolve_link(F.col("url"), href).alias("link"),
        snippet_clean(plain_text(F.regexp_extract("block", r"(?is)<p\b[^>]*>(.*?)(</p>|<p\b|$)", 1))).alias("snippet"),
        F.coalesce(blank_to_null(strip(stamp)), plain_text(_inner(F.col("block"), "time"))).alias("article_date"),
        plain_text(F.col("block")).alias("text"),
    )


def provider_name(label: Column, link_text: Column, default: str) -> Column:
    """Name behind 'Provider: ', else the text of the source link, else the default."""
    named = F.when(F.startswith(label, F.lit("Provider: ")), strip(F.replace(label, F.lit("Provider: "))))
    return F.coalesce(blank_to_null(named), blank_to_null(strip(link_text)), F.lit(default))


def news_source_union(feeds: list[DataFrame]) -> DataFrame:
    """Articles of all sources, one below the other."""
    return reduce(lambda a, b: a.unionByName(b), feeds)


def session_dedup_cap(articles: DataFrame, cap: int = SESSION_ARTICLES) -> DataFrame:
    """First occurrence of every link in order of appearance, up to the number of articles a session takes."""
    rest = [c for c in articles.columns if c != "link"]
    usable = articles.filter(F.coalesce("link", F.lit("")) != "")
    first = usable.groupBy("link").agg(F.min_by(F.struct(*rest), "seq").alias("first"))
    return first.select("link", "first.*").orderBy("seq").limit(cap).select(*articles.columns)


def news_latest500(articles: DataFrame, newest: int = NEWEST_ARTICLES) -> DataFrame:
    """The newest articles: last scraped first, later additions before earlier ones."""
    return articles.orderBy(F.desc("scraped_date"), F.desc("seq")).limit(newest)


def date_display(articles: DataFrame) -> DataFrame:
    """Articles with the date to show."""
    return articles.withColumn("date_display", display_date(F.col("article_date"), F.col("scraped_date")))
