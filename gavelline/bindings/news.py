"""News over the supplied pages and documents."""

from pyspark.sql import functions as F

from gavelline.bindings.base import table
from gavelline.functions import links
from gavelline.operators import dedup, news

SCRAPED = "2025-09-02 08:00:00"


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _cards(spark, sf):
    return news.page_cards(_pages(spark, sf))


def page_cards(spark, sf):
    return _cards(spark, sf).select("page_id", "pos", "title", "link", "article_date")


def page_text(spark, sf):
    """The texts that the cards hold."""
    return _cards(spark, sf).select("page_id", "text", "snippet")


def sponsor_filter(spark, sf):
    """Cards without advertisements; titles of every seventh page carry a mark."""
    marked = F.when(F.col("page_id") % 7 == 0, F.concat(F.col("title"), F.lit(" Ad  | x"))).otherwise(F.col("title"))
    named = F.when(F.col("page_id") % 11 == 0, F.lit("")).otherwise(F.col("title"))
    cards = _cards(spark, sf).withColumns({"text": marked, "title": named})
    return news.sponsor_filter(cards).select("page_id", "title")


def snippet_clean(spark, sf):
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" News "), F.col("source"))).otherwise(F.concat(F.col("lang"), F.lit(" NEWS ")))
    return table(spark, sf, "documents").select("doc_id", news.snippet_clean(raw).alias("snippet"))


def jsonld_articles(spark, sf):
    """Pages that carry their title as structured data: a first block of another type, a broken one, then a list."""
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    def block(body):
        return F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))

    item = F.struct(F.lit("Article").alias("@type"), title.alias("name"), F.col("url"), F.lit("2025-09-02").alias("datePublished"))
    other = F.struct(F.lit("Video").alias("@type"), F.lit("x").alias("name"), F.col("url"), F.lit(None).cast("string").alias("datePublished"))
    no_url = F.struct(F.lit("Article").alias("@type"), title.alias("name"), F.lit(None).cast("string").alias("url"), F.lit("").alias("datePublished"))
    entries = F.array(F.struct(other.alias("item")), F.struct(no_url.alias("item")), F.struct(item.alias("item")))
    ld = F.concat(
        block(F.lit('{"@type": "Organization", "name": "x"}')), block(F.lit("{broken")),
        block(F.to_json(F.struct(F.lit("ItemList").alias("@type"), entries.alias("itemListElement")))),
    )
    pages = _pages(spark, sf).withColumn("html", F.concat(ld, F.col("html")))
    return news.jsonld_articles(pages, "Trade Wire").select("page_id", "pos", "headline", "snippet", "source", "link", "article_date")


def provider_name(spark, sf):
    k = F.col("page_id") % 4
    label = F.when(k == 0, F.concat(F.lit("Provider: "), F.col("page_id").cast("string"))).when(k == 1, F.lit("Provider: ")).when(k == 2, F.lit("By x"))
    link_text = F.when(k == 1, F.lit(" desk ")).otherwise(F.lit(" "))
    return _pages(spark, sf).select("page_id", news.provider_name(label, link_text, "Wire").alias("source"))


def link_canonical(spark, sf):
    link = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("notes/"), F.col("page_id").cast("string"), F.lit("?x"))).otherwise(F.col("url"))
    return _pages(spark, sf).select("page_id", links.canonical_link(link).alias("link"))


def link_resolve(spark, sf):
    """Every link of a page in its order, seen from the page."""
    found = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))
    rows = _pages(spark, sf).select("page_id", "url", F.posexplode(found).alias("place", "href"))
    return rows.select("page_id", "place", links.resolve_link(F.col("url"), F.col("href")).alias("link"))


def _articles(spark, sf):
    """Pages as scraped articles; the sequence is the page id."""
    day = F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), (F.col("page_id") % 300).cast("int")), "yyyy-MM-dd")
    k = F.col("page_id") % 4
    stamp = F.when(k == 0, F.concat(day, F.lit("T10:00:00Z"))).when(k == 1, day).when(k == 2, F.lit(" 1h ago ")).otherwise(F.lit(""))
    return _pages(spark, sf).select(
        F.col("page_id").alias("seq"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("headline"),
        F.lit("").alias("snippet"), F.lit("Wire").alias("source"), F.col("url").alias("link"),
        F.to_timestamp(F.lit(SCRAPED)).alias("scraped_date"), stamp.alias("article_date"),
    )


def date_display(spark, sf):
    return news.date_display(_articles(spark, sf)).select("seq", "date_display")


def news_source_union(spark, sf):
    """Articles from pages, from documents, from conversations and from the benchmark, one below the other."""
    def feed(name, key, source):
        return table(spark, sf, name).select(
            F.lit(source).alias("source"), F.col(key).alias("key"), F.length("text").cast("bigint").alias("chars")
        )

    pages = _pages(spark, sf).select(
        F.lit("pages").alias("source"), F.col("page_id").alias("key"), F.length("html").cast("bigint").alias("chars")
    )
    rest = [feed("documents", "doc_id", "documents"), feed("conversations", "conv_id", "talk"), feed("benchmark", "item_id", "bench")]
    return news.news_source_union([pages, *rest])


def session_dedup_cap(spark, sf):
    """Every third event address once, in order of appearance, up to 200."""
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("link")
    )
    return news.session_dedup_cap(events)


def news_latest500(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("n_chars") % 200).cast("int")).alias("scraped_date")
    )
    return news.news_latest500(docs).select("seq", F.col("scraped_date").cast("string").alias("scraped_date"))


def link_exists_anti(spark, sf):
    """Odd pages against even ones; every tenth odd page asks for its site only, some with a cut host."""
    pages = _pages(spark, sf).select("page_id", F.col("url").alias("link"))
    k = F.col("page_id") % 10
    site = F.regexp_extract("link", "^([a-z]+://[^/]+/)", 1)
    asked = F.when(k == 1, site).when(k == 3, F.regexp_extract("link", r"^([a-z]+://[^/]*[.]exampl)", 1)).when(
        k == 5, F.upper(F.col("link"))).otherwise(F.col("link"))
    new = pages.filter("page_id % 2 = 1").withColumn("link", asked)
    return dedup.link_exists_anti(new, pages.filter("page_id % 2 = 0"))


def canonical_once(spark, sf):
    return dedup.canonical_once(_articles(spark, sf).select("seq", "link"))


def _headlines(spark, sf):
    """Whole titles of pages as headlines, the page number as sequence."""
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("seq"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("headline"),
        F.lit("").alias("snippet"), F.lit("Wire").alias("source"), F.concat("url", F.lit("&ref=x")).alias("link"),
        F.lit("").alias("article_date"),
    )


def headline_fuzzy_dup(spark, sf):
    """Titles of pages of odd number against those of even number."""
    df = _headlines(spark, sf)
    found = dedup.headline_fuzzy_dup(df.filter("seq % 2 = 1"), df.filter("seq % 2 = 0"))
    return found.select("seq", "is_duplicate")


def _first_lines(spark, sf):
    """Whole first lines of documents as headlines, the document number as sequence."""
    df = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.substring_index("text", "\n", 1).alias("headline"))
    return df.na.drop()


def first_line_fuzzy_dup(spark, sf):
    """First lines of documents of odd number against those of even number; lines have up to some ten thousand characters."""
    df = _first_lines(spark, sf)
    return dedup.headline_fuzzy_dup(df.filter("seq % 2 = 1"), df.filter("seq % 2 = 0")).select("seq", "is_duplicate")


def news_dedup_greedy(spark, sf):
    """All pages in their order, with the pages of every fifth number in the store already."""
    df = _headlines(spark, sf)
    return dedup.news_dedup_greedy(df.filter("seq % 5 <> 0"), df.filter("seq % 5 = 0")).select("seq", "link")


_TEXT = """replace(replace(replace(replace(replace(replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '&lt;', '<'),
'&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"""


def _sql_text(x):
    return f"trim(regexp_replace({_TEXT.format(x=x)}, '\\s+', ' ', 'g'))"


_BLOCK = "regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)"
_TITLE = _sql_text(f"regexp_extract({_BLOCK}, '(?s)<h1[^>]*>(.*?)</h1>', 1)")
_CANON = "regexp_replace({x}, '[?#].*$', '')"

# Equal headlines, and those whose longest common subsequence is above 90.5 % of their mean length: the edit distance, which
# is never above the inserted and deleted characters, decides which pairs are looked at, then one row of the table of
# common lengths per character of the first headline.
_ALIKE = """
with recursive heads as (
  select page_id as seq, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as headline, url || '&ref=x' as link from pages),
texts as (select distinct headline from heads),
near as (
  select x.headline as a, y.headline as b from texts x join texts y on x.headline < y.headline
  where 200 * levenshtein(x.headline, y.headline) <= 19 * (length(x.headline) + length(y.headline))),
common as (
  select a, b, 0 as place, list_transform(range(length(b) + 1), lambda k: cast(0 as bigint)) as row from near
  union all
  select a, b, place + 1, list_transform(range(1, length(b) + 2), lambda k: list_max(list_transform(range(1, k + 1), lambda j:
         case when j > 1 and substr(a, place + 1, 1) = substr(b, cast(j - 1 as integer), 1)
              then greatest(row[j], row[j - 1] + 1) else row[j] end)))
  from common where place < length(a)),
judged as (select a, b, row[-1] as n from common where place = length(a)),
one_way as (select a, b from judged where round_even(100.0 * 2 * n / (length(a) + length(b)), 0) > 90),
alike as (select a, b from one_way union all select b, a from one_way union all select headline, headline from texts)
"""

# Rows one by one in their order: kept unless a stored or kept row has the link or an alike headline.
GREEDY_SQL = _ALIKE + """
        , keyed as (select *, lower(regexp_replace(link, '[?#].*$', '')) as clean, {stored} as stored from heads),
        clash as (
          select n.seq, o.seq as other, o.stored from keyed n join keyed o on o.seq <> n.seq and starts_with(lower(o.link), n.clean)
          union select n.seq, o.seq, o.stored from keyed n join alike on alike.a = n.headline join keyed o on o.headline = alike.b
          where o.seq <> n.seq),
        new as (
          select k.seq, row_number() over (order by k.seq) as turn,
                 coalesce(list(c.other) filter (c.other is not null), []) as others,
                 coalesce(bool_or(c.stored), false) as stored
          from keyed k left join clash c on c.seq = k.seq where not k.stored group by k.seq),
        steps as (
          select cast(0 as bigint) as turn, cast([] as bigint[]) as kept
          union all
          select n.turn, case when n.stored or list_has_any(s.kept, n.others) then s.kept else list_append(s.kept, n.seq) end
          from steps s join new n on n.turn = s.turn + 1)
        select seq, link from heads join (select unnest(kept) as seq from (select kept from steps order by turn desc limit 1)) using (seq)"""

QUERIES = {
    "page_cards": (page_cards, f"""
        select page_id, cast(0 as integer) as pos, {_TITLE} as title, url as link, '' as article_date from pages"""),
    "page_text": (page_text, f"""
        select page_id, {_sql_text(_BLOCK)} as text,
               {_sql_text(f"split_part(split_part(regexp_extract({_BLOCK}, '(?s)<p[^>]*>(.*)', 1), '</p>', 1), '<p>', 1)")} as snippet
        from pages"""),
    "sponsor_filter": (sponsor_filter, f"""
        select page_id, {_TITLE} as title from pages where page_id % 7 <> 0 and page_id % 11 <> 0"""),
    "snippet_clean": (snippet_clean, """
        select doc_id, case when doc_id % 3 = 0 then source else lang || ' NEWS' end as snippet from documents"""),
    "jsonld_articles": (jsonld_articles, """
        select page_id, cast(0 as integer) as pos, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) as headline, '' as snippet,
               'Trade Wire' as source, url as link, '2025-09-02' as article_date from pages"""),
    "provider_name": (provider_name, """
        select page_id, case page_id % 4 when 0 then cast(page_id as varchar) when 1 then 'desk' else 'Wire' end as source from pages"""),
    "link_canonical": (link_canonical, f"""
        select page_id, case when page_id % 5 = 0 then 'notes/' || page_id || '?x' else {_CANON.format(x='url')} end as link from pages"""),
    "link_resolve": (link_resolve, r"""
        select page_id, cast(generate_subscripts(found, 1) - 1 as integer) as place,
               regexp_extract(url, '^([a-z]+://[^/]+)', 1) || unnest(found) as link
        from (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) as found from pages)"""),
    "date_display": (date_display, """
        select page_id as seq, case page_id % 4 when 2 then '1h ago' when 3 then '02 Sep 2025'
               else strftime(date '2025-01-01' + cast(page_id % 300 as integer), '%d %b %Y') end as date_display from pages"""),
    "news_source_union": (news_source_union, """
        select 'pages' as source, page_id as key, length(html) as chars from pages
        union all select 'documents', doc_id, length(text) from documents
        union all select 'talk', conv_id, length(text) from conversations
        union all select 'bench', item_id, length(text) from benchmark"""),
    "session_dedup_cap": (session_dedup_cap, """
        select min(event_id) as seq, event_type || '/' || user_id as link from events group by 2 order by 1 limit 200"""),
    "news_latest500": (news_latest500, """
        select doc_id as seq, cast(date '2025-01-01' + cast(n_chars % 200 as integer) as varchar) as scraped_date
        from documents order by 2 desc, 1 desc limit 500"""),
    "link_exists_anti": (link_exists_anti, r"""
        with asked as (
          select page_id, case page_id % 10 when 1 then regexp_extract(url, '^([a-z]+://[^/]+/)', 1)
                               when 3 then regexp_extract(url, '^([a-z]+://[^/]*[.]exampl)', 1)
                               when 5 then upper(url) else url end as link
          from pages where page_id % 2 = 1)
        select page_id, link from asked a where not exists (
          select 1 from pages p where p.page_id % 2 = 0
            and starts_with(lower(p.url), lower(regexp_replace(a.link, '[?#].*$', ''))))"""),
    "canonical_once": (canonical_once, f"""
        select seq, link from (select page_id as seq, url as link from pages)
        qualify row_number() over (partition by lower({_CANON.format(x='link')}) order by seq) = 1"""),
    "headline_fuzzy_dup": (headline_fuzzy_dup, _ALIKE + """
        select seq, exists (select 1 from heads o join alike on alike.a = n.headline and alike.b = o.headline
                            where o.seq % 2 = 0) as is_duplicate
        from heads n where seq % 2 = 1"""),
    # SQL that tells the common lengths of such long lines takes hours; tests compare with every pair of the smallest tables.
    "first_line_fuzzy_dup": (first_line_fuzzy_dup, None),
    "news_dedup_greedy": (news_dedup_greedy, GREEDY_SQL.format(stored="seq % 5 = 0")),
}
