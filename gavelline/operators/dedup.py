"""News de-duplication: by link or link prefix, by similar headline, and both in the order of arrival."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelline.functions.links import canonical_link
from gavelline.functions.similarity import tile_pairs
from gavelline.functions.text import ascii_lower
from gavelline.operators.prefixes import prefix_matches
from gavelline.session import cut

#: How many alike headlines of a tile are looked for first, and by how much that grows while headlines are open.
FIRST_PARTNERS, FURTHER = 16, 8
#: Lengths of alike headlines differ by a factor below 219 / 181, which is less than WIDTH to the power of CLASSES.
WIDTH, CLASSES = 1.1, 2
#: Characters of a part of the headlines, and how many tasks tiles are dealt to.
PART, MOST_TASKS = 1 << 21, 4000


# --- links -----------------------------------------------------------------------------------------------------------


def clean_key(links: DataFrame) -> DataFrame:
    """Links with the lower-case canonical form that is looked for among stored links."""
    return links.withColumn("clean", ascii_lower(canonical_link(F.col("link"))))


def known_links(new: DataFrame, store: DataFrame) -> DataFrame:
    """Distinct new links that the store has already, as they are or as the start of a stored link, whatever their case."""
    links = clean_key(new.filter("link <> ''").select("link").distinct())
    stored = store.filter("link <> ''").select(ascii_lower(F.col("link")).alias("low"))
    hits = prefix_matches(links, stored, once=True).select("clean").distinct()
    return links.join(hits, "clean", "left_semi").select("link")


def link_exists_anti(new: DataFrame, store: DataFrame) -> DataFrame:
    """New rows whose link is not in the store; rows without a link count as new."""
    return new.join(known_links(new, store), "link", "left_anti").select(*new.columns)


# --- headlines -------------------------------------------------------------------------------------------------------


def with_id(texts: DataFrame) -> DataFrame:
    """Distinct headlines with a short id, so that keys and pairs need not carry the text."""
    return texts.select("headline").distinct().withColumn("id", F.unhex(F.md5("headline")))


def _sizes(texts: DataFrame) -> DataFrame:
    """Texts with the class of their length: alike ones are at most CLASSES classes apart."""
    sized = texts.filter("headline <> ''").withColumn("size", F.length("headline"))
    return sized.withColumn("class", F.floor(F.log("size") / F.log(F.lit(WIDTH))).cast("int"))


def _parts(sized: DataFrame) -> dict[int, int]:
    """Into how many parts the texts of a class are cut; there are as many classes as lengths have powers of WIDTH."""
    sums = sized.groupBy("class").agg(F.sum("size").alias("n")).collect()
    return {r["class"]: -(-r["n"] // PART) for r in sums}


def alike_pairs(left: DataFrame, right: DataFrame, most: int) -> DataFrame:
    """Pairs of ids (a, b) of alike texts of (id, headline, at) rows, of right texts whose `at` is below that of the left one.

    Both sides are cut into parts of like length and bounded size, and every two parts that can hold alike texts are a tile, the work
    of one task.  A left text leaves a tile with `most` alike ones found; `upto`, on a row without b, is the first `at` that it
    has not met then.  So near copies are settled without pairing them all.
    """
    spark = left.sparkSession
    mine, theirs = _sizes(left), _sizes(right)
    parts, others = _parts(mine), _parts(theirs)
    tiles = [(a, b, parts[a], others[b]) for a in parts for b in range(a - CLASSES, a + CLASSES + 1) if b in others]
    meet = spark.createDataFrame(tiles, "a int, b int, n_a int, n_b int")

    def dealt(sized, own, other):
        """Rows once per tile; the part is the id's, the other side's parts are counted through."""
        rows = sized.join(meet, F.col("class") == F.col(own))
        part = F.pmod(F.xxhash64("id"), F.col(f"n_{own}")).cast("int").alias(f"p_{own}")
        each = F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)).alias(f"p_{other}")
        rows = rows.select("id", "headline", "at", "a", "b", part, each)
        return rows.select(F.lit(own == "a").alias("mine"), "id", "headline", F.col("at").cast("long"), "a", "b", "p_a", "p_b")

    n = sum(n_a * n_b for _, _, n_a, n_b in tiles)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n, MOST_TASKS))
    rows = dealt(mine, "a", "b").union(dealt(theirs, "b", "a")).repartition(n, "a", "b", "p_a", "p_b")
    found = rows.groupBy("a", "b", "p_a", "p_b").applyInPandas(lambda tile: tile_pairs(tile, most), "a binary, b binary, upto long")
    return found


def headline_matches(new: DataFrame, store: DataFrame) -> DataFrame:
    """Distinct new headlines that are alike to a stored one: equal ones are found by a join, the others in tiles."""
    texts, known = with_id(new), with_id(store)
    equal = texts.join(known, "id", "left_semi").select("headline")
    rest = cut(texts.join(known, "id", "left_anti"))
    first = alike_pairs(rest.withColumn("at", F.lit(1)), cut(known).withColumn("at", F.lit(0)), 1)
    near = first.filter("b is not null").select(F.col("a").alias("id")).distinct()
    return equal.union(rest.join(near, "id", "left_semi").select("headline"))


def headline_fuzzy_dup(new: DataFrame, store: DataFrame) -> DataFrame:
    """New rows with a flag telling whether a stored headline is alike."""
    found = headline_matches(new, store).withColumn("is_duplicate", F.lit(True))
    return new.join(found, "headline", "left").fillna(False, ["is_duplicate"])


# --- both, in order of arrival ---------------------------------------------------------------------------------------
# A row is kept unless an earlier kept row (or the store) has its link or an alike headline.  Rows are decided in rounds: a row
# with no undecided earlier neighbour is kept, a row with a kept earlier neighbour is dropped, and dropped rows leave.  What a
# row needs to know of its neighbours is the smallest sequence number among them, which aggregates; groups are never listed.
# A headline takes a few of its neighbours in each tile only, the first ones.  Rows that have more before them wait, until a wider
# look is due; by then, most of what was before them has left.


def _smallest(*found: DataFrame, by: str, name: str) -> DataFrame:
    rows = reduce(DataFrame.union, found)
    return rows.groupBy(by).agg(F.min("seq").alias(name))


class _Links:
    def __init__(self, rows: DataFrame):
        self.members = cut(prefix_matches(rows.select("clean"), rows.select("low")))

    def earliest(self, rows: DataFrame, name: str) -> DataFrame:
        per_link = rows.groupBy("low").agg(F.min("seq").alias("seq"))
        return _smallest(self.members.join(per_link, "low").select("clean", "seq"), by="clean", name=name)


class _Headlines:
    """Alike headlines that come before an open one, `reach` of a tile at least, and up to which row that is all there are."""

    def __init__(self, rows: DataFrame, texts: DataFrame, reach: int):
        alive = rows.groupBy("id").agg(F.min("seq").alias("lead"), F.max(F.when(~F.col("kept"), F.col("seq"))).alias("last"))
        alive = cut(texts.join(alive, "id"))
        waiting = alive.filter("last is not null").select("id", "headline", F.col("last").alias("at"))
        found = cut(alike_pairs(waiting, alive.select("id", "headline", F.col("lead").alias("at")), reach))
        self.pairs = found.filter("b is not null").select("a", "b")
        self.limits = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.min("upto").alias("limit"))

    def earliest(self, rows: DataFrame, name: str) -> DataFrame:
        own = rows.groupBy("id").agg(F.min("seq").alias("seq"))
        near = self.pairs.join(own.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "seq")
        return _smallest(own, near, by="id", name=name)


def _without_dropped(rows: DataFrame, links: _Links, near: _Headlines) -> DataFrame:
    """Rows that are kept, or have no kept row before them that they repeat."""
    kept = rows.filter("kept")
    seen = rows.join(links.earliest(kept, "link_kept"), "clean", "left").join(near.earliest(kept, "near_kept"), "id", "left")
    first = (F.coalesce("link_kept", "seq") >= F.col("seq")) & (F.coalesce("near_kept", "seq") >= F.col("seq"))
    return seen.filter(F.col("kept") | first).select(*rows.columns)


def _round(rows: DataFrame, links: _Links, near: _Headlines) -> DataFrame:
    """Rows after those with nothing open before them are kept, and those that repeat a kept one have left."""
    open_rows = rows.filter("not kept")
    seen = rows.join(links.earliest(open_rows, "link_lead"), "clean", "left").join(near.earliest(open_rows, "lead"), "id", "left")
    seen = seen.join(near.limits, "id", "left")
    free = reduce(lambda a, b: a & b, [F.coalesce(c, "seq") >= F.col("seq") for c in ("link_lead", "lead", "limit")])
    decided = cut(seen.withColumn("kept", F.col("kept") | free).select(*rows.columns))
    return cut(_without_dropped(decided, links, near))


def news_dedup_greedy(new: DataFrame, store: DataFrame, fuzzy: bool = True, watch=None) -> DataFrame:
    """The new rows that enter the store, as if they were tested and added one by one in the order of `seq`.

    Rows without headline, source or link are rejected; an empty link is stored once and never counts as known.  `watch` is told
    the reach and the number of open rows before every round.
    """
    valid = new.na.drop(subset=["headline", "source", "link"])
    blank = cut(valid.filter("link = ''").orderBy("seq").limit(1).select("seq", "headline"))
    rows = valid.filter("link <> ''").groupBy("link", "headline").agg(F.min("seq").alias("seq"))
    rows = rows.join(known_links(rows, store), "link", "left_anti")
    if fuzzy:
        rows = rows.join(headline_matches(rows, store), "headline", "left_anti")
        if not blank.isEmpty():
            near = headline_matches(rows, blank).withColumn("near", F.lit(True))
            late = F.col("near") & (F.col("seq") > blank.select("seq").scalar())
            rows = rows.join(near, "headline", "left").filter(~F.coalesce(late, F.lit(False))).drop("near")
    # without the headline test every row is a text of its own, with no keys
    identity = F.unhex(F.md5("headline")) if fuzzy else F.col("seq").cast("string").cast("binary")
    named = clean_key(rows).select("seq", ascii_lower(F.col("link")).alias("low"), "clean", "headline", identity.alias("id"))
    named = cut(named)
    texts = cut(named.select("id", "headline").distinct())
    texts = texts if fuzzy else texts.filter("false")
    links = _Links(named)
    rows = cut(named.select("seq", "low", "clean", "id", F.lit(False).alias("kept")))
    left, reach = rows.count(), FIRST_PARTNERS
    while left:
        near = _Headlines(rows, texts, reach)
        rows, before = cut(_without_dropped(rows, links, near)), None
        left = rows.filter("not kept").count()
        while left and left != before:
            if watch:
                watch(reach, left)
            rows, before = _round(rows, links, near), left
            left = rows.filter("not kept").count()
        reach *= FURTHER
    return valid.join(rows.filter("kept").select("seq").union(blank.select("seq")), "seq", "left_semi")


def canonical_once(articles: DataFrame) -> DataFrame:
    """First article per canonical link, by sequence."""
    rest = [c for c in articles.columns if c != "clean"]
    keyed = clean_key(articles.filter("link <> ''"))
    first = keyed.groupBy("clean").agg(F.min_by(F.struct(*rest), "seq").alias("a"))
    return first.select("a.*")
