"""Report index, catalogue, datasets and job postings."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelline.constants import REPORT_FOLDER, VIEWER_PAGE
from gavelline.functions.links import viewer_link
from gavelline.functions.text import grouped, holds, slug
from gavelline.schemas import INDEX_ENTRY


def index_entries(files: DataFrame) -> DataFrame:
    """Entries of index files given as (path, body), an array or an entry per line; a file that does not parse is skipped."""
    lines = F.concat(F.lit("["), F.regexp_replace(F.trim(F.regexp_replace("body", "\\s+$", "")), "\n", ","), F.lit("]"))
    files = files.withColumn("body", F.when(F.col("body").rlike("^\\s*\\["), F.col("body")).otherwise(lines))
    row = ", ".join(f"{n}: {t}" for n, t in (c.split() for c in INDEX_ENTRY.split(", ")))
    parsed = F.from_json("body", f"array<struct<{row}>>", {"mode": "PERMISSIVE"})
    return files.select("path", F.posexplode(parsed).alias("pos", "entry")).select("path", "pos", "entry.*")


def library_entries(entries: DataFrame, source: str, viewer=VIEWER_PAGE, folder=REPORT_FOLDER) -> DataFrame:
    """Index entries as catalogue entries; an entry without a file name is rejected."""
    place = F.coalesce("location", F.lit("Unknown"))
    keep = [c for c in ("path", "pos") if c in entries.columns]
    return entries.filter(F.col("filename").isNotNull()).select(
        F.coalesce("year", F.lit("Unknown")).alias("year"),
        F.col("sale_num_only").alias("week_number"),
        F.concat(place, F.lit(" Auction Analysis")).alias("title"),
        F.coalesce("snapshot", F.lit("Awaiting data.")).alias("description"),
        place.alias("auction_centre"),
        F.lit(source).alias("source"),
        viewer_link(F.concat(F.lit(folder + "/"), F.col("filename")), viewer).alias("report_link"),
        *keep,
    )


def _digits(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.rlike(r"^\d+$"), text.try_cast("bigint")).otherwise(F.lit(0))


def library_sort(entries: DataFrame) -> DataFrame:
    """Newest year and week first; texts that are no number count as 0, ties keep their order."""
    ties = [c for c in ("path", "pos") if c in entries.columns]
    return entries.orderBy(F.desc(_digits(F.col("year"))), F.desc(_digits(F.col("week_number"))), *ties)


def index_sort(entries: DataFrame) -> DataFrame:
    """Greatest sale number text first."""
    return entries.orderBy(F.desc("sale_number"))


def catalogue_filter(entries: DataFrame, year="all", centre="all", source="all", term="") -> DataFrame:
    """Chosen year, centre and source, and a text in title or description."""
    df = entries
    for column, choice in (("year", year), ("auction_centre", centre), ("source", source)):
        if choice != "all":
            df = df.filter(F.col(column).cast("string") == str(choice))
    if term:
        df = df.filter(holds(F.col("title"), term) | holds(F.col("description"), term))
    return df


def facets(entries: DataFrame) -> DataFrame:
    """Values to choose from: years from the newest, centres and sources by name."""
    values = entries.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))
        for c in ("year", "auction_centre", "source")
    ])).alias("f")).select("f.*").filter("value is not null and value <> ''").distinct()
    newest = F.when(F.col("facet") == "year", _digits(F.col("value"))).otherwise(F.lit(0))
    return values.orderBy("facet", F.desc(newest), "value")


def period_text(entries: DataFrame) -> DataFrame:
    """'Week w, y', or the year alone, or nothing."""
    week, year = F.col("week_number").cast("string"), F.col("year").cast("string")
    has_week, has_year = ~F.coalesce(week, F.lit("")).isin("", "0"), ~F.coalesce(year, F.lit("")).isin("", "0")
    text = F.when(has_week, F.concat(F.lit("Week "), week, F.lit(", "), F.coalesce(year, F.lit("")))).when(has_year, year)
    return entries.withColumn("period_text", F.coalesce(text, F.lit("")))


def dataset_search(datasets: DataFrame, term: str) -> DataFrame:
    """Datasets with the text in title, description, source or any tag."""
    tagged = F.coalesce(F.exists("tags", lambda t: holds(t, term)), F.lit(False))
    return datasets.filter(holds(F.col("title"), term) | holds(F.col("description"), term) | holds(F.col("source"), term) | tagged)


def dataset_sort(datasets: DataFrame) -> DataFrame:
    """By title in the order of a dictionary."""
    return datasets.orderBy(F.collate("title", "UNICODE"), "title")


def dataset_period(name: Column) -> tuple[Column, Column]:
    """(month, year) of a dataset called uk-imports-<month>-<year>."""
    parts = F.split(F.replace(F.replace(name, F.lit("uk-imports-")), F.lit(".json")), "-")
    month = F.get(parts, F.lit(0))
    return F.concat(F.upper(F.left(month, F.lit(1))), F.substr(month, F.lit(2))), F.get(parts, F.lit(1))


def signed_diff(c: Column, decimals: int) -> tuple[Column, Column]:
    """(text, class) of a difference: a plus in front of gains, N/A for null."""
    text = F.concat(F.when(c > 0, F.lit("+")).otherwise(F.lit("")), grouped(c, decimals))
    kind = F.when(c > 0, F.lit("diff-positive")).when(c < 0, F.lit("diff-negative")).otherwise(F.lit(""))
    return F.coalesce(text, F.lit("N/A")), kind


def job_filter(jobs: DataFrame, type_slug="all", location_slug="all") -> DataFrame:
    """Postings of the chosen type and location, compared as slugs."""
    df = jobs
    for column, choice in (("type", type_slug), ("location", location_slug)):
        if choice != "all":
            df = df.filter(slug(F.col(column)) == choice)
    return df


def job_facets(jobs: DataFrame) -> DataFrame:
    """Types and locations to choose from, with their slugs, by name."""
    values = jobs.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("type", "location")
    ])).alias("f")).select("f.*").filter("value is not null and value <> ''").distinct()
    return values.withColumn("slug", slug(F.col("value"))).orderBy("facet", "value")


def job_id(jobs: DataFrame) -> DataFrame:
    """Postings with an id that depends on their content only, and its text for page attributes."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "company", "location", "type", "link")]
    key = F.sha2(F.concat_ws("\x1f", *parts), 256)
    return jobs.withColumns({"id": key, "item_id": F.base64(key.cast("binary"))})


def saved_flag(items: DataFrame, saves: DataFrame, user_id: str, item_type: str) -> DataFrame:
    """Items with a flag telling whether the user saved them."""
    mine = _saved(saves, user_id, item_type).withColumn("saved", F.lit(True))
    return items.join(mine, "item_id", "left").fillna(False, ["saved"])


def saved_items(items: DataFrame, saves: DataFrame, user_id: str, item_type: str) -> DataFrame:
    """Only the items that the user saved."""
    return items.join(_saved(saves, user_id, item_type), "item_id", "left_semi")


def _saved(saves: DataFrame, user_id: str, item_type: str) -> DataFrame:
    return saves.filter((F.col("user_id") == user_id) & (F.col("item_type") == item_type)).select("item_id").distinct()


def registry_insert(submissions: DataFrame, known: DataFrame) -> DataFrame:
    """Report headers to add: the first submission of a link that is not registered yet.

    The id follows from the link, so concurrent runs need no counter.
    """
    place = F.row_number().over(Window.partitionBy("report_link").orderBy("submission"))
    needed = submissions.na.drop(subset=["title", "auction_centre", "year", "source", "report_link"])
    first = needed.withColumn("place", place).filter("place = 1").drop("place")
    new = first.join(known.select("report_link"), "report_link", "left_anti")
    return new.withColumn("report_id", F.sha2("report_link", 256))


def registry_children(rows: DataFrame, added: DataFrame) -> DataFrame:
    """Result rows of the submissions that were added, under the id of their report; missing columns are null."""
    columns = {"lot_number": "string", "garden_name": "string", "tea_grade": "string", "quantity_kg": "double", "price": "double"}
    ids = added.select("submission", "report_id")
    return rows.join(ids, "submission").select("report_id", *[
        (F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()
    ])


def registry_export(reports: DataFrame) -> DataFrame:
    """Registered reports, newest first; reports without a week come last in their year."""
    return reports.select(
        "title", "description", "auction_centre", "week_number", "year", "source", "report_link"
    ).orderBy(F.desc("year"), F.desc("week_number"))


def report_results(reports: DataFrame, results: DataFrame) -> DataFrame:
    """Result rows with the header of their report."""
    return results.join(reports.select("report_id", "title", "auction_centre", "year", "week_number"), "report_id")
