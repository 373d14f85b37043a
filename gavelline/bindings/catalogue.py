"""Report index, catalogue, registry, datasets, postings and statistics over the supplied tables."""

from pyspark.sql import functions as F

from gavelline.bindings.base import table, total
from gavelline.functions.numbers import exact_sum
from gavelline.operators import catalogue, statistics

SOURCE = "Weekly Desk"


# --- index files and catalogue ---------------------------------------------------------------------------------------


def _index_files(spark, sf):
    """One index file per order with two entries; some files are broken, some entries lack a file name."""
    k, key = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    week = F.when(k % 7 == 0, F.lit("n/a")).otherwise(F.month("o_orderdate").cast("string"))

    def entry(sale, filename):
        return F.struct(
            F.concat(F.date_format("o_orderdate", "yyyy-"), F.lit(sale)).alias("sale_number"), week.alias("sale_num_only"),
            day.alias("sale_date"), F.when(k % 11 == 0, F.lit("Unknown")).otherwise(F.date_format("o_orderdate", "yyyy")).alias("year"),
            filename.alias("filename"), F.col("o_orderpriority").alias("location"),
            F.when(k % 3 != 0, F.concat(F.lit("Status "), F.col("o_orderstatus"))).alias("snapshot"),
        )

    named = F.concat(F.lit("report "), key, F.lit("_a+b.json"))
    body = F.to_json(F.array(entry("1", named), entry("2", F.when(k % 5 != 0, named))))
    broken = F.when(k % 13 == 0, F.lit('[{"sale_number": ')).otherwise(body)
    return table(spark, sf, "orders").select(F.concat(F.lit("f"), key).alias("path"), broken.alias("body"))


def _entries(spark, sf):
    return catalogue.index_entries(_index_files(spark, sf))


def _library(spark, sf):
    return catalogue.library_entries(_entries(spark, sf), SOURCE)


def index_scan(spark, sf):
    return _entries(spark, sf)


def report_link(spark, sf):
    return _library(spark, sf).drop("path", "pos")


def library_sort(spark, sf):
    return catalogue.library_sort(_library(spark, sf)).select("path", "pos", "year", "week_number")


def index_sort(spark, sf):
    return catalogue.index_sort(_entries(spark, sf)).select("sale_number", "path", "pos")


def facets(spark, sf):
    return catalogue.facets(_library(spark, sf))


def catalogue_filter(spark, sf):
    df = catalogue.catalogue_filter(_library(spark, sf), year=1997, centre="2-HIGH", term="STATUS o")
    return df.select("path", "pos", "report_link")


def period_text(spark, sf):
    week = F.when(F.col("o_orderkey") % 3 != 0, F.month("o_orderdate").cast("string"))
    year = F.when(F.col("o_orderkey") % 4 != 0, F.year("o_orderdate").cast("string"))
    df = table(spark, sf, "orders").select("o_orderkey", week.alias("week_number"), year.alias("year"))
    return catalogue.period_text(df).select("o_orderkey", "period_text")


_ENTRIES = """
with entries as (
  select 'f' || o_orderkey as path, cast(pos as integer) as pos, strftime(o_orderdate, '%Y-') || (pos + 1) as sale_number,
         case when o_orderkey % 7 = 0 then 'n/a' else cast(month(o_orderdate) as varchar) end as sale_num_only,
         strftime(o_orderdate, '%Y-%m-%d') as sale_date,
         case when o_orderkey % 11 = 0 then 'Unknown' else strftime(o_orderdate, '%Y') end as year,
         case when pos = 0 or o_orderkey % 5 <> 0 then 'report ' || o_orderkey || '_a+b.json' end as filename,
         o_orderpriority as location, case when o_orderkey % 3 <> 0 then 'Status ' || o_orderstatus end as snapshot
  from orders, (select unnest([0, 1]) as pos) where o_orderkey % 13 <> 0),
library as (
  select year, sale_num_only as week_number, location || ' Auction Analysis' as title,
         coalesce(snapshot, 'Awaiting data.') as description, location as auction_centre, 'Weekly Desk' as source,
         'report_viewer.html?data=report_data/' || replace(replace(filename, ' ', '%20'), '+', '%2B') as report_link, path, pos
  from entries where filename is not null)
"""

# --- registry --------------------------------------------------------------------------------------------------------


def _submissions(spark, sf):
    link = F.concat(F.lit("/reports/"), F.col("o_custkey").cast("string"), F.lit("/"), F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("submission"), F.concat(F.lit("Report "), F.col("o_custkey").cast("string")).alias("title"),
        F.col("o_orderstatus").alias("description"), F.col("o_orderpriority").alias("auction_centre"),
        F.month("o_orderdate").alias("week_number"), F.year("o_orderdate").alias("year"), F.lit(SOURCE).alias("source"),
        link.alias("report_link"),
    )


def _registered(spark, sf):
    """All reports come in, those of the year 1996 are known."""
    df = _submissions(spark, sf)
    return catalogue.registry_insert(df, df.filter("year = 1996"))


def _results(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("submission"), F.col("l_linenumber").cast("string").alias("lot_number"),
        F.col("l_partkey").cast("string").alias("garden_name"), F.col("l_quantity").alias("quantity_kg"),
        F.col("l_extendedprice").alias("price"),
    )


def registry_insert(spark, sf):
    return _registered(spark, sf).drop("source")


def registry_children(spark, sf):
    return catalogue.registry_children(_results(spark, sf), _registered(spark, sf))


def registry_export(spark, sf):
    return catalogue.registry_export(_registered(spark, sf))


def report_results(spark, sf):
    reports = _registered(spark, sf)
    results = catalogue.registry_children(_results(spark, sf), reports)
    df = catalogue.report_results(reports, results)
    return df.groupBy("report_id", "title", "auction_centre", "year", "week_number").agg(
        F.count("*").alias("lots"), F.min("price").alias("lowest"), F.max("quantity_kg").alias("largest")
    )


_REGISTRY = """
with subs as (
  select o_orderkey as submission, 'Report ' || o_custkey as title, o_orderstatus as description,
         o_orderpriority as auction_centre, cast(month(o_orderdate) as integer) as week_number,
         cast(year(o_orderdate) as integer) as year, 'Weekly Desk' as source,
         '/reports/' || o_custkey || '/' || year(o_orderdate) as report_link
  from orders),
added as (
  select *, sha256(report_link) as report_id from subs
  where report_link not in (select report_link from subs where year = 1996)
  qualify row_number() over (partition by report_link order by submission) = 1),
children as (
  select report_id, cast(l_linenumber as varchar) as lot_number, cast(l_partkey as varchar) as garden_name,
         cast(null as varchar) as tea_grade, l_quantity as quantity_kg, l_extendedprice as price
  from lineitem join added on l_orderkey = submission)
"""

# --- datasets and postings -------------------------------------------------------------------------------------------


def _datasets(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("title"), F.concat(F.lit("About "), F.col("p_type")).alias("description"),
        F.col("p_brand").alias("source"), F.array("p_type", F.concat(F.lit("Size "), F.col("p_size").cast("string"))).alias("tags"),
    )


def dataset_search(spark, sf):
    return catalogue.dataset_search(_datasets(spark, sf), "SIZE 4").select("p_partkey", "title")


def dataset_sort(spark, sf):
    return catalogue.dataset_sort(_datasets(spark, sf)).select("title", "p_partkey")


def _jobs(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("title"), F.concat(F.initcap("p_type"), F.lit("  Time")).alias("type"),
        F.concat(F.lit("Port "), F.col("p_brand")).alias("location"), F.col("p_size").cast("string").alias("item_id"),
    )


def job_filter(spark, sf):
    return catalogue.job_filter(_jobs(spark, sf), "economy-time", "port-brand#11").select("p_partkey", "title")


def job_facets(spark, sf):
    return catalogue.job_facets(_jobs(spark, sf))


def _saves(spark, sf):
    kind = F.when(F.col("event_type") == "purchase", F.lit("jobs")).otherwise(F.col("event_type"))
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), kind.alias("item_type"),
        F.floor("value").cast("string").alias("item_id"),
    )


def saved_flag(spark, sf):
    return catalogue.saved_flag(_jobs(spark, sf), _saves(spark, sf), "7", "jobs").select("p_partkey", "item_id", "saved")


def saved_items(spark, sf):
    return catalogue.saved_items(_jobs(spark, sf), _saves(spark, sf), "7", "jobs").select("p_partkey", "item_id")


_SAVED = """(select cast(cast(floor(value) as bigint) as varchar) from events where event_type = 'purchase' and user_id = 7)"""

# --- statistics ------------------------------------------------------------------------------------------------------


def _nations(spark, sf):
    """Customer balances by nation as this year, order totals by nation as last year."""
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(exact_sum(F.col("c_acctbal")).alias("current_year_todate"))
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.groupBy(F.col("c_nationkey").alias("o_nationkey")).agg(exact_sum(F.col("o_totalprice")).alias("previous_year_todate"))
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    df = n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(o, F.col("n_nationkey") == F.col("o_nationkey"), "left")
    some = F.when(F.col("n_nationkey") % 6 != 0, F.col("previous_year_todate"))
    return df.select("n_name", "r_name", "current_year_todate", some.alias("previous_year_todate"))


def _documents(spark, sf):
    """Statistics documents, one per nation, in the nested form in which they are published."""
    df = _nations(spark, sf)
    difference = F.col("current_year_todate") - F.col("previous_year_todate")
    region = F.struct(
        F.col("n_name").alias("region"), F.lit("August").alias("as_of_month"), "current_year_todate",
        "previous_year_todate", difference.alias("difference"), F.lit(SOURCE).alias("source"),
    )
    channel = F.struct(F.col("n_name").alias("channel"), "current_year_todate", "previous_year_todate")
    stats = F.struct(F.lit("August").alias("as_of_date"), F.array(channel).alias("channels"))
    return df.select(F.array(region).alias("production_statistics_mkg"), F.create_map("r_name", stats).alias("sales_channel_statistics_kg"))


def production_totals(spark, sf):
    return statistics.production_totals(statistics.production_rows(_documents(spark, sf)))


def channel_totals(spark, sf):
    return statistics.channel_totals(statistics.channel_rows(_documents(spark, sf)))


def _imports(spark, sf):
    """Shipped quantity and price by supplier nation as imports."""
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, sf, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    df = lines.groupBy("n_name", "n_nationkey").agg(
        exact_sum(F.col("l_quantity")).alias("mass"), exact_sum(F.col("l_extendedprice")).alias("value"),
    )
    k = F.col("n_nationkey")
    return df.select(
        F.col("n_name").alias("partner_country"), F.when(k % 9 == 0, F.lit(0.0)).when(k % 7 != 0, F.col("mass")).alias("net_mass_kg"),
        F.col("value").alias("value_gbp"),
    )


def import_totals(spark, sf):
    return statistics.import_totals(_imports(spark, sf))


def imports_top10(spark, sf):
    return statistics.imports_top10(_imports(spark, sf))


def signed_diff(spark, sf):
    value = F.when(F.col("c_custkey") % 10 == 0, F.lit(0.0)).when(F.col("c_custkey") % 10 != 1, F.col("c_acctbal"))
    text, kind = catalogue.signed_diff(value, 1)
    return table(spark, sf, "customer").select("c_custkey", text.alias("text"), F.coalesce(kind, F.lit("")).alias("class"))


def dataset_period(spark, sf):
    name = F.concat(F.lit("uk-imports-"), F.lower(F.date_format("o_orderdate", "MMMM-yyyy")), F.lit(".json"))
    month, year = catalogue.dataset_period(name)
    return table(spark, sf, "orders").select("o_orderkey", month.alias("month"), year.alias("year"))


_STATISTICS = f"""
with figures as (
  select n_name, r_name, c.v as cur, case when n_nationkey % 6 <> 0 then o.v end as prev
  from nation join region on n_regionkey = r_regionkey
    left join (select c_nationkey, {total('c_acctbal')} as v from customer group by 1) c on c.c_nationkey = n_nationkey
    left join (select c_nationkey, {total('o_totalprice')} as v from orders join customer on o_custkey = c_custkey group by 1) o on o.c_nationkey = n_nationkey),
sums as (select coalesce({total('coalesce(cur, 0)')}, 0) as c, coalesce({total('coalesce(prev, 0)')}, 0) as p from figures),
parts as (select r_name, {total('coalesce(cur, 0)')} as c, {total('coalesce(prev, 0)')} as p from figures group by 1)
"""

_IMPORTS = f"""
with imports as (
  select n_name as partner_country,
         case when n_nationkey % 9 = 0 then 0 when n_nationkey % 7 <> 0 then {total('l_quantity')} end as net_mass_kg,
         {total('l_extendedprice')} as value_gbp
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  group by n_name, n_nationkey),
known as (select partner_country, coalesce(net_mass_kg, 0) as m, coalesce(value_gbp, 0) as v from imports)
"""

QUERIES = {
    "index_scan": (index_scan, _ENTRIES + "select * from entries"),
    "report_link": (report_link, _ENTRIES + "select * exclude (path, pos) from library"),
    "library_sort": (library_sort, _ENTRIES + "select path, pos, year, week_number from library"),
    "index_sort": (index_sort, _ENTRIES + "select sale_number, path, pos from entries"),
    "facets": (facets, _ENTRIES + """
        select distinct 'year' as facet, year as value from library
        union all select distinct 'auction_centre', auction_centre from library
        union all select distinct 'source', source from library"""),
    "catalogue_filter": (catalogue_filter, _ENTRIES + """
        select path, pos, report_link from library where year = '1997' and auction_centre = '2-HIGH'
          and (lower(title) like '%status o%' or lower(description) like '%status o%')"""),
    "period_text": (period_text, """
        select o_orderkey,
          case when o_orderkey % 3 <> 0
                 then 'Week ' || month(o_orderdate) || ', ' || case when o_orderkey % 4 <> 0 then cast(year(o_orderdate) as varchar) else '' end
               when o_orderkey % 4 <> 0 then cast(year(o_orderdate) as varchar) else '' end as period_text
        from orders"""),
    "registry_insert": (registry_insert, _REGISTRY + "select * exclude (source) from added"),
    "registry_children": (registry_children, _REGISTRY + "select * from children"),
    "registry_export": (registry_export, _REGISTRY + "select * exclude (submission, report_id) from added"),
    "report_results": (report_results, _REGISTRY + """
        select report_id, title, auction_centre, year, week_number, count(*) as lots, min(price) as lowest,
               max(quantity_kg) as largest
        from children join added using (report_id) group by all"""),
    "dataset_search": (dataset_search, """
        select p_partkey, p_name as title from part
        where lower(p_name) like '%size 4%' or lower(p_type) like '%size 4%' or lower(p_brand) like '%size 4%'
           or ('size ' || p_size) like '%size 4%'"""),
    "dataset_sort": (dataset_sort, "select p_name as title, p_partkey from part"),
    "job_filter": (job_filter, "select p_partkey, p_name as title from part where lower(p_type) = 'economy' and p_brand = 'Brand#11'"),
    "job_facets": (job_facets, """
        select distinct 'type' as facet, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || '  Time' as value,
               lower(p_type) || '-time' as slug from part
        union all select distinct 'location', 'Port ' || p_brand, 'port-' || lower(p_brand) from part"""),
    "saved_flag": (saved_flag, f"select p_partkey, cast(p_size as varchar) as item_id, cast(p_size as varchar) in {_SAVED} as saved from part"),
    "saved_items": (saved_items, f"select p_partkey, cast(p_size as varchar) as item_id from part where cast(p_size as varchar) in {_SAVED}"),
    "production_totals": (production_totals, _STATISTICS + """
        select n_name as region, 'August' as as_of_month, cur as current_year_todate, prev as previous_year_todate,
               cur - prev as difference, 'Weekly Desk' as source, false as is_total from figures
        union all select 'TOTAL (Tracked Regions)', '', c, p, c - p, '', true from sums"""),
    "channel_totals": (channel_totals, _STATISTICS + """
        select r_name as region, n_name as channel, cur as current_year_todate, prev as previous_year_todate,
               coalesce(cur, 0) - coalesce(prev, 0) as difference, false as is_total from figures
        union all select r_name, 'TOTAL', c, p, c - p, true from parts"""),
    "import_totals": (import_totals, _IMPORTS + f"""
        select partner_country, m as net_mass_kg, v as value_gbp, case when m <> 0 and v <> 0 then v / m else 0 end as avg_price,
               false as is_total from known
        union all select 'TOTAL', {total('m')}, {total('v')}, case when {total('m')} > 0 then {total('v')} / {total('m')} else 0 end, true
        from known"""),
    "imports_top10": (imports_top10, _IMPORTS + """
        select * from imports order by coalesce(net_mass_kg, 0) desc, partner_country limit 10"""),
    "signed_diff": (signed_diff, """
        select c_custkey,
          case when c_custkey % 10 = 1 then 'N/A' when c_custkey % 10 = 0 then '0.0'
               when c_acctbal > 0 then '+' || format('{:,.1f}', c_acctbal) else format('{:,.1f}', c_acctbal) end as text,
          case when c_custkey % 10 < 2 then '' when c_acctbal > 0 then 'diff-positive' when c_acctbal < 0 then 'diff-negative'
               else '' end as class
        from customer"""),
    "dataset_period": (dataset_period, """
        select o_orderkey, strftime(o_orderdate, '%B') as month, strftime(o_orderdate, '%Y') as year from orders"""),
}
