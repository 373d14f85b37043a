"""Files, sheets, cleaning, metadata, append and ledger over the supplied tables."""

from datetime import datetime

from pyspark.sql import functions as F

from gavelline.bindings.base import table, total
from gavelline.constants import LOT_ALIASES
from gavelline.functions import dates, numbers
from gavelline.operators import certification, ingest, sheets
from gavelline.session import run_folder
from gavelline.sources import files, payloads

# --- file names made of orders -------------------------------------------------------------------------------------

# Spellings of file names that the rules tell apart.
_NAMES = [
    ("%~", "~$Sale {k}.xlsx"), ("general", "GeneralReport ({k}).csv"), ("offer", "Catalogue Sale {k}.xls"),
    ("average", "Sale {k} Average.xlsx"), ("sale", "Sale {k} (02.09.2025).csv"), ("comment", "Market Report {k}.docx"),
    ("plain", "Lots {k}.XLSX"), ("pdf", "Lots {k}.pdf"), ("numbered", "Sale_No_{k}_14th_15th_October_2025.csv"),
    ("commentsale", "Commentary Sale {k}.docx"), ("dated", "14th_October_2025_Sale_No_{k}_x.csv"),
]


def _order_files(spark, sf):
    k = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % len(_NAMES)
    name = None
    for i, (_, pattern) in enumerate(_NAMES):
        left, right = pattern.split("{k}")
        value = F.concat(F.lit(left), k, F.lit(right))
        name = F.when(kind == i, value) if name is None else name.when(kind == i, value)
    return table(spark, sf, "orders").select("o_orderkey", name.alias("file"))


_KIND = f"o_orderkey % {len(_NAMES)}"


def file_classify(spark, sf):
    return _order_files(spark, sf).select("o_orderkey", files.file_type(F.col("file")).alias("data_type"))


def filename_meta(spark, sf):
    number, date = ingest.filename_meta(F.col("file"))
    return _order_files(spark, sf).select(
        "o_orderkey", number.alias("sale_number"), date.cast("string").alias("sale_date")
    )


def _mapped_orders(spark, sf):
    """Orders as mapped lot rows: one file per customer, sale codes and end times as they come."""
    df = table(spark, sf, "orders")
    code = F.when(F.col("o_orderkey") % 5 != 4, F.concat(F.lit("Sale "), (F.col("o_orderkey") % 5).cast("string"), F.lit(" - M2")))
    day = F.when(F.col("o_custkey") % 3 != 0, F.date_format(F.date_trunc("month", "o_orderdate"), "dd/MM/yyyy"))
    name = F.concat(F.lit("Sale "), F.col("o_custkey").cast("string"), F.lit(" (02.09.2025).csv"))
    return df.select(name.alias("file"), "o_custkey", code.alias("sale_number_internal"), day.alias("sale_date_internal"))


def internal_meta_mode(spark, sf):
    df = ingest.internal_meta(_mapped_orders(spark, sf))
    return df.select("file", "internal_number", F.col("internal_date").cast("string").alias("internal_date"))


def meta_priority(spark, sf):
    df = ingest.meta_priority(_mapped_orders(spark, sf))
    return df.select("file", "sale_number", F.col("sale_date").cast("string").alias("sale_date"))


_META = """
with m as (
  select 'Sale ' || o_custkey || ' (02.09.2025).csv' as file, o_custkey as c,
         case when o_orderkey % 5 <> 4 then 'Sale ' || (o_orderkey % 5) || ' - M2' end as code,
         case when o_custkey % 3 <> 0 then strftime(date_trunc('month', o_orderdate), '%d/%m/%Y') end as day
  from orders),
codes as (select file, code from m where code is not null group by file, code
          qualify row_number() over (partition by file order by count(*) desc, code) = 1),
days as (select file, day from m where day is not null group by file, day
         qualify row_number() over (partition by file order by count(*) desc, day) = 1),
meta as (select coalesce(codes.file, days.file) as file, regexp_extract(code, 'Sale ([0-9]+)', 1) as n,
                cast(cast(strptime(day, '%d/%m/%Y') as date) as varchar) as d
         from codes full join days using (file))
"""

# --- text to values --------------------------------------------------------------------------------------------------


def _number_texts(spark, sf):
    k, v = F.col("c_custkey") % 8, F.col("c_acctbal")
    text = (
        F.when(k == 0, F.concat(F.lit("$"), F.format_number(v, 2)))
        .when(k == 1, F.concat(F.lit("  "), F.replace(F.format_number(v, 2), F.lit(",")), F.lit(" ")))
        .when(k == 2, F.lit("-")).when(k == 3, F.lit("   ")).when(k == 4, F.lit("12abc")).when(k == 5, F.lit("1e3"))
        .when(k == 6, F.lit("1d")).otherwise(F.replace(F.format_number(v, 1), F.lit(",")))
    )
    return table(spark, sf, "customer").select("c_custkey", text.alias("text"))


def numeric_clean(spark, sf):
    return _number_texts(spark, sf).select("c_custkey", numbers.numeric(F.col("text")).alias("number"))


def intlike_clean(spark, sf):
    return _number_texts(spark, sf).select("c_custkey", numbers.whole_number(F.col("text")).alias("number"))


def bytes_numeric(spark, sf):
    """Numbers kept as bytes, with a stray byte in front of every third."""
    digits = F.replace(F.format_number("c_acctbal", 2), F.lit(",")).cast("binary")
    kept = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.unhex(F.lit("FF")), digits)).otherwise(digits)
    df = table(spark, sf, "customer").select("c_custkey", kept.alias("blob"))
    return df.select("c_custkey", numbers.bytes_number(F.col("blob")).alias("number"))


_DATE_STYLES = [
    "dd/MM/yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "dd-MMM-yyyy", "dd/MM/yyyy", "dd.MM.yyyy", "d MMMM yyyy", "dd-MMM-yy", "yyyyMMdd",
    "EEEE d MMMM yyyy", "yyyy.MM.dd", "MMM d, yyyy", "MM/dd/yy",
]


def date_parse(spark, sf):
    """Order dates written in every accepted format, with noise and garbage between them."""
    k, d = F.col("o_orderkey") % 16, F.col("o_orderdate")
    text = F.when(k == 13, F.lit(" nil ")).when(k == 14, F.lit("13/25/2025")).when(k == 15, F.lit("45902"))
    for i, style in enumerate(_DATE_STYLES):
        tail = {0: " 12:49:12:300", 1: " 08:05:09"}.get(i, "")
        text = text.when(k == i, F.concat(F.date_format(d, style), F.lit(tail)))
    df = table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return df.select("o_orderkey", dates.parse_date(F.col("text")).cast("string").alias("day"))


def excel_serial_date(spark, sf):
    number = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date")) + F.lit(0.25)
    df = table(spark, sf, "orders").select("o_orderkey", number.alias("number"))
    return df.select("o_orderkey", dates.serial_date(F.col("number")).cast("string").alias("day"))


# --- sheets made of suppliers ----------------------------------------------------------------------------------------
# Even nations use one layout, odd nations another; a nation's sheet has 0 to 2 title rows.  In every second odd nation
# the Mark column is empty, so that Estate takes its place.

# Header spellings.
_EVEN = ["Broker", "LotNo", "Garden", "Grade", "Kilos", "Bags", "Price", "Remark"]
_ODD = [" lotno ", "BROKER", "Mark", "Estate", "Grade", "Net Weight", "Pkgs", "Final Price"]


def _grid(spark, sf, by_region=False):
    nations = table(spark, sf, "nation")
    k = F.col("n_nationkey")
    if by_region:
        file, sheet = F.concat(F.lit("Region "), F.col("n_regionkey").cast("string"), F.lit(".csv")), k.cast("int")
    else:
        file = F.when(k % 4 == 2, F.concat(F.lit("GeneralReport ("), k.cast("string"), F.lit(").csv"))).otherwise(
            F.concat(F.lit("Lots "), k.cast("string"), F.lit(".csv"))
        )
        sheet = F.lit(0)
    titles = F.when(F.contains(file, F.lit("General")), F.lit(0)).otherwise(k % 3)
    nations = nations.select("n_nationkey", file.alias("file"), sheet.alias("sheet"), titles.alias("titles"))

    def row(*cells):
        return F.array(*[c if hasattr(c, "cast") else F.lit(c) for c in cells])

    title = nations.select("file", "sheet", F.explode(F.when(
        F.col("titles") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("titles").cast("bigint") - 1)
    )).alias("row_pos"), row("Weekly lots", "", "Grade").alias("cells"))
    odd = F.col("n_nationkey") % 2 == 1
    header = nations.select(
        "file", "sheet", F.col("titles").cast("bigint").alias("row_pos"), F.when(odd, row(*_ODD)).otherwise(row(*_EVEN)).alias("cells")
    )
    noise = nations.filter(F.contains("file", F.lit("General"))).select(
        "file", "sheet", F.lit(1).cast("bigint").alias("row_pos"), row("x", "noise row", "x").alias("cells")
    )
    s = table(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    key, weight = F.col("s_suppkey").cast("string"), F.concat(F.lit("$"), F.format_number("s_acctbal", 2))
    mark = F.when(F.col("n_nationkey") % 4 == 1, F.lit("")).otherwise(F.concat(F.lit("M"), key))
    estate, price = F.concat(F.lit("E"), key), F.when(F.col("s_suppkey") % 4 == 0, F.lit("n/a")).otherwise(F.lit("2.5"))
    odd = F.col("n_nationkey") % 2 == 1
    data = s.select(
        "file", "sheet", (F.col("titles") + 2 + F.col("s_suppkey")).cast("bigint").alias("row_pos"),
        F.when(odd, row(key, F.col("s_name"), mark, estate, "bp1", weight, "12.9", price))
        .otherwise(row(F.col("s_name"), key, F.concat(F.lit("G"), key), "pf", weight, "7", price, "x")).alias("cells"),
    )
    return title.union(header).union(noise).union(data)


def header_detect(spark, sf):
    df = sheets.with_header(_grid(spark, sf))
    return df.select("file", "header_row", "first_row")


def alias_map(spark, sf):
    df = sheets.alias_map(_grid(spark, sf))
    return df.select("file", "broker", "lot_number", "mark", "grade", "quantity_kgs", "package_count", "price", "buyer")


def sheet_concat(spark, sf):
    """All nations of a region as sheets of one file: a target keeps the column of the first sheet that has it."""
    df = sheets.alias_map(_grid(spark, sf, by_region=True))
    return df.select("file", "sheet", "row_pos", "mark", "quantity_kgs", "package_count", "broker", "lot_number")


def drop_empty(spark, sf):
    """Prices of fully priced line items only; the null rows and the null column go."""
    df = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).alias("quantity"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return sheets.drop_empty(df)


def lot_csv_scan(spark, sf):
    """Sheets written as delimited files, then read back and mapped.

    Marks begin with a size in inches, whose sign stands in a cell without quotes; names are quoted and hold signs and line ends.
    """
    folder = run_folder(spark, "sheets")

    def written(c):
        quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        name = F.concat(F.lit('"'), c, F.lit('\n""and sons"", ltd"'))
        return F.when(c.rlike("^[MEG][0-9]+$"), F.concat(F.lit('5" '), c)).when(c.startswith("Supplier"), name).otherwise(quoted)

    lines = _grid(spark, sf).withColumn("value", F.array_join(F.transform("cells", written), ","))
    lines = lines.repartitionByRange("file").sortWithinPartitions("file", "row_pos")
    lines.select("file", "value").write.partitionBy("file").text(folder)
    # the folder of a file carries its name
    grid = files.read_grid(spark, [f"{folder}/*"], named_by_folder=True)
    return sheets.alias_map(grid).select("file", "lot_number", "broker", "mark", "quantity_kgs", "price")


_SHEETS = """
with n as (
  select *, case when n_nationkey % 4 = 2 then 'GeneralReport (' || n_nationkey || ').csv'
                 else 'Lots ' || n_nationkey || '.csv' end as file,
         case when n_nationkey % 4 = 2 then 0 else n_nationkey % 3 end as titles
  from nation),
cells as (
  select n.*, s.*, n_nationkey % 2 = 1 as odd, '$' || format('{:,.2f}', s_acctbal) as weight,
         case when s_suppkey % 4 <> 0 then '2.5' end as price
  from supplier s join n on s_nationkey = n_nationkey)
"""

_MARK = """case when not odd then 'G' || s_suppkey when n_nationkey % 4 = 1 then 'E' || s_suppkey else 'M' || s_suppkey end"""

# --- append and ledger -----------------------------------------------------------------------------------------------


def _keyed_lines(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(
        "l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("l_linenumber"), "l_shipdate", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", F.col("l_returnflag").alias("file_identifier"),
    )


_ORDER = ["file_identifier", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _appended(spark, sf):
    df = _keyed_lines(spark, sf)
    store, new = df.filter("file_identifier = 'A'"), df.filter("file_identifier <> 'A'")
    return ingest.append_unique(new, store, ["l_orderkey", "l_linenumber"], _ORDER)


def append_unique(spark, sf):
    df = _appended(spark, sf)
    return df.select("l_orderkey", F.coalesce("l_linenumber", F.lit(-1)).alias("l_linenumber"), "l_partkey", "l_suppkey", "l_quantity")


def ingest_counts(spark, sf):
    lines = _keyed_lines(spark, sf)
    seen = lines.select("file_identifier").distinct().select(
        "file_identifier", F.lit("SALE").alias("data_type"), F.lit(True).alias("readable")
    )
    return ingest.ingest_counts(seen, _appended(spark, sf))


_APPEND = """
with l as (select *, nullif(l_linenumber, 7) as line from lineitem),
fresh as (
  select * from l where l_returnflag <> 'A' and line is not null
  qualify row_number() over (partition by l_orderkey, line
    order by l_returnflag, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1),
added as (
  select * from fresh where not exists (select 1 from l s where s.l_returnflag = 'A' and s.l_orderkey = fresh.l_orderkey
                                         and s.line = fresh.line)
  union all select * from l where l_returnflag <> 'A' and line is null)
"""


def _ledger(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("file_identifier"), F.col("event_type").alias("data_type"),
        F.col("ts").alias("processed_timestamp"), F.col("event_id").alias("records_inserted"),
        F.when(F.col("value") > 100, F.lit("SUCCESS")).when(F.col("value") > 20, F.lit("NO_NEW_DATA"))
        .otherwise(F.lit("FAILURE")).alias("status"),
    )


def ledger_upsert(spark, sf):
    df = ingest.ledger_upsert(_ledger(spark, sf), ["file_identifier", "data_type"], ["processed_timestamp", "records_inserted"])
    return df.select("file_identifier", "data_type", "records_inserted", "status")


def incremental_skip(spark, sf):
    key = ["file_identifier", "data_type"]
    ledger = ingest.ledger_upsert(_ledger(spark, sf), key, ["processed_timestamp", "records_inserted"])
    return ingest.incremental_skip(_ledger(spark, sf).select(*key, "records_inserted"), ledger, key)


_LEDGER = """
with e as (
  select cast(user_id as varchar) as file_identifier, event_type as data_type, event_id as records_inserted,
         case when value > 100 then 'SUCCESS' when value > 20 then 'NO_NEW_DATA' else 'FAILURE' end as status, ts
  from events),
ledger as (
  select file_identifier, data_type, records_inserted, status from e
  qualify row_number() over (partition by file_identifier, data_type order by ts desc, records_inserted desc) = 1)
"""

# --- licences --------------------------------------------------------------------------------------------------------


def _licences(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("s_suppkey") % 900).cast("int"))
    k = F.col("s_suppkey") % 6
    text = (
        F.when(k == 4, F.date_format(day, "yyyyMMdd")).when(k == 5, F.lit("45902"))
        .when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "d MMMM yyyy"))
        .when(k == 2, F.date_format(day, "dd-MMM-yyyy")).otherwise(F.lit("soon"))
    )
    df = s.select(F.col("s_suppkey").cast("string"), F.col("s_name"), text, text, F.col("n_name"))
    return df.toDF("[certificateholder_id]", " [certificateholder_name]"[1:], "[start_date_license]", "[end_date_license ]", "country")


def licence_header_clean(spark, sf):
    return certification.licence_header_clean(_licences(spark, sf)).select("certificateholder_id", "certificateholder_name", "country")


def licence_dates(spark, sf):
    df = certification.licence_dates(certification.licence_header_clean(_licences(spark, sf)))
    return df.select(
        "certificateholder_id", F.col("start_date_license").cast("string").alias("start_date_license"),
        F.col("end_date_license").cast("string").alias("end_date_license"),
    )


def batch_append_history(spark, sf):
    """Two deliveries of the same list; both stay in the history."""
    df = certification.licence_dates(certification.licence_header_clean(_licences(spark, sf))).drop(
        "start_date_license", "end_date_license"
    )
    first = certification.batch_append_history(df, datetime(2025, 9, 2, 8, 0, 0), "batch-1")
    second = certification.batch_append_history(df, datetime(2025, 9, 9, 8, 0, 0), "batch-2")
    both = first.union(second)
    return both.withColumn("ingestion_timestamp", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss"))


# --- payloads --------------------------------------------------------------------------------------------------------


def _payloads(spark, sf):
    """One payload per order with two rows; some are empty, too narrow or broken."""
    k, key = F.col("o_orderkey") % 10, F.col("o_orderkey").cast("string")
    price = F.format_string("%s", F.col("o_custkey"))

    def row(lot, *rest):
        return F.array(F.concat(key, F.lit(lot)), F.col("o_orderpriority"), *[F.lit(r) for r in rest], price)

    wide = F.array(row("-1", "BP", "I1", "20"), row("-2", "PF", "I2", "40"))
    narrow = F.array(row("-1", "BP", "I1"))
    body = (
        F.when(k == 0, F.lit('{"aaData": []}')).when(k == 1, F.to_json(F.struct(narrow.alias("aaData"))))
        .when(k == 2, F.lit('{"aaData": [[')).otherwise(F.to_json(F.struct(wide.alias("aaData"))))
    )
    return table(spark, sf, "orders").select(F.col("o_orderstatus").alias("centre"), key.alias("sale"), body.alias("body"))


def json_rows_flatten(spark, sf):
    return payloads.json_rows_flatten(_payloads(spark, sf))


def harvest_union_csv(spark, sf):
    """The delimited output, read back."""
    folder = run_folder(spark, "harvest")
    payloads.harvest_union_csv(_payloads(spark, sf), folder)
    columns = ", ".join(f"`{c}` string" for c in payloads.PAYLOAD_COLUMNS + ["auction_centre", "sale_no_scraped"])
    return spark.read.schema(columns).option("header", True).csv(folder)


_FLAT = """
select o_orderkey || '-' || n as "Lot No", o_orderpriority as "Garden", case n when 1 then 'BP' else 'PF' end as "Grade",
       'I' || n as "Invoice", cast(n * 20 as varchar) as "Packages", cast(o_custkey as varchar) as "Price",
       o_orderstatus as auction_centre, cast(o_orderkey as varchar) as sale_no_scraped
from orders, (select unnest([1, 2]) as n) where o_orderkey % 10 > 2
"""

QUERIES = {
    "file_classify": (file_classify, f"""
        select o_orderkey, case {_KIND} when 1 then 'SALE' when 2 then 'OFFER' when 3 then 'SUMMARY' when 4 then 'SALE'
               when 5 then 'COMMENTARY' when 6 then 'SALE' when 8 then 'SALE' when 9 then 'SALE' when 10 then 'SALE' end as data_type
        from orders"""),
    "filename_meta": (filename_meta, f"""
        select o_orderkey, case when {_KIND} in (1, 4, 8, 10) then cast(o_orderkey as varchar) end as sale_number,
               case {_KIND} when 4 then '2025-09-02' when 10 then '2025-10-14' end as sale_date
        from orders"""),
    "internal_meta_mode": (internal_meta_mode, _META + "select file, n as internal_number, d as internal_date from meta"),
    "meta_priority": (meta_priority, _META + """
        select distinct m.file, coalesce(n, cast(c as varchar)) as sale_number, coalesce(d, '2025-09-02') as sale_date
        from m left join meta using (file)"""),
    "numeric_clean": (numeric_clean, """
        select c_custkey, case c_custkey % 8 when 0 then c_acctbal when 1 then c_acctbal when 5 then 1000.0
               when 7 then cast(format('{:.1f}', c_acctbal) as double) end as number from customer"""),
    "intlike_clean": (intlike_clean, """
        select c_custkey, case when c_custkey % 8 in (0, 1)
                 then cast(split_part(format('{:.2f}', c_acctbal), '.', 1) as double)
               when c_custkey % 8 = 5 then 1000.0
               when c_custkey % 8 = 7 then cast(split_part(format('{:.1f}', c_acctbal), '.', 1) as double) end as number
        from customer"""),
    "bytes_numeric": (bytes_numeric, "select c_custkey, c_acctbal as number from customer"),
    "date_parse": (date_parse, """
        select o_orderkey, case when o_orderkey % 16 < 13 then cast(cast(o_orderdate as date) as varchar) end as day
        from orders"""),
    "excel_serial_date": (excel_serial_date, "select o_orderkey, cast(cast(o_orderdate as date) as varchar) as day from orders"),
    "header_detect": (header_detect, _SHEETS + """
        select file, cast(titles as bigint) as header_row,
               cast(titles + case when file like 'General%' then 2 else 1 end as bigint) as first_row from n"""),
    "alias_map": (alias_map, _SHEETS + f"""
        select file, s_name as broker, cast(s_suppkey as varchar) as lot_number, {_MARK} as mark,
               case when odd then 'bp1' else 'pf' end as grade, weight as quantity_kgs,
               case when odd then '12.9' else '7' end as package_count, price, cast(null as varchar) as buyer
        from cells"""),
    "sheet_concat": (sheet_concat, _SHEETS + """
        , named as (select *, 'Region ' || n_regionkey || '.csv' as book, n_nationkey % 3 as above from cells),
        names as (
          select 'Region ' || n_regionkey || '.csv' as book, target, name, min(n_nationkey * 10 + pos) as place
          from nation join (values (1, 'mark', 'Mark', 2), (1, 'mark', 'Estate', 3), (0, 'mark', 'Garden', 2),
                                   (1, 'kgs', 'Net Weight', 5), (0, 'kgs', 'Kilos', 4),
                                   (1, 'lot', ' lotno ', 0), (0, 'lot', 'LotNo', 1)) v(odd, target, name, pos)
               on n_nationkey % 2 = odd
          group by all),
        filled as (
          select distinct book, unnest(case when not odd then ['Garden', 'Kilos', 'LotNo']
                                            when n_nationkey % 4 = 1 then ['Estate', 'Net Weight', ' lotno ']
                                            else ['Mark', 'Estate', 'Net Weight', ' lotno '] end) as name
          from named),
        first as (select book, target, arg_min(name, place) as name from names join filled using (book, name) group by all),
        marks as (select book, name as m from first where target = 'mark'),
        weights as (select book, name as w from first where target = 'kgs'),
        lotnames as (select book, name as l from first where target = 'lot')
        select book as file, n_nationkey as sheet, cast(above + 2 + s_suppkey as bigint) as row_pos,
               case when m = 'Garden' and not odd then 'G' || s_suppkey
                    when m = 'Mark' and odd and n_nationkey % 4 <> 1 then 'M' || s_suppkey
                    when m = 'Estate' and odd then 'E' || s_suppkey end as mark,
               case when odd = (w = 'Net Weight') then weight end as quantity_kgs,
               case when odd = (w = 'Net Weight') then case when odd then '12.9' else '7' end end as package_count,
               case when odd = (l = ' lotno ') then s_name end as broker,
               case when odd = (l = ' lotno ') then cast(s_suppkey as varchar) end as lot_number
        from named join marks using (book) join weights using (book) join lotnames using (book)"""),
    "drop_empty": (drop_empty, """
        select case when l_returnflag <> 'R' then l_extendedprice end as price,
               case when l_linenumber = 1 then l_quantity end as quantity
        from lineitem where l_returnflag <> 'R' or l_linenumber = 1"""),
    "lot_csv_scan": (lot_csv_scan, _SHEETS + f"""
        select file, cast(s_suppkey as varchar) as lot_number, s_name || chr(10) || '"and sons", ltd' as broker,
               '5" ' || {_MARK} as mark, weight as quantity_kgs, price from cells"""),
    "append_unique": (append_unique, _APPEND + """
        select l_orderkey, coalesce(line, -1) as l_linenumber, l_partkey, l_suppkey, l_quantity from added"""),
    "ingest_counts": (ingest_counts, _APPEND + """
        select f.l_returnflag as file_identifier, 'SALE' as data_type, count(a.l_orderkey) as records_inserted,
               case when count(a.l_orderkey) > 0 then 'SUCCESS' else 'NO_NEW_DATA' end as status
        from (select distinct l_returnflag from lineitem) f left join added a using (l_returnflag) group by 1"""),
    "ledger_upsert": (ledger_upsert, _LEDGER + "select * from ledger"),
    "incremental_skip": (incremental_skip, _LEDGER + """
        select file_identifier, data_type, records_inserted from e
        where not exists (select 1 from ledger l where l.status = 'SUCCESS' and l.file_identifier = e.file_identifier
                          and l.data_type = e.data_type)"""),
    "licence_header_clean": (licence_header_clean, """
        select cast(s_suppkey as varchar) as certificateholder_id, s_name as certificateholder_name, n_name as country
        from supplier join nation on s_nationkey = n_nationkey"""),
    "licence_dates": (licence_dates, """
        select cast(s_suppkey as varchar) as certificateholder_id,
               case when s_suppkey % 6 in (0, 1, 2, 4) then cast(date '2020-01-01' + cast(s_suppkey % 900 as integer) as varchar) end as start_date_license,
               case when s_suppkey % 6 in (0, 1, 2, 4) then cast(date '2020-01-01' + cast(s_suppkey % 900 as integer) as varchar) end as end_date_license
        from supplier"""),
    "batch_append_history": (batch_append_history, """
        select cast(s_suppkey as varchar) as certificateholder_id, s_name as certificateholder_name, n_name as country,
               t as ingestion_timestamp, b as batch_id
        from supplier join nation on s_nationkey = n_nationkey,
             (values ('2025-09-02 08:00:00', 'batch-1'), ('2025-09-09 08:00:00', 'batch-2')) v(t, b)"""),
    "json_rows_flatten": (json_rows_flatten, _FLAT),
    "harvest_union_csv": (harvest_union_csv, _FLAT),
}
