"""The supplied tables seen as auction tables, in Spark and in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.operators.lots import prepare_offers, prepare_sales, stored_lots


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lots(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Line items as lots.  Only the tables behind the requested names (mark, grade, buyer) are joined."""
    df = table(spark, sf_dir, "lineitem")
    df = df.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    columns = {
        "sale_number": F.date_format("l_shipdate", "yyyy-MM"),
        "sale_date": F.col("l_shipdate").cast("date"),
        "broker": F.col("s_name"),
        "lot_number": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "quantity_kgs": F.col("l_quantity"),
        "package_count": (F.nullif("l_linenumber", F.lit(7)) - 2).cast("double"),
        "price": F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")),
        "auction_type": F.col("l_linestatus"),
    }
    if {"mark", "grade"} & set(names):
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
        df = df.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        columns |= {"mark": F.col("p_brand"), "grade": F.col("p_type")}
    if "buyer" in names:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        # orders get their names first, so that the larger line items are dealt out once
        named = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(named, F.col("l_orderkey") == F.col("o_orderkey"))
        open_lot = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1)
        columns["buyer"] = F.when(~open_lot, F.col("c_name"))
    return df.select(*[c.alias(n) for n, c in columns.items()])


def offered_lots(spark, sf_dir, *names) -> DataFrame:
    """Lots on offer as they are stored, not cleaned yet."""
    return lots(spark, sf_dir, *names).drop("price", "buyer")


def sold_lots(spark, sf_dir, *names) -> DataFrame:
    """Sold lots as they are stored, not cleaned yet."""
    return lots(spark, sf_dir, *names).drop("auction_type").filter(F.col("price").isNotNull())


def raw_offers(spark, sf_dir, *names) -> DataFrame:
    return stored_lots(offered_lots(spark, sf_dir, *names))


def raw_sales(spark, sf_dir, *names) -> DataFrame:
    return stored_lots(sold_lots(spark, sf_dir, *names))


def prepared_sales(spark, sf_dir, *names) -> DataFrame:
    return prepare_sales(raw_sales(spark, sf_dir, *names))


def prepared_offers(spark, sf_dir, *names) -> DataFrame:
    return prepare_offers(raw_offers(spark, sf_dir, *names))


def cleaned(column: str) -> str:
    """SQL of the text cleaning."""
    v = f"upper(trim({column}))"
    return f"case when {v} not in ('NAN','NONE','','-','NIL','N/A','NULL','UNKNOWN') then {v} end"


def total(expression: str) -> str:
    """SQL of the exact sum of doubles: whole numbers and 2^-53 parts in wide integers, rounded once."""
    x = f"cast({expression} as double)"
    units = f"sum(cast(trunc(({x} - trunc({x})) * 9007199254740992) as hugeint))"
    wholes = f"sum(cast(trunc({x}) as hugeint))"
    return (
        f"(cast({wholes} + {units} // 9007199254740992 as double) "
        f"+ cast({units} % 9007199254740992 as double) / 9007199254740992)"
    )


def mean(expression: str) -> str:
    """SQL of an unweighted mean that does not depend on row order."""
    return f"({total(expression)} / count({expression}))"


LOTS_SQL = f"""
lots as (
  select strftime(l_shipdate, '%Y-%m') as sale_number, cast(l_shipdate as date) as sale_date,
         {cleaned('s_name')} as broker, {cleaned('p_brand')} as mark, {cleaned('p_type')} as grade,
         concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as lot_number,
         l_quantity as quantity_kgs, cast(nullif(l_linenumber, 7) - 2 as double) as package_count,
         case when l_returnflag <> 'R' then l_extendedprice end as price,
         case when not (l_linestatus = 'F' and l_linenumber = 1) then {cleaned('c_name')} end as buyer,
         l_linestatus as auction_type,
         l_quantity * greatest(coalesce(cast(nullif(l_linenumber, 7) - 2 as double), 1), 1) as total_weight_kgs
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey),
raw_offers as (
  select * from lots where broker is not null and lot_number is not null and sale_number is not null
                           and sale_date is not null),
raw_sales as (select * from raw_offers where price is not null),
offers as (select * from raw_offers where total_weight_kgs > 0),
sales as (
  select * replace (coalesce(mark, 'N/A (Pending)') as mark, coalesce(grade, 'N/A (Pending)') as grade,
                    coalesce(buyer, 'N/A (Pending)') as buyer),
         price * total_weight_kgs as value_usd
  from raw_sales where total_weight_kgs > 0 and price > 0),
universe as (select sale_number from raw_sales union select sale_number from raw_offers),
previous as (
  select u.sale_number, (select max(s.sale_number) from (select distinct sale_number from sales) s
                         where s.sale_number < u.sale_number) as previous_sale
  from universe u)
"""

KPIS_SQL = f"""
sold as (
  select sale_number, count(*) as priced_lots, {total('total_weight_kgs')} as total_volume,
         {total('value_usd')} as total_value
  from sales group by sale_number),
kpis as (
  select sale_number, coalesce(priced_lots, 0) as priced_lots, coalesce(total_volume, 0) as total_volume,
         coalesce(total_value, 0) as total_value,
         case when total_volume > 0 then total_value / total_volume else 0 end as avg_price
  from universe left join sold using (sale_number)),
changes as (
  select k.*, p.avg_price as prev_avg_price,
         case when k.priced_lots > 0 and p.avg_price > 0
              then (k.avg_price - p.avg_price) / p.avg_price * 100 else 0 end as price_change_numeric,
         case when k.priced_lots > 0 and p.avg_price > 0
              then format('{{:+.2f}}%', (k.avg_price - p.avg_price) / p.avg_price * 100)
              when k.priced_lots > 0 then 'N/A (First Sale)' else 'N/A' end as price_change
  from kpis k left join previous using (sale_number) left join kpis p on p.sale_number = previous.previous_sale),
offered as (select sale_number, count(distinct (broker, lot_number)) as n from offers group by sale_number),
brought as (select sale_number, count(distinct (broker, lot_number)) as n from raw_sales group by sale_number),
through as (
  select u.sale_number, coalesce(o.n, 0) as lots_offered,
         case when k.priced_lots > 0 or o.n > 0 then coalesce(b.n, 0) else 0 end as lots_sold
  from universe u join kpis k using (sale_number) left join offered o using (sale_number)
       left join brought b using (sale_number)),
rates as (
  select *, case when lots_offered > 0 then cast(lots_sold as double) / lots_offered else 0 end as sell_through_rate
  from through)
"""

MOVES_SQL = f"""
bars as (
  select sale_number, mark, grade, {mean('price')} as close, max(price) as high, min(price) as low,
         {total('total_weight_kgs')} as volume
  from sales group by all),
moves as (
  select c.sale_number, p.previous_sale, c.mark, c.grade, b.close as open, c.close, c.high, c.low, c.volume,
         c.close - b.close as change, (c.close - b.close) / b.close * 100 as change_pct,
         case when c.close - b.close >= 0 then '#34a853' else '#ea4335' end as color
  from bars c join previous p using (sale_number)
       join bars b on b.sale_number = p.previous_sale and b.mark = c.mark and b.grade = c.grade)
"""


def with_lots(select: str, *more: str) -> str:
    return "with " + ",".join((LOTS_SQL,) + more) + select
