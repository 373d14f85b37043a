"""Weekly key figures, movements, market views and report texts over the lots."""

from pyspark.sql import functions as F

from gavelline.bindings.base import (
    KPIS_SQL, MOVES_SQL, lots, mean, prepared_offers, prepared_sales, raw_offers, raw_sales, total, with_lots,
)
from gavelline.operators import kpis, lots as lot_ops, market, movements, sequence
from gavelline.schemas import AUCTION_OFFERS
from gavelline.sources.tables import table_or_empty

LOW, HIGH = 20000.0, 60000.0  # an example price interval


def _weeks(spark, sf):
    return sequence.sale_universe(raw_sales(spark, sf), raw_offers(spark, sf))


def _previous(spark, sf):
    """The sale before each: sales and offers read once."""
    marked = lot_ops.mark_sales(raw_sales(spark, sf)).select("sale_number", F.col("priced").alias("marked"))
    return sequence.previous_of(marked, raw_offers(spark, sf))


def sale_kpis(spark, sf):
    return kpis.sale_kpis(raw_sales(spark, sf), raw_offers(spark, sf))


def price_change(spark, sf):
    return kpis.price_change(sale_kpis(spark, sf)).select(
        "sale_number", "avg_price", "prev_avg_price", "price_change_numeric", "price_change", "price_change_class"
    )


def sell_through(spark, sf):
    return kpis.sell_through(raw_sales(spark, sf), raw_offers(spark, sf))


def weekly_kpis(spark, sf):
    return kpis.weekly_kpis(raw_sales(spark, sf), raw_offers(spark, sf))


def snapshot_text(spark, sf):
    return weekly_kpis(spark, sf).select(
        "sale_number", "total_volume_text", "avg_price_text", "price_change", "sell_through_text", "snapshot"
    )


def kpi_table(spark, sf):
    return kpis.kpi_table(sell_through(spark, sf))


def outlook(spark, sf):
    return kpis.outlook(raw_sales(spark, sf), raw_offers(spark, sf), "the coast").select(
        "sale_number", "next_sale", "forthcoming_offerings_kgs", "weather_outlook"
    )


def forthcoming_volume(spark, sf):
    return kpis.outlook(raw_sales(spark, sf), raw_offers(spark, sf), "the coast").select(
        "sale_number", "next_sale", F.coalesce("forthcoming_kgs", F.lit(0.0)).alias("forthcoming_kgs")
    )


def prev_sale_asof(spark, sf):
    """The sale before each week, with the rows it brings along."""
    rows = prepared_sales(spark, sf).groupBy("sale_number").agg(F.count("*").alias("n"))
    rows = rows.withColumnRenamed("sale_number", "previous_sale")
    df = _previous(spark, sf).join(rows, "previous_sale", "left")
    return df.select("sale_number", "previous_sale", F.coalesce("n", F.lit(0)).alias("previous_rows"))


def next_sale_asof(spark, sf):
    return sequence.next_sales(_weeks(spark, sf), prepared_offers(spark, sf))


def sale_universe(spark, sf):
    return _weeks(spark, sf)


def sale_date_first(spark, sf):
    position = F.struct("sale_date", "broker", "lot_number")
    df = sequence.sale_dates(raw_sales(spark, sf), prepared_offers(spark, sf), position)
    return df.select("sale_number", F.col("sale_date").cast("string").alias("sale_date"))


def sale_attributes(spark, sf):
    position = F.struct("sale_date", "broker", "lot_number")
    dates = sequence.sale_dates(raw_sales(spark, sf), prepared_offers(spark, sf), position)
    df = sequence.sale_attributes(dates)
    return df.select("sale_number", F.col("sale_week").cast("double").alias("sale_week"), "sale_num_only", "year")


def _lot_key(*extra):
    return ["sale_number", "broker", "lot_number", *extra]


def text_clean(spark, sf):
    df = lots(spark, sf, "mark", "buyer").withColumn("buyer", F.coalesce("buyer", F.lit(" n/a ")))
    df = lot_ops.clean_columns(df.withColumn("mark", F.concat(F.lit("  "), F.lower("mark"))))
    return df.groupBy("mark", "grade").agg(
        F.count("buyer").alias("named"), F.count("*").alias("n"), F.min("broker").alias("first_broker")
    )


def key_filter(spark, sf):
    df = lots(spark, sf, "buyer").withColumn("broker", F.col("buyer"))
    df = lot_ops.key_filter(lot_ops.clean_columns(df))
    return df.groupBy("sale_number").agg(F.count("*").alias("n"))


def total_weight(spark, sf):
    return lot_ops.total_weight(raw_offers(spark, sf)).select(
        *_lot_key(), F.coalesce("package_count", F.lit(-9.0)).alias("package_count"), "total_weight_kgs"
    )


def sales_prepare(spark, sf):
    return prepared_sales(spark, sf, "mark", "buyer").select(
        *_lot_key("mark", "grade", "buyer", "price", "total_weight_kgs", "value_usd")
    )


def offers_prepare(spark, sf):
    return prepared_offers(spark, sf, "mark").select(*_lot_key("mark", "grade", "total_weight_kgs"))


def offers_sales_split(spark, sf):
    offers, sales = lot_ops.split_lots(lot_ops.lots_with_number(lots(spark, sf, "mark", "buyer")))
    def count(df, name):
        return df.groupBy("sale_number", "grade").agg(F.count("*").alias(name))

    return count(offers, "offers").join(count(sales, "sales"), ["sale_number", "grade"], "left").fillna(0)


def lot_validate(spark, sf):
    """Lots whose number survives the cleaning; line 1 of returned lots has a noise number here."""
    number = F.when((F.col("auction_type") == "F") & F.col("lot_number").endswith("-1"), F.lit(" nil ")).otherwise(F.col("lot_number"))
    df = lot_ops.clean_columns(lots(spark, sf).withColumn("lot_number", number))
    return lot_ops.lots_with_number(df).groupBy("sale_number").agg(F.count("*").alias("n"))


def raw_export(spark, sf):
    return lot_ops.raw_export(prepared_sales(spark, sf, "mark", "buyer"))


def table_scan_present(spark, sf):
    """Sales are there, the offers table is missing and reads as empty."""
    raw_sales(spark, sf).createOrReplaceTempView("gavelline_auction_sales")
    sales = table_or_empty(spark, "gavelline_auction_sales", AUCTION_OFFERS)
    offers = table_or_empty(spark, "gavelline_no_such_table", AUCTION_OFFERS)
    return sequence.sale_universe(sales, offers).join(
        sales.groupBy("sale_number").agg(F.count("*").alias("n")), "sale_number"
    )


def ohlc(spark, sf):
    return movements.ohlc(prepared_sales(spark, sf, "mark"))


def movement_join(spark, sf):
    return movements.movement_join(prepared_sales(spark, sf, "mark"))


def movement_metrics(spark, sf):
    return movements.movement_metrics(movement_join(spark, sf)).select(
        "sale_number", "mark", "grade", "change", "change_pct", "color"
    )


def movement_marks(spark, sf):
    return movements.movement_marks(movement_join(spark, sf))


def movement_by_mark(spark, sf):
    return movements.movement_by_mark(movement_join(spark, sf))


def top_movers(spark, sf):
    return movements.top_movers(movements.movement_metrics(movement_join(spark, sf)))


def insights_text(spark, sf):
    return movements.insights_of(raw_sales(spark, sf, "mark"), raw_offers(spark, sf))


def prev_grade_mean(spark, sf):
    return market.prev_grade_mean(prepared_sales(spark, sf, "grade"), _previous(spark, sf))


def prev_broker_total(spark, sf):
    return market.prev_broker_total(prepared_sales(spark, sf), _previous(spark, sf))


def grade_lookup(spark, sf):
    df = market.grade_lookup_of(raw_sales(spark, sf, "grade"), raw_offers(spark, sf))
    return df.select(*_lot_key("grade", "price", "prev_avg_price"))


def broker_lookup(spark, sf):
    df = market.broker_lookup_of(raw_sales(spark, sf), raw_offers(spark, sf))
    return df.select(*_lot_key("price", "prev_total_value"))


def grade_layer(spark, sf):
    return market.grade_layer_of(raw_sales(spark, sf, "grade"), raw_offers(spark, sf), LOW, HIGH)


def broker_layer(spark, sf):
    return market.broker_layer_of(raw_sales(spark, sf), raw_offers(spark, sf), LOW, HIGH)


def price_histogram(spark, sf):
    return market.price_histogram(prepared_sales(spark, sf))


def grade_performance(spark, sf):
    return market.grade_performance(prepared_sales(spark, sf, "grade"), LOW, HIGH)


def broker_performance(spark, sf):
    return market.broker_performance(prepared_sales(spark, sf), LOW, HIGH)


def buyer_ranking(spark, sf):
    return market.buyer_ranking(prepared_sales(spark, sf, "buyer"))


def top15_rank(spark, sf):
    return market.buyer_ranking(prepared_sales(spark, sf, "buyer"), "volume").select(
        "sale_number", "buyer", "total_volume", F.col("rank").cast("bigint").alias("rank")
    )


def buyer_grade_breakdown(spark, sf):
    return market.buyer_grades(prepared_sales(spark, sf, "buyer", "grade"))


def buyer_choice(spark, sf):
    chosen = ["CUSTOMER#000000001", "CUSTOMER#000000007"]
    return market.buyer_grade_breakdown(prepared_sales(spark, sf, "buyer", "grade"), chosen)


def grade_summary_build(spark, sf):
    return lot_ops.grade_summary(raw_offers(spark, sf, "grade"))


_PERFORMANCE_BINS = f"""
, per as (
  select sale_number, min(price) as low, max(price) as high,
         case when max(price) <> min(price) then max(price) - min(price)
              when min(price) <> 0 then abs(min(price)) else 1 end as span
  from sales group by 1),
s0 as (select *, pow(10.0, floor(log10(span) + 0.5) - 2) as step0 from per),
s1 as (select *, case when ceil(span / step0) <= 50 then step0 else step0 * 10 end as step1 from s0),
s2 as (select *, case when span / (step1 / 5) <= 50 then step1 / 5 else step1 end as step2 from s1),
s3 as (select *, case when span / (step2 / 2) <= 50 then step2 / 2 else step2 end as step from s2),
s4 as (select *, floor(low / step) * step as start, ceil(high / step) * step as stop from s3)
select sale_number, start + step * floor((least(price, stop - step) - start) / step + 1e-14) as bin_start, step,
       count(*) as lots
from sales join s4 using (sale_number) group by all
"""

_MOVERS = """
, named as (select * from moves where volume > 500 and mark <> 'N/A (Pending)'),
ranked as (
  select 'riser' as direction, *, row_number() over (partition by sale_number order by change_pct desc, mark, grade) as place
  from named
  union all
  select 'faller', *, row_number() over (partition by sale_number order by change_pct, mark, grade) from named),
movers as (
  select sale_number, direction, place, mark, grade, open, close, change_pct, volume from ranked where place <= 3)
"""

_INSIGHTS = """
, lines as (
  select sale_number,
         string_agg('- ' || mark || ' (' || grade || ') rose by ' || format('{:.1f}', change_pct) || '% (from $'
                    || format('{:.2f}', open) || ' to $' || format('{:.2f}', close) || ').', chr(10) order by place)
           filter (direction = 'riser') as up,
         string_agg('- ' || mark || ' (' || grade || ') decreased by ' || format('{:.1f}', change_pct) || '% (from $'
                    || format('{:.2f}', open) || ' to $' || format('{:.2f}', close) || ').', chr(10) order by place)
           filter (direction = 'faller') as down
  from movers group by 1)
select sale_number,
  case when sale_number not in (select sale_number from sales)
         then 'Awaiting current week data or missing key columns for trend analysis.'
       when previous_sale is null then 'First sale recorded; no historical data for comparison.'
       when sale_number not in (select sale_number from moves)
         then 'No common items sold between this week and the previous week for comparison.'
       when up is null
         then 'Prices across most compared gardens and grades remained relatively stable week-over-week.'
       else 'Notable price increases week-over-week (min 500kg):' || chr(10) || up || chr(10) || chr(10) || chr(10)
            || 'Significant price declines week-over-week (min 500kg):' || chr(10) || down end as insights
from previous left join lines using (sale_number)
"""

_TEXTS = """
, texts as (
  select sale_number, format('{:,.0f}', total_volume) as total_volume_text,
         '$' || format('{:.2f}', avg_price) as avg_price_text, price_change,
         format('{:.2f}%', sell_through_rate * 100) as sell_through_text,
         case when format('{:,.0f}', total_volume) = '0' then 'Awaiting sales results. Offers published.'
              else case when price_change_numeric > 1.5 then 'Prices significantly higher'
                        when price_change_numeric > 0.5 then 'Prices firm to dearer'
                        when price_change_numeric < -1.5 then 'Prices significantly lower'
                        when price_change_numeric < -0.5 then 'Prices easier' else 'Prices generally steady' end
                   || ' (' || price_change || '). '
                   || case when sell_through_rate > 0.95 then 'Excellent absorption.'
                           when sell_through_rate >= 0.85 then 'Good general demand.'
                           when sell_through_rate >= 0.75 then 'Fair demand; selective buying.'
                           else 'Low demand; significant withdrawals.' end end as snapshot
  from changes join rates using (sale_number))
"""

_CLASS = """case when price_change_numeric > 0.5 then 'positive' when price_change_numeric < -0.5 then 'negative'
                 else 'neutral' end as price_change_class"""

_AHEAD = f"""
, ahead as (
  select u.sale_number, min(o.sale_number) as next_sale
  from universe u left join (select distinct sale_number from offers) o on o.sale_number > u.sale_number group by 1),
volumes as (select sale_number as next_sale, {total('total_weight_kgs')} as kgs from offers group by 1),
forthcoming as (
  select sale_number, coalesce(next_sale, 'N/A') as next_sale, coalesce(kgs, 0) as kgs
  from ahead left join volumes using (next_sale))
"""

_GRADE_PREV = f"""
, means as (select sale_number, grade, {mean('price')} as m from sales group by all),
prev_grades as (
  select p.sale_number, grade, m as prev_avg_price from previous p join means on means.sale_number = p.previous_sale)
"""

_BROKER_PREV = f"""
, sums as (select sale_number, broker, {total('value_usd')} as m from sales group by all),
prev_brokers as (
  select p.sale_number, broker, m as prev_total_value from previous p join sums on sums.sale_number = p.previous_sale)
"""

_INTERVAL = f"price >= {LOW} and price <= {HIGH}"

_BUYERS = f"""
, totals as (
  select sale_number, buyer, {total('value_usd')} as total_value, {total('total_weight_kgs')} as total_volume
  from sales where buyer <> 'N/A (Pending)' group by all)
"""

QUERIES = {
    "sale_kpis": (sale_kpis, with_lots("select * from kpis", KPIS_SQL)),
    "price_change": (price_change, with_lots(
        f"select sale_number, avg_price, prev_avg_price, price_change_numeric, price_change, {_CLASS} from changes", KPIS_SQL)),
    "sell_through": (sell_through, with_lots("select * from rates", KPIS_SQL)),
    "weekly_kpis": (weekly_kpis, with_lots(
        _TEXTS + f"""select c.*, {_CLASS}, lots_offered, lots_sold, sell_through_rate, total_volume_text,
        avg_price_text, sell_through_text, 'N/A' as realization_rate, snapshot
        from changes c join rates using (sale_number) join texts using (sale_number)""", KPIS_SQL)),
    "snapshot_text": (snapshot_text, with_lots(_TEXTS + "select * from texts", KPIS_SQL)),
    "kpi_table": (kpi_table, with_lots("""
        select sale_number, 'sell_through' as "table", 'Lots Offered' as metric, format('{:,}', lots_offered) as value from rates
        union all select sale_number, 'sell_through', 'Lots Sold', format('{:,}', lots_sold) from rates
        union all select sale_number, 'sell_through', 'Rate', format('{:.2f}%', sell_through_rate * 100) from rates
        union all select sale_number, 'realization', 'Status', 'Insufficient Data' from rates""", KPIS_SQL)),
    "outlook": (outlook, with_lots(_AHEAD + """
        select sale_number, next_sale,
               case when kgs > 0 then format('{:,.0f}', kgs) else 'Awaiting Catalogues' end as forthcoming_offerings_kgs,
               'Seasonal weather patterns are prevailing in the key growing regions supplying the coast. '
               || 'Production levels are reported as stable.' as weather_outlook
        from forthcoming""")),
    "forthcoming_volume": (forthcoming_volume, with_lots(
        _AHEAD + "select sale_number, next_sale, kgs as forthcoming_kgs from forthcoming")),
    "prev_sale_asof": (prev_sale_asof, with_lots("""
        select p.sale_number, p.previous_sale, count(s.sale_number) as previous_rows
        from previous p left join sales s on s.sale_number = p.previous_sale group by 1, 2""")),
    "next_sale_asof": (next_sale_asof, with_lots(_AHEAD + "select * from ahead")),
    "sale_universe": (sale_universe, with_lots("select * from universe")),
    "sale_date_first": (sale_date_first, with_lots("""
        select u.sale_number, cast(coalesce(min(s.sale_date), min(o.sale_date)) as varchar) as sale_date
        from universe u left join (select sale_number, min(sale_date) as sale_date from raw_sales group by 1) s using (sale_number)
             left join (select sale_number, min(sale_date) as sale_date from offers group by 1) o using (sale_number)
        group by 1""")),
    "sale_attributes": (sale_attributes, with_lots("""
        select sale_number, cast(split_part(sale_number, '-', 2) as double) as sale_week,
               cast(cast(split_part(sale_number, '-', 2) as integer) as varchar) as sale_num_only,
               substr(sale_number, 1, 4) as year from universe""")),
    "text_clean": (text_clean, with_lots(
        "select mark, grade, count(buyer) as named, count(*) as n, min(broker) as first_broker from lots group by all")),
    "key_filter": (key_filter, with_lots(
        "select sale_number, count(*) as n from lots where buyer is not null group by 1")),
    "total_weight": (total_weight, with_lots("""
        select sale_number, broker, lot_number, coalesce(package_count, -9) as package_count, total_weight_kgs
        from raw_offers""")),
    "sales_prepare": (sales_prepare, with_lots("""
        select sale_number, broker, lot_number, mark, grade, buyer, price, total_weight_kgs, value_usd from sales""")),
    "offers_prepare": (offers_prepare, with_lots(
        "select sale_number, broker, lot_number, mark, grade, total_weight_kgs from offers")),
    "offers_sales_split": (offers_sales_split, with_lots(
        "select sale_number, grade, count(*) as offers, count(price) as sales from lots group by all")),
    "lot_validate": (lot_validate, with_lots("""
        select sale_number, count(*) as n from lots
        where not (auction_type = 'F' and lot_number like '%-1') group by 1""")),
    "raw_export": (raw_export, with_lots("""
        select sale_number, mark as "Mark", grade as "Grade", lot_number as "Lot", total_weight_kgs as "KGs",
               price as "Price (USD)", buyer as "Buyer", broker as "Broker" from sales""")),
    "table_scan_present": (table_scan_present, with_lots(
        "select sale_number, count(*) as n from raw_sales group by 1")),
    "ohlc": (ohlc, with_lots("select * from bars", MOVES_SQL)),
    "movement_join": (movement_join, with_lots(
        "select sale_number, previous_sale, mark, grade, open, close, high, low, volume from moves", MOVES_SQL)),
    "movement_metrics": (movement_metrics, with_lots(
        "select sale_number, mark, grade, change, change_pct, color from moves", MOVES_SQL)),
    "movement_marks": (movement_marks, with_lots("""
        select distinct sale_number, mark, mark = min(mark) over (partition by sale_number) as is_default
        from moves where mark <> 'N/A (Pending)'""", MOVES_SQL)),
    "movement_by_mark": (movement_by_mark, with_lots("""
        select sale_number, previous_sale, mark, grade, open, close, high, low, volume from moves
        qualify mark = min(mark) over (partition by sale_number)""", MOVES_SQL)),
    "top_movers": (top_movers, with_lots(_MOVERS + "select * from movers", MOVES_SQL)),
    "insights_text": (insights_text, with_lots(_MOVERS + _INSIGHTS, MOVES_SQL)),
    "prev_grade_mean": (prev_grade_mean, with_lots(_GRADE_PREV + "select * from prev_grades")),
    "prev_broker_total": (prev_broker_total, with_lots(_BROKER_PREV + "select * from prev_brokers")),
    "grade_lookup": (grade_lookup, with_lots(_GRADE_PREV + """
        select sale_number, broker, lot_number, grade, price, prev_avg_price
        from sales left join prev_grades using (sale_number, grade)""")),
    "broker_lookup": (broker_lookup, with_lots(_BROKER_PREV + """
        select sale_number, broker, lot_number, price, prev_total_value
        from sales left join prev_brokers using (sale_number, broker)""")),
    "grade_layer": (grade_layer, with_lots(_GRADE_PREV + f"""
        select * from (select sale_number, grade, {mean('price')} as avg_price, {total('total_weight_kgs')} as volume
                       from sales where {_INTERVAL} group by all)
        full join prev_grades using (sale_number, grade)""")),
    "broker_layer": (broker_layer, with_lots(_BROKER_PREV + f"""
        select * from (select sale_number, broker, {total('value_usd')} as total_value, {mean('price')} as avg_price
                       from sales where {_INTERVAL} group by all)
        full join prev_brokers using (sale_number, broker)""")),
    "price_histogram": (price_histogram, with_lots(_PERFORMANCE_BINS)),
    "grade_performance": (grade_performance, with_lots(f"""
        select sale_number, grade, {mean('price')} as avg_price, {total('total_weight_kgs')} as volume
        from sales where {_INTERVAL} group by all""")),
    "broker_performance": (broker_performance, with_lots(f"""
        select sale_number, broker, {total('value_usd')} as total_value, {mean('price')} as avg_price
        from sales where {_INTERVAL} group by all""")),
    "buyer_ranking": (buyer_ranking, with_lots(_BUYERS + """
        select *, total_value as metric_sum, cast(rank() over (partition by sale_number order by total_value desc) as integer) as rank,
               total_value / total_volume as avg_price from totals qualify rank <= 15""")),
    "top15_rank": (top15_rank, with_lots(_BUYERS + """
        select sale_number, buyer, total_volume, rank() over (partition by sale_number order by total_volume desc) as rank
        from totals qualify rank <= 15""")),
    "buyer_grade_breakdown": (buyer_grade_breakdown, with_lots(f"""
        select sale_number, buyer, grade, {total('value_usd')} as total_value, {total('total_weight_kgs')} as total_volume
        from sales group by all""")),
    "buyer_choice": (buyer_choice, with_lots(f"""
        select sale_number, grade, {total('value_usd')} as total_value, {total('total_weight_kgs')} as total_volume,
               {total('value_usd')} as metric_sum
        from sales where buyer in ('CUSTOMER#000000001', 'CUSTOMER#000000007') group by all""")),
    "grade_summary_build": (grade_summary_build, with_lots(f"""
        select sale_number, auction_type, grade, count(distinct lot_number) as lots, {total('quantity_kgs')} as quantity_kgs
        from raw_offers group by all""")),
}
