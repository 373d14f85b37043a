"""Whole runs over files: ingest, reports, news, catalogue and their streaming twins."""

import json
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gavelline.operators import catalogue, ingest, news, statistics
from gavelline.plans import ingest as ingest_plan
from gavelline.plans import certification, library, news as news_plan, registry, weekly
from gavelline.schemas import GLOBAL_STATISTICS
from gavelline.sources import files, payloads
from gavelline.sources.store import read_store
from gavelline.streaming import lots as lot_stream, news as news_stream

HEADER = "Broker,LotNo,Garden,Grade,Invoice,Kilos,Bags,Final Price,Buyer,Sale Code"


def write_sheets(folder):
    folder.mkdir()
    (folder / "Sale 35 (02.09.2025).csv").write_text(
        "Weekly lots,,\n\n" + HEADER + '\nAlpha,1,"Green, Hill",bp1,I1,"$1,000.5",20.9,2.5,Buyer A,Sale 36 - M2\n'
        + 'Alpha,2,"Two\nlines",pf,I2,10,,,,Sale 36 - M2\nAlpha,1,Dup,pf,I3,10,1,9,,Sale 36 - M2\n,,,,,,,,,\nBeta,nil,x,pf,I,1,1,1,,\n'
    )
    (folder / "GeneralReport (40).csv").write_text(HEADER + "\nnoise,,,,,,,,,\nAlpha,1,M,bp1,I1,10,2,1.5,B,\nGamma,7,M,bp1,I1,10,2,,B,\n")
    (folder / "Catalogue 41.csv").write_text("Lot No,Broker,Mark,Estate,Grade,Net Weight,RP\n9,Beta,,E9,bp1,55,3.1\n")
    (folder / "Sale Summary 3.csv").write_text("a,b\n1,2\n")
    (folder / "Sale 50 (02.09.2025).csv").write_text("\n")
    (folder / "notes.pdf").write_text("x")
    for name in ("Sale 60.xlsx", "Sale Average 61.xlsx"):
        (folder / name).write_bytes(b"PK\x03\x04\x00\xff,\n" * 20)


def stored(spark, root, name, *columns):
    return sorted((tuple(r) for r in read_store(spark, root, name).select(*columns).collect()), key=str)


def test_ingest_and_second_run(spark, tmp_path):
    write_sheets(tmp_path / "in")
    root = str(tmp_path / "store")
    log = ingest_plan.ingest_folder(spark, str(tmp_path / "in"), root, "Harbour", datetime(2025, 9, 3))
    status = {r["file_identifier"].split("|")[0]: (r["records_inserted"], r["status"]) for r in log.collect()}
    assert status["GeneralReport (40).csv"] == (3, "SUCCESS")
    assert status["Catalogue 41.csv"] == (1, "SUCCESS")
    assert status["Sale Summary 3.csv"] == (0, "NO_NEW_DATA")
    assert status["Sale 50 (02.09.2025).csv"] == (0, "FAILURE")
    assert "notes.pdf" not in status
    offers = stored(spark, root, "auction_offers", "sale_number", "lot_number", "broker", "mark", "quantity_kgs", "package_count")
    assert status["Sale 35 (02.09.2025).csv"] == (3, "SUCCESS")
    assert ("36", "1", "ALPHA", "GREEN, HILL", 1000.5, 20.0) in offers and ("36", "2", "ALPHA", "TWO\nLINES", 10.0, None) in offers
    assert len([o for o in offers if o[0] == "36"]) == 2
    assert stored(spark, root, "auction_sales", "sale_number", "lot_number", "price") == [("36", "1", 2.5), ("40", "1", 1.5)]
    assert status["Sale 60.xlsx"] == status["Sale Average 61.xlsx"] == (0, "FAILURE")
    dateless = read_store(spark, root, "auction_offers").filter("lot_number = '9'").first()
    assert dateless["mark"] == "E9" and dateless["sale_number"] is None and dateless["valuation_or_rp"] == 3.1
    again = ingest_plan.ingest_folder(spark, str(tmp_path / "in"), root, "Harbour", datetime(2025, 9, 4))
    retried = {r["file_identifier"].split("|")[0]: r["status"] for r in again.collect()}
    assert retried == {
        "Sale Summary 3.csv": "NO_NEW_DATA", "Sale 50 (02.09.2025).csv": "FAILURE", "Sale 60.xlsx": "FAILURE",
        "Sale Average 61.xlsx": "FAILURE",
    }
    assert stored(spark, root, "auction_offers", "sale_number", "lot_number", "broker", "mark", "quantity_kgs", "package_count") == offers


def test_stream_of_files_equals_batch(spark, tmp_path):
    write_sheets(tmp_path / "in")
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    ingest_plan.ingest_folder(spark, str(tmp_path / "in"), batch, "Harbour")
    lot_stream.stream_lot_files(spark, str(tmp_path / "in"), stream, "Harbour", str(tmp_path / "offsets")).awaitTermination()
    for name in ("auction_offers", "auction_sales"):
        columns = ["sale_number", "lot_number", "broker", "mark"]
        assert stored(spark, batch, name, *columns) == stored(spark, stream, name, *columns)
    out = str(tmp_path / "reports")
    weekly.build_reports(spark, batch, out, "Harbour")
    assert sorted(p.name for p in (tmp_path / "reports" / "documents").iterdir() if p.suffix == ".json") == ["harbour_36.json"]
    doc = json.loads((tmp_path / "reports" / "documents" / "harbour_36.json").read_text())
    assert doc["kpis"]["TOTAL_VOLUME"] == f"{1000.5 * 20:,.0f}" and doc["metadata"]["location"] == "Harbour"
    assert [b["lots"] for b in doc["charts"]["price_distribution"]] == [1] and doc["charts"]["broker_performance"][0]["broker"] == "ALPHA"
    assert [(r["rank"], r["buyer"]) for r in doc["charts"]["top_buyers_by_value"]] == [(1, "BUYER A")]
    entries = json.loads((tmp_path / "reports" / "harbour_index.json").read_text())
    assert [e["sale_number"] for e in entries] == ["36"]  # sale 40 has no date
    sources = {r["name"]: r["folder"] for r in doc["data_sources"]}
    assert spark.read.json(f"{out}/{sources['raw_sales_data']}").count() == 1
    listed = library.build_library(spark, out, "Desk").collect()
    assert [r["report_link"] for r in listed] == ["report_viewer.html?data=report_data/harbour_36.json"]


def test_append_rules(spark):
    schema = "location string, sale string, lot string, v int, pos int"
    rows = [("x", "1", "a", 1, 1), ("x", "1", "a", 2, 2), ("x", None, "a", 3, 3), ("x", None, "a", 4, 4), ("x", "2", "b", 5, 5)]
    new = spark.createDataFrame(rows, schema)
    key = ["location", "sale", "lot"]
    store = spark.createDataFrame([("x", "2", "b", 0, 0)], schema)
    added = ingest.append_unique(new, store, key, ["pos"])
    assert sorted(r["v"] for r in added.collect()) == [1, 3, 4]
    assert ingest.append_unique(added.filter("sale is not null"), store.union(added), key, ["pos"]).count() == 0


def test_histories_append(spark, tmp_path):
    root = str(tmp_path)
    rows = [("c1", "2 Sept 2025", "x"), ("c2", "45902", "y")]
    licences = spark.createDataFrame(rows, ["[certificateholder_id]", "[start_date_license ]", "country"])
    for batch in ("b1", "b2", "b2"):
        certification.append_certifications(licences, root, datetime(2025, 9, 3), batch)
    got = certification.certification_history(spark, root).collect()
    assert sorted((r["certificateholder_id"], str(r["start_date_license"]), r["batch_id"]) for r in got) == [
        ("c1", "2025-09-02", "b1"), ("c1", "2025-09-02", "b2"), ("c2", "None", "b1"), ("c2", "None", "b2")]
    heads = spark.createDataFrame(
        [(1, "t", "d", "c", 3, 2025, "s", "/a"), (2, "t", "d", "c", 4, 2025, "s", "/a"), (3, "t", "d", "c", None, 2025, "s", "/b")],
        "submission int, title string, description string, auction_centre string, week_number int, year int, source string, report_link string",
    )
    lots = spark.createDataFrame([(1, "l1"), (2, "l2"), (3, "l3"), (3, "l4")], "submission int, lot_number string")
    registry.register_reports(heads.filter("submission < 3"), lots, root, batch="b1")
    for _ in range(2):
        registry.register_reports(heads, lots, root, batch="b2")
    assert stored(spark, root, "reports", "report_link", "week_number") == [("/a", 3), ("/b", None)]
    assert stored(spark, root, "results", "lot_number") == [("l1",), ("l3",), ("l4",)]


def test_news_store(spark, tmp_path):
    schema = "seq bigint, headline string, snippet string, source string, link string, article_date string"
    first = [(1, "tea up", "", "s", "http://a.example.com/x?1", ""), (2, "tea down today", "", "s", "http://a.example.com/x?2", "")]
    news_plan.update_news(spark.createDataFrame(first, schema), str(tmp_path), "b1", datetime(2025, 1, 1))
    second = [(3, "tea up", "", "s", "http://b.example.com/y", ""), (4, "quite new", "", "s", "http://c.example.com/z", "2025-02-03")]
    rows = spark.createDataFrame(second, schema)
    news_plan.update_news(rows, str(tmp_path), "b2", datetime(2025, 1, 2))
    news_plan.update_news(rows, str(tmp_path), "b2", datetime(2025, 1, 2))
    got = [(r["seq"], r["date_display"]) for r in news_plan.newest_news(spark, str(tmp_path)).collect()]
    assert got == [(4, "03 Feb 2025"), (1, "01 Jan 2025")]
    rows.union(spark.createDataFrame(first, schema)).write.parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "feed"))
    news_stream.stream_news_dedup(stream, str(tmp_path / "s"), str(tmp_path / "o"), fuzzy=False).awaitTermination()
    assert sorted(r["seq"] for r in news_plan.newest_news(spark, str(tmp_path / "s")).collect()) == [1, 3, 4]


def test_catalogue_order(spark, tmp_path):
    weeks = [(2025, 40), (2025, 39), (2025, 39), ("Unknown", 7), (2024, "x"), (2025, 41)]
    entries = [
        {"sale_number": f"{y}-{w}", "sale_num_only": w, "sale_date": "d", "year": y, "filename": f"f {i}.json", "location": "Harbour", "snapshot": f"s{i}"}
        for i, (y, w) in enumerate(weeks)
    ]
    del entries[3]["filename"]
    (tmp_path / "a_index.json").write_text(json.dumps(entries, indent=2))
    (tmp_path / "b_index.json").write_text("[{broken")
    rows = library.build_library(spark, str(tmp_path), "Desk").collect()
    assert [r["description"] for r in rows] == ["s5", "s0", "s1", "s2", "s4"]
    assert rows[0]["report_link"] == "report_viewer.html?data=report_data/f%205.json" and rows[0]["title"] == "Harbour Auction Analysis"
    assert catalogue.period_text(spark.createDataFrame(rows)).first()["period_text"] == "Week 41, 2025"


def test_structured_data_rules(spark):
    ok = '{"@type":"ItemList","itemListElement":[{"item":{"@type":"Article","name":" N ","url":"u"}},{"item":{"@type":"Article","name":"x"}},3]}'
    empty = '{"@type":"ItemList","itemListElement":[{"item":{"@type":"Video","name":"v","url":"u"}}]}'
    def tag(body):
        return f'<script type="application/ld+json">{body}</script>'

    pages = [(1, tag('{"@type":"Thing"}') + tag("{bad") + tag(empty) + tag(ok) + tag(ok)), (2, "none")]
    df = news.jsonld_articles(spark.createDataFrame(pages, "page_id bigint, html string"), "S")
    assert [(r["page_id"], r["headline"], r["link"], r["article_date"]) for r in df.collect()] == [(1, "N", "u", "")]


def test_payload_rules(spark):
    six = ["1", "g", "bp", "i", "2", "3"]
    rows = [("c", "1", json.dumps({"aaData": [six, six[:4]]})), ("c", "2", json.dumps({"aaData": [six[:5]]})), ("c", "3", "{"), ("c", "4", '{"aaData": []}'), ("c", "5", "{}")]
    df = spark.createDataFrame(rows, "centre string, sale string, body string")
    got = payloads.json_rows_flatten(df).collect()
    assert [(r["sale_no_scraped"], r["Price"]) for r in got] == [("1", "3"), ("1", None)]
    assert sorted(r["sale"] for r in payloads.payload_rejects(df).collect()) == ["2", "3", "5"]


def test_statistics_document(spark, tmp_path):
    doc = {
        "current_year": 2025, "previous_year": 2024, "last_updated": "x",
        "production_statistics_mkg": [
            {"region": "A", "as_of_month": "May", "current_year_todate": 10.5, "previous_year_todate": None, "difference": None, "source": "s"},
            {"region": "B", "as_of_month": "May", "current_year_todate": 1.0, "previous_year_todate": 4.0, "difference": -3.0, "source": "s"}],
        "sales_channel_statistics_kg": {"A": {"as_of_date": "d", "channels": [{"channel": "c", "current_year_todate": 5.0, "previous_year_todate": 7.0}]}},
    }
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=1))
    df = payloads.read_json_table(spark, str(tmp_path / "d.json"), GLOBAL_STATISTICS)
    total = [r for r in statistics.production_totals(statistics.production_rows(df)).collect() if r["is_total"]][0]
    assert (total["current_year_todate"], total["previous_year_todate"], total["difference"]) == (11.5, 4.0, 7.5)
    parts = {(r["region"], r["channel"]): r["difference"] for r in statistics.channel_totals(statistics.channel_rows(df)).collect()}
    assert parts == {("A", "c"): -2.0, ("A", "TOTAL"): -2.0}


def test_greedy_does_not_depend_on_partitions(spark):
    from gavelline.operators.dedup import news_dedup_greedy

    rng = random.Random(9)
    rows = [(i, "price of tea " + rng.choice("abcd") * rng.randrange(1, 4), "s", f"http://h.example.com/{rng.randrange(30)}") for i in range(40)]
    df = spark.createDataFrame(rows, "seq bigint, headline string, source string, link string")
    store = df.filter("false")
    runs = [sorted(r["seq"] for r in news_dedup_greedy(df.repartition(n), store).collect()) for n in (1, 6)]
    assert runs[0] == runs[1]


def test_reports_read_lots_once_per_role(spark, monkeypatch):
    """Line items are read once for sales and once for offers; all that a report tells derives from what is written then."""
    from gavelline import session
    from gavelline.bindings import streams
    from gavelline.operators import kpis, market, movements

    read = []

    def counted(df, cut=session.cut):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        read.append(sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()))
        return cut(df)

    for module in (weekly, kpis, market, movements):
        monkeypatch.setattr(module, "cut", counted)
    df = streams.report_documents(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum(read) == 2 and "l_orderkey" not in plan


def test_first_dates_go_by_time_of_storing_then_file_then_date(spark):
    schema = "sale_number string, sale_date date, broker string, processed_timestamp timestamp, source_file_identifier string"
    d1, d2, t1, t2 = datetime(2025, 1, 1).date(), datetime(2025, 1, 2).date(), datetime(2025, 2, 1), datetime(2025, 2, 2)
    sales = [("1", d2, "z", t1, "f"), ("1", d1, "a", t2, "f"), ("1", d2, "a", t1, "f"), ("2", d2, "a", t1, "f"), ("2", d1, "z", t1, "f"),
             ("2", d1, "z", t1, "f"), ("3", None, "a", t1, "f"), ("4", d2, "b", None, "f"), ("4", d1, "a", t1, "f")]
    offers = [("1", d1, "a", t1, "a"), ("3", d2, "a", t1, "f"), ("3", d1, "a", t1, "g")]
    dates = weekly.first_dates(spark.createDataFrame(sales, schema), spark.createDataFrame(offers, schema))
    assert {r["sale_number"]: r["sale_date"] for r in dates.collect()} == {"1": d2, "2": d1, "3": d2, "4": d2}


def test_chart_tables_are_worked_out_once(spark, tmp_path, monkeypatch):
    """Documents and files of the chart tables are written from the same written rows."""
    given = {}

    def kept(docs, tables, with_charts=weekly.with_charts):
        given.update(tables)
        return with_charts(docs, tables)

    monkeypatch.setattr(weekly, "with_charts", kept)
    day = datetime(2025, 9, 1).date()
    rows = [(day, "1", "b", "m", "g", f"{i}", 10.0, 1.0, 2.0 + i, f"buyer{i % 3}") for i in range(9)]
    schema = "sale_date date, sale_number string, broker string, mark string, grade string, lot_number string, quantity_kgs double, package_count double, price double, buyer string"
    sales = spark.createDataFrame(rows, schema)
    out = str(tmp_path / "reports")
    weekly.report_json_sink(weekly.report_tables(sales, sales.drop("price", "buyer"), "Harbour"), out, "Harbour")
    for name in weekly.CHARTS:
        plan = given[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" in plan and not any(step in plan for step in ("Aggregate", "Window", "Join"))
    doc = json.loads((tmp_path / "reports" / "documents" / "harbour_1.json").read_text())
    assert [(r["rank"], r["buyer"], r["total_value"]) for r in doc["charts"]["top_buyers_by_value"]] == [
        (1, "BUYER2", 210.0), (2, "BUYER1", 180.0), (3, "BUYER0", 150.0)]
    files = spark.read.json(f"{out}/top_buyers_by_value")
    assert sorted((r["rank"], r["buyer"]) for r in files.collect()) == [(1, "BUYER2"), (2, "BUYER1"), (3, "BUYER0")]


def test_row_tables_take_less_room_than_their_rows(spark, tmp_path):
    """Row tables of lots are compressed and hold the same rows; none of their text lies about plain."""
    day = datetime(2025, 9, 1).date()
    rows = [(day, f"{i % 3}", f"b{i % 5}", f"m{i % 7}", "g", f"{i * 7919}", 10.0, 1.0, 2.0 + i, f"buyer{i % 300}") for i in range(6000)]
    schema = "sale_date date, sale_number string, broker string, mark string, grade string, lot_number string, quantity_kgs double, package_count double, price double, buyer string"
    sales = spark.createDataFrame(rows, schema)
    out = tmp_path / "reports"
    tables = weekly.report_tables(sales, sales.drop("price", "buyer"), "Harbour")
    weekly.report_json_sink(tables, str(out), "Harbour")
    for name in ("raw_sales_data", "source_sales_week", "buyer_grades"):
        texts = sorted(r["value"] for r in tables[name].drop("sale_number").toJSON().toDF("string").collect())
        assert texts == sorted(r["value"] for r in spark.read.text(f"{out}/{name}/*").collect())
        assert spark.read.json(f"{out}/{name}").groupBy("sale_number").count().count() == 3
        sizes = sum(p.stat().st_size for p in (out / name).rglob("part-*"))
        assert 0 < sizes < sum(map(len, texts)) / 4


def test_lots_are_dealt_out_once(spark, tmp_path, monkeypatch):
    """Sales are written by sale; tables of lots are written from there without another shuffle."""
    day = datetime(2025, 9, 1).date()
    rows = [(day, f"{i % 2}", "b", "m", "g", f"{i}", 10.0, 1.0, 2.0 + i, "x") for i in range(50)]
    schema = "sale_date date, sale_number string, broker string, mark string, grade string, lot_number string, quantity_kgs double, package_count double, price double, buyer string"
    sales = spark.createDataFrame(rows, schema)
    cuts = []

    def kept(df, cut=weekly.cut):
        cuts.append(df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df)

    monkeypatch.setattr(weekly, "cut", kept)
    tables = weekly.report_tables(sales, sales.drop("price", "buyer"), "Harbour")
    assert "Rebalance" in cuts[0] and "value_usd" not in cuts[0]
    for name in weekly.BY_SALE:
        plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" in plan and not any(step in plan for step in ("Aggregate", "Window", "Join", "Rebalance", "Repartition"))


def test_shuffles_go_with_their_query(spark, tmp_path):
    from gavelline.session import freed_shuffles

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        found = set()
        while files.hasNext():
            found.add(files.next().getName())
        return {f for f in found if f.startswith("shuffle_")}

    before, known = spark.conf.get(name, None), shuffled()
    with freed_shuffles(spark):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        df.write.parquet(str(tmp_path / "t"))
    for _ in range(100):
        if not shuffled() - known:
            break
        time.sleep(0.1)
    assert not shuffled() - known and spark.conf.get(name, None) == before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7 and df.count() == 7
