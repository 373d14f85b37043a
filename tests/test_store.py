"""The store: batches that count as a whole, keys in parts, running totals with late rows, documents as files."""

import math
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gavelline.plans import ingest as ingest_plan
from gavelline.plans import registry
from gavelline.sources import documents
from gavelline.sources.store import read_store
from gavelline.streaming import kpis, lots

HEADER = "Broker,LotNo,Garden,Grade,Invoice,Kilos,Bags,Final Price,Buyer,Sale Code,Sale Date\n"


def test_a_stopped_batch_shows_nothing_and_is_repaired(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Sale 1.csv").write_text(HEADER + "A,1,m,g,i,10,1,2.5,b,Sale 7 - x,02/09/2025\nA,2,m,g,i,10,1,,b,Sale 7 - x,02/09/2025\n")
    root = str(tmp_path / "store")
    write = ingest_plan.write_batch
    for stop in ("auction_sales", "processing_log"):
        def stopping(df, root, name, *args, stop=stop, **more):
            if name == stop:
                raise RuntimeError("stopped")
            write(df, root, name, *args, **more)

        monkeypatch.setattr(ingest_plan, "write_batch", stopping)
        with pytest.raises(RuntimeError):
            ingest_plan.ingest_folder(spark, str(tmp_path / "in"), root, "Harbour", datetime(2025, 9, 3))
        for name in ("auction_offers", "auction_sales", "processing_log"):
            assert read_store(spark, root, name).count() == 0
    monkeypatch.setattr(ingest_plan, "write_batch", write)
    log = ingest_plan.ingest_folder(spark, str(tmp_path / "in"), root, "Harbour", datetime(2025, 9, 4))
    assert [(r["records_inserted"], r["status"]) for r in log.collect()] == [(3, "SUCCESS")]
    assert read_store(spark, root, "auction_offers").count() == 2 and read_store(spark, root, "auction_sales").count() == 1
    assert read_store(spark, root, "processing_log").count() == 1


def test_a_report_without_its_results_is_not_there(spark, tmp_path, monkeypatch):
    heads = spark.createDataFrame([(1, "t", "d", "c", 3, 2025, "s", "/a")], "submission int, title string, description string, auction_centre string, week_number int, year int, source string, report_link string")
    rows = spark.createDataFrame([(1, "l1")], "submission int, lot_number string")
    write = registry.write_batch

    def stopping(df, root, name, *args, **more):
        if name == "reports":
            raise RuntimeError("stopped")
        write(df, root, name, *args, **more)

    monkeypatch.setattr(registry, "write_batch", stopping)
    with pytest.raises(RuntimeError):
        registry.register_reports(heads, rows, str(tmp_path), batch="b1")
    assert read_store(spark, str(tmp_path), "results").count() == 0
    monkeypatch.setattr(registry, "write_batch", write)
    registry.register_reports(heads, rows, str(tmp_path), batch="b2")
    assert read_store(spark, str(tmp_path), "results").count() == read_store(spark, str(tmp_path), "reports").count() == 1


def test_a_batch_reads_the_parts_of_its_own_keys(spark, tmp_path, monkeypatch):
    root, key, order = str(tmp_path), ["a", "b"], ["v"]
    frame = lambda rows: spark.createDataFrame(rows, "a int, b string, v int")
    lots.add_unique(frame([(k, "x", k) for k in range(3000)]), root, "t", key, order, "b0")
    read = []

    def watched(*args, keys=lots.stored_keys, **more):
        df = keys(*args, **more)
        read.append((len(df.inputFiles()), df))
        return df

    monkeypatch.setattr(lots, "stored_keys", watched)
    lots.add_unique(frame([(5, "x", -1), (5, "y", 2), (5, "y", 1), (None, "x", 7), (None, "x", 8), (9000, "x", 1)]), root, "t", key, order, "b1")
    assert re.search(r"part#\d+ IN \(", read[0][1]._jdf.queryExecution().executedPlan().toString())  # a filter of partitions
    assert read[0][1].count() <= 3 * 3000 / 256 * 4  # three keys, a part each
    expected = {(5, "y", 1), (None, "x", 7), (None, "x", 8), (9000, "x", 1)}
    schema = frame([]).schema
    for _ in range(2):
        got = lots.read_table(spark, schema, f"{root}/t").filter("batch = 'b1'").select("a", "b", "v").collect()
        assert set(map(tuple, got)) == expected and len(got) == 4
        # the batch runs again
        lots.add_unique(frame([(5, "x", -1), (5, "y", 2), (5, "y", 1), (None, "x", 7), (None, "x", 8), (9000, "x", 1)]), root, "t", key, order, "b1")
    lots.add_unique(frame([(5, "y", 0), (9000, "x", 0), (9001, "x", 0)]), root, "t", key, order, "b2")
    got = lots.read_table(spark, schema, f"{root}/t").filter("batch = 'b2'").select("a").collect()
    assert [r.a for r in got] == [9001]


def test_late_rows_correct_settled_totals(spark, tmp_path):
    draw, out, start = random.Random(2), str(tmp_path), datetime(2025, 1, 1)
    batches = []
    for day in range(4):  # a day per batch, and some rows for days before
        rows = [(start + timedelta(hours=24 * draw.choice([day, day, day, max(0, day - 1), 0]) + draw.random() * 23), draw.choice("xy"), draw.uniform(1, 50), draw.uniform(1, 1e6)) for _ in range(60)]
        batches.append(spark.createDataFrame(rows, "t timestamp, sale_number string, total_weight_kgs double, value_usd double"))
    for number, batch in enumerate(batches):
        kpis.add_sales(batch, number, out, "t", "1 day", "12 hours")
        if number in (1, 3):  # runs again
            kpis.add_sales(batch, number, out, "t", "1 day", "12 hours")
    rows = [r for b in batches for r in b.collect()]
    got = {(r["window_start"], r["sale_number"]): r for r in kpis.latest_totals(spark, out, "12 hours").collect()}
    groups = {}
    for r in rows:
        groups.setdefault((datetime(r.t.year, r.t.month, r.t.day), r.sale_number), []).append(r)
    assert set(got) == set(groups)
    latest = max(r.t for r in rows)
    for key, mine in groups.items():
        assert got[key]["lots"] == len(mine)
        assert got[key]["total_value"] == math.fsum(r.value_usd for r in mine)
        assert got[key]["total_volume"] == math.fsum(r.total_weight_kgs for r in mine)
        assert got[key]["settled"] == (key[0] + timedelta(days=1) <= latest - timedelta(hours=12))
    assert sum(r["late"] for r in got.values()) > 10 and got[(datetime(2025, 1, 4), "x")]["late"] == 0


def test_an_update_reads_the_windows_it_touches(spark, tmp_path):
    out = str(tmp_path)
    for number in range(3):
        rows = [(datetime(2025, 1, 1 + number), "x", 1.0, 2.0)]
        kpis.add_sales(spark.createDataFrame(rows, "t timestamp, sale_number string, total_weight_kgs double, value_usd double"), number, out, "t", "1 day", "1 day")
    assert sorted((p.parent.name, p.name) for p in (tmp_path / "totals").glob("day=*/update=*")) == [
        ("day=2025-01-01", "update=0"), ("day=2025-01-02", "update=1"), ("day=2025-01-03", "update=2")]


def test_documents_are_files(spark, tmp_path):
    folder = str(tmp_path / "docs")
    docs = spark.createDataFrame([(f"a {k}%=.json", f'{{"k": {k}}}') for k in range(5)], "filename string, body string").repartition(3)
    for _ in range(2):
        assert documents.write_documents(docs, folder) == 5
    found = {p.name: p.read_text() for p in (tmp_path / "docs").iterdir() if not p.name.startswith(".")}
    assert found == {f"a {k}%=.json": f'{{"k": {k}}}\n' for k in range(5)}
    broken = docs.withColumn("body", F.when(F.col("filename") == "a 3%=.json", F.raise_error(F.lit("no"))).otherwise(F.lit("new")))
    with pytest.raises(Exception):
        documents.write_documents(broken, folder)
    assert {p.name: p.read_text() for p in (tmp_path / "docs").iterdir() if not p.name.startswith(".")} == found
    assert [p.name for p in tmp_path.iterdir()] == ["docs"]
