import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from gavelline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.cut(stage(spark, before, SF))
        assert after.columns == columns and after.count() > 0, name
        assert after.filter(F.col("n_chars") != F.char_length("text")).count() == 0
        if name != "line dedup":
            assert after.exceptAll(before).count() == 0 or name.startswith("mixing")
        before = after
    ids = before.select("doc_id").distinct()
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert packed.select("doc_id").distinct().count() == ids.count()
    again = corpus_pipeline.run(spark, SF)
    assert again.agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()


def test_stages_on_awkward_rows(spark, awkward, nothing):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() > 0 or name == "quality rules"
        assert stage(spark, nothing.select(docs.columns), SF).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_tables(spark, name):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = entry.queries()[name](spark, SF)
    per_row = not name.startswith(("op4_", "op8_", "op10_", "op11_", "op13_"))
    assert rows.count() == n if per_row else rows.count() > 0
