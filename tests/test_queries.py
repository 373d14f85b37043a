"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from gavelline import session
from gavelline.operators import dedup, kpis, market, movements
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 83 and df.columns[0] == "sale_number"


def _number(text):
    return int(text) if str(text).isdigit() else 0


# What the sort operators order by, the first key first; larger means later.
ORDERS = {
    "library_sort": lambda r: (-_number(r.year), -_number(r.week_number), r.path, r.pos),
    "index_sort": lambda r: tuple(-ord(c) for c in r.sale_number),
    "registry_export": lambda r: (-r.year, -r.week_number),
    "facets": lambda r: (r.facet, -_number(r.value) if r.facet == "year" else 0, r.value),
    "dataset_sort": lambda r: r.title,
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_are_in_order(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    keys = [ORDERS[name](r) for r in rows]
    assert len(rows) > 4 and keys == sorted(keys)


@pytest.mark.parametrize("partners", [1, 1000])
def test_headline_looks_agree(spark, monkeypatch, partners):
    """How many headlines are looked at first leaves the result alone."""
    sf = "/root/testdata/sf0.01"
    monkeypatch.setattr(dedup, "FIRST_PARTNERS", partners)
    for name in ("headline_fuzzy_dup", "news_dedup_greedy"):
        assert difference(entry.queries()[name](spark, sf), duck(sf), SQL[name]) is None


def _scans(df, table):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line and table in line for line in plan.splitlines())


@pytest.mark.parametrize("name, most", [
    ("insights_text", 2), ("grade_layer", 2), ("broker_layer", 2), ("weekly_kpis", 2), ("prev_sale_asof", 3), ("sale_kpis", 2),
    ("grade_lookup", 2), ("broker_lookup", 2), ("prev_grade_mean", 3), ("movement_by_mark", 1), ("movement_marks", 1),
    ("price_histogram", 2),  # the bounds go first
])
def test_scans_of_lots(spark, monkeypatch, name, most):
    """Line items are read once per role, in the steps that are written on the way as well."""
    read = []

    def counted(df, cut=session.cut):
        read.append(_scans(df, "l_orderkey"))
        return cut(df)

    for module in (kpis, market, movements):
        if hasattr(module, "cut"):
            monkeypatch.setattr(module, "cut", counted)
    read.append(_scans(entry.queries()[name](spark, SF), "l_orderkey"))
    assert sum(read) <= most
