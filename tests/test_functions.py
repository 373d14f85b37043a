"""Text rules on hand-made rows."""

import math
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gavelline.functions import dates, links, numbers, text


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("s"))).collect()]


def test_numbers(spark):
    cases = {
        "$1,234.50": (1234.5, 1234.0), "": (None, None), "  ": (None, None), "-": (None, None), "12.9": (12.9, 12.0),
        ".5": (0.5, None), "-3.7": (-3.7, -3.0), "1e3": (1000.0, 1000.0), "1d": (None, None), "1.5f": (None, 1.0),
        "0x10": (None, None), "nan": (None, None), "12abc": (None, None), " 12 ": (12.0, 12.0), "+5": (5.0, 5.0), "5.": (5.0, 5.0),
        "inf": (float("inf"), float("inf")), None: (None, None),
    }
    assert column(spark, list(cases), "string", numbers.numeric) == [v[0] for v in cases.values()]
    assert column(spark, list(cases), "string", numbers.whole_number) == [v[1] for v in cases.values()]
    assert column(spark, [b"40", b"4\xff0", b"", None, b"x"], "binary", numbers.bytes_number) == [40.0, 40.0, None, None, None]


def test_clean_text(spark):
    assert column(spark, [" ab ", "n/a", "NIL", "", "\t-\n", " x y ", None], "string", text.clean_text) == [
        "AB", None, None, None, None, "X Y", None]


def test_exact_sum(spark):
    draw, inf = random.Random(4), float("inf")
    lists = [
        [1.25, -0.0001, 1e12, -1e12, 0.1, 0.2], [1e15, 1.0], [0.00004, 0.00004], [9.0e14] * 1000, [-0.1] * 10, [-1e-5, -3e-7], [1e15, 1e-5, -1e15],
        [draw.uniform(-1e6, 1e9) for _ in range(2000)], [draw.uniform(0, 1e-9) for _ in range(50)], [1e300, 1.0], [2.0**62, 0.5],
    ]
    rows = [(k, v) for k, values in enumerate(lists) for v in [*values, None, float("nan")]]
    sums = spark.createDataFrame(rows, "k int, v double").repartition(5).groupBy("k").agg(numbers.exact_sum(F.col("v")).alias("s"))
    assert {r.k: r.s for r in sums.collect()} == {k: math.fsum(values) for k, values in enumerate(lists)}
    df = spark.createDataFrame([(inf,), (1.0,), (None,)], "v double")
    assert df.agg(numbers.exact_sum(F.col("v"))).first()[0] == inf
    assert df.filter("v is null").agg(numbers.exact_sum(F.col("v"))).first()[0] is None


def test_exact_sums_leave_code_that_the_jvm_compiles(spark):
    """Methods beyond 8,000 bytes are interpreted; two exact sums by group have to stay below."""
    df = spark.range(10).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"))
    df = df.groupBy("k").agg(numbers.exact_sum(F.col("v")), numbers.exact_sum(F.col("v") * 3))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(map(int, sizes)) < 6000


def test_dates(spark):
    cases = {
        "02/09/2025 12:49:12:300": date(2025, 9, 2), "2025-09-02 01:02:03": date(2025, 9, 2), "2025/07/29": date(2025, 7, 29),
        "2-Sep-2025": date(2025, 9, 2), "03/04/2025": date(2025, 4, 3), "12/25/2025": date(2025, 12, 25),
        "02.09.2025": date(2025, 9, 2), "14th October 2025": date(2025, 10, 14), "October 14, 2025": date(2025, 10, 14),
        "2025-09-02": date(2025, 9, 2), "2025-09-02T10:00:00Z": date(2025, 9, 2), "13/25/2025": None, "nil": None, "soon": None,
        "41 14th 15th October 2025": None, "": None, None: None, "31/02/2025": None, "02-Sep-25": date(2025, 9, 2),
        "15 Sept 2025": date(2025, 9, 15), "20250902": date(2025, 9, 2), "Tuesday 2 September 2025": date(2025, 9, 2),
        "02/09/25": date(2025, 2, 9), "30/09/25": date(2025, 9, 30), "2025.09.02": date(2025, 9, 2), "02-09-2025": date(2025, 2, 9),
        "2 September 2025 10:30 pm": date(2025, 9, 2), "Tue, Sep 2, 2025": date(2025, 9, 2), "3-Mar-98": date(1998, 3, 3),
        "September 2025": date(2025, 9, 1), "45902": None, "2025": None, "20251302": None,
        "2nd of September 2025": date(2025, 9, 2), "Sept. 2, 2025": date(2025, 9, 2), "20250902T101112": date(2025, 9, 2),
        "10:30 2 Sep 2025": date(2025, 9, 2), "2 Sep 2025 at 10:30": date(2025, 9, 2), "Tue Sep 2 10:00:00 2025": date(2025, 9, 2),
        "Tue, 02 Sep 2025 10:00:00 GMT": date(2025, 9, 2), "2/Sep/2025": date(2025, 9, 2), "Sep-02-2025": date(2025, 9, 2),
        "2025/9": date(2025, 9, 1), "9/2025": date(2025, 9, 1), "02Sep2025": date(2025, 9, 2), "2Sep25": date(2025, 9, 2),
        "September 2nd 2025": date(2025, 9, 2), "1 2 2025": date(2025, 1, 2), "2025.9.2 10:00": date(2025, 9, 2), "Sep 2": None,
        "2 Sep '25": date(2025, 9, 2), "2025-09-02 10:00 PM": date(2025, 9, 2), "2;9;2025": date(2025, 2, 9),
        "02-09-2025 10:11": date(2025, 2, 9), "31/12/2025 24:00": None, "12/31/25": date(2025, 12, 31), "2025-13-01": None,
        "2 Sep 2025 AD": date(2025, 9, 2), "2 Sep 2025 10:30:15.123 +03:00": date(2025, 9, 2), "noon 2 Sep 2025": None,
        "Week 36 2025": None, "the 2nd of September, 2025": None, "14th/15th October 2025": None,
    }
    assert column(spark, list(cases), "string", dates.parse_date) == list(cases.values())
    assert column(spark, ["45902", "45902.75", "02.09.2025"], "string", dates.parse_date_or_serial) == [date(2025, 9, 2)] * 3
    shown = column(spark, ["2025-09-02T23:00:00Z", "1h ago", " ", None], "string", lambda c: dates.display_date(c, F.lit(datetime(2025, 1, 5))))
    assert shown == ["02 Sep 2025", "1h ago", "05 Jan 2025", "05 Jan 2025"]


def test_number_text(spark):
    values = [0.125, 0.5, 1.5, 2.675, 1234567.5, -0.001, -1234.565, 0.0, 99.995]
    assert column(spark, values, "double", lambda c: text.fixed(c, 2)) == [f"{v:.2f}" for v in values]
    assert column(spark, values, "double", lambda c: text.grouped(c)) == [f"{v:,.0f}" for v in values]
    assert column(spark, values, "double", lambda c: text.signed(c, 1)) == [f"{v:+.1f}" for v in values]


def test_links(spark):
    from urllib.parse import quote, urljoin, urlparse

    def canonical(x):
        p = urlparse(x)
        return p.scheme + "://" + p.netloc + p.path if p.scheme and p.netloc else x

    cases = ["https://a.b/c?d#e", "HTTP://A.b/C;p=1", "a/b?c", "http://h", "http://h?x", "mailto:x@y", "http://h/a;b/c"]
    assert column(spark, cases, "string", links.canonical_link) == [canonical(c) for c in cases]
    page = "https://h.example/a/b/c.html?x=1#y"
    hrefs = ["d", "/d", "../d?e", "//o/p", "?q", "#f", "", "http://z/", "./d/./e", "../../../g", "d/..", "mailto:x"]
    assert column(spark, hrefs, "string", lambda c: links.resolve_link(F.lit(page), c)) == [urljoin(page, h) for h in hrefs]
    names = ["a b.json", "x+y.json", "é~*.json", "p/q.json"]
    assert column(spark, names, "string", lambda c: links.viewer_link(c, "v.html")) == ["v.html?data=" + quote(n) for n in names]


@pytest.mark.parametrize("name,kind", [
    ("GeneralReport (3).csv", "SALE"), ("Offer sale.xlsx", "OFFER"), ("Sale Summary 3.xlsx", "SUMMARY"), ("Commentary Sale 3.docx", "SALE"),
    ("market report.pdf", "COMMENTARY"), ("x.csv", "SALE"), ("x.xlsm", None), ("~$x.xlsx", None), (".x.csv", None), ("x.pdf", None),
    ("Price List.pdf", "SALE"), ("average.csv", "SALE"),
])
def test_file_types(spark, name, kind):
    from gavelline.sources.files import file_type

    assert column(spark, [name], "string", file_type) == [kind]
