"""Compares the rows of a Spark query with the rows of its SQL.  Run directly to check all queries at a scale."""

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float) and v == 0:
        return "0.0"
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def difference(df, con, sql):
    """None if the rows agree, else a short text."""
    c1, r1 = spark_rows(df)
    c2, r2 = sql_rows(con, sql)
    if c1 != c2:
        return f"columns {c1} / {c2}"
    if r1 == r2:
        return None
    s1, s2 = set(r1), set(r2)
    return f"{len(r1)} / {len(r2)} rows; only spark {list(s1 - s2)[:3]}; only sql {list(s2 - s1)[:3]}"


def main(sf_dir, names):
    import __spark_entry__ as entry
    from gavelline.session import local_session

    spark = local_session("8", 8, "12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                told = difference(df, con, sqls[name])
                n = ""
            else:
                n, told = df.count(), None
                told = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            told, n = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += bool(told)
        print(f"{name:26s} {time.time() - start:6.2f}s {'ok' if not told else told} {n}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
