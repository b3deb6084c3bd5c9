"""Run a catalogue query on Spark and its oracle on DuckDB; compare results.

Comparison: column names and types, row count, and the sorted multiset of
rows with integers as they are, doubles rounded to 9 significant digits and timestamps as naive
datetimes.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kiln.plans.views import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return (2, f"{float(v):.9g}")
    if isinstance(v, int):
        return (6, v)  # exactly
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (3, dt.datetime(v.year, v.month, v.day).isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    return (5, str(v))


# Spark type name -> DuckDB type name, for the schema part of the check.
SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "float": "FLOAT",
}


def _duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(spark_type, spark_type)


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, query_fn, sql: str, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t).replace(" ", "") for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    else:
        wrong = {
            c: (t, d_types[c]) for c, t in sdf.dtypes if _duck_type(t).replace(" ", "") != d_types[c]
        }
        if wrong:
            problems.append(f"types differ (spark, duck): {wrong}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif not problems:
        a, b = canon(s_rows, s_cols), canon(d_rows, d_cols)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows), t1 - t0


def main(argv):
    from kiln.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E

    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:28s} NO ORACLE")
            continue
        try:
            problems, n, secs = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as e:  # report and go on
            problems, n, secs = [f"error {type(e).__name__}: {str(e)[:300]}"], -1, 0.0
        bad += bool(problems)
        print(f"{name:28s} {'OK ' if not problems else 'BAD'} rows={n:<7d} {secs:6.2f}s {'; '.join(problems)}")
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
