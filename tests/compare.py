"""Runs queries beside their SQL: python tests/compare.py SF_DIR [NAME...] prints what differs."""

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(_plain(v) for v in x)
    if isinstance(x, dict):
        return tuple(sorted((k, _plain(v)) for k, v in x.items()))
    return x


def rows_of(table) -> Counter:
    """Rows of an Arrow table as a bag, columns by name."""
    names = sorted(table.column_names)
    return Counter(tuple(_plain(r[c]) for c in names) for r in table.select(names).to_pylist())


def expected(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con.execute(sql).to_arrow_table()


def difference(got, want) -> str:
    """What differs between two Arrow tables; empty if nothing does."""
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} against {sorted(want.column_names)}"
    a, b = rows_of(got), rows_of(want)
    return "" if a == b else f"{got.num_rows} rows against {want.num_rows}; only ours {list((a - b).elements())[:2]}; only SQL's {list((b - a).elements())[:2]}"


def main(sf_dir: str, *names: str) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from ledgerlens.session import get_session

    spark = get_session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    sql, bad = e.oracle_sql(), 0
    for name, f in e.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            got = f(spark, sf_dir).toArrow()
            why = difference(got, expected(sf_dir, sql[name])) if name in sql else ""
            print(f"{name}: {got.num_rows} rows, {time.time() - began:.1f} s, {why or ('same' if name in sql else 'no SQL')}"[:1500], flush=True)
            bad += bool(why)
        except Exception as x:
            print(f"{name}: {str(x)[:700]}", flush=True)
            bad += 1
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
