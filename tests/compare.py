"""python -m tests.compare [SF_DIR] [NAME...]: queries held against their SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(sql)
    return [c[0] for c in found.description], found.fetchall()


def plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, (datetime, date)):
        return str(value)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(plain(r[k]) for k in order) for r in rows)


def difference(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if the rows are the same."""
    df = query(spark, sf_dir)
    columns, rows = oracle_rows(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    ours, theirs = bag(df.columns, [tuple(r) for r in df.collect()]), bag(columns, rows)
    if ours != theirs:
        return f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"), sys.argv[2:]
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or [n for n in queries if not n.startswith("op") and n != "pipeline"]:
        began = time.time()
        try:
            said = difference(spark, sf_dir, queries[name], sql[name]) if name in sql else f"no SQL; {queries[name](spark, sf_dir).count()} rows"
        except Exception as error:  # noqa: BLE001  the next query still runs
            said = f"failed: {str(error)[:500]}"
        print(f"{name}: {said or 'same'} ({time.time() - began:.1f} s)", flush=True)
