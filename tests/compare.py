"""Run registered queries against their SQL and report differences.

    python -m tests.compare [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, bool) or value is None:
        return value
    return value


# What the SQL side calls the types of the Spark side.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def type_difference(df, con, sql: str) -> str | None:
    described = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    wrong = [f"{n}: {t} vs {described.get(n)}" for n, t in df.dtypes if TYPES.get(t, t) != described.get(n)]
    return f"types {wrong}" if wrong else None


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, Counter(tuple(_plain(row[i]) for i in at) for row in result.fetchall())


def difference(spark_rows, sql_rows) -> str | None:
    (names, left), (other, right) = spark_rows, sql_rows
    if names != other:
        return f"columns {names} vs {other}"
    if left == right:
        return None
    only_left, only_right = list((left - right).elements()), list((right - left).elements())
    return f"{sum(left.values())} vs {sum(right.values())} rows, {len(only_left)} differ: {only_left[:2]} | {only_right[:2]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from sparkwarden.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}
    spark: SparkSession = build_session("compare", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = rows_of_spark(df)
            seconds = time.time() - start
            if name not in sql:
                print(f"rows {name:32s} {seconds:6.2f}s {sum(found[1].values())} rows", flush=True)
                continue
            problem = difference(found, rows_of_sql(con, sql[name])) or type_difference(df, con, sql[name])
        except Exception as e:  # noqa: BLE001
            seconds, problem = time.time() - start, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        count = 0 if problem else sum(found[1].values())
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {seconds:6.2f}s {problem or f'{count} rows'}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
