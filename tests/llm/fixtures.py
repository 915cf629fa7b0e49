"""Small tables as files, and a query's rows beside those of its SQL."""

from collections import Counter

import duckdb


def written(spark, folder, **tables):
    """Each table as (rows, schema), under ``folder``; its path as an input folder."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows_of(df):
    names = sorted(df.columns)
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def rows_of_sql(folder, sql, *tables):
    con = duckdb.connect()
    for name in tables:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet/*.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    at = [names.index(n) for n in sorted(names)]
    return Counter(tuple(r[i] for i in at) for r in result.fetchall())
