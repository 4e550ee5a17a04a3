"""Run registered queries next to their SQL and compare all rows.

``python -m tests.compare /root/testdata/sf0.01 [query ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("caselake")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in r) for r in df.select(*names).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return sorted(columns), Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir: str, build, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    names, mine = spark_rows(build(spark, sf_dir))
    other_names, theirs = duck_rows(con, sql)
    if names != other_names:
        return f"columns {sorted(set(names) ^ set(other_names))}"
    if mine == theirs:
        return None
    return (f"{sum(mine.values())} rows against {sum(theirs.values())}; "
            f"only Spark {list((mine - theirs).items())[:2]}; only SQL {list((theirs - mine).items())[:2]}")


def main(sf_dir: str, wanted: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract

    spark, con = session(), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            found = (difference(spark, con, sf_dir, queries[name], oracles[name]) if name in oracles
                     else f"no SQL, {queries[name](spark, sf_dir).count()} rows")
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
