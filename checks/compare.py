"""Run queries against their SQL on one scale: python -m checks.compare [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import oracle
from checks.queries import registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(columns: list[str], rows: list) -> list[tuple]:
    """Rows as sorted text, columns by name."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if Spark and DuckDB agree on columns and rows, else what differs."""
    mine = registered()[name](spark, sf_dir)
    theirs = con.execute(oracle.statements()[name])
    columns = [column[0] for column in theirs.description]
    if sorted(mine.columns) != sorted(columns):
        return f"columns {sorted(mine.columns)} against {sorted(columns)}"
    left, right = canonical(mine.columns, mine.collect()), canonical(columns, theirs.fetchall())
    if left == right:
        return None
    only_left, only_right = sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2]
    return f"rows {len(left)} against {len(right)}; {only_left} against {only_right}"


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, bad = session(), duck(sf_dir), 0
    statements = oracle.statements()
    for name, query in registered().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            if name in statements:
                wrong = differences(spark, con, sf_dir, name)
                verdict = "ok" if wrong is None else f"DIFFERS {wrong}"
            else:
                wrong, rows = None, query(spark, sf_dir).count()
                verdict = f"{rows} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            wrong = verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += wrong is not None
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s {verdict}", flush=True)
    print(f"{bad} bad", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, sys.argv[2:]) else 0)
