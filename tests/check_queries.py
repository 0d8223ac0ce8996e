"""Compare registered queries with their SQL: ``check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return frame.sort_values(list(frame.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str:
    """Empty when the query and its SQL agree in columns, rows and values."""
    ours = registry.queries()[name](spark, sf_dir).toPandas()
    theirs = connection.execute(registry.oracle_sql()[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    kinds = {c: (ours[c].dtype, theirs[c].dtype) for c in ours if ours[c].dtype.kind != theirs[c].dtype.kind}
    left, right = canonical(ours), canonical(theirs)
    if not left.equals(right):
        unequal = (left != right).any(axis=1)
        examples = [f[unequal].head(2).values.tolist() for f in (left, right)]
        return f"values differ in {int(unequal.sum())} rows, such as {examples} {kinds}"
    return f"kinds {kinds}" if kinds else ""


def main() -> None:
    sf, names = (sys.argv[1:] or ["0.01"])[0], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "20g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("PARTITIONS", "8"))
        .config("spark.sql.session.timeZone", os.environ.get("ZONE", "UTC")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    for name in names or registry.oracle_sql():
        start = time.time()
        problem = difference(spark, connection, sf_dir, name)
        print(f"{name:32s} {time.time() - start:6.1f}s {problem or 'same'}", flush=True)


if __name__ == "__main__":
    main()
