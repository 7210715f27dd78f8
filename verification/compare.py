"""Run every query in Spark and in DuckDB on one data folder and compare the rows.

    python -m verification.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification.catalog import oracle_sql, queries


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object).where(df.notna(), None)
    return df.sort_values(list(df.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or nothing."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    ours, theirs = _sorted(ours), _sorted(theirs)
    differs = (ours != theirs) & ~(ours.isna() & theirs.isna())
    if differs.to_numpy().any():
        rows = differs.any(axis=1)
        columns = list(differs.columns[differs.any(axis=0)])
        return f"{int(rows.sum())} rows differ in {columns}:\n{ours[rows].head(3)}\n{theirs[rows].head(3)}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").appName("compare")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failures = oracle(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            ours = query(spark, sf_dir).toPandas()
            spent = time.time() - started
            found = difference(ours, connection.execute(sql[name]).df())
            print(f"{'same' if found is None else 'DIFFERENT'} {name} {len(ours)} rows {spent:.1f} s "
                  f"(SQL {time.time() - started - spent:.1f} s) {found or ''}", flush=True)
        except Exception as error:
            found = str(error)
            print(f"FAILED {name}: {found[:400]}", flush=True)
        failures += found is not None
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
