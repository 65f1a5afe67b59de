"""Run registered queries in Spark and their SQL in DuckDB and compare whole results.

    python -m verification.compare SF_DIR [query ...]
"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame

from gaugeflow.session import build_session
from verification.oracle import oracle_sql
from verification.queries import QUERIES


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return repr(value)


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(result: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> str:
    """'ok N rows', or how the result differs from the query's SQL."""
    found = _rows(result.columns, result.collect())
    cursor = con.execute(oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    if sorted(columns) != sorted(result.columns):
        return f"COLUMNS {sorted(result.columns)} != {sorted(columns)}"
    wanted = _rows(columns, cursor.fetchall())
    if found == wanted:
        return f"ok {len(found)} rows"
    extra, lacking = sorted(set(found) - set(wanted)), sorted(set(wanted) - set(found))
    return (
        f"DIFFERS {len(found)} / {len(wanted)} rows; {len(extra)} only here {extra[:2]}; "
        f"{len(lacking)} only in SQL {lacking[:2]}"
    )


def main(sf_dir: str, *names: str) -> int:
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            verdict = compare(QUERIES[name](spark, sf_dir), con, name)
        except Exception as error:  # report and go on with the next query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        failed += not verdict.startswith("ok")
        print(f"{name}: {verdict} ({time.time() - started:.2f} s)", flush=True)
    print(f"{failed} of {len(names or QUERIES)} not equal")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
