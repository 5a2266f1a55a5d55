"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(f"{sf_dir}/{name}.parquet")
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def rows(names: list[str], values) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in values)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides have the same columns and rows, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    if found != wanted:
        extra, missing = list((found - wanted).items())[:2], list((wanted - found).items())[:2]
        return f"{found.total()} rows, expected {wanted.total()}; extra {extra} missing {missing}"
    types = {type(v) for row in wanted for v in row}
    other = {type(v) for row in found for v in row}
    return None if types == other else f"value types {other} != {types}"


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries

    from strata.session import build_session

    sf_dir = sys.argv[1]
    picked = sys.argv[2:]
    spark = build_session(
        "oracle-check",
        {
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
        },
        "local[8]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name, run in queries().items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            sql = oracle_sql().get(name)
            verdict = compare(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
