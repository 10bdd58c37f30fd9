"""Run every query next to its SQL and compare rows: ``python -m checks.compare [sf_dir] [names]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(names: list[str], table: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda n: names[n])
    return Counter(tuple(row[n] for n in order) for row in table)


def difference(spark: SparkSession, sf_dir: str, name: str, connection) -> str | None:
    """None if equal, else what differs."""
    frame = queries()[name](spark, sf_dir)
    cursor = connection.execute(oracle_sql()[name])
    expected_names = [d[0] for d in cursor.description]
    expected = rows(expected_names, cursor.fetchall())
    actual = rows(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(frame.columns) != sorted(expected_names):
        return f"columns {sorted(frame.columns)} != {sorted(expected_names)}"
    if actual != expected:
        return f"only Spark {list((actual - expected).items())[:2]}; only SQL {list((expected - actual).items())[:2]}"
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    known = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
             "double": "DOUBLE"}
    odd = {n: (t, kinds[n]) for n, t in types.items() if known.get(t, t.upper()) != kinds[n].replace(" ", "")}
    return f"types {odd}" if odd else None


def main(sf_dir: str, chosen: list[str]) -> int:
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = duck(sf_dir), 0
    for name in chosen or list(queries()):
        start = time.time()
        try:
            found = difference(spark, sf_dir, name, connection) if name in oracle_sql() else "no SQL"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) > 0)
