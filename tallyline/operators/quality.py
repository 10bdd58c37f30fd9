"""Declared constraints of the warehouse tables as queries that count violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schemas import FOREIGN_KEYS, MAX_LENGTHS, NOT_NULL, PRIMARY_KEYS, RETURN, SALE
from tallyline.session import stage


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per foreign key whose parent is missing. Facts are counted per key before the join."""
    parts = []
    for child, key, parent in FOREIGN_KEYS:
        if child not in tables or parent not in tables:
            continue
        per_key = tables[child].where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        orphans = per_key.join(tables[parent].select(key), key, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(child).alias("table_name"), F.lit(key).alias("key_name"),
            F.lit(parent).alias("parent_table"), "orphan_rows"))
    return _union(parts)


def repeated_keys(table: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once.

    Short hashes are counted first, which exchanges eight bytes a row. Rows whose short hash occurs once are the
    only ones of their key; the keys of the others are counted whole.
    """
    short = F.xxhash64(*key)
    counted = table.groupBy(short.alias("_short")).agg(F.count("*").alias("_n"))
    shared = stage(counted.where("_n > 1").select("_short"), "shared-hashes")
    if shared.isEmpty():
        return table.select(*key).where(F.lit(False))
    rows = table.select(*key, short.alias("_short")).join(shared, "_short", "left_semi")
    return rows.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*key)


def pk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of keys that occur more than once."""
    parts = []
    for name, key in PRIMARY_KEYS.items():
        if name in tables:
            parts.append(repeated_keys(tables[name], key).agg(F.count("*").alias("repeated_keys")).select(
                F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_name"), "repeated_keys"))
    return _union(parts)


def domain_violations(facts: DataFrame) -> DataFrame:
    return facts.where(~F.col("transaction_type").isin(SALE, RETURN)).agg(
        F.count("*").alias("bad_transaction_types")
    )


def _count_per_column(name: str, table: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """All column tests of one table in one pass, one output row per column."""
    counted = table.agg(*[F.count_if(test).alias(column) for column, test in tests.items()])
    return counted.unpivot([], list(tests), "column_name", "violations").select(
        F.lit(name).alias("table_name"), "column_name", "violations"
    )


def not_null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        _count_per_column(name, tables[name], {c: F.col(c).isNull() for c in columns})
        for name, columns in NOT_NULL.items() if name in tables
    ])


def length_violations(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        _count_per_column(name, tables[name], {c: F.length(c) > n for c, n in limits.items()})
        for name, limits in MAX_LENGTHS.items() if name in tables
    ])
