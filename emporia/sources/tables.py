"""Parquet table access with column pruning at the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(base: str, name: str) -> str:
    return os.path.join(base, f"{name}.parquet") if "://" not in base else f"{base}/{name}.parquet"


def table(spark: SparkSession, base: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<base>/<name>.parquet``; ``columns`` narrows the ReadSchema."""
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df


def scan(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Full scan of a table (``SELECT *``)."""
    return table(spark, base, name)


def preview(df: DataFrame, order_by: list[str], n: int = 100) -> DataFrame:
    """First ``n`` rows in a stated order (a bare LIMIT is not deterministic).

    Spark plans ``orderBy + limit`` as TakeOrderedAndProject: each task keeps
    its own top ``n`` and only those reach the final merge.
    """
    return df.orderBy(*order_by).limit(n)


def use_database(spark: SparkSession, database: str) -> None:
    """Make ``database`` the current namespace (``USE database``)."""
    spark.catalog.setCurrentDatabase(database)


def catalog_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table by (optionally database-qualified) name."""
    df = spark.table(name)
    return df.select(*columns) if columns else df
