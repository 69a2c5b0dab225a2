"""Registry of the queries on the given tables and SQL fragments for their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class GivenTables:
    """The given tables by name, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _plain(df: DataFrame) -> DataFrame:
    """Exact sums become doubles and all integers BIGINT, as in the SQL."""
    integers = (T.ByteType, T.ShortType, T.IntegerType)

    def shown(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, integers):
            return column.cast("bigint").alias(field.name)
        return column

    if all(not isinstance(f.dataType, (T.DecimalType, *integers)) for f in df.schema.fields):
        return df
    return df.select(*[shown(f) for f in df.schema.fields])


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that checks it."""

    def register(function: Callable[[GivenTables], DataFrame]):
        name = function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _plain(function(GivenTables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def money(column: str) -> Column:
    """Amounts as exact decimals."""
    return F.col(column).cast("decimal(18,2)")


# SQL fragments, so that the check SQL states each rule once.


def sql_money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def sql_big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def sql_total(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE)"


def sql_mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(CAST(count({x}) AS DOUBLE), 0))"


def sql_round(x: str, digits: int = 0) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    return (
        f"(CASE WHEN ({x}) < 0 THEN -CAST(floor(abs(({x}) * {scale}) + 0.5) AS BIGINT)"
        f" ELSE CAST(floor(({x}) * {scale} + 0.5) AS BIGINT) END / {scale})"
    )


def sql_percent(part: str, whole: str, digits: int = 1) -> str:
    ratio = f"CAST(100 AS DOUBLE) * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"
    return sql_round(ratio, digits)


def sql_quarter(x: str) -> str:
    return f"(year({x}) || '-Q' || quarter({x}))"


def sql_key(prefix: str, number: str) -> str:
    return f"'{prefix}' || printf('%05d', {number})"
