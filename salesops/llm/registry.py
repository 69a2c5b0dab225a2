"""Queries of this package and the SQL that checks them."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from salesops.session import tune

# Whole rows are read and go to Python workers in batches of at most so many rows, the latter also of so many bytes.
# A worker and the JVM each hold a batch several times over (as it arrives, by pieces, as it leaves).
BATCH_ROWS, BATCH_BYTES = 1024, "8m"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library's code to the executors, once per application, as ``--py-files`` would."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId not in _shipped and package.is_dir():
        folder = Path(tempfile.mkdtemp(prefix="salesops-code-")).resolve()
        context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, read lazily."""
    ship(spark)
    return tune(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def in_small_batches(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, in a session that reads whole rows and passes them on in small batches."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return table(spark, folder, name)


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that checks it."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register
