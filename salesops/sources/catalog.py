"""Named tables: reading a folder, typing, views, SQL and counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops.functions import blank_to_null
from salesops.sources.files import open_bucketed, published, read_raw_csv


def _entries(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the entries of a folder on any file system Hadoop knows."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in fs.listStatus(path))


def read_catalog(
    spark: SparkSession, folder: str, names: Iterable[str] | None = None, ordinal: bool = False
) -> dict[str, DataFrame]:
    """Every ``<name>.csv`` (a file or a folder of part files) as a raw table."""
    if names is None:
        paths = [p for p in _entries(spark, folder) if p.endswith(".csv")]
    else:
        paths = [f"{folder.rstrip('/')}/{name}.csv" for name in names]
    return {p.rsplit("/", 1)[-1][: -len(".csv")]: read_raw_csv(spark, p, ordinal) for p in paths}


def typed(raw: DataFrame, schema: T.StructType | str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Cast text columns to a schema by name; blank and unreadable values are NULL.

    A column that the input does not have is its default, or NULL without one.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return raw.select(*[_typed(raw, f, defaults or {}).alias(f.name) for f in schema.fields])


def _typed(raw: DataFrame, field: T.StructField, defaults: Mapping[str, object]) -> Column:
    if field.name not in raw.columns:
        return F.lit(defaults.get(field.name)).cast(field.dataType)
    if isinstance(field.dataType, T.StringType):
        return blank_to_null(field.name)
    return blank_to_null(F.trim(field.name)).try_cast(field.dataType)


def load_typed(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """S3: a CSV read as text and cast by column name."""
    return typed(read_raw_csv(spark, path, multi_line=multi_line), schema)


def lost_values(raw: DataFrame, schema: T.StructType | str, table: str) -> DataFrame:
    """Per column of the input, the non-blank texts that do not fit the type; one scan."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    present = [f for f in schema.fields if f.name in raw.columns]
    fields = [f for f in present if not isinstance(f.dataType, T.StringType)] or present
    if not fields:
        return raw.sparkSession.createDataFrame([], "table string, column string, lost bigint")
    counts = raw.agg(
        *[
            F.count_if(
                blank_to_null(F.trim(f.name)).isNotNull()
                & blank_to_null(F.trim(f.name)).try_cast(f.dataType).isNull()
            ).alias(f"c{i}")
            for i, f in enumerate(fields)
        ]
    )
    entries = F.array(
        *[F.struct(F.lit(f.name).alias("column"), F.col(f"c{i}").alias("lost")) for i, f in enumerate(fields)]
    )
    return counts.select(F.lit(table).alias("table"), F.inline(entries))


def load_catalog(
    spark: SparkSession, folder: str, schemas: Mapping[str, str], defaults: Mapping[str, Mapping[str, object]] | None = None
) -> dict[str, DataFrame]:
    """S3 for every table with a schema; ``defaults`` are for columns an input does not have."""
    raw = read_catalog(spark, folder, schemas)
    return {name: typed(df, schemas[name], (defaults or {}).get(name)) for name, df in raw.items()}


def lost_in_catalog(spark: SparkSession, folder: str, schemas: Mapping[str, str]) -> DataFrame:
    """Columns of all tables whose texts do not all fit their type: table, column, lost."""
    union = None
    for name, df in read_catalog(spark, folder, schemas).items():
        part = lost_values(df, schemas[name], name)
        union = part if union is None else union.unionByName(part)
    return union.where("lost > 0")


def open_tables(spark: SparkSession, folder: str, schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    """Typed tables as Parquet: those that ``rebuild`` wrote, or the latest that ``publish`` has made current."""
    now = published(spark, folder)
    return open_set(spark, now["path"], schemas, now["layout"])


def open_set(
    spark: SparkSession, path: str, schemas: Mapping[str, str], layout: Mapping[str, Mapping] | None = None
) -> dict[str, DataFrame]:
    """Tables of one folder; ``layout`` names key and number of buckets of those that have buckets."""
    layout = layout or {}

    def opened(name: str, schema: str) -> DataFrame:
        at = f"{path.rstrip('/')}/{name}.parquet"
        if name in layout:
            return open_bucketed(spark, at, schema, layout[name]["key"], layout[name]["buckets"])
        return spark.read.schema(schema).parquet(at)

    return {name: opened(name, schema) for name, schema in schemas.items()}


def register_tables(tables: Mapping[str, DataFrame]) -> list[str]:
    """Make tables queryable by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """The lazy result of a SQL text over the registered tables."""
    return spark.sql(text)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    union = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(name).alias("table"), "total_rows")
        union = one if union is None else union.unionByName(one)
    return union
