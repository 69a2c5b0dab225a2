"""CSV in, CSV or Parquet out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Position of a row in its files: path, start of the split, row within the split.
ORDINAL = "_ordinal"


def read_raw_csv(spark: SparkSession, path: str, ordinal: bool = False, multi_line: bool = False) -> DataFrame:
    """A CSV with header; every column is text, empty fields are NULL.

    Names come from the header and are trimmed; no schema is passed, because a
    CSV schema binds by position. ``ordinal`` adds the file order, captured at
    the scan, for keep-last. ``multi_line`` allows line breaks inside quotes,
    at the price that a file is no longer split.
    """
    df = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("encoding", "UTF-8")
        .csv(path)
    )
    names = [c.replace("\ufeff", "").strip() for c in df.columns]
    if not ordinal:
        return df.toDF(*names)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", position.alias(ORDINAL)).toDF(*names, ORDINAL)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # Texts are written as they are: no trimming, doubled quotes, empty = NULL.
        writer = (
            writer.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.format(fmt).save(path)


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", layout: Mapping[str, Mapping] | None = None
) -> dict[str, int]:
    """Write each table to ``folder/<name>.<fmt>`` and return its row count.

    The rows are counted while they are written, in the last stage of each job,
    so there is no second pass over the data. ``layout`` names ``key`` and number
    of ``buckets`` of tables that are laid out by key (Parquet only).
    """
    counts = {}
    for name, df in tables.items():
        if layout and name in layout:
            counts[name] = write_bucketed(df, f"{folder.rstrip('/')}/{name}.{fmt}", **layout[name])
            continue
        seen = Observation()
        _write(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{folder.rstrip('/')}/{name}.{fmt}", fmt)
        counts[name] = seen.get["rows"]
    return counts


def rebuild(
    tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", layout: Mapping[str, Mapping] | None = None
) -> dict[str, int]:
    """Replace all tables of a folder. Running it twice gives the same tables."""
    return write_tables(tables, folder, fmt, layout)


# A published folder: numbered manifests, each naming the folder of a complete set of tables.
_MANIFESTS, _VERSIONS = "_manifest", "_versions"


def _system(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder, and its way to make paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _manifests(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the manifests, oldest first."""
    system, path = _system(spark, folder)
    at = path(f"{folder.rstrip('/')}/{_MANIFESTS}")
    names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
    return sorted(int(n) for n in names if n.isdigit())


def _read_manifest(spark: SparkSession, folder: str, number: int) -> dict:
    rows = spark.read.text(f"{folder.rstrip('/')}/{_MANIFESTS}/{number}", wholetext=True).first()
    return json.loads(rows["value"])


def staging_folder(folder: str) -> str:
    """A new place for a set of tables that is not published yet."""
    return f"{folder.rstrip('/')}/{_VERSIONS}/{uuid.uuid4().hex}"


def published(spark: SparkSession, folder: str) -> dict:
    """What is in a folder now: ``path`` of its tables and their ``layout``.

    The manifest with the highest number counts. A folder without manifests,
    as ``rebuild`` writes it, is its own set of tables.
    """
    numbers = _manifests(spark, folder)
    if not numbers:
        return {"path": folder.rstrip("/"), "layout": {}}
    manifest = _read_manifest(spark, folder, numbers[-1])
    return {"path": f"{folder.rstrip('/')}/{_VERSIONS}/{manifest['version']}", "layout": manifest["layout"]}


def publish(spark: SparkSession, folder: str, staged: str, layout: Mapping | None = None, keep: int = 2) -> None:
    """Make a complete set of tables, written to a ``staging_folder``, the one that readers open.

    The switch is one rename of a manifest to the next number: readers see the
    former set or the new one, never a part. If two loads end at the same time,
    the rename of one finds the number taken, and that load fails. The ``keep``
    latest sets stay, so that a reader may finish with the former one.
    """
    system, path = _system(spark, folder)
    base = folder.rstrip("/")
    numbers = _manifests(spark, folder)
    number = (numbers[-1] if numbers else 0) + 1
    draft, final = path(f"{base}/{_MANIFESTS}/.{uuid.uuid4().hex}"), path(f"{base}/{_MANIFESTS}/{number}")
    out = system.create(draft)
    out.write(bytearray(json.dumps({"version": staged.rstrip("/").rsplit("/", 1)[-1], "layout": dict(layout or {})}).encode()))
    out.close()
    if system.exists(final) or not system.rename(draft, final):
        raise FileExistsError(f"another load has published {final}")
    for old in numbers[: max(len(numbers) + 1 - keep, 0)]:
        discard(spark, f"{base}/{_VERSIONS}/{_read_manifest(spark, folder, old)['version']}")
        system.delete(path(f"{base}/{_MANIFESTS}/{old}"), False)


def discard(spark: SparkSession, staged: str) -> None:
    """Remove a set of tables that is not, or no longer, published."""
    system, path = _system(spark, staged)
    system.delete(path(staged), True)


def bucket_number(input_bytes: int, cores: int) -> int:
    """Buckets for tables of that size: some 256 MB each, and work for every core."""
    return max(2 * cores, -(-input_bytes // (256 * 1024 * 1024)))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> int:
    """S4 laid out by key: each bucket one sorted Parquet file; returns the rows written.

    Tables that share key type and bucket number join on the key without a shuffle
    and without a sort (``open_bucketed``). Rows are dealt to the tasks as the
    buckets are, so that a task writes one file. A bucket is never split: a table
    of which one key holds a large share is better left without buckets.
    """
    name = f"written_{uuid.uuid4().hex}"
    seen = Observation()
    rows = df.repartition(buckets, key).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    # Only the session's name goes: the files are an external table's.
    df.sparkSession.sql(f"DROP TABLE {name}")
    return seen.get["rows"]


def open_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """A table written by ``write_bucketed``, known to Spark as bucketed and sorted by its key."""
    name = f"bucketed_{uuid.uuid4().hex}"
    at = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{at}'"
    )
    return spark.table(name)
