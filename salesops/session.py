"""Session settings, durable intermediates and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only below both bounds; beyond them it is shuffled.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# A last stage of few rows is merged: rows of a task and its file, and tasks per core at least.
TASK_ROWS, TASKS_PER_CORE = 250_000, 2

# Runtime settings every plan here counts on. Hot join keys are split by the
# adaptive skew join, also where the split costs an extra shuffle downstream.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partitions that fit in memory are joined by hash instead of being sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Tables of one sorted file per bucket are read as sorted, so that joins on their key need no sort.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle and scan sizing for an input volume.

    Shuffles start with one partition per 128 MB (at least two per core; some
    800,000 for 100 TB) and adaptive execution merges the small ones; scans use
    256 MB splits so that 100 TB become some 400,000 scan tasks.
    """
    target = 128 * 1024 * 1024
    partitions = max(2 * cores, -(-input_bytes // target))
    return {
        **ADAPTIVE_SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def build_session(app: str = "salesops", input_bytes: int = 0, cores: int = 8) -> SparkSession:
    """A session with the settings above; the master comes from the submit command."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for key, value in cluster_settings(input_bytes, cores).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_for(spark: SparkSession, folder: str) -> int:
    """Measure an input folder and size the session's shuffles and scans for it. Returns the bytes."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = system.getContentSummary(path).getLength()
    for key, value in cluster_settings(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    return size


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediates named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="salesops-")
    context.setCheckpointDir(fallback)
    return fallback


_roots: set[str] = set()


def _scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediates; it goes when the driver's JVM ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/salesops/{spark.sparkContext.applicationId}"
    if root not in _roots:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _roots.add(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediates of this application at once, when its results are written."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def materialize(df: DataFrame, partition_by: str | None = None, most_rows: int | None = None) -> DataFrame:
    """Cut the lineage by writing a table to the shared folder and reading it back.

    Frames that are read more than once, or whose row placement must not change
    between two reads, go through here. The table outlives any executor, so a
    lost one never leads to a second, different evaluation. Later reads fetch
    only the columns they need, and the planner knows the true size. With
    ``partition_by`` a filter on that column reads its folder only.

    ``most_rows`` bounds the rows that the last stage reads. A file costs three
    processes (``chmod``) that the executor starts where Hadoop's native library
    is missing, so a small table is not written in a file per shuffle partition.
    """
    return written(df, partition_by, most_rows)[0]


def written(df: DataFrame, partition_by: str | None = None, most_rows: int | None = None) -> tuple[DataFrame, str]:
    """As ``materialize``, with the folder, so that a superseded table can go.

    The driver starts such processes too, for each folder and for the file that
    marks a job's success; nothing asks for that mark here.
    """
    path = scratch_path(df.sparkSession, "table")
    if most_rows is not None:
        df = merged(df, most_rows)
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns), path


def merged(df: DataFrame, most_rows: int) -> DataFrame:
    """With as few partitions as ``most_rows`` of the last stage need."""
    return df.coalesce(max(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, -(-most_rows // TASK_ROWS)))


def measure(stored: DataFrame) -> tuple[int, bool]:
    """Rows of a materialised frame, and whether it is within both broadcast bounds."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(16) for c in stored.columns),
        F.lit(0),
    )
    rows, size = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows, rows <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES


def is_small(stored: DataFrame) -> bool:
    return measure(stored)[1]


def small_side(df: DataFrame, stored: bool = False, most_rows: int | None = None) -> DataFrame:
    """A join side that is broadcast only if its measured size is small.

    The frame is materialised once (unless the caller has done so) and measured;
    beyond the bounds it is returned without a hint and Spark plans a shuffle
    join.
    """
    side = df if stored else materialize(df, most_rows=most_rows)
    return F.broadcast(side) if is_small(side) else side
