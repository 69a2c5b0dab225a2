import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesops import session, sources  # noqa: E402
from salesops.plans import model, verify  # noqa: E402
from salesops.plans.clean import clean_model  # noqa: E402
from tests.sales_export import make_export  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = (
        SparkSession.builder.master("local[8]")
        .appName("salesops-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    yield session.tune(built)
    built.stop()


@pytest.fixture
def many_ranges(spark):
    """Keep small shuffles in many partitions, as large ones are."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    spark.conf.set(key, "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Every measured side counts as large, and Spark broadcasts nothing by itself."""
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(scope="session")
def raw(tmp_path_factory):
    """A generated raw export: its folder and its rows."""
    folder = str(tmp_path_factory.mktemp("raw"))
    return folder, make_export(folder)


@pytest.fixture(scope="session")
def cleaned(spark, raw, tmp_path_factory):
    """The export cleaned: folder of CSVs, rows per table, audit log."""
    tables, audit = clean_model(sources.read_catalog(spark, raw[0], ordinal=True))
    out = str(tmp_path_factory.mktemp("clean"))
    counts = sources.rebuild(tables, out, "csv")
    return out, counts, {(r["step"], r["table"], r["metric"]): r["value"] for r in audit.collect()}


@pytest.fixture(scope="session")
def typed(spark, cleaned, tmp_path_factory):
    """The clean tables, typed and stored."""
    folder = str(tmp_path_factory.mktemp("tables"))
    loaded = verify.with_defaults(sources.load_catalog(spark, cleaned[0], model.SCHEMAS))
    assert sources.rebuild(loaded, folder) == cleaned[1]
    return sources.open_tables(spark, folder, model.SCHEMAS)
