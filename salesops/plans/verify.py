"""All constraints of the model over a set of typed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.operators import integrity
from salesops.plans import model


def with_defaults(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Add the default of every declared column an input does not have."""
    return {name: integrity.fill_defaults(df, model.DEFAULTS.get(name, {})) for name, df in tables.items()}


def require_constraints(report: DataFrame) -> None:
    """Raise if any declared constraint is broken. Reads one row per broken constraint."""
    broken = report.where("violations > 0").orderBy("check", "table", "column").collect()
    if broken:
        text = "; ".join(f"{r['check']} {r['table']}.{r['column']}: {r['violations']}" for r in broken)
        raise integrity.IntegrityError(f"broken constraints: {text}")


def foreign_key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    keys = [k for k in model.FOREIGN_KEYS if k.child in tables and k.parent in tables]
    return integrity.check_foreign_keys(tables, keys)


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Broken rows per declared constraint: (check, table, column, violations).

    Three jobs for the whole model: one join for all foreign keys, one shuffle
    for all keys, one scan per table for its columns.
    """
    primary = [(t, k) for t, k in model.PRIMARY_KEYS.items() if t in tables]
    unique = [(t, c) for t, c in model.UNIQUE if t in tables]
    foreign = foreign_key_violations(tables).select(
        F.lit("foreign key").alias("check"), F.col("child").alias("table"), F.col("fk").alias("column"), "violations"
    )
    is_primary = F.concat_ws(".", "table", "key").isin(*[f"{t}.{k}" for t, k in primary])
    keys = integrity.check_unique(tables, [*primary, *unique]).select(
        F.when(is_primary, "primary key").otherwise("unique").alias("check"),
        "table",
        F.col("key").alias("column"),
        # A unique column may be missing, a primary key may not.
        (F.col("extra_rows") + F.when(is_primary, F.col("null_rows")).otherwise(0)).alias("violations"),
    )
    columns = integrity.check_columns(
        tables,
        {t: c for t, c in model.NOT_NULL.items() if t in tables},
        {t: c for t, c in model.RANGES.items() if t in tables},
    ).select(F.col("rule").alias("check"), "table", "column", "violations")
    return foreign.unionByName(keys).unionByName(columns)
