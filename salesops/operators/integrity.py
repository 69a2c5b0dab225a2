"""Constraint checks and reconciliation (V1-V11). Every check is one job that
returns a DataFrame; nothing but the small result reaches the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.functions import total_or_zero
from salesops.session import materialize, small_side


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_key: str
    cascade: bool = False


class IntegrityError(RuntimeError):
    """A table breaks a declared constraint."""


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    union = None
    for frame in frames:
        union = frame if union is None else union.unionByName(frame)
    return union


def _key_type(columns: Iterable[tuple[DataFrame, str]]) -> str:
    """BIGINT if all keys are integers, else text."""
    integers = {"tinyint", "smallint", "int", "bigint"}
    return "bigint" if all(dict(df.dtypes)[c] in integers for df, c in columns) else "string"


def _key_parts(columns: Iterable[str]) -> Column:
    """A key of one or several columns as an array of texts; NULL if any part is."""
    parts = [F.col(c).cast("string") for c in columns]
    known = F.lit(True)
    for part in parts:
        known = known & part.isNotNull()
    return F.when(known, F.array(*parts))


def check_foreign_keys(tables: Mapping[str, DataFrame], keys: Iterable[ForeignKey]) -> DataFrame:
    """V1: for every foreign key, the rows whose non-NULL key has no parent row.

    All keys are checked in one job: each key column is read once, equal keys
    are counted on the map side, and one join against the parents' keys serves
    all of them. A hot key is one row by then. Pass scans or stored tables.
    Returns child, fk, parent, violations with one row per declared key.
    """
    keys = list(keys)
    session = next(iter(tables.values())).sparkSession
    key_type = _key_type(
        [(tables[k.child], k.column) for k in keys] + [(tables[k.parent], k.parent_key) for k in keys]
    )
    parents = list(dict.fromkeys((k.parent, k.parent_key) for k in keys))
    numbered = [(n, parents.index((k.parent, k.parent_key)), k) for n, k in enumerate(keys)]
    references = [
        tables[k.child].select(
            F.lit(n).alias("link"), F.lit(p).alias("parent_no"), F.col(k.column).cast(key_type).alias("key")
        )
        for n, p, k in numbered
    ]
    counted = (
        _union(references)
        .where(F.col("key").isNotNull())
        .groupBy("link", "parent_no", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    present = _union(
        tables[parent].select(F.lit(p).alias("_parent_no"), F.col(pk).cast(key_type).alias("_key"))
        for p, (parent, pk) in enumerate(parents)
    )
    missing = (
        counted.join(
            present,
            (F.col("parent_no") == F.col("_parent_no")) & (F.col("key") == F.col("_key")),
            "left_anti",
        )
        .groupBy("link")
        .agg(F.sum("n").alias("found"))
    )
    declared = session.createDataFrame(
        [(n, k.child, k.column, k.parent) for n, _, k in numbered], "link int, child string, fk string, parent string"
    )
    return declared.join(missing, "link", "left").select(
        "child", "fk", "parent", F.coalesce("found", F.lit(0)).alias("violations")
    )


def violation_summary(violations: DataFrame) -> DataFrame:
    """V2: violations per (child, parent)."""
    return (
        violations.groupBy("child", "parent")
        .agg(F.sum("violations").alias("violations"))
        .where("violations > 0")
    )


def require_no_violations(violations: DataFrame) -> None:
    """V2: raise if any foreign key is broken. Reads one row per broken pair of tables."""
    broken = violation_summary(violations).collect()
    if broken:
        text = "; ".join(f"{r['child']} -> {r['parent']}: {r['violations']}" for r in broken)
        raise IntegrityError(f"foreign keys without parent: {text}")


def check_unique(tables: Mapping[str, DataFrame], keys: Iterable[tuple[str, str | tuple[str, ...]]]) -> DataFrame:
    """V3, V4: duplicates and NULLs of primary keys and unique columns.

    All keys share one shuffle; equal keys are counted on the map side.
    Returns table, key, duplicate_keys, extra_rows, null_rows, one row per
    declared key, also for empty tables.
    """
    checked = [(t, (c,) if isinstance(c, str) else tuple(c)) for t, c in keys]
    counted = (
        _union(
            tables[table].select(F.lit(n).alias("check_no"), _key_parts(columns).alias("value"))
            for n, (table, columns) in enumerate(checked)
        )
        .groupBy("check_no", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.col("value").isNotNull()
    repeated = known & (F.col("n") > 1)
    result = counted.groupBy("check_no").agg(
        F.count_if(repeated).alias("duplicate_keys"),
        total_or_zero(F.when(repeated, F.col("n") - 1)).alias("extra_rows"),
        total_or_zero(F.when(~known, F.col("n"))).alias("null_rows"),
    )
    declared = result.sparkSession.createDataFrame(
        [(n, table, ", ".join(columns)) for n, (table, columns) in enumerate(checked)],
        "check_no int, table string, key string",
    )
    counts = ("duplicate_keys", "extra_rows", "null_rows")
    return declared.join(result, "check_no", "left").select(
        "table", "key", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts]
    )


def _count_broken(df: DataFrame, table: str, rules: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Count rows per broken rule of one table in one scan; one row per rule."""
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[name]).alias(f"r{i}") for i, name in enumerate(names)])
    entries = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"r{i}").alias("violations")
            )
            for i, (rule, column) in enumerate(names)
        ]
    )
    return counts.select(F.lit(table).alias("table"), F.inline(entries))


def _outside(column: str, low: float | None, high: float | None) -> Column:
    value = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (value < low)
    if high is not None:
        broken = broken | (value > high)
    return broken


def check_columns(
    tables: Mapping[str, DataFrame],
    required: Mapping[str, Iterable[str]],
    ranges: Mapping[str, Mapping[str, tuple[float | None, float | None]]],
) -> DataFrame:
    """V5 and V6 together: one scan per table. Returns table, rule, column, violations."""
    parts = []
    for table in dict.fromkeys((*required, *ranges)):
        rules = {("not null", c): F.col(c).isNull() for c in required.get(table, ())}
        rules |= {("range", c): _outside(c, *bounds) for c, bounds in ranges.get(table, {}).items()}
        parts.append(_count_broken(tables[table], table, rules))
    return _union(parts)


def check_not_null(tables: Mapping[str, DataFrame], required: Mapping[str, Iterable[str]]) -> DataFrame:
    """V5: NULLs in mandatory columns; one scan per table."""
    return check_columns(tables, required, {})


def check_range(
    tables: Mapping[str, DataFrame],
    ranges: Mapping[str, Mapping[str, tuple[float | None, float | None]]],
) -> DataFrame:
    """V6: values outside their inclusive bounds; NULL passes; one scan per table."""
    return check_columns(tables, {}, ranges)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """V7: add columns missing from the input with their default.

    A column that is present keeps its NULLs.
    """
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def cascade_delete(
    tables: Mapping[str, DataFrame],
    root: str,
    root_keys: DataFrame,
    keys: Iterable[ForeignKey],
    primary_keys: Mapping[str, str],
) -> dict[str, DataFrame]:
    """V8: remove rows of ``root`` and all their descendants over cascading keys.

    ``keys`` come parents first. Only the removed primary keys travel down, and
    they are broadcast if they are few; a row without a parent key stays. Tables out of reach are returned unchanged.
    """
    removed = {root: small_side(root_keys.toDF("_removed"))}
    for key in keys:
        if not key.cascade or key.parent not in removed:
            continue
        gone = (
            tables[key.child]
            .join(removed[key.parent], F.col(key.column) == F.col("_removed"), "left_semi")
            .select(F.col(primary_keys[key.child]).alias("_removed"))
        )
        known = removed.get(key.child)
        removed[key.child] = small_side((known.unionByName(gone) if known is not None else gone).distinct())
    return {
        name: df.join(removed[name], F.col(primary_keys[name]) == F.col("_removed"), "left_anti")
        if name in removed
        else df
        for name, df in tables.items()
    }


def delete_unless_referenced(
    tables: Mapping[str, DataFrame],
    root: str,
    root_keys: DataFrame,
    keys: Iterable[ForeignKey],
    primary_keys: Mapping[str, str],
) -> tuple[dict[str, DataFrame], DataFrame]:
    """V8 with restricting keys: remove as many rows of ``root`` as can go, with all their descendants.

    A key that does not cascade restricts: its parent row can go only if the
    referencing row goes as well. A root that would take a row with it which a
    remaining row references is kept, with all that hangs on it, unless another
    root takes that. Rows that are kept this way may hold further roots, so the
    steps are repeated until nothing changes; what is removed in the end is the
    largest set that leaves no reference dangling.

    Tables are read for keys of rows in reach of ``root_keys`` only, and once per
    foreign key; the rounds work on these stored pairs of keys. ``keys`` come
    parents first, a row without a key in ``primary_keys``' column is never
    removed. Returns the remaining tables and the refused root keys (``key``).
    Runs jobs at once.
    """
    keys = list(keys)
    wanted = materialize(
        root_keys.toDF("_key").join(
            tables[root].select(F.col(primary_keys[root]).alias("_own")), F.col("_key") == F.col("_own"), "left_semi"
        ).distinct()
    )
    # Everything that could go, and the cascading pairs (child row, parent row) that say why.
    reach = {root: small_side(wanted, stored=True)}
    links: list[tuple[ForeignKey, DataFrame]] = []
    for key in keys:
        if key.cascade and key.parent in reach:
            pairs = materialize(_references(tables, key, primary_keys, reach[key.parent]).where("_child IS NOT NULL"))
            links.append((key, pairs))
            reach[key.child] = small_side(_more(reach.get(key.child), pairs.select(F.col("_child").alias("_key"))))
    # Restricting references to what could go.
    holds = [
        (key, materialize(_references(tables, key, primary_keys, reach[key.parent])))
        for key in keys
        if not key.cascade and key.parent in reach
    ]
    going, refused = wanted, wanted.limit(0)
    while True:
        removed = {root: small_side(going, stored=True)}
        for key, pairs in links:
            if key.parent in removed:
                gone = _semi(pairs, "_parent", removed[key.parent]).select(F.col("_child").alias("_key"))
                removed[key.child] = small_side(_more(removed.get(key.child), gone))
        held: dict[str, DataFrame] = {}
        for key, pairs in holds:
            if key.parent not in removed:
                continue
            staying = _semi(pairs, "_parent", removed[key.parent])
            if key.child in removed:
                staying = _semi(staying, "_child", removed[key.child], "left_anti")
            held[key.parent] = _more(held.get(key.parent), staying.select(F.col("_parent").alias("_key")))
        # What is held holds the rows whose removal would take it along.
        for key, pairs in reversed(links):
            if key.child in held:
                above = _semi(pairs, "_child", small_side(held[key.child])).select(F.col("_parent").alias("_key"))
                held[key.parent] = _more(held.get(key.parent), above)
        if root not in held:
            break
        kept = materialize(held[root].join(going.withColumnRenamed("_key", "_going"), F.col("_key") == F.col("_going"), "left_semi"))
        if kept.isEmpty():
            break
        refused = materialize(refused.unionByName(kept))
        going = materialize(_semi(going, "_key", small_side(kept, stored=True), "left_anti"))
    left = {
        name: _semi(df, primary_keys[name], removed[name], "left_anti") if name in removed else df
        for name, df in tables.items()
    }
    return left, refused.select(F.col("_key").alias("key"))


def _references(
    tables: Mapping[str, DataFrame], key: ForeignKey, primary_keys: Mapping[str, str], parents: DataFrame
) -> DataFrame:
    """Rows that reference one of the parents: their own key (NULL without one) and the parent's."""
    child = tables[key.child]
    own = F.col(primary_keys[key.child]) if key.child in primary_keys else F.lit(None).cast(dict(child.dtypes)[key.column])
    return _semi(child.select(own.alias("_child"), F.col(key.column).alias("_parent")), "_parent", parents)


def _semi(rows: DataFrame, column: str, among: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose column is (or, with ``left_anti``, is not) among stored keys."""
    others = among.withColumnRenamed("_key", "_among")
    return rows.join(others, F.col(column) == F.col("_among"), how)


def _more(known: DataFrame | None, found: DataFrame) -> DataFrame:
    """Distinct keys of both."""
    return (found if known is None else known.unionByName(found)).distinct()


def fanout_audit(
    parents: DataFrame, key: str, amount: str, children: DataFrame, child_key: str
) -> DataFrame:
    """V9: total of a parent measure, before and after a join to many children.

    The join itself is never built: each parent counts once per child, so the
    children are counted per key and the amount is multiplied by the count.
    """
    per_key = children.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("_children"))
    joined = parents.join(per_key, F.col(key) == F.col("_key"), "left")
    totals = joined.agg(
        F.sum(amount).alias("true_total"),
        F.sum(F.col(amount) * F.coalesce("_children", F.lit(0)).cast("decimal(20,0)")).alias("joined_total"),
    )
    return totals.select(
        F.col("true_total").cast("double").alias("true_total"),
        F.col("joined_total").cast("double").alias("joined_total"),
        F.try_divide(F.col("joined_total").cast("double"), F.col("true_total").cast("double")).alias("inflation"),
        (F.col("joined_total") - F.col("true_total")).cast("double").alias("excess"),
    )


def reconcile(grouped: DataFrame, grouped_total: str, facts: DataFrame, amount: str) -> DataFrame:
    """The grouped totals must add up to the total of the facts."""
    expected = facts.agg(F.sum(amount)).scalar()
    return grouped.agg(F.sum(grouped_total).alias("grouped")).select(
        F.col("grouped").cast("double").alias("grouped_total"),
        expected.cast("double").alias("true_total"),
        (F.col("grouped") == expected).alias("matches"),
    )


def lines_per_parent(children: DataFrame, fk: str) -> DataFrame:
    """Parents with children, and those with at least two."""
    per_parent = children.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    return per_parent.agg(
        F.count(F.lit(1)).alias("parents"), F.count_if(F.col("n") >= 2).alias("parents_with_many")
    )
