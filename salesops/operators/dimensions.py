"""Dimensions, surrogate keys and foreign-key repair."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.functions import format_key, is_blank, md5_modulo
from salesops.operators.ordering import number_values
from salesops.operators.rows import last_first
from salesops.session import is_small, materialize, small_side

# Texts that mean "no value" in a lookup.
LOOKUP_SENTINELS = ("", "Na", "NA", "N/A", "nan", "None")


def surrogate_keys(values: DataFrame, value: str, prefix: str, key: str, place: str | None = None) -> DataFrame:
    """One row per distinct value with key = prefix + rank of the value; ``place`` names a column for the rank itself."""
    numbered = number_values(values.select(F.lit("").alias("_one"), value), "_one", value)
    return numbered.select(format_key(prefix, "position").alias(key), value, *_placed(place))


def _placed(place: str | None) -> list[Column]:
    return [F.col("position").alias(place)] if place else []


def build_dimension(
    lookup: DataFrame,
    id_col: str,
    value_col: str,
    prefix: str,
    sentinels: Iterable[str] = LOOKUP_SENTINELS,
    place: str | None = None,
) -> DataFrame:
    """The distinct real values of a lookup, keyed in code-point order; ``place`` as in ``surrogate_keys``."""
    real = lookup.select(value_col).where(~_is_sentinel(F.col(value_col), sentinels))
    return surrogate_keys(real, value_col, prefix, id_col, place)


def build_dimensions(
    lookups: Mapping[str, tuple[DataFrame, str, str, str, Iterable[str]]], place: str | None = None
) -> tuple[dict[str, DataFrame], bool]:
    """N1 for many lookups in a single pass; ``place`` as in ``surrogate_keys``.

    ``lookups`` maps a name to (frame, id column, value column, prefix,
    sentinels). All values are numbered together, grouped by lookup, so the
    cost is one shuffle for all of them. The dimensions are stored; the flag
    tells whether they are small, all together, by measurement.
    """
    union = None
    for name, (lookup, _, value_col, _, sentinels) in lookups.items():
        value = F.col(value_col)
        part = lookup.where(~_is_sentinel(value, sentinels)).select(
            F.lit(name).alias("_lookup"), F.coalesce(value, F.lit("")).alias("_value")
        )
        union = part if union is None else union.unionByName(part)
    numbered = materialize(number_values(union, "_lookup", "_value"))
    built = {
        name: numbered.where(F.col("_lookup") == name).select(
            format_key(prefix, "position").alias(id_col), F.col("_value").alias(value_col), *_placed(place)
        )
        for name, (_, id_col, value_col, prefix, _) in lookups.items()
    }
    return built, is_small(numbered)


def _is_sentinel(value: Column, sentinels: Iterable[str]) -> Column:
    """NULL counts as the empty text; an empty list means every text is real."""
    return F.coalesce(value, F.lit("")).isin(*sentinels)


def store_lookups(lookups: Mapping[str, DataFrame], ordinal: str) -> dict[str, DataFrame]:
    """Parse the text of many raw lookups once: (id, value, ordinal) under their own names.

    All of them go into one stored table, in a folder per lookup.
    """
    union = None
    for name, df in lookups.items():
        id_col, value_col = df.columns[:2]
        part = df.select(
            F.lit(name).alias("_lookup"), F.col(id_col).alias("_id"), F.col(value_col).alias("_value"), ordinal
        )
        union = part if union is None else union.unionByName(part)
    stored = materialize(union, partition_by="_lookup")
    return {
        name: stored.where(F.col("_lookup") == name).select(
            F.col("_id").alias(df.columns[0]), F.col("_value").alias(df.columns[1]), ordinal
        )
        for name, df in lookups.items()
    }


def id_value_map(lookup: DataFrame, id_col: str, value_col: str, ordinal: Column | str) -> DataFrame:
    """Old id -> value, unique on the id; the last row by ``ordinal`` wins, a NULL ordinal comes first.

    Blank ids are left out: they identify nothing.
    Returns ``old_id``, ``value``.
    """
    return (
        lookup.where(~is_blank(lookup, id_col))
        .groupBy(F.col(id_col).alias("old_id"))
        .agg(F.max_by(F.col(value_col), last_first(ordinal)).alias("value"))
    )


def key_mapping(
    id_map: DataFrame, dimension: DataFrame, key_col: str, value_col: str, small: bool | None = None
) -> DataFrame:
    """Old id -> new key. Ids whose value is no member of the dimension drop out.

    A missing value is the empty text on both sides, as it is among the members.

    Few values may stand for very many ids, so a dimension of checked size is
    broadcast instead of shuffling the ids by value. ``small`` passes on the
    result of a check already made.
    """
    members = dimension.select(F.col(key_col).alias("new_id"), F.coalesce(F.col(value_col), F.lit("")).alias("value"))
    if is_small(members) if small is None else small:
        members = F.broadcast(members)
    return id_map.withColumn("value", F.coalesce("value", F.lit(""))).join(members, "value").select("old_id", "new_id")


def _join_key(df: DataFrame, key: Column, row_key: str | None = None) -> Column:
    """A left-join key whose NULLs do not all meet in one partition.

    A missing text key becomes one of many texts that no key equals, picked by
    the row's own key (default: the first column); other types are left to the
    skew join.
    """
    if df.select(key).schema[0].dataType.simpleString() != "string":
        return key
    bucket = F.pmod(F.xxhash64(F.col(row_key or df.columns[0])), F.lit(4096))
    return F.coalesce(key, F.concat(F.lit("\u0000"), bucket.cast("string")))


def repoint_fk(fact: DataFrame, fk: str, mapping: DataFrame) -> DataFrame:
    """Replace an old foreign key by the new one, NULL if it does not resolve.

    The mapping is as large as the raw lookup, so Spark chooses the join by
    size. It is unique on the old id: the row count cannot change.
    """
    return relink(fact, fk, mapping, fk)


def merge_dimensions(frames: Iterable[tuple[DataFrame, str]], prefix: str, key: str, value: str) -> DataFrame:
    """Set union of the values of several lookups, keyed as one dimension.

    No text is treated as a sentinel here; NULL counts as the empty text.
    """
    union = None
    for frame, column in frames:
        part = frame.select(F.coalesce(F.col(column), F.lit("")).alias(value))
        union = part if union is None else union.unionByName(part)
    return surrogate_keys(union, value, prefix, key)


def relink(child: DataFrame, old_fk: str, mapping: DataFrame, new_fk: str, via: Column | None = None) -> DataFrame:
    """Resolve ``via`` (default: the old key) through the mapping into ``new_fk``.

    The old key column is dropped; a key replaced under its own name keeps its
    place among the columns.
    """
    key = _join_key(child, via if via is not None else F.col(old_fk))
    mapped = mapping.select(F.col("old_id").alias("_old_id"), F.col("new_id").alias("_new_id"))
    joined = child.withColumn("_key", key).join(mapped, F.col("_key") == F.col("_old_id"), "left")
    if new_fk in child.columns:
        kept = [F.col("_new_id").alias(c) if c == new_fk else F.col(c) for c in child.columns]
    else:
        kept = [F.col(c) for c in child.columns if c != old_fk] + [F.col("_new_id").alias(new_fk)]
    return joined.select(*kept)


def recovery_counts(df: DataFrame, resolved: Column | str) -> DataFrame:
    """Rows, and how many of them did and did not get a key; one pass."""
    resolved = F.col(resolved).isNotNull() if isinstance(resolved, str) else resolved
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(resolved).alias("resolved"),
        F.count_if(~resolved).alias("unresolved"),
    )


def hash_fill(
    fact: DataFrame,
    key: str,
    fk: str,
    mapping: DataFrame,
    dimension: DataFrame,
    dim_key: str,
    dim_value: str,
    genuine: str | None = None,
    place: str | None = None,
) -> DataFrame:
    """Keep a reference that resolves, else pick a member by MD5 of the row key.

    The member number is the MD5 of ``key`` modulo the number of members, in
    value order. The pick is an equi-join on that number, so the dimension may
    have any size. ``place`` is the dimension's column of that order, from 1, if
    it was built with one (``surrogate_keys``); without it the members are numbered
    again. ``genuine`` names an optional flag column.
    """
    if place:
        members = dimension.select(F.col(place).alias("position"), dim_key)
    else:
        members = number_values(
            dimension.select(F.lit("").alias("_one"), dim_value), "_one", dim_value
        ).join(dimension.select(dim_key, dim_value), dim_value)
    choices = small_side(
        members.select((F.col("position") - 1).alias("_choice"), F.col(dim_key).alias("_picked"))
    )
    size = choices.agg(F.count(F.lit(1))).scalar()
    mapped = mapping.select(F.col("old_id").alias("_old_id"), F.col("new_id").alias("_new_id"))
    # Every row gets a number, also those that keep their reference: the join
    # key stays evenly spread and has no NULLs.
    filled = (
        fact.withColumn("_key", _join_key(fact, F.col(fk), key))
        .join(mapped, F.col("_key") == F.col("_old_id"), "left")
        .withColumn("_number", md5_modulo(key, size))
        .join(choices, F.col("_number") == F.col("_choice"), "left")
    )
    chosen = F.coalesce("_new_id", "_picked")
    kept = [chosen.alias(c) if c == fk else F.col(c) for c in fact.columns]
    if genuine:
        kept.append(F.col("_new_id").isNotNull().alias(genuine))
    return filled.select(*kept)
