"""Raw export -> clean model: dimensions, key repair, keep-last, orphans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.functions import repair_prefix
from salesops.operators import dimensions as dim
from salesops.operators import rows
from salesops.plans import model
from salesops.session import materialize
from salesops.sources import ORDINAL


def _lookup_columns(raw: DataFrame) -> tuple[str, str]:
    """Lookups are addressed by position: id first, value second."""
    return raw.columns[0], raw.columns[1]


def clean_model(raw: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean tables and the audit log (step, table, metric, value).

    ``raw`` holds text tables read with ``ordinal=True``; the raw frames are
    never changed, so no key is repointed twice. A table missing from the
    input is left out, together with the steps that need it. The order of the
    steps matters: repoint, keep last, blank rows, orphans.
    """
    lookup_names = [n for n in (*model.LOOKUPS, *model.OTHER_LOOKUPS) if n in raw]
    if lookup_names:
        raw = {**raw, **dim.store_lookups({n: raw[n] for n in lookup_names}, ORDINAL)}
    tables = dict(raw)
    stored: dict[str, DataFrame] = {}
    audit: list[DataFrame] = []

    # 1. Dimensions and the keys that use them. All dimensions are numbered together.
    lookups = {
        name: (raw[name], *_lookup_columns(raw[name]), prefix, dim.LOOKUP_SENTINELS)
        for name, (prefix, _) in model.LOOKUPS.items()
        if name in raw
    }
    if "JobTitle" in raw:
        lookups["JobTitle"] = (raw["JobTitle"], *_lookup_columns(raw["JobTitle"]), "JOB", ("",))
    numbered, small = dim.build_dimensions(lookups, "_place") if lookups else ({}, None)
    clean = {name: dimension.drop("_place") for name, dimension in numbered.items()}
    for name, (_, references) in model.LOOKUPS.items():
        if name not in clean:
            continue
        audit += rows.before_after("dimension", name, raw[name], clean[name])
        id_col, value_col = _lookup_columns(raw[name])
        id_map = dim.id_value_map(raw[name], id_col, value_col, ORDINAL)
        mapping = dim.key_mapping(id_map, clean[name], id_col, value_col, small)
        for fact, fk in references:
            if fact in tables:
                tables[fact] = dim.repoint_fk(tables[fact], fk, mapping)

    # 2. One city dimension for both kinds of addresses.
    cities = [(raw[n], _lookup_columns(raw[n])[1]) for n in ("BillingCity", "ShippingCity") if n in raw]
    if cities:
        clean["City"] = materialize(dim.merge_dimensions(cities, "CTY", "city_id", "city_name"))
        audit.append(rows.row_count(clean["City"], "city", "City"))
    for kind, repair in (("Billing", None), ("Shipping", ("CIT", "SCT"))):
        table, lookup = f"{kind}Address", f"{kind}City"
        if table not in raw or lookup not in raw:
            continue
        id_col, value_col = _lookup_columns(raw[lookup])
        id_map = dim.id_value_map(raw[lookup], id_col, value_col, ORDINAL)
        mapping = dim.key_mapping(id_map, clean["City"], "city_id", "city_name")
        old = f"{kind.lower()}_city_id"
        via = repair_prefix(old, *repair) if repair else F.col(old)
        linked, counts = rows.store_counted(
            dim.relink(raw[table], old, mapping, "city_id", via),
            {"total_rows": None, "resolved": F.col("city_id").isNotNull()},
        )
        audit.append(rows.audit_rows(linked.sparkSession, "city", table, counts))
        tables[table] = stored[table] = linked

    # 3. Job titles: genuine references are kept, the rest is filled by hash.
    if "JobTitle" in clean:
        audit += rows.before_after("dimension", "JobTitle", raw["JobTitle"], clean["JobTitle"])
    if "JobTitle" in clean and "Customer" in raw:
        id_col, value_col = _lookup_columns(raw["JobTitle"])
        id_map = dim.id_value_map(raw["JobTitle"], id_col, value_col, ORDINAL)
        mapping = dim.key_mapping(id_map, clean["JobTitle"], id_col, value_col, small)
        filled, counts = rows.store_counted(
            dim.hash_fill(
                raw["Customer"], "customer_id", "job_title_id", mapping,
                numbered["JobTitle"], id_col, value_col, genuine="_genuine", place="_place",
            ),
            {"kept": F.col("_genuine"), "filled": ~F.col("_genuine")},
        )
        audit.append(rows.audit_rows(filled.sparkSession, "job title", "Customer", counts))
        tables["Customer"] = stored["Customer"] = filled.drop("_genuine")

    # 4. One row per key, sentinels, blank rows.
    entities = [t for t in model.SCHEMAS if t not in model.DIMENSIONS and t in tables]
    for table in entities:
        # Stored once with its new keys; the steps below read it column by column.
        before = df = stored[table] if table in stored else materialize(tables[table])
        if table in model.REPEATED_KEYS:
            # Stored again: the orphan steps and the audit read it several times.
            df, counts = rows.store_counted(rows.dedupe_keep_last(before, model.PRIMARY_KEYS[table], ORDINAL), {"rows_after": None})
            audit.append(rows.row_count(before, "keep last", table, "rows_before"))
            audit.append(rows.audit_rows(df.sparkSession, "keep last", table, counts))
        df = rows.null_sentinels(df)
        if table in model.REQUIRED:
            filled_rows = rows.require_non_blank(df, model.REQUIRED[table])
            audit += rows.before_after("blank rows", table, df, filled_rows)
            df = filled_rows
        clean[table] = df

    # 5. Orphans, parents first.
    for child, fk, parent, pk in model.ORPHAN_LINKS:
        if child not in clean or parent not in clean:
            continue
        kept = rows.drop_orphans(clean[child], fk, clean[parent], pk)
        audit += rows.before_after(f"orphans {fk}", child, clean[child], kept)
        clean[child] = kept

    clean = {name: df.drop(ORDINAL) for name, df in clean.items()}
    return clean, rows.audit_log(audit)
