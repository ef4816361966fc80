"""New table states from an old state and a batch: upsert, schema drift and audit stamps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F


def audit_columns(df: DataFrame, now: datetime, reference: date | None = None) -> DataFrame:
    """Created and updated stamps and, when a reference day is given, that day."""
    stamps = {"criado_em": F.lit(now), "atualizado_em": F.lit(now)}
    if reference is not None:
        stamps["data_referencia"] = F.lit(reference)
    return df.withColumns(stamps)


def sync_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target with every column that is new in the batch, null in old rows."""
    new = {f.name: F.lit(None).cast(f.dataType) for f in batch.schema.fields if f.name not in target.columns}
    return target.withColumns(new)


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Name and database type of every column."""
    # The database type that each column type is stored as.
    names = {
        "boolean": "BOOLEAN",
        "tinyint": "BIGINT",
        "smallint": "BIGINT",
        "int": "BIGINT",
        "bigint": "BIGINT",
        "float": "DOUBLE PRECISION",
        "double": "DOUBLE PRECISION",
        "timestamp": "TIMESTAMP",
        "timestamp_ntz": "TIMESTAMP",
        "date": "DATE",
    }
    return [(name, names.get(kind, "TEXT")) for name, kind in df.dtypes]


def type_report(df: DataFrame) -> DataFrame:
    """Per column its database type and how many values it holds, in one pass."""
    counts = df.agg(*(F.count(f"`{name}`").alias(name) for name in df.columns))
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"), F.col(f"`{name}`").alias("non_null"))
        for name, kind in column_types(df)
    ]
    return counts.select(F.inline(F.array(*entries)))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], frozen: Sequence[str] = ()) -> DataFrame:
    """Target with the batch's rows inserted or updated by key.

    A null in the batch overwrites. Frozen columns keep the value of the first
    insert. Columns that only the target has keep their value and are null in
    inserted rows. Both sides must be unique by key, which also means that no key
    can be hot in this join.
    """
    keys = list(keys)
    target = sync_columns(target, batch)
    new = batch.selectExpr(
        *(f"`{k}`" for k in keys),
        *(f"`{name}` AS `__new_{name}`" for name in batch.columns if name not in keys),
        "true AS __got",
    )
    joined = target.withColumn("__had", F.lit(True)).join(new, keys, "full_outer")

    def rule(name: str) -> str:
        if name in keys or name not in batch.columns:
            return f"`{name}`"
        if name in frozen:
            return f"CASE WHEN __had THEN `{name}` ELSE `__new_{name}` END AS `{name}`"
        return f"CASE WHEN __got THEN `__new_{name}` ELSE `{name}` END AS `{name}`"

    return joined.selectExpr(*(rule(name) for name in target.columns))


def upsert_known(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], frozen: Sequence[str], untouched: DataFrame
) -> DataFrame:
    """As ``upsert``, if the keys of the target that the batch leaves alone are known.

    Of an updated row only what the batch does not overwrite is read, and of the others nothing is joined but these
    keys, so that wide old rows are sent only where many stay. Keys may be null in the target, not in the batch.
    """
    keys = list(keys)
    target = sync_columns(target, batch)
    alone = untouched.select(*(F.col(key).alias(f"__alone_{i}") for i, key in enumerate(keys)))
    same = [target[key].eqNullSafe(alone[f"__alone_{i}"]) for i, key in enumerate(keys)]
    own = [name for name in target.columns if name not in keys and (name in frozen or name not in batch.columns)]
    old = target.selectExpr(*(f"`{k}`" for k in keys), *(f"`{name}` AS `__old_{name}`" for name in own), "true AS __had")
    joined = batch.join(old, keys, "left")

    def rule(name: str) -> str:
        if name not in own:
            return f"`{name}`"
        new = f"`{name}`" if name in batch.columns else "NULL"
        return f"CASE WHEN __had THEN `__old_{name}` ELSE {new} END AS `{name}`"

    return target.join(alone, same, "left_semi").unionByName(joined.selectExpr(*(rule(name) for name in target.columns)))


def drop_absent_children(state: DataFrame, batch: DataFrame, parent: str, keys: Sequence[str]) -> DataFrame:
    """State without the children that a parent in the batch no longer has there."""
    parents = batch.select(F.col(parent).alias("__parent")).distinct()
    children = batch.select(*(F.col(key).alias(f"__child_{i}") for i, key in enumerate(keys)))
    same_child = [state[key] == children[f"__child_{i}"] for i, key in enumerate(keys)]
    marked = state.join(children, same_child, "left").join(parents, state[parent] == parents["__parent"], "left")
    return marked.filter("__parent is null or __child_0 is not null").select(*state.columns)


def replace_slices(target: DataFrame, batch: DataFrame, slice_column: str, slices: Sequence | None = None) -> DataFrame:
    """Target with whole slices replaced by the batch's rows.

    The slices are those the batch holds, or the given ones, which may be empty in the batch.
    """
    if slices is None:
        kept = target.join(batch.select(slice_column).distinct(), slice_column, "left_anti").select(*target.columns)
    else:
        kept = target.filter(~F.coalesce(F.col(slice_column).isin(list(slices)), F.lit(False)))
    return sync_columns(kept, batch).unionByName(batch, allowMissingColumns=True)
