"""Projections and filters over whole frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names in lower case without blanks around them; two equal results are an error."""
    names = [name.lower().strip() for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after clean-up: {clashes}")
    return df.toDF(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names that are absent are ignored."""
    return df.drop(*names)


def require(df: DataFrame, names: Iterable[str]) -> None:
    """Raise with the names of all missing columns."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")


def map_columns(df: DataFrame, names: Iterable[str], rule: Callable[[Column], Column]) -> DataFrame:
    """Apply one rule to several columns in a single projection."""
    names = list(names)
    require(df, names)
    return df.withColumns({name: rule(F.col(f"`{name}`")) for name in names})


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop the rows in which every column is null."""
    return df.na.drop("all")


def drop_null_rows(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the rows with a null in any of the given columns."""
    return df.na.drop(subset=list(names))


def null_where(value: Column, condition: Column) -> Column:
    """Null where the condition holds; a null condition keeps the value."""
    return F.when(condition, F.lit(None)).otherwise(value)


def any_distinct(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True when any pair differs, with null treated as a value of its own."""
    return reduce(lambda a, b: a | b, (~left.eqNullSafe(right) for left, right in pairs), F.lit(False))


def current_versions(df: DataFrame, flag: str = "vigente") -> DataFrame:
    """Versions flagged current; a null flag is not current."""
    return df.filter(F.col(flag))


def append(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), others, first)
