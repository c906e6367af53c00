"""Keyed row operations as pure DataFrame functions; tables.py applies them to tables.

A single key may hold a large share of all rows. Duplicates are therefore resolved by
aggregation, which combines before the shuffle, and joins are of a kind that adaptive
execution splits where a key is heavy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.names import c, resolve


def matches(where: Mapping[str, Any]) -> Column:
    """AND of equalities, of which there must be one; a null never matches."""
    if not where:
        raise ValueError("No condition given; this would change or remove every row")
    return reduce(Column.__and__, [c(name) == F.lit(value) for name, value in where.items()])


def select_rows(
    df: DataFrame, columns: Sequence[str] | None = None, where: Mapping[str, Any] | None = None
) -> DataFrame:
    kept = df.where(matches(where)) if where else df
    return kept if columns is None else kept.select(*[c(name) for name in resolve(df, columns)])


def update_rows(df: DataFrame, data: Mapping[str, Any], where: Mapping[str, Any]) -> DataFrame:
    """Set columns of the rows that match ``where``."""
    names = dict(zip(resolve(df, data), data.values()))
    hit = F.coalesce(matches(where), F.lit(False))
    return df.select(
        *[
            F.when(hit, F.lit(names[name]).cast(df.schema[name].dataType))
            .otherwise(c(name))
            .alias(name)
            if name in names
            else c(name)
            for name in df.columns
        ]
    )


def delete_rows(df: DataFrame, where: Mapping[str, Any]) -> DataFrame:
    """Rows that do not match ``where``; a comparison with null is no match."""
    return df.where(~F.coalesce(matches(where), F.lit(False)))


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    keep: str = "first",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key (null equals null): the first or last by ``order_by``.

    Rows are unordered in Spark, so a proper subset of the columns needs an order;
    ties fall to the smallest (first) or largest (last) remaining values. A min/max
    over whole rows combines on the map side: a key with many copies costs one row
    per task, where a ranking window would sort them all in one place.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    keys = resolve(df, keys) if keys is not None else df.columns
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.dropDuplicates()
    order = resolve(df, order_by)
    if not order:
        raise ValueError("Name the columns that order the rows (order_by)")
    pick = F.min if keep == "first" else F.max
    ranked = [*order, *[name for name in rest if name not in order]]
    chosen = df.groupBy(*map(c, keys)).agg(pick(F.struct(*map(c, ranked))).alias("__row"))
    return chosen.select(
        *[c(name) if name in keys else F.col("__row")[name].alias(name) for name in df.columns]
    )


def upsert(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``existing`` with ``new`` on top: rows of ``new`` win, null keys are equal.

    Within ``new`` the last row per key by ``order_by`` counts. The old rows are filtered by an
    anti join, which broadcasts a small batch: they are neither shuffled nor sorted for it.
    Old rows that share a key stay as they are unless the batch has it; with ``order_by`` too
    they are brought down to the last one, which shuffles them.
    """
    keys = resolve(existing, keys)
    rest = [name for name in existing.columns if name not in keys]
    new = new.select(*map(c, existing.columns))
    if order_by or not rest:
        existing = deduplicate(existing, keys, "last", order_by)
        new = deduplicate(new, keys, "last", order_by)
    else:
        new = deduplicate(new, keys, "last", rest)
    taken = new.select(*[c(name).alias(f"__{number}") for number, name in enumerate(keys)])
    same = [c(name).eqNullSafe(F.col(f"__{number}")) for number, name in enumerate(keys)]
    return existing.join(taken, reduce(Column.__and__, same), "left_anti").unionByName(new)


def rows_with_new_keys(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``.

    A null in a key matches nothing, so such rows are kept, as are repetitions within ``new``.
    One anti join against the distinct keys: the batch is read once, and a key with many rows
    is split by the skew handling of adaptive execution.
    """
    names = resolve(new, keys)
    known = existing.select(*[c(old).alias(name) for old, name in zip(resolve(existing, keys), names)])
    return new.join(known.distinct(), names, "left_anti")
