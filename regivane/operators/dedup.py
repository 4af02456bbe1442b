"""Keep-last and keep-first deduplication by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: list[str], order: str | Column, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # a partial aggregate: equal keys of a partition meet before the shuffle
    kept = df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order) if isinstance(order, str) else order).alias("__kept"))
    return kept.select(*keys, *(F.col(f"__kept.{c}").alias(c) for c in rest)).select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """The row of the highest ``order`` for each key; null keys equal each other, null fields are kept."""
    return _keep(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    return _keep(df, keys, order, F.min_by)


def keep_last_by_address(df: DataFrame, keys: list[str], address: list[str]) -> DataFrame:
    """As :func:`keep_last` for rows that the ``address`` columns name, the last of which is the order, a number.

    Only keys and addresses are aggregated, in a hash table; the winners' rows are then taken by
    a semi-join on their addresses, so no whole row goes through the aggregate.
    """
    *within, order = address
    winners = df.groupBy(*keys).agg(F.max(order).alias(order)).select(*within, order)
    return df.join(winners, address, "left_semi")
