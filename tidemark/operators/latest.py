"""Top-1 per group, in the shapes that the read and queue plans share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_group(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in ``order``, which should be total. Null keys group together.

    ``row_number() = 1`` lets Spark push a group limit below the shuffle, so each task sends one row a key.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_value(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """One column of the greatest row per group, by an aggregate with map-side combine instead of a sort."""
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(name))


def left_top1(rows: DataFrame, others: DataFrame, on: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left join with the first matching row: what a correlated lateral subquery with a limit of one yields."""
    return rows.join(latest_per_group(others, on, order), list(on), "left")


def newest_differs(rows: DataFrame, key: str, order: Sequence[Column], current: Column, name: str = "warning_id", ident: str = "event_id") -> DataFrame:
    """Groups whose newest row is not the current one: the newest row's id, where ``current`` is false for it."""
    newest = latest_per_group(rows, [key], order)
    return newest.where(~current).select(key, F.col(ident).alias(name))
