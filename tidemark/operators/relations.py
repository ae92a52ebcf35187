"""Joins and set operations that recur: lateral shapes, anti-joins, neighbours, multiset pairing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import cut


def neighbours(hits: DataFrame, rows: DataFrame, group: str, position: str, radius: int) -> DataFrame:
    """Rows within ``radius`` positions of a hit in its group: one range frame over rows and hits together.

    Stretches of many radii are windows of their own, so that a group of any length is spread; a hit near a stretch's end stands in both.
    """
    span = 64 * radius + 1
    hit = hits.select(F.col(group).alias("_g"), F.col(position).cast("long").alias("_p"), F.explode(F.array_distinct(F.array(*[F.floor((F.col(position) + d) / span) for d in (-radius, radius)]))).alias("_stretch"))
    marked = rows.select(*rows.columns, F.col(group).alias("_g"), F.col(position).cast("long").alias("_p"), F.floor(F.col(position) / span).alias("_stretch"), F.lit(False).alias("_hit"))
    together = marked.unionByName(hit.withColumn("_hit", F.lit(True)), allowMissingColumns=True)
    near = F.max("_hit").over(W.partitionBy("_g", "_stretch").orderBy("_p").rangeBetween(-radius, radius))
    return together.withColumn("_near", near).where("_near and not _hit").select(*rows.columns)


def multiset_pair(old: DataFrame, new: DataFrame, ident: str, exact: Sequence[str], loose: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pair two multisets: first equal on ``exact`` keys, the rest on ``loose`` ones, each by ordinal. Columns old_id, new_id, change.

    unchanged: equal on all exact keys; changed: equal on the loose ones; removed and created: left without a partner. Every
    row pairs once, whatever the number of duplicates. Ordinals are taken within a key, never over all rows.
    """

    def numbered(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order, ident))).select(*keys, "_n", F.col(ident).alias(name))

    first = numbered(old, exact, "old_id").join(numbered(new, exact, "new_id"), [*exact, "_n"], "full")
    same = first.where("old_id is not null and new_id is not null").select("old_id", "new_id", F.lit("unchanged").alias("change"))
    old_left = old.join(first.where("new_id is null").select(F.col("old_id").alias(ident)), ident, "left_semi")
    new_left = new.join(first.where("old_id is null").select(F.col("new_id").alias(ident)), ident, "left_semi")
    second = numbered(old_left, loose, "old_id").join(numbered(new_left, loose, "new_id"), [*loose, "_n"], "full")
    change = F.when(F.col("new_id").isNull(), "removed").when(F.col("old_id").isNull(), "created").otherwise("changed")
    return same.unionByName(second.select("old_id", "new_id", change.alias("change")))


def change_kind(pairs: DataFrame, had_previous: bool) -> DataFrame:
    """One row: materialized for a first version or if anything was created or removed, else observed."""
    counts = pairs.agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("created", "removed", "changed", "unchanged")])
    kind = F.when(F.lit(not had_previous) | (F.col("created") > 0) | (F.col("removed") > 0), "materialized").otherwise("observed")
    return counts.withColumn("change_kind", kind)


# The order in which a publication's events follow each other: fixed by the feed's contract.
EVENT_ORDER = {"removed": 1, "created": 2, "changed": 3}


def numbered(rows: DataFrame, order: Sequence[str], name: str, after: int = 0) -> DataFrame:
    """Number all rows in order, following ``after`` without gaps: within ranges, each from where the one before it ends."""
    ranges = cut(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_range", "_before")
    number = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return ranges.join(before, "_range").withColumn(name, F.lit(after) + F.col("_before") + number).drop("_range", "_before")


def outbox_events(pairs: DataFrame, run: str, after: int = 0) -> DataFrame:
    """Change events in feed order, ``seq`` following ``after`` without gaps, the publication itself last.

    The sequence is total by contract; it is counted range by range.
    """
    rank = F.coalesce(*[F.when(F.col("change") == name, F.lit(n)) for name, n in EVENT_ORDER.items()])
    changed = pairs.where(F.col("change").isin(*EVENT_ORDER)).select(
        rank.alias("rank"), F.concat(F.lit("unit."), F.when(F.col("change") == "changed", "projection_changed").otherwise(F.col("change"))).alias("event"), F.coalesce("new_id", "old_id").alias("unit_id")
    )
    published = pairs.sparkSession.range(1).select(F.lit(9).alias("rank"), F.lit("run.published").alias("event"), F.lit(None).cast(changed.schema["unit_id"].dataType).alias("unit_id"))
    return numbered(changed.unionByName(published), ["rank", "unit_id"], "seq", after).select("seq", F.lit(run).alias("run_id"), "event", "unit_id")


def without(rows: DataFrame, others: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """Anti-join; unlike NOT IN it can hash or sort both sides and nulls need no special plan."""
    return rows.join(others, list(on) if not isinstance(on, Column) else on, "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows replace current ones of equal key, others are added: what is then written over the table."""
    return without(current, incoming, key).unionByName(incoming)


def replace_keys(current: DataFrame, incoming: DataFrame, owner: str, owners: DataFrame) -> DataFrame:
    """All current rows of the given owners go, the incoming come, even where an owner has none now."""
    return without(current, owners, [owner]).unionByName(incoming)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both sides that the other lacks, counted with duplicates; ``side`` says which."""
    return left.exceptAll(right).withColumn("side", F.lit("removed")).unionByName(right.exceptAll(left).withColumn("side", F.lit("created")))
