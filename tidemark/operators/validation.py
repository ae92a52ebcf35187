"""Constraints as queries: each yields the rows that violate it, none when all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.filters import KEY_FORM
from tidemark.operators.intake import legal_kinds


def failing(rows: DataFrame, valid: Column) -> DataFrame:
    """Rows for which a condition is false or unknown."""
    return rows.where(~F.coalesce(valid, F.lit(False)))


def unknown_values(rows: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return failing(rows, F.col(column).isin(*allowed))


def neither(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.where(F.col(a).isNull() & F.col(b).isNull())


def not_exactly_one(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return rows.where(present != 1)


def illegal_kinds(rows: DataFrame) -> DataFrame:
    return failing(rows, legal_kinds(F.col("asset_kind"), F.col("payload_kind")))


def bad_key_sets(rows: DataFrame, scalar: str, array: str) -> DataFrame:
    """Scalar and array are null together, the first element is the scalar, and every key has the form of one."""
    both_null = F.col(scalar).isNull() & F.col(array).isNull()
    fits = (F.get(array, F.lit(0)) == F.col(scalar)) & F.forall(array, lambda k: k.rlike(KEY_FORM)) & (F.size(F.array_distinct(array)) == F.size(array))
    return failing(rows, both_null | F.coalesce(fits, F.lit(False)))


def duplicates(rows: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once (among the rows of a condition), with their number."""
    chosen = rows if where is None else rows.where(where)
    return chosen.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def order_gaps(rows: DataFrame, owner: str, order: str) -> DataFrame:
    """Owners whose order numbers are not 1 to n without gaps or repeats."""
    found = rows.groupBy(owner).agg(F.count("*").alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi"), F.countDistinct(order).alias("distinct"))
    return found.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("distinct") != F.col("n"))).select(owner)


def missing_references(rows: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    known = others.select(F.col(other_key).alias(key))
    return rows.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def bad_retry_errors(rows: DataFrame, error: str) -> DataFrame:
    """Failed rows whose error is not JSON with a text stage and a boolean retryable."""
    parsed = F.try_parse_json(error)
    stage, retryable = F.try_variant_get(parsed, "$.stage", "string"), F.try_variant_get(parsed, "$.retryable", "boolean")
    return failing(rows, stage.isNotNull() & retryable.isNotNull())


def bad_section_keys(rows: DataFrame, array: str) -> DataFrame:
    """Section keys may be absent, but not an empty list, nor have a blank or repeated key."""
    fits = (F.size(array) > 0) & F.forall(array, lambda k: F.coalesce(F.trim(k) != "", F.lit(False))) & (F.size(F.array_distinct(array)) == F.size(array))
    return failing(rows, F.col(array).isNull() | F.coalesce(fits, F.lit(False)))


def partition_violations(members: DataFrame, owned: DataFrame, group: str, member: str) -> DataFrame:
    """(group, member, reason) where owners do not partition a group's members in order.

    ``members`` has group, member and place; ``owned`` has group, owner, place and member. Each member needs one owner (missing, repeated),
    each owned item must be a member (unknown), and read by owner and place, members must come in their own order (out_of_order).
    """
    known = members.select(group, member, F.col("place").alias("_place"))
    missing = known.join(owned.select(group, member), [group, member], "left_anti").select(group, member, F.lit("missing").alias("reason"))
    placed = owned.select(group, member, "owner", "place").join(known, [group, member], "left")
    before = F.max("_place").over(W.partitionBy(group).orderBy("owner", "place", "_place").rowsBetween(W.unboundedPreceding, -1))
    counted = placed.withColumns({"_n": F.count("*").over(W.partitionBy(group, member)), "_before": before})
    reason = F.when(F.col("_place").isNull(), "unknown").when(F.col("_n") > 1, "repeated").when(F.col("_place") < F.col("_before"), "out_of_order")
    return counted.select(group, member, reason.alias("reason")).where("reason is not null").distinct().union(missing)
