"""Content-addressed registration: identities, tri-state outcomes, supersede chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import python_side as py
from tidemark.session import python_rows


def canonical_row(columns: Sequence[str]) -> Column:
    """A row as canonical JSON: keys sorted, nulls kept."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def recordset_hash(rows: DataFrame, groups: Sequence[str], keys: Sequence[str], columns: Sequence[str], name: str = "content_hash") -> DataFrame:
    """sha256 over a record set per group: rows sorted by their keys as text, so 10 comes before 9, then joined as a JSON list.

    A record set is registered as one asset, so a group is as large as what one registration carries.
    """
    entry = F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)], canonical_row(columns).alias("row"))
    ordered = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["row"])
    return rows.groupBy(*groups).agg(F.sha2(F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")), 256).alias(name))


def sorted_hash(rows: DataFrame, groups: Sequence[str], digest: str, name: str, prefix: str = "sha256:") -> DataFrame:
    """sha256 over the sorted digests of a group, duplicates kept: the same for any order."""
    return rows.groupBy(*groups).agg(F.concat(F.lit(prefix), F.sha2(F.array_join(F.sort_array(F.collect_list(digest)), "\n"), 256)).alias(name))


def ordered_hash(rows: DataFrame, groups: Sequence[str], order: Sequence[str], digest: str, name: str, prefix: str = "sha256:") -> DataFrame:
    """sha256 over the digests of a group in order: changes with the order."""
    entries = F.sort_array(F.collect_list(F.struct(*order, F.col(digest).alias("_digest"))))
    return rows.groupBy(*groups).agg(F.concat(F.lit(prefix), F.sha2(F.array_join(F.transform(entries, lambda e: e["_digest"]), "\n"), 256)).alias(name))


def unit_hashes(units: DataFrame) -> DataFrame:
    """Adds content_hash, query_projection_hash and structure_hash: what a unit says, what a query sees of it, and where it stands.

    ``units`` has payload_kind, payload (a JSON object), title, heading_path, quality_status, order_index, and semantic_key,
    semantic_keys, section_keys and applicability where there are any. ``hash_error`` says why a unit has no hashes.
    """
    known = [c for c in ("payload_kind", "title", "heading_path", "semantic_key", "semantic_keys", "section_keys", "quality_status", "applicability", "order_index") if c in units.columns]
    found = python_rows(units).withColumn("_identity", py.unit_identities(F.to_json(F.struct(*known), {"ignoreNullFields": "false"}), F.col("payload")))
    return found.select("*", "_identity.content_hash", "_identity.query_projection_hash", "_identity.structure_hash", F.col("_identity.error").alias("hash_error")).drop("_identity")


def register_snapshots(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Outcome of each observation (observed_at, semantic_key, content_hash, n_records, error) against existing assets.

    In the order of observed_at within a semantic key: "error" and "empty" leave no asset; content that any earlier asset of the
    key has, active or not, is "observed"; anything else is "materialized" and becomes the key's active asset. So a return to
    former content is observed on the inactive asset and does not become active again. Adds dedup_key and is_active.
    """
    dedup = F.sha2(F.concat_ws("||", "semantic_key", "content_hash"), 256)
    known = existing.select("dedup_key").distinct().withColumn("known", F.lit(True))
    rows = incoming.withColumn("dedup_key", dedup).join(known, "dedup_key", "left")
    has_content = F.col("error").isNull() & (F.coalesce("n_records", F.lit(0)) > 0)
    nth = F.sum(F.when(has_content, 1).otherwise(0)).over(W.partitionBy("dedup_key").orderBy("observed_at").rowsBetween(W.unboundedPreceding, 0))
    outcome = (
        F.when(F.col("error").isNotNull(), "error").when(~has_content, "empty").when(F.coalesce("known", F.lit(False)) | (F.col("_nth") > 1), "observed").otherwise("materialized")
    )
    judged = rows.withColumn("_nth", nth).withColumn("outcome", outcome)
    later = F.max(F.when(F.col("outcome") == "materialized", F.col("observed_at"))).over(W.partitionBy("semantic_key"))
    active = (F.col("outcome") == "materialized") & (F.col("observed_at") == later)
    return judged.withColumn("is_active", active).drop("known", "_nth")


def superseded(registrations: DataFrame, key: Sequence[str], order: Sequence[str], ident: str) -> DataFrame:
    """Each registration with the one that it supersedes: the row before it, by distinct content."""
    return registrations.withColumn("supersedes", F.lag(ident).over(W.partitionBy(*key).orderBy(*order)))


def monotone_checkpoint(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Cursor per scope_key: never moved back."""
    return current.unionByName(seen).groupBy("scope_key").agg(F.max("cursor").alias("cursor"))


def resolve_subjects(rows: DataFrame, by_security: DataFrame, by_credit: DataFrame) -> DataFrame:
    """company_id by security, else by credit code; ``contested`` where both are known and disagree."""
    first = by_security.select("security", F.col("company_id").alias("_by_security"))
    second = by_credit.select("credit_code", F.col("company_id").alias("_by_credit"))
    joined = rows.join(first, "security", "left").join(second, "credit_code", "left")
    contested = F.coalesce(F.col("_by_security") != F.col("_by_credit"), F.lit(False))
    return joined.withColumn("contested", contested).withColumn("company_id", F.when(~contested, F.coalesce("_by_security", "_by_credit"))).drop("_by_security", "_by_credit")


def reconcile(desired: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """What to do for each key: create, update, pause, or keep."""
    a, b = desired.select(key, F.col(value).alias("_wanted"), F.lit(True).alias("_in")), current.select(key, F.col(value).alias("_there"), F.lit(True).alias("_had"))
    action = F.when(F.col("_had").isNull(), "create").when(F.col("_in").isNull(), "pause").when(~F.col("_wanted").eqNullSafe(F.col("_there")), "update").otherwise("keep")
    return a.join(b, key, "full").select(key, action.alias("action"))


def guard_mismatches(stored: DataFrame, replayed: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fields in which stored rows differ from a fresh replay, null-safe; rows that only one side has differ in all."""
    a, b = stored.alias("a"), replayed.alias("b")
    fields = F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns]))
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), F.explode(fields).alias("field"))


# Legal payload kinds by asset kind: fixed by the shared contract.
KIND_MATRIX: Mapping[str, Sequence[str]] = {
    "document_unit": ("text", "table", "qa"),
    "dataset_snapshot": ("recordset",),
    "tool_result": ("search_result", "api_response", "page_snippet"),
    "artifact_unit": ("calculation_table", "model_table", "checklist", "note"),
}


def legal_kinds(asset_kind: Column, payload_kind: Column) -> Column:
    legal = F.lit(False)
    for kind, payloads in KIND_MATRIX.items():
        legal = legal | ((asset_kind == kind) & payload_kind.isin(*payloads))
    return F.coalesce(legal, F.lit(False))
