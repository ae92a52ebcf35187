"""What happens to runs before and after publication: validation, rebuilding, and windows of the next synchronisation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import intake

HASHES = ("content_hash", "query_projection_hash", "structure_hash")


def run_violations(runs: DataFrame, units: DataFrame) -> DataFrame:
    """(processing_run_id, reason) of everything that forbids publishing a run; a run without violations has no row.

    A run's units need distinct asset ids, the run's document, and order_index 1 to n; their stored hashes and the run's two
    aggregates must be those that are computed anew. Hash checks follow only where the set of units is in order, as an aggregate over a wrong
    set says nothing. A run without units has the aggregates of nothing. Units are counted and hashed where they lie; a run is brought together for its aggregates only.
    """
    run = runs.select("processing_run_id", F.col("document_id").alias("_document"), F.col("content_hash_aggregate").alias("_content"), F.col("structure_hash").alias("_structure"))
    owned = units.join(run.select("processing_run_id", "_document"), "processing_run_id")
    sets = owned.groupBy("processing_run_id").agg(
        (F.countDistinct("asset_id") < F.count("*")).alias("duplicate_asset_id"),
        F.bool_or(~F.col("document_id").eqNullSafe(F.col("_document"))).alias("document_mismatch"),
        ((F.min("order_index") != 1) | (F.max("order_index") != F.count("*")) | (F.countDistinct("order_index") != F.count("*"))).alias("order_index_not_contiguous"),
    )
    named = lambda names: F.explode(F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in names])))
    wrong_sets = sets.select("processing_run_id", named(["duplicate_asset_id", "document_mismatch", "order_index_not_contiguous"]).alias("reason"))
    fields = [c for c in units.columns if c not in HASHES]
    orderly = run.join(wrong_sets.select("processing_run_id").distinct(), "processing_run_id", "left_anti")
    stored = units.join(orderly.select("processing_run_id"), "processing_run_id", "left_semi").select(*fields, *[F.col(h).alias(f"_{h}") for h in HASHES])
    hashed = intake.unit_hashes(stored)
    differs = hashed.withColumns({"canonical_json_invalid": F.col("hash_error").isNotNull(), **{f"{h}_mismatch": F.col("hash_error").isNull() & ~F.col(h).eqNullSafe(F.col(f"_{h}")) for h in HASHES}})
    wrong_units = differs.select("processing_run_id", named(["canonical_json_invalid", *[f"{h}_mismatch" for h in HASHES]]).alias("reason")).distinct()
    content = intake.sorted_hash(hashed, ["processing_run_id"], "content_hash", "_now_content")
    structure = intake.ordered_hash(hashed, ["processing_run_id"], ["order_index"], "structure_hash", "_now_structure")
    both = orderly.join(content, "processing_run_id", "left").join(structure, "processing_run_id", "left")
    nothing = F.concat(F.lit("sha256:"), F.sha2(F.lit(""), 256))
    differs_from = lambda stored_one, now: ~F.col(stored_one).eqNullSafe(F.coalesce(F.col(now), nothing))
    both = both.withColumns({"content_hash_aggregate_mismatch": differs_from("_content", "_now_content"), "run_structure_hash_mismatch": differs_from("_structure", "_now_structure")})
    wrong_runs = both.select("processing_run_id", named(["content_hash_aggregate_mismatch", "run_structure_hash_mismatch"]).alias("reason"))
    return wrong_sets.union(wrong_units).union(wrong_runs)


def rebuilt_runs(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """A ``rebuild_units`` run for each wanted document_id, from the artifacts of its newest succeeded run; or the reason why there is none.

    The run that owns the artifacts is taken over as owner, together with its parser and hashes; it must be of the same document.
    """
    newest = runs.where("status = 'succeeded'").groupBy("document_id").agg(F.max_by("artifact_owner_processing_run_id", F.struct("finished_at", "processing_run_id")).alias("_owner"))
    owner = runs.select(F.col("processing_run_id").alias("_owner"), F.col("document_id").alias("_owner_document"), "parser_name", "artifact_hash")
    found = wanted.select("document_id").distinct().join(newest, "document_id", "left").join(owner, "_owner", "left")
    error = F.when(F.col("_owner").isNull(), "NO_SUCCEEDED_PARSE_RUN").when(~F.col("_owner_document").eqNullSafe(F.col("document_id")), "ARTIFACT_OWNER_INVALID")
    valid = lambda column: F.when(error.isNull(), column)
    return found.select("document_id", valid(F.col("_owner")).alias("artifact_owner_processing_run_id"), valid(F.lit("rebuild_units")).alias("run_kind"), valid(F.col("parser_name")).alias("parser_name"), valid(F.col("artifact_hash")).alias("artifact_hash"), error.alias("error"))


def sync_start(checkpoint_end: Column, lookback_days: Column, today: Column, overlap_days: int, initial_days: int = 1095) -> Column:
    """First day of a company's next window: its checkpoint less the overlap, else its own lookback (not negative), else the initial one."""
    days = F.when(lookback_days >= 0, lookback_days).otherwise(F.lit(initial_days))
    return F.coalesce(F.date_sub(checkpoint_end, F.lit(overlap_days)), F.date_sub(today, days))


def explicit_window(today: date, days: int | None = None, start: date | None = None, end: date | None = None) -> tuple[date, date] | None:
    """A window that a caller asks for: a range that has both ends and none in the future, or the days before today; None if nothing is asked."""
    if start is None and end is None:
        if days is None:
            return None
        if days < 0:
            raise ValueError("a window has no negative length")
        return date.fromordinal(today.toordinal() - days), today
    if days is not None or start is None or end is None or not start <= end <= today:
        raise ValueError("a range needs both ends, in order, not in the future, and no number of days beside it")
    return start, end


def queue_page(queue: DataFrame, after: object | None = None, ids: list | None = None, key: str = "document_id") -> DataFrame:
    """Queue rows behind a key or of given ids, not both; no ids are no rows."""
    if after is not None and ids is not None:
        raise ValueError("give either a key to go on from or ids")
    if ids is not None:
        return queue.where(F.col(key).isin(*ids)) if ids else queue.where(F.lit(False))
    return queue if after is None else queue.where(F.col(key) > F.lit(after))


def stale_stamped(rows: DataFrame, key: str, stamp: str, now: str, batches: int) -> DataFrame:
    """Keys whose stamp is missing or another, with the stamp to write and one of so many batches, which may be written apart and again."""
    return rows.where(~F.col(stamp).eqNullSafe(F.lit(now))).select(key, F.lit(now).alias(stamp), F.pmod(F.crc32(F.col(key).cast("string")), F.lit(batches)).cast("int").alias("batch"))
