"""Work queues derived from append-only logs: what is pending, eligible, due, dead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.filters import blank_to_null, is_due, retry_allowed
from tidemark.operators.latest import latest_per_group


def newest_candidates(accesses: DataFrame) -> DataFrame:
    """One row per candidate_id of an access log: rows with codes first, then the newest, then the greatest access_id."""
    coded = blank_to_null(F.col("codes")).isNotNull()
    return latest_per_group(accesses, ["candidate_id"], [coded.desc(), F.desc("accessed_at"), F.desc("access_id")])


def pending_downloads(accesses: DataFrame, registered: DataFrame, failures: DataFrame) -> DataFrame:
    """Candidates that are not registered, or whose size has changed, without a terminal failure; with their failures' number.

    Sizes are compared as text, null being a value. A terminal failure keeps a candidate out for good.
    """
    known = registered.select("candidate_id", F.col("size").alias("known_size"), F.lit(True).alias("known"))
    summary = failures.groupBy("candidate_id").agg(F.count("*").alias("failures"), F.bool_or("terminal").alias("terminal"))
    rows = newest_candidates(accesses).join(known, "candidate_id", "left").join(summary, "candidate_id", "left")
    drifted = ~F.col("size").eqNullSafe(F.col("known_size"))
    open_rows = rows.where((F.col("known").isNull() | drifted) & ~F.coalesce("terminal", F.lit(False)))
    return open_rows.select("candidate_id", "accessed_at", "codes", "size", F.coalesce("failures", F.lit(0)).alias("failures"))


def eligible_downloads(pending: DataFrame, budget: int, in_scope: Column | None = None) -> DataFrame:
    """Pending candidates under the failure budget and inside the scope, oldest first."""
    rows = pending.where(F.col("failures") < budget)
    return (rows.where(in_scope) if in_scope is not None else rows).orderBy("accessed_at", "candidate_id")


def scope(candidates: DataFrame, wanted: DataFrame, carriers: DataFrame, noise: DataFrame, key: str) -> DataFrame:
    """Wanted, not carried outside the scope, and no hard noise: a semi-join and two anti-joins."""
    return candidates.join(wanted, key, "left_semi").join(carriers, key, "left_anti").join(noise, key, "left_anti")


def pending_parses(documents: DataFrame, runs: DataFrame, budget: int) -> DataFrame:
    """Documents to parse: registered or failed, no run under way, and a retry budget left.

    ``runs`` has document_id, run_id, status, started_at, charged, retryable. The latest failure decides whether a retry is
    allowed; a run without a start counts as latest.
    """
    failed = runs.where("status = 'failed'")
    summary = failed.groupBy("document_id").agg(
        F.count("*").alias("failures"),
        F.count_if("charged").alias("charged_failures"),
        F.max_by("retryable", F.struct(F.col("started_at").isNull(), "started_at", "run_id")).alias("last_retryable"),
    )
    running = runs.where("status = 'running'").select("document_id")
    rows = documents.where(F.col("status").isin("registered", "parse_failed")).join(running, "document_id", "left_anti").join(summary, "document_id", "left")
    allowed = retry_allowed(F.coalesce("last_retryable", F.lit(True)), F.col("failures"), F.col("charged_failures"), budget)
    return rows.where(allowed).select("document_id", F.coalesce("failures", F.lit(0)).alias("failures"), "last_retryable")


def pending_builds(runs: DataFrame, built: DataFrame) -> DataFrame:
    return runs.where("status = 'succeeded'").join(built, "run_id", "left_anti").select("run_id", "document_id")


def pending_publications(built_runs: DataFrame, active: DataFrame, units: DataFrame) -> DataFrame:
    """The latest built run per document that is newer than the active one and has units."""
    current = active.select("document_id", F.col("finished_at").alias("active_at"))
    newer = built_runs.join(current, "document_id", "left").where(F.col("active_at").isNull() | (F.col("finished_at") > F.col("active_at")))
    filled = newer.join(units.select("run_id"), "run_id", "left_semi")
    return latest_per_group(filled, ["document_id"], [F.desc("finished_at"), F.desc("run_id")]).select("document_id", "run_id")


def due_syncs(companies: DataFrame, checkpoints: DataFrame, failures: DataFrame, now: Column, cooldown: Column) -> DataFrame:
    """Active companies never synced or past their own interval, unless one failed just now; never failed and never synced first."""
    last_failed = failures.groupBy("company_id").agg(F.max("failed_at").alias("failed_at"))
    rows = companies.where("active").join(checkpoints, "company_id", "left").join(last_failed, "company_id", "left")
    rested = F.col("failed_at").isNull() | (F.col("failed_at") < now - cooldown)
    due = rows.where(is_due(F.col("synced_at"), F.col("interval"), now) & rested)
    return due.orderBy(F.asc_nulls_first("failed_at"), F.asc_nulls_first("synced_at"), "company_id")


def gauges(failures: DataFrame, key: str, budget: int) -> DataFrame:
    """One row: items that retry and dead letters, which have used up the budget or failed for good."""
    per_item = failures.groupBy(key).agg(F.count("*").alias("n"), F.bool_or("terminal").alias("terminal"))
    dead = (F.col("n") >= budget) | F.col("terminal")
    return per_item.agg(F.count_if(~dead).alias("retrying"), F.count_if(dead).alias("dead_letters"))


def reclaim_stale(runs: DataFrame, now: Column, limit: Column) -> DataFrame:
    """Runs under way for longer than ``limit`` become failed, with a structured error."""
    stale = (F.col("status") == "running") & (F.col("started_at") < now - limit)
    error = F.to_json(F.struct(F.lit("worker").alias("stage"), F.lit("stale run").alias("reason"), F.lit(True).alias("retryable")))
    return runs.withColumn("error", F.when(stale, error).otherwise(F.col("error"))).withColumn("status", F.when(stale, "failed").otherwise(F.col("status")))


def parse_lane(size_mb: Column, pages: Column, size_limit: int = 80, page_limit: int = 500) -> Column:
    return F.when((size_mb > size_limit) | (pages > page_limit), "large").otherwise("small")
