"""Public projections: private tables as the columns, names and constants that readers may rely on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the public contracts.
SERVICE = "disclosure_anchor"
DOCUMENT_CONTRACT, UNIT_CONTRACTS, SOURCE_CONTRACT, EVENT_CONTRACT = "document.v1", ("document_unit.v1", "document_unit.v2"), "source_ref.v1", "change_event.v1"
SECOND_TIER_TYPES = ("investor_relations", "performance_briefing")
DOCUMENT_OWN = ("document_id", "provider", "provider_document_id", "title", "announcement_date", "report_period", "raw_file_hash", "status", "current_processing_run_id", "created_at", "updated_at", "supersedes_document_id", "correction_of_document_id", "provider_metadata")
RUN_OWN = (
    "processing_run_id", "document_id", "artifact_owner_processing_run_id", "run_kind", "status", "parser_name", "parser_version", "artifact_hash", "content_hash_aggregate", "structure_hash", "is_active",
    "started_at", "finished_at", "created_at", "parser_backend", "input_raw_file_hash", "parser_method", "parser_language", "unit_build_status", "unit_build_attempt_count", "unit_built_at", "builder_rules_version",
)
UNIT_OWN = (
    "asset_id", "document_id", "processing_run_id", "provider_document_id", "payload_kind", "heading_path", "title", "order_index", "semantic_key", "semantic_keys", "section_keys", "payload",
    "content_hash", "structure_hash", "quality_status", "applicability", "page_no", "artifact_locator", "created_at", "query_projection_hash",
)
SOURCE_OWN = ("asset_id", "document_id", "processing_run_id", "payload_kind", "heading_path", "title", "quality_status", "applicability", "page_no", "artifact_locator")
EVENT_OWN = ("seq", "event_id", "event_kind", "document_id", "processing_run_id", "asset_id", "payload", "occurred_at", "change_kind", "subject_kind", "subject_ref", "created_at")


def of(side: str, names: Sequence[str]) -> list[Column]:
    return [F.col(f"{side}.{name}") for name in names]


def filing_type() -> Column:
    return F.coalesce(F.col("d.class_filing_type"), F.lit("other"))


ASSET_OWN = (
    "asset_id", "asset_kind", "payload_kind", "contract_version", "content_hash", "subject_candidates", "title", "semantic_key", "material_type", "event_time", "published_at", "report_period", "observed_at",
    "provider", "adapter", "tool", "source_tier", "trace_level", "locator", "raw_asset_ref", "sensitivity", "payload", "quality_status", "is_active", "superseded_by",
)


def assets_view(assets: DataFrame) -> DataFrame:
    """Registered assets with their address; columns that are not named here stay private."""
    uri = F.concat(F.lit("asset://asset_intake/v1/"), "a.asset_kind", F.lit("/"), F.col("a.asset_id").cast("string"))
    return assets.alias("a").select(*of("a", ASSET_OWN), uri.alias("asset_uri"), F.col("a.source_access_id").alias("source_ref"), F.col("a.processing_run_id").alias("producer_action_ref"))


def documents_view(documents: DataFrame, securities: DataFrame) -> DataFrame:
    """Documents with their security and the newest document that supersedes each; one row a document, security or not."""
    later = documents.where("supersedes_document_id is not null").groupBy(F.col("supersedes_document_id").alias("_old"))
    newest = later.agg(F.max(F.struct("created_at", "document_id")).alias("_by")).select("_old", F.col("_by.document_id").alias("superseded_by_document_id"))
    joined = documents.alias("d").join(securities.alias("s"), F.col("s.security_id") == F.col("d.security_id"), "left").join(newest, F.col("_old") == F.col("d.document_id"), "left")
    return joined.select(
        *of("d", DOCUMENT_OWN),
        *of("s", ("security_code", "exchange")),
        filing_type().alias("filing_type"),
        F.col("d.class_disclosure_topics").alias("disclosure_topics"),
        F.lit(DOCUMENT_CONTRACT).alias("contract_version"),
        F.col("d.company_id").alias("company_ref"),
        F.col("d.security_id").alias("security_ref"),
        F.col("d.source_access_id").alias("source_ref"),
        "superseded_by_document_id",
        F.col("d.class_publisher_categories").alias("publisher_categories"),
        F.col("d.class_market").alias("market"),
        F.col("d.class_content_categories").alias("content_categories"),
    )


def body_status(kind: Column, payload: Column, title: Column) -> Column:
    """heading_only, empty or content; only a text unit whose text is empty has no content."""
    empty = (kind == "text") & (payload == '{"text":""}')
    return F.when(empty & title.isNotNull(), "heading_only").when(empty, "empty").otherwise("content")


def units_view(units: DataFrame, documents: DataFrame, securities: DataFrame, runs: DataFrame, version: int = 2) -> DataFrame:
    """Units with their document, security and run; ``payload`` is canonical JSON. Version 2 adds body_status and content_categories."""
    joined = (
        units.alias("u")
        .join(documents.alias("d"), F.col("d.document_id") == F.col("u.document_id"))
        .join(securities.alias("s"), F.col("s.security_id") == F.col("d.security_id"), "left")
        .join(runs.alias("r"), F.col("r.processing_run_id") == F.col("u.processing_run_id"))
    )
    second = filing_type().isin(*SECOND_TIER_TYPES)
    added = [F.col("d.class_content_categories").alias("content_categories"), body_status(F.col("u.payload_kind"), F.col("u.payload"), F.col("u.title")).alias("body_status")]
    path = F.when(F.size("u.heading_path") > 0, F.array_join("u.heading_path", " > "))
    return joined.select(
        *of("u", UNIT_OWN),
        F.coalesce("r.is_active", F.lit(False)).alias("is_active_run"),
        path.alias("heading_path_text"),
        F.lit(UNIT_CONTRACTS[version - 1]).alias("contract_version"),
        F.col("d.company_id").alias("company_ref"),
        F.col("d.security_id").alias("security_ref"),
        *of("s", ("security_code", "exchange")),
        filing_type().alias("filing_type"),
        F.col("d.class_disclosure_topics").alias("disclosure_topics"),
        *of("d", ("report_period", "announcement_date", "raw_file_hash")),
        F.col("u.processing_run_id").alias("producer_action_ref"),
        F.col("d.source_access_id").alias("source_ref"),
        F.col("u.document_id").alias("parent_ref"),
        F.lit("document_unit").alias("asset_kind"),
        F.col("u.created_at").alias("observed_at"),
        F.when(second, "tier_0b").otherwise("tier_0a").alias("source_tier"),
        F.lit("G0").alias("trace_level"),
        *(added if version == 2 else []),
    )


def runs_view(runs: DataFrame) -> DataFrame:
    return runs.select(*RUN_OWN)


def source_refs_view(units: DataFrame, documents: DataFrame, runs: DataFrame) -> DataFrame:
    """Where each unit comes from; a unit whose run is not known is of no active run."""
    joined = units.alias("u").join(documents.alias("d"), F.col("d.document_id") == F.col("u.document_id")).join(runs.alias("r"), F.col("r.processing_run_id") == F.col("u.processing_run_id"), "left")
    return joined.select(
        F.lit(SERVICE).alias("service"), F.lit(SOURCE_CONTRACT).alias("contract_version"), *of("u", SOURCE_OWN), *of("d", ("source_access_id", "provider", "provider_document_id", "raw_file_hash")),
        F.coalesce("r.is_active", F.lit(False)).alias("is_active_run"), F.col("u.content_hash").alias("unit_content_hash"),
    )


def events_view(outbox: DataFrame) -> DataFrame:
    return outbox.select(*EVENT_OWN, F.lit(SERVICE).alias("source"), F.lit(EVENT_CONTRACT).alias("contract_version"))


def children_view(children: DataFrame, projections: DataFrame, key: str = "asset_id", inherited: Sequence[str] = ("projection_version", "built_at")) -> DataFrame:
    """Windows or atoms of a search projection with the version and time of the projection that they belong to."""
    return children.join(projections.select(key, *inherited), key)


def with_category_names(coded: DataFrame, categories: DataFrame) -> DataFrame:
    """Codes with the names that their provider's dimension gives them; unknown codes stay, without a name."""
    names = categories.select(F.col("provider").alias("_provider"), F.col("code").alias("_code"), F.col("name").alias("category_name"))
    return coded.join(names, (F.col("provider") == F.col("_provider")) & (F.col("code") == F.col("_code")), "left").drop("_provider", "_code")
