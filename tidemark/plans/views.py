"""Queries over public views, publication checks and worker pages. Orders stand for documents and runs, line items for units, customers for securities."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import python_side as py
from tidemark.operators import filters, intake, publication, queues, validation, views
from tidemark.plans.catalog import query, table
from tidemark.sources import readers

# The private tables, said once in SQL for both engines' oracles.
PRIVATE = """
WITH d AS (SELECT o_orderkey AS document_id, 'prov' AS provider, 'N' || o_orderkey AS provider_document_id, o_orderpriority AS title, o_orderdate AS announcement_date, NULL::VARCHAR AS report_period,
    md5(o_orderkey::VARCHAR) AS raw_file_hash, o_orderstatus AS status, o_orderkey AS current_processing_run_id, o_orderdate AS created_at, o_orderdate AS updated_at,
    CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey // 50 * 50 + 1 END AS supersedes_document_id, NULL::BIGINT AS correction_of_document_id, NULL::VARCHAR AS provider_metadata,
    o_custkey AS security_id, 'C' || o_custkey AS company_id, o_orderkey + 7 AS source_access_id, nullif(CASE o_orderpriority WHEN '1-URGENT' THEN 'investor_relations' ELSE o_orderpriority END, '5-LOW') AS class_filing_type,
    nullif(o_orderstatus, 'P') AS class_disclosure_topics, NULL::VARCHAR AS class_publisher_categories, 'm' AS class_market, o_orderstatus AS class_content_categories FROM orders),
s AS (SELECT c_custkey AS security_id, c_name AS security_code, c_mktsegment AS exchange FROM customer WHERE c_acctbal > 1000),
u AS (SELECT l_orderkey * 100 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS asset_id, l_orderkey AS document_id, l_orderkey AS processing_run_id, 'N' || l_orderkey AS provider_document_id,
    CASE WHEN l_returnflag = 'R' THEN 'table' ELSE 'text' END AS payload_kind, l_returnflag AS a, l_linestatus AS b, nullif(l_returnflag, 'N') AS title, l_linenumber AS order_index,
    CASE WHEN l_linestatus = 'O' THEN '{"text":""}' ELSE '{"text":"x"}' END AS payload FROM lineitem),
r AS (SELECT o_orderkey AS processing_run_id, CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS is_active FROM orders WHERE o_orderkey % 11 <> 0)
"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey document_id", "'prov' provider", "concat('N', o_orderkey) provider_document_id", "o_orderpriority title", "o_orderdate announcement_date", "cast(null as string) report_period",
        "md5(cast(cast(o_orderkey as string) as binary)) raw_file_hash", "o_orderstatus status", "o_orderkey current_processing_run_id", "o_orderdate created_at", "o_orderdate updated_at",
        "case when o_orderkey % 5 = 0 then o_orderkey div 50 * 50 + 1 end supersedes_document_id", "cast(null as bigint) correction_of_document_id", "cast(null as string) provider_metadata",
        "o_custkey security_id", "concat('C', o_custkey) company_id", "o_orderkey + 7 source_access_id", "nullif(case o_orderpriority when '1-URGENT' then 'investor_relations' else o_orderpriority end, '5-LOW') class_filing_type",
        "nullif(o_orderstatus, 'P') class_disclosure_topics", "cast(null as string) class_publisher_categories", "'m' class_market", "o_orderstatus class_content_categories",
    )


def _securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal > 1000").selectExpr("c_custkey security_id", "c_name security_code", "c_mktsegment exchange")


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = "l_orderkey * 100 + row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) asset_id"
    return table(spark, sf_dir, "lineitem").selectExpr(
        numbered, "l_orderkey document_id", "l_orderkey processing_run_id", "concat('N', l_orderkey) provider_document_id", "case when l_returnflag = 'R' then 'table' else 'text' end payload_kind",
        "array(l_returnflag, l_linestatus) heading_path", "nullif(l_returnflag, 'N') title", "l_linenumber order_index", "'k' semantic_key", "array('k') semantic_keys", "cast(null as array<string>) section_keys",
        """case when l_linestatus = 'O' then '{"text":""}' else '{"text":"x"}' end payload""", "cast(null as string) content_hash", "cast(null as string) structure_hash", "'ok' quality_status", "cast(null as string) applicability",
        "1 page_no", "cast(null as string) artifact_locator", "l_shipdate created_at", "cast(null as string) query_projection_hash",
    )


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0").selectExpr("o_orderkey processing_run_id", "case o_orderstatus when 'O' then true when 'F' then false end is_active")


@query(
    "p01_documents_view",
    PRIVATE + """SELECT d.document_id, provider, provider_document_id, title, announcement_date, report_period, raw_file_hash, status, current_processing_run_id, created_at, updated_at, d.supersedes_document_id,
    correction_of_document_id, provider_metadata, s.security_code, s.exchange, coalesce(class_filing_type, 'other') AS filing_type, class_disclosure_topics AS disclosure_topics, 'document.v1' AS contract_version, company_id AS company_ref,
    d.security_id AS security_ref, source_access_id AS source_ref, n.document_id AS superseded_by_document_id, class_publisher_categories AS publisher_categories, class_market AS market, class_content_categories AS content_categories
    FROM d LEFT JOIN s ON s.security_id = d.security_id LEFT JOIN (SELECT supersedes_document_id, document_id FROM d WHERE supersedes_document_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY supersedes_document_id ORDER BY created_at DESC, document_id DESC) = 1) n ON n.supersedes_document_id = d.document_id""",
)
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents_view(_documents(spark, sf_dir), _securities(spark, sf_dir))


@query(
    "p02_units_view",
    PRIVATE + """SELECT u.asset_id, u.document_id, payload_kind, a || ' > ' || b AS heading_path_text, u.title, order_index, coalesce(is_active, false) AS is_active_run, s.security_code, coalesce(class_filing_type, 'other') AS filing_type,
    CASE WHEN class_filing_type IN ('investor_relations', 'performance_briefing') THEN 'tier_0b' ELSE 'tier_0a' END AS source_tier, 'document_unit.v2' AS contract_version, u.document_id AS parent_ref, source_access_id AS source_ref,
    CASE WHEN payload_kind = 'text' AND payload = '{"text":""}' THEN CASE WHEN u.title IS NOT NULL THEN 'heading_only' ELSE 'empty' END ELSE 'content' END AS body_status
    FROM u JOIN d ON d.document_id = u.document_id JOIN r ON r.processing_run_id = u.processing_run_id LEFT JOIN s ON s.security_id = d.security_id""",
)
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = views.units_view(_units(spark, sf_dir), _documents(spark, sf_dir), _securities(spark, sf_dir), _runs(spark, sf_dir))
    return seen.select("asset_id", "document_id", "payload_kind", "heading_path_text", "title", "order_index", "is_active_run", "security_code", "filing_type", "source_tier", "contract_version", "parent_ref", "source_ref", "body_status")


@query(
    "p06_source_refs",
    PRIVATE + """SELECT 'disclosure_anchor' AS service, 'source_ref.v1' AS contract_version, u.asset_id, u.document_id, provider, d.provider_document_id, raw_file_hash, source_access_id, u.processing_run_id, coalesce(is_active, false) AS is_active_run, payload_kind, u.title
    FROM u JOIN d ON d.document_id = u.document_id LEFT JOIN r ON r.processing_run_id = u.processing_run_id""",
)
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = views.source_refs_view(_units(spark, sf_dir), _documents(spark, sf_dir), _runs(spark, sf_dir))
    return seen.select("service", "contract_version", "asset_id", "document_id", "provider", "provider_document_id", "raw_file_hash", "source_access_id", "processing_run_id", "is_active_run", "payload_kind", "title")


@query(
    "p07_change_events",
    "SELECT event_id AS seq, event_type AS event_kind, user_id AS document_id, props AS payload, ts AS occurred_at, 'disclosure_anchor' AS source, 'change_event.v1' AS contract_version FROM events",
)
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = [F.lit(None).cast("string").alias(c) for c in ("processing_run_id", "asset_id", "change_kind", "subject_kind", "subject_ref")]
    outbox = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), "event_id", F.col("event_type").alias("event_kind"), F.col("user_id").alias("document_id"), F.col("props").alias("payload"), F.col("ts").alias("occurred_at"), F.col("ts").alias("created_at"), *none
    )
    return views.events_view(outbox).select("seq", "event_kind", "document_id", "payload", "occurred_at", "source", "contract_version")


@query(
    "p05_runs_view",
    "SELECT o_orderkey AS processing_run_id, o_orderkey AS document_id, o_orderkey AS artifact_owner_processing_run_id, o_orderpriority AS run_kind, o_orderstatus AS status, o_orderstatus = 'F' AS is_active, o_orderdate AS finished_at FROM orders",
)
def p05(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = {"processing_run_id": "o_orderkey", "document_id": "o_orderkey", "artifact_owner_processing_run_id": "o_orderkey", "run_kind": "o_orderpriority", "status": "o_orderstatus", "is_active": "o_orderstatus = 'F'", "finished_at": "o_orderdate"}
    runs = table(spark, sf_dir, "orders").select(*[F.expr(known.get(c, "cast(null as string)")).alias(c) for c in views.RUN_OWN], F.lit("private").alias("parser_secret"))
    return views.runs_view(runs).select(*known)


@query(
    "p10_search_children",
    "SELECT l_orderkey AS asset_id, l_linenumber AS window_index, o_orderpriority AS projection_version, o_orderdate AS built_at FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
)
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    projections = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("asset_id"), F.col("o_orderpriority").alias("projection_version"), F.col("o_orderdate").alias("built_at"))
    return views.children_view(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("asset_id"), F.col("l_linenumber").alias("window_index")), projections)


@query(
    "j11_category_names",
    "SELECT c_custkey, 'p' || (c_custkey % 2) AS provider, c_nationkey AS code, n_name AS category_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND c_custkey % 2 = 1 AND n_nationkey < 20",
)
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "customer").selectExpr("c_custkey", "concat('p', c_custkey % 2) provider", "c_nationkey code")
    return views.with_category_names(coded, table(spark, sf_dir, "nation").where("n_nationkey < 20").selectExpr("'p1' provider", "n_nationkey code", "n_name name"))


@query("l02_units_order", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey = 7 OR l_orderkey = 32 ORDER BY l_linenumber, l_orderkey, l_partkey LIMIT 50")
def l02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_orderkey in (7, 32)").orderBy("l_linenumber", "l_orderkey", "l_partkey").limit(50).select("l_orderkey", "l_linenumber", "l_partkey")


@query("l09_queue_page", "SELECT o_orderkey, 'after' AS asked FROM orders WHERE o_orderstatus = 'O' AND o_orderkey > 500 UNION ALL SELECT o_orderkey, 'ids' FROM orders WHERE o_orderstatus = 'O' AND o_orderkey IN (1, 2, 3, 33, 64)")
def l09(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    behind, of_ids = publication.queue_page(queue, after=500, key="o_orderkey"), publication.queue_page(queue, ids=[1, 2, 3, 33, 64], key="o_orderkey")
    return behind.withColumn("asked", F.lit("after")).union(of_ids.withColumn("asked", F.lit("ids")))


@query("s17_stale_batches", "SELECT batch_of, count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM (SELECT o_orderkey, 'v2' AS batch_of FROM orders WHERE o_orderpriority IS DISTINCT FROM '2-HIGH') x GROUP BY 1")
def s17(spark: SparkSession, sf_dir: str) -> DataFrame:
    stale = publication.stale_stamped(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("stamp")), "o_orderkey", "stamp", "2-HIGH", 8)
    return stale.groupBy(F.lit("v2").alias("batch_of")).agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("keys"))


@query(
    "fn_sync_window",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-01-31' - (c_custkey % 60)::INTEGER - 3 WHEN c_nationkey < 5 THEN DATE '2024-02-01' - 1095 ELSE DATE '2024-02-01' - c_nationkey END AS window_start FROM customer
    """,
)
def fn_sync_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint = F.when(F.col("c_custkey") % 3 == 0, F.date_sub(F.lit(date(2024, 1, 31)), (F.col("c_custkey") % 60).cast("int")))
    lookback = F.when(F.col("c_nationkey") < 3, F.lit(-1)).when(F.col("c_nationkey") >= 5, F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", publication.sync_start(checkpoint, lookback, F.lit(date(2024, 2, 1)), 3).alias("window_start"))


@query(
    "d56_rebuild_runs",
    """
    WITH r AS (SELECT event_id AS run, user_id AS document_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status, ts, CASE WHEN event_id % 4 = 0 THEN event_id // 10 * 10 + 3 ELSE event_id END AS owner, event_type AS parser FROM events),
    n AS (SELECT document_id, arg_max(owner, struct_pack(t := ts, e := run)) AS owner FROM r WHERE status = 'succeeded' GROUP BY document_id),
    j AS (SELECT c.c_custkey AS document_id, n.owner, o.document_id AS owner_document, o.parser FROM customer c LEFT JOIN n ON n.document_id = c_custkey LEFT JOIN r o ON o.run = n.owner)
    SELECT document_id, CASE WHEN owner IS NULL THEN 'NO_SUCCEEDED_PARSE_RUN' WHEN owner_document IS DISTINCT FROM document_id THEN 'ARTIFACT_OWNER_INVALID' END AS error,
      CASE WHEN owner_document = document_id THEN owner END AS artifact_owner_processing_run_id, CASE WHEN owner_document = document_id THEN 'rebuild_units' END AS run_kind, CASE WHEN owner_document = document_id THEN parser END AS parser_name FROM j
    """,
)
def d56(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").selectExpr(
        "event_id processing_run_id", "user_id document_id", "case when event_type = 'error' then 'failed' else 'succeeded' end status", "ts finished_at",
        "case when event_id % 4 = 0 then event_id div 10 * 10 + 3 else event_id end artifact_owner_processing_run_id", "event_type parser_name", "md5(cast(cast(event_id as string) as binary)) artifact_hash",
    )
    return publication.rebuilt_runs(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("document_id")), runs).drop("artifact_hash")


@query(
    "d33_run_violations",
    """
    WITH u AS (SELECT doc_id, source AS run, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, count(*) OVER (PARTITION BY source) AS units FROM documents),
    x AS (SELECT run, min(units) AS units, count(*) FILTER (doc_id % 50 = 7) AS broken FROM u GROUP BY run)
    SELECT run AS processing_run_id, 'order_index_not_contiguous' AS reason FROM x WHERE ascii(right(run, 1)) % 3 = 0
    UNION ALL SELECT run, 'content_hash_mismatch' FROM x WHERE ascii(right(run, 1)) % 3 <> 0 AND broken > 0
    UNION ALL SELECT run, 'content_hash_aggregate_mismatch' FROM x WHERE ascii(right(run, 1)) % 3 = 1
    """,
)
def d33(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    plain = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("asset_id"), F.col("source").alias("document_id"), F.col("source").alias("processing_run_id"), F.lit("text").alias("payload_kind"), F.to_json(F.struct("text")).alias("payload"), F.col("lang").alias("title"),
        F.array("lang").alias("heading_path"), F.lit("k").alias("semantic_key"), F.array(F.lit("k")).alias("semantic_keys"), F.lit("ok").alias("quality_status"),
        F.row_number().over(W.partitionBy("source").orderBy("doc_id")).alias("order_index"),
    )
    units = intake.unit_hashes(plain)
    kind = F.ascii(F.right("processing_run_id", F.lit(1))) % 3
    content = intake.sorted_hash(units, ["processing_run_id"], "content_hash", "content_hash_aggregate")
    structure = intake.ordered_hash(units, ["processing_run_id"], ["order_index"], "structure_hash", "structure_hash")
    runs = content.join(structure, "processing_run_id").withColumn("document_id", F.col("processing_run_id")).withColumn("content_hash_aggregate", F.when(kind == 1, "sha256:0").otherwise(F.col("content_hash_aggregate")))
    # Of every third kind of run, numbers begin at 2; some units say another hash than theirs.
    stored = units.drop("hash_error").withColumn("order_index", F.when(kind == 0, F.col("order_index") + 1).otherwise(F.col("order_index")))
    stored = stored.withColumn("content_hash", F.when(F.col("asset_id") % 50 == 7, "sha256:1").otherwise(F.col("content_hash")))
    return publication.run_violations(runs, stored)


@query("f23_key_list", "SELECT event_id FROM events WHERE event_type IN ('click', 'purchase')")
def f23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type").isin(*filters.key_list("click, purchase,click"))).select("event_id")


@query(
    "f15_scope",
    """
    SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)
      AND o_orderkey NOT IN (SELECT event_id FROM events WHERE event_type = 'error')
    """,
)
def f15(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    noise = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("event_id").alias("o_orderkey"))
    return queues.scope(table(spark, sf_dir, "orders").select("o_orderkey"), lines.where("l_returnflag = 'R'"), lines.where("l_quantity > 45"), noise, "o_orderkey")


@query(
    "s03_two_channels",
    "SELECT o_orderkey, o_orderpriority, NULL::DOUBLE AS o_totalprice, 'main' AS channel FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, NULL, o_totalprice, 'extra' FROM orders WHERE o_totalprice > 100000",
)
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return readers.combined(orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderpriority"), orders.where("o_totalprice > 100000").select("o_orderkey", "o_totalprice"), ("main", "extra"))


@query(
    "fn_chinese_ordinal",
    """
    WITH w(k, value) AS (VALUES (0, 10), (1, 23), (2, 105), (3, NULL), (4, 2), (5, 30000), (6, 102003), (7, NULL), (8, 7), (9, NULL))
    SELECT event_id, w.value AS value FROM events JOIN w ON w.k = event_id % 10
    """,
)
def fn_chinese_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.array(*map(F.lit, ["十", "二十三", "一百零五", "零", "一二", "三万", "十万零两千〇三", "第五", "7", ""]))
    return table(spark, sf_dir, "events").select("event_id", py.chinese_ordinal(F.get(said, F.col("event_id") % 10)).alias("value"))


@query(
    "p09_assets_view",
    "SELECT p_partkey AS asset_id, p_brand AS asset_kind, p_name AS title, p_size AS source_ref, p_partkey + 1 AS producer_action_ref, 'asset://asset_intake/v1/' || p_brand || '/' || p_partkey AS asset_uri FROM part",
)
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = {"asset_id": "p_partkey", "asset_kind": "p_brand", "title": "p_name"}
    assets = table(spark, sf_dir, "part").select(*[F.expr(known.get(c, "cast(null as string)")).alias(c) for c in views.ASSET_OWN], F.col("p_size").alias("source_access_id"), (F.col("p_partkey") + 1).alias("processing_run_id"), F.col("p_retailprice").alias("private"))
    return views.assets_view(assets).select(*known, "source_ref", "producer_action_ref", "asset_uri")


@query(
    "v05_section_keys",
    "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING (count(*) % 4 = 0 AND count(DISTINCT o_orderstatus) < count(*)) OR count(*) % 4 = 1 OR (count(*) % 4 = 2)",
)
def v05(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderstatus").alias("all"), F.collect_set("o_orderstatus").alias("set"))
    n = F.size("all") % 4
    keys = F.when(n == 0, F.col("all")).when(n == 1, F.array().cast("array<string>")).when(n == 2, F.concat("set", F.array(F.lit(" ")))).when(F.size("all") % 8 == 3, F.col("set"))
    return validation.bad_section_keys(held.withColumn("section_keys", keys), "section_keys").select("o_custkey")


@query(
    "v11_partition",
    """
    WITH m AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events),
    o AS (SELECT user_id, event_id, place // 5 AS owner, CASE WHEN event_id % 40 = 0 THEN place - 2 ELSE place END AS place FROM m WHERE event_id % 50 <> 0
      UNION ALL SELECT user_id, event_id, place // 5, place FROM m WHERE event_id % 60 = 1 UNION ALL SELECT user_id, -event_id, 1000000, 1 FROM m WHERE event_id % 70 = 1),
    j AS (SELECT coalesce(o.user_id, m.user_id) AS user_id, coalesce(o.event_id, m.event_id) AS event_id, o.owner, o.place, m.place AS mp, o.event_id IS NOT NULL AS owned FROM o FULL JOIN m ON m.user_id = o.user_id AND m.event_id = o.event_id),
    w AS (SELECT *, count(*) FILTER (owned) OVER (PARTITION BY user_id, event_id) AS n, max(mp) OVER (PARTITION BY user_id ORDER BY owner NULLS FIRST, place NULLS FIRST, mp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM j WHERE owned)
    SELECT DISTINCT user_id, event_id, CASE WHEN mp IS NULL THEN 'unknown' WHEN n > 1 THEN 'repeated' WHEN mp < b THEN 'out_of_order' END AS reason FROM w WHERE mp IS NULL OR n > 1 OR mp < b
    UNION ALL SELECT user_id, event_id, 'missing' FROM j WHERE NOT owned
    """,
)
def v11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    members = table(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(W.partitionBy("user_id").orderBy("event_id")).alias("place"))
    owner = F.floor(F.col("place") / 5).alias("owner")
    kept = members.where("event_id % 50 <> 0").select("user_id", "event_id", owner, F.when(F.col("event_id") % 40 == 0, F.col("place") - 2).otherwise(F.col("place")).alias("place"))
    again = members.where("event_id % 60 = 1").select("user_id", "event_id", owner, "place")
    strange = members.where("event_id % 70 = 1").select("user_id", (-F.col("event_id")).alias("event_id"), F.lit(1000000).cast("long").alias("owner"), F.lit(1).alias("place"))
    return validation.partition_violations(members, kept.union(again).union(strange), "user_id", "event_id")
