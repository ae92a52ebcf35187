"""Queries of queues, identity, structure, search, routing and validation over the harness tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import python_side as py
from tidemark.functions import text as tx
from tidemark.operators import intake, queues, routing, search, structure, validation
from tidemark.plans.catalog import query, table

ACCESS = """
WITH access AS (SELECT event_id AS access_id, user_id AS candidate_id, ts AS accessed_at, CASE WHEN event_type = 'view' THEN '01||02' WHEN event_type = 'click' THEN ' ' END AS codes, (event_id % 4)::VARCHAR AS size FROM events),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY (nullif(trim(codes), '') IS NOT NULL) DESC, accessed_at DESC, access_id DESC) AS rn FROM access) t WHERE rn = 1),
registered AS (SELECT c_custkey AS candidate_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE (c_custkey % 4)::VARCHAR END AS size FROM customer WHERE c_custkey % 2 = 0),
failures AS (SELECT user_id AS candidate_id, value > 499 AS terminal FROM events WHERE event_type = 'error'),
failed AS (SELECT candidate_id, count(*) AS failures, bool_or(terminal) AS terminal FROM failures GROUP BY 1),
pending AS (SELECT n.candidate_id, n.accessed_at, n.codes, n.size, coalesce(f.failures, 0)::BIGINT AS failures
  FROM newest n LEFT JOIN registered r USING (candidate_id) LEFT JOIN failed f USING (candidate_id)
  WHERE (r.candidate_id IS NULL OR n.size IS DISTINCT FROM r.size) AND NOT coalesce(f.terminal, false))
"""


def _access(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    codes = F.when(F.col("event_type") == "view", "01||02").when(F.col("event_type") == "click", " ")
    access = events.select(F.col("event_id").alias("access_id"), F.col("user_id").alias("candidate_id"), F.col("ts").alias("accessed_at"), codes.alias("codes"), (F.col("event_id") % 4).cast("string").alias("size"))
    size = F.when(F.col("c_custkey") % 5 != 0, (F.col("c_custkey") % 4).cast("string"))
    registered = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("candidate_id"), size.alias("size"))
    failures = events.where("event_type = 'error'").select(F.col("user_id").alias("candidate_id"), (F.col("value") > 499).alias("terminal"))
    return access, registered, failures


@query("d06_pending_download", ACCESS + "SELECT candidate_id, codes, size, failures FROM pending")
def d06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.pending_downloads(*_access(spark, sf_dir)).drop("accessed_at")


@query("d07_eligible_download", ACCESS + "SELECT candidate_id, failures FROM pending WHERE failures < 15 AND candidate_id % 3 <> 0")
def d07(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = queues.pending_downloads(*_access(spark, sf_dir))
    return queues.eligible_downloads(pending, 15, F.col("candidate_id") % 3 != 0).select("candidate_id", "failures")


RUNS = """
WITH runs AS (SELECT l_orderkey AS document_id, l_orderkey * 10 + l_linenumber AS run_id,
    CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'running' ELSE 'succeeded' END AS status,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END AS started_at, l_quantity > 25 AS charged, l_discount < 0.08 AS retryable, l_shipdate AS finished_at FROM lineitem),
documents_ AS (SELECT o_orderkey AS document_id, CASE o_orderstatus WHEN 'O' THEN 'registered' WHEN 'F' THEN 'parse_failed' ELSE 'parsed' END AS status FROM orders)
"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "R", "failed").when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), "running").otherwise("succeeded")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("document_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("run_id"),
        status.alias("status"),
        F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("started_at"),
        (F.col("l_quantity") > 25).alias("charged"),
        (F.col("l_discount") < 0.08).alias("retryable"),
        F.col("l_shipdate").alias("finished_at"),
    )


def _queue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "registered").when(F.col("o_orderstatus") == "F", "parse_failed").otherwise("parsed")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), status.alias("status"))


@query(
    "d08_pending_parse",
    RUNS + """, f AS (SELECT document_id, count(*) AS failures, count(*) FILTER (charged) AS charged_failures,
      arg_max(retryable, struct_pack(n := started_at IS NULL, s := coalesce(started_at, TIMESTAMP '1900-01-01'), r := run_id)) AS last_retryable FROM runs WHERE status = 'failed' GROUP BY 1)
    SELECT d.document_id, coalesce(f.failures, 0)::BIGINT AS failures, f.last_retryable FROM documents_ d LEFT JOIN f USING (document_id)
    WHERE d.status IN ('registered', 'parse_failed') AND NOT EXISTS (SELECT 1 FROM runs r WHERE r.document_id = d.document_id AND r.status = 'running')
      AND coalesce(f.last_retryable, true) AND coalesce(f.failures, 0) < 2 AND coalesce(f.charged_failures, 0) < 10""",
)
def d08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.pending_parses(_queue_documents(spark, sf_dir), _runs(spark, sf_dir), 2)


@query("d09_pending_build", RUNS + "SELECT run_id, document_id FROM runs WHERE status = 'succeeded' AND NOT EXISTS (SELECT 1 FROM events WHERE event_id = run_id)")
def d09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.pending_builds(_runs(spark, sf_dir), table(spark, sf_dir, "events").select(F.col("event_id").alias("run_id")))


@query(
    "d10_pending_publish",
    RUNS + """, active AS (SELECT o_orderkey AS document_id, o_orderdate + INTERVAL 60 DAY AS active_at FROM orders WHERE o_orderkey % 2 = 0)
    SELECT document_id, run_id FROM (SELECT r.document_id, r.run_id, row_number() OVER (PARTITION BY r.document_id ORDER BY r.finished_at DESC, r.run_id DESC) AS rn
      FROM runs r LEFT JOIN active a USING (document_id) WHERE r.status = 'succeeded' AND (a.active_at IS NULL OR r.finished_at > a.active_at)
      AND r.run_id % 3 <> 0) t WHERE rn = 1""",
)
def d10(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).where("status = 'succeeded'").select("document_id", "run_id", "finished_at")
    active = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("document_id"), F.expr("o_orderdate + interval 60 day").alias("finished_at"))
    units = runs.where("run_id % 3 <> 0").select("run_id")
    return queues.pending_publications(runs, active, units)


@query(
    "d11_sync_due",
    """
    WITH c AS (SELECT c_custkey AS company_id, c_acctbal > 0 AS active, CASE WHEN c_custkey % 2 = 0 THEN 24 ELSE 48 END AS hours FROM customer),
    k AS (SELECT user_id AS company_id, max(ts) AS synced_at FROM events WHERE event_type = 'view' GROUP BY 1),
    f AS (SELECT user_id AS company_id, max(ts) AS failed_at FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT company_id FROM c LEFT JOIN k USING (company_id) LEFT JOIN f USING (company_id)
    WHERE active AND (synced_at IS NULL OR synced_at < TIMESTAMP '2024-01-30' - to_hours(hours)) AND (failed_at IS NULL OR failed_at < TIMESTAMP '2024-01-30' - INTERVAL 60 SECOND)
    """,
)
def d11(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = F.when(F.col("c_custkey") % 2 == 0, 24).otherwise(48)
    companies = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_id"), (F.col("c_acctbal") > 0).alias("active"), F.make_dt_interval(F.lit(0), hours).alias("interval"))
    events = table(spark, sf_dir, "events")
    checkpoints = events.where("event_type = 'view'").groupBy(F.col("user_id").alias("company_id")).agg(F.max("ts").alias("synced_at"))
    failures = events.where("event_type = 'error'").select(F.col("user_id").alias("company_id"), F.col("ts").alias("failed_at"))
    return queues.due_syncs(companies, checkpoints, failures, F.expr("timestamp_ntz'2024-01-30'"), F.expr("interval 60 second")).select("company_id")


@query(
    "d12_gauges",
    "SELECT count(*) FILTER (n < 14 AND NOT terminal) AS retrying, count(*) FILTER (n >= 14 OR terminal) AS dead_letters FROM (SELECT user_id, count(*) AS n, bool_or(value > 499) AS terminal FROM events WHERE event_type = 'error' GROUP BY 1) t",
)
def d12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.gauges(_access(spark, sf_dir)[2], "candidate_id", 14)


@query(
    "d13_reclaim_stale",
    RUNS + """SELECT run_id, CASE WHEN status = 'running' AND started_at < TIMESTAMP '1997-01-01' - INTERVAL 2 HOUR THEN 'failed' ELSE status END AS status,
    CASE WHEN status = 'running' AND started_at < TIMESTAMP '1997-01-01' - INTERVAL 2 HOUR THEN '{"stage":"worker","reason":"stale run","retryable":true}' END AS error FROM runs""",
)
def d13(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).withColumn("error", F.lit(None).cast("string"))
    return queues.reclaim_stale(runs, F.expr("timestamp_ntz'1997-01-01'"), F.expr("interval 2 hour")).select("run_id", "status", "error")


@query("d15_checkpoint", "SELECT user_id || ':index' AS scope_key, max(event_id) AS cursor FROM events GROUP BY 1")
def d15(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.concat(F.col("user_id").cast("string"), F.lit(":index")).alias("scope_key"), F.col("event_id").alias("cursor"))
    return intake.monotone_checkpoint(events.where("cursor % 2 = 0"), events.where("cursor % 2 = 1"))


@query(
    "d16_supersede",
    """SELECT source, doc_id, lag(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS supersedes FROM (SELECT source, text, min(doc_id) AS doc_id FROM documents GROUP BY source, text) t""",
)
def d16(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "documents").groupBy("source", F.sha2("text", 256).alias("raw_hash")).agg(F.min("doc_id").alias("doc_id"))
    return intake.superseded(first, ["source"], ["doc_id"], "doc_id").select("source", "doc_id", "supersedes")


@query(
    "d17_subjects",
    """
    SELECT o_orderkey, (o_custkey <> o_orderkey % 1500 AND o_custkey % 4 <> 0 AND o_orderkey % 1500 % 3 <> 0) AS contested,
      CASE WHEN o_custkey <> o_orderkey % 1500 AND o_custkey % 4 <> 0 AND o_orderkey % 1500 % 3 <> 0 THEN NULL
        WHEN o_custkey % 4 <> 0 THEN o_custkey WHEN o_orderkey % 1500 % 3 <> 0 THEN o_orderkey % 1500 END AS company_id FROM orders
    """,
)
def d17(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("security"), (F.col("o_orderkey") % 1500).alias("credit_code"))
    securities = rows.select("security").distinct().where("security % 4 <> 0").withColumn("company_id", F.col("security"))
    credits = rows.select("credit_code").distinct().where("credit_code % 3 <> 0").withColumn("company_id", F.col("credit_code"))
    return intake.resolve_subjects(rows, securities, credits).select("o_orderkey", "contested", "company_id")


@query(
    "d18_reconcile",
    """
    WITH a AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 'X' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 4 <> 0)
    SELECT coalesce(a.k, b.k) AS c_custkey, CASE WHEN b.k IS NULL THEN 'create' WHEN a.k IS NULL THEN 'pause' WHEN a.v IS DISTINCT FROM b.v THEN 'update' ELSE 'keep' END AS action FROM a FULL JOIN b ON a.k = b.k
    """,
)
def d18(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    current = customer.where("c_custkey % 4 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "X").otherwise(F.col("c_mktsegment")))
    return intake.reconcile(customer.where("c_custkey % 3 <> 0"), current, "c_custkey", "c_mktsegment")


INTAKE = """
WITH i AS (SELECT event_id, ts, user_id || '|' || event_type AS semantic_key, sha256((event_id % 3)::VARCHAR) AS content_hash, CASE WHEN event_id % 11 = 0 THEN 0 ELSE 5 END AS n_records, CASE WHEN event_id % 13 = 0 THEN 'refused' END AS error FROM events),
n AS (SELECT *, sum(CASE WHEN error IS NULL AND n_records > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY semantic_key, content_hash ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nth FROM i),
o AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'error' WHEN n_records = 0 THEN 'empty' WHEN semantic_key LIKE '1|%' AND event_id % 3 = 1 OR nth > 1 THEN 'observed' ELSE 'materialized' END AS outcome FROM n)
SELECT event_id, outcome, (outcome = 'materialized' AND event_id = max(event_id) FILTER (outcome = 'materialized') OVER (PARTITION BY semantic_key)) AS is_active FROM o
"""


@query("d47_intake", INTAKE)
def d47(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    incoming = events.select(
        "event_id",
        F.col("event_id").alias("observed_at"),
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("semantic_key"),
        F.sha2((F.col("event_id") % 3).cast("string"), 256).alias("content_hash"),
        F.when(F.col("event_id") % 11 == 0, 0).otherwise(5).alias("n_records"),
        F.when(F.col("event_id") % 13 == 0, "refused").alias("error"),
    )
    one = F.sha2(F.lit("1"), 256)
    existing = incoming.where("semantic_key like '1|%'").select(F.sha2(F.concat_ws("||", "semantic_key", one), 256).alias("dedup_key")).distinct()
    return intake.register_snapshots(incoming, existing).select("event_id", "outcome", "is_active")


@query(
    "d48_tool_result",
    """
    SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS dedup_key, bool_and(length(text) > 0) AS located FROM conversations GROUP BY conv_id
    """,
)
def d48(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("item", F.concat_ws(":", "role", "text"))
    keys = intake.ordered_hash(turns, ["conv_id"], ["turn"], "item", "dedup_key", prefix="")
    located = turns.groupBy("conv_id").agg(F.bool_and(F.length("text") > 0).alias("located"))
    return keys.join(located, "conv_id")


@query("a13_hash_aggregate", "SELECT user_id, 'sha256:' || sha256(string_agg(event_type, chr(10) ORDER BY event_type)) AS content_hash FROM events GROUP BY user_id")
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.sorted_hash(table(spark, sf_dir, "events"), ["user_id"], "event_type", "content_hash")


@query("a14_structure_hash", "SELECT user_id, 'sha256:' || sha256(string_agg(event_type, chr(10) ORDER BY event_id)) AS structure_hash FROM events GROUP BY user_id")
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.ordered_hash(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], "event_type", "structure_hash")


@query(
    "a16_recordset_hash",
    """
    SELECT user_id, sha256('[' || string_agg('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}', ',' ORDER BY event_id::VARCHAR) || ']') AS content_hash FROM events GROUP BY user_id
    """,
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.recordset_hash(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], ["event_type", "event_id"])


@query(
    "d27_unit_hashes",
    """
    WITH u AS (SELECT doc_id, '"heading_path":["' || lang || '","' || source || '"]' AS path, to_json(split_part(text, chr(10), 1))::VARCHAR AS title, to_json(text)::VARCHAR AS body, lang, source FROM documents)
    SELECT doc_id, 'sha256:' || sha256('{"payload":{"text":' || body || '},"payload_kind":"text"}') AS content_hash,
      'sha256:' || sha256('{"applicability":null,' || path || ',"payload_kind":"text","quality_status":"ok","semantic_key":"' || source || '"' || CASE WHEN lang = 'en' THEN ',"semantic_keys":["' || source || '","en"]' ELSE '' END || ',"title":' || title || '}') AS query_projection_hash,
      'sha256:' || sha256('{' || path || ',"order_index":' || doc_id || ',"payload_kind":"text"}') AS structure_hash FROM u
    """,
)
def d27(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.lit("text").alias("payload_kind"),
        F.to_json(F.struct("text")).alias("payload"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.array("lang", "source").alias("heading_path"),
        F.col("source").alias("semantic_key"),
        F.when(F.col("lang") == "en", F.array("source", "lang")).otherwise(F.array("source")).alias("semantic_keys"),
        F.lit("ok").alias("quality_status"),
        F.col("doc_id").alias("order_index"),
    )
    return intake.unit_hashes(units).select("doc_id", "content_hash", "query_projection_hash", "structure_hash")


@query(
    "d32_guard",
    "SELECT doc_id, 'n_chars' AS field FROM documents WHERE doc_id % 10 = 0 AND length(text) <> 0 UNION ALL SELECT doc_id, 'lang' FROM documents WHERE doc_id % 15 = 0 AND lang <> 'en'",
)
def d32(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    stored = documents.select("doc_id", F.when(F.col("doc_id") % 10 == 0, 0).otherwise(F.length("text")).alias("n_chars"), F.when(F.col("doc_id") % 15 == 0, "en").otherwise(F.col("lang")).alias("lang"))
    return intake.guard_mismatches(stored, documents.select("doc_id", F.length("text").alias("n_chars"), "lang"), "doc_id", ["n_chars", "lang"])


LINES = """
WITH lines AS (SELECT source AS doc, doc_id AS page, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents),
b AS (SELECT *, CASE WHEN line = 1 THEN 'header' WHEN line = 2 THEN 'footer' WHEN line = 3 THEN 'page_number' ELSE 'body' END AS role FROM lines)
"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.col("source").alias("document_id"), F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n")).alias("line", "text"))
    role = F.when(F.col("line") == 0, "header").when(F.col("line") == 1, "footer").when(F.col("line") == 2, "page_number").otherwise("body")
    return lines.withColumns({"role": role, "position": F.col("page") * 100000 + F.col("line"), "is_heading": F.length("text") < 60})


@query(
    "d20_furniture",
    LINES + """, n AS (SELECT doc, role, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS norm FROM b WHERE role IN ('header', 'footer') GROUP BY ALL HAVING count(DISTINCT page) >= 2)
    SELECT b.doc AS document_id, b.page, (b.line - 1)::INTEGER AS line, (n.norm IS NOT NULL OR b.role = 'page_number') AS is_furniture
    FROM b LEFT JOIN n ON n.doc = b.doc AND n.role = b.role AND n.norm = lower(trim(regexp_replace(b.text, '\\s+', ' ', 'g')))""".replace("\\\\", "\\"),
)
def d20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.page_furniture(_blocks(spark, sf_dir)).select("document_id", "page", "line", "is_furniture")


@query(
    "d24_coarse_units",
    LINES + """, u AS (SELECT *, page * 100000 + line - 1 AS position, sum((length(text) < 60)::INT) OVER (PARTITION BY doc ORDER BY page, line) AS unit_index FROM b)
    SELECT doc AS document_id, unit_index::BIGINT AS unit_index, count(*) AS blocks, min(position)::BIGINT AS first_position, max(position)::BIGINT AS last_position, string_agg(text, chr(10) ORDER BY position) AS text FROM u GROUP BY doc, unit_index""",
)
def d24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.unit_texts(_blocks(spark, sf_dir))


@query("d23_head_path")
def d23(spark: SparkSession, sf_dir: str) -> DataFrame:
    headings = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("document_id"), F.col("event_id").alias("position"), (F.length("event_type") % 4 + 1).alias("rank"), (F.col("event_id") % 7 == 0).alias("weak"), F.col("event_type").alias("title")
    )
    return structure.head_paths(headings).withColumn("path", F.array_join("path", " > "))


@query(
    "d19_logical_tables",
    """
    WITH b AS (SELECT user_id AS document_id, event_id AS position, event_id // 100 AS page, CASE WHEN event_type IN ('click', 'purchase', 'view') THEN 'table' ELSE 'other' END AS kind, event_id % 2 = 0 AS continues FROM events WHERE event_type <> 'error'),
    p AS (SELECT *, lag(kind) OVER w AS pk, lag(page) OVER w AS pp FROM b WINDOW w AS (PARTITION BY document_id ORDER BY position)),
    t AS (SELECT *, continues AND coalesce(pk = 'table' AND page - pp <= 1, false) AS joins FROM p WHERE kind = 'table')
    SELECT document_id, position, (sum((NOT joins)::INT) OVER (PARTITION BY document_id ORDER BY position))::BIGINT AS table_id, (continues AND NOT joins) AS unbound FROM t
    """,
)
def d19(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("click", "purchase", "view"), "table").otherwise("other")
    blocks = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("document_id"), F.col("event_id").alias("position"), F.floor(F.col("event_id") / 100).alias("page"), kind.alias("kind"), (F.col("event_id") % 2 == 0).alias("continues"), (F.col("event_type") == "error").alias("is_furniture")
    )
    return structure.logical_tables(blocks).select("document_id", "position", "table_id", "unbound")


@query("html_visible")
def html_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", py.html_visible_text("html").alias("text"))


@query("html_segments")
def html_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(py.html_segments("html"), "\n").alias("segments"))


@query(
    "html_roles",
    """
    SELECT page_id, '[{"text":"name","role":"header"},{"text":"value","role":"header"},{"text":"x","role":"header"},{"text":"' || url || '","role":"value"},{"text":"1","role":"value"},{"text":"' || page_id || '","role":"value"}]' AS cells FROM pages
    """,
)
def html_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.concat(F.lit("<table><tr><td>name</td><td>value</td><td>x</td></tr><tr><td>"), F.col("url"), F.lit("</td><td>1</td><td>"), F.col("page_id").cast("string"), F.lit("</td></tr></table>"))
    return table(spark, sf_dir, "pages").select("page_id", F.to_json(py.html_cell_roles(F.concat("html", rows))).alias("cells"))


@query(
    "similarity",
    """
    WITH p AS (SELECT DISTINCT lower(p_name) AS a FROM part), t AS (SELECT DISTINCT lower(p_type) AS b FROM part),
    g AS (SELECT a, b, list_distinct(string_split(a, '')) AS a1, list_distinct(string_split(b, '')) AS b1,
      list_distinct(list_transform(range(1, length(a)), lambda i: substr(a, i, 2))) AS a2, list_distinct(list_transform(range(1, length(b)), lambda i: substr(b, i, 2))) AS b2 FROM p, t)
    SELECT a AS name, b AS label, CASE WHEN length(a) < 4 OR length(b) < 4 THEN 0.0::DOUBLE ELSE round(0.6::DOUBLE * (len(list_intersect(a1, b1))::DOUBLE / len(b1)) + 0.4::DOUBLE * ((2 * len(list_intersect(a2, b2)))::DOUBLE / (len(a2) + len(b2))), 6) END AS similarity FROM g
    """,
)
def similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    names, labels = part.select(F.lower("p_name").alias("name")).distinct(), part.select(F.lower("p_type").alias("label")).distinct()
    return names.join(F.broadcast(labels)).select("name", "label", F.round(tx.title_similarity(F.col("name"), F.col("label")), 6).alias("similarity"))


LABELS = [("risk", "the", True, True, True), ("anchor", "and", False, True, False), ("scope", "de la", False, False, False), ("rare", "th onth", False, True, False)]


def _labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELS, "label_key string, name string, is_risk boolean, in_scope boolean, exclusive boolean")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.substring_index("text", "\n", 1)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_id"), title.alias("title"), F.substr("text", F.length(title) + 2).alias("body"))


CANDIDATES = """
WITH l(label_key, name, is_risk, in_scope, exclusive) AS (VALUES ('risk', 'the', true, true, true), ('anchor', 'and', false, true, false), ('scope', 'de la', false, false, false), ('rare', 'th onth', false, true, false)),
s AS (SELECT doc_id AS unit_id, lower(split_part(text, chr(10), 1)) AS title, lower(regexp_replace(text, '^[^\n]*\n?', '')) AS body FROM documents),
g AS (SELECT s.*, l.*, list_distinct(string_split(title, '')) AS a1, list_distinct(string_split(name, '')) AS b1,
  list_distinct(list_transform(range(1, length(title)), lambda i: substr(title, i, 2))) AS a2, list_distinct(list_transform(range(1, length(name)), lambda i: substr(name, i, 2))) AS b2 FROM s, l),
m AS (SELECT *, CASE WHEN length(title) < 4 OR length(name) < 4 THEN 0.0::DOUBLE ELSE 0.6::DOUBLE * (len(list_intersect(a1, b1))::DOUBLE / len(b1)) + 0.4::DOUBLE * ((2 * len(list_intersect(a2, b2)))::DOUBLE / (len(a2) + len(b2))) END AS sim FROM g),
c AS (SELECT unit_id, label_key, exclusive, CASE WHEN title = name AND is_risk THEN 1200 WHEN title = name AND in_scope THEN 1000 WHEN title = name THEN 700 WHEN contains(title, name) THEN 650
  WHEN contains(body, name || ':') THEN 900 WHEN contains(body, name) THEN 300 + length(name) WHEN sim >= 0.6 THEN 500 + floor(sim * 100) ELSE 0 END::INTEGER AS score,
  CASE WHEN contains(title, name) OR contains(body, name) THEN 'text' ELSE 'similarity' END AS evidence FROM m)
"""


@query("d28_candidates", CANDIDATES + "SELECT * FROM c WHERE score >= 55")
def d28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.candidates(_sources(spark, sf_dir), _labels(spark))


@query(
    "d29_pruned",
    CANDIDATES + """, k AS (SELECT *, max(CASE WHEN exclusive AND score >= 700 THEN score END) OVER (PARTITION BY unit_id) AS locked FROM c WHERE score >= 55)
    SELECT unit_id, label_key, exclusive, score, evidence, row_number() OVER (PARTITION BY unit_id ORDER BY (evidence = 'similarity'), score DESC, label_key)::INTEGER AS position FROM k WHERE locked IS NULL OR (exclusive AND score = locked)""",
)
def d29(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.pruned(routing.candidates(_sources(spark, sf_dir), _labels(spark)))


@query(
    "d30_sections",
    """
    WITH h AS (SELECT doc_id AS unit_id, unnest([lang, source, lang, 'src' || (doc_id % 20)]) AS heading, unnest([0, 1, 2, 3]) AS depth FROM documents),
    c(name, label_key) AS (VALUES ('EN', 'english'), ('fr', 'french'), ('src3', 'third'), ('src4', 'fourth')),
    m AS (SELECT unit_id, depth, min(label_key) AS key FROM h JOIN c ON lower(heading) = lower(name) GROUP BY 1, 2),
    f AS (SELECT unit_id, key, min(depth) AS depth FROM m GROUP BY 1, 2)
    SELECT unit_id, string_agg(key, ',' ORDER BY depth) AS section_keys FROM f GROUP BY unit_id
    """,
)
def d30(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_id"), F.array("lang", "source", "lang", F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string"))).alias("heading_path"))
    containers = spark.createDataFrame([("EN", "english"), ("fr", "french"), ("src3", "third"), ("src4", "fourth")], "name string, label_key string")
    return routing.section_keys(paths, containers).withColumn("section_keys", F.array_join("section_keys", ","))


POSTINGS = """
WITH t AS (SELECT doc_id, 'A' AS weight, list_filter(regexp_split_to_array(lower(split_part(text, chr(10), 1)), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS tokens FROM documents
  UNION ALL SELECT doc_id, 'C', list_filter(regexp_split_to_array(lower(regexp_replace(text, '^[^\n]*\n?', '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') FROM documents),
p AS (SELECT doc_id, weight, lexeme, count(*) AS tf FROM (SELECT doc_id, weight, unnest(tokens) AS lexeme FROM t) u GROUP BY ALL)
"""


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    title, body = F.substring_index("text", "\n", 1), F.regexp_replace("text", r"^[^\n]*\n?", "")
    return search.postings(table(spark, sf_dir, "documents"), "doc_id", {"title": search.index_tokens(title), "body": search.index_tokens(body)})


@query("d37_projection", POSTINGS + "SELECT * FROM p")
def d37(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _postings(spark, sf_dir)


@query(
    "d41_match",
    POSTINGS + """SELECT doc_id FROM p WHERE lexeme IN ('the', 'la', 'of', 'de') GROUP BY doc_id
    HAVING count(DISTINCT CASE WHEN lexeme IN ('the', 'la') THEN 0 ELSE 1 END) = 2 UNION SELECT doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS atom FROM documents) a WHERE contains(atom, 'thon')""",
)
def d41(spark: SparkSession, sf_dir: str) -> DataFrame:
    atoms = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("atom"))
    return search.search(_postings(spark, sf_dir), atoms, [["the", "la"], ["of", "de"]], "thon", "doc_id")


@query("d42_weighted_rank", POSTINGS + "SELECT doc_id, round(sum(CASE weight WHEN 'A' THEN 1.0::DOUBLE ELSE 0.2::DOUBLE END), 6) AS rank FROM p WHERE lexeme IN ('the', 'of', 'and') GROUP BY doc_id")
def d42(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.weighted_rank(_postings(spark, sf_dir), ["the", "of", "and", "the"], "doc_id")


@query(
    "d38_windows",
    """
    WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS tokens FROM documents)
    SELECT doc_id, w::INTEGER AS window_index, (w * 200)::INTEGER AS token_start, least(w * 200 + 200, len(tokens))::INTEGER AS token_end, array_to_string(tokens[w * 200 + 1 : w * 200 + 200], ' ') AS body
    FROM (SELECT *, unnest(range(0, (len(tokens) + 199) // 200)) AS w FROM t WHERE len(tokens) > 0) x
    """,
)
def d38(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "documents").select("doc_id", search.index_tokens(F.col("text")).alias("tokens"))
    return search.windows(tokens, "doc_id", "tokens", 200)


@query("d46_delta", "SELECT doc_id AS asset_id FROM documents WHERE doc_id % 3 = 0")
def d46(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"))
    projected = units.select("asset_id", F.when(F.col("asset_id") % 3 == 0, "v1").otherwise("v2").alias("version"))
    return search.stale_projections(units, projected, "v2")


@query("d45_orphans", "SELECT doc_id AS asset_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0)")
def d45(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("asset_id"))
    return search.orphans(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("asset_id")), units)


@query(
    "d43_evaluation_rank",
    """
    SELECT doc_id, ((CASE WHEN contains(lower(split_part(text, chr(10), 1)), 'the') THEN 60 ELSE 0 END) + (CASE WHEN contains(lower(text), 'the') THEN 20 ELSE 0 END) + (CASE WHEN lang = 'en' THEN 200 ELSE 0 END)
      + (CASE WHEN source = 'src1' THEN 100 ELSE 0 END) + (CASE WHEN n_chars > 1000 THEN 50 ELSE 0 END) + (CASE WHEN doc_id % 10 < 4 THEN greatest(1, 6 - doc_id % 10) ELSE 0 END))::BIGINT AS score FROM documents
    """,
)
def d43(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"title": F.lower(F.substring_index("text", "\n", 1)), "body": F.lower("text")}
    lexical = search.lexical_score(["the"], fields, {"title": 60, "body": 20})
    distance = F.when(F.col("doc_id") % 10 < 4, F.col("doc_id") % 10)
    score = search.evaluation_score(lexical, F.col("lang") == "en", F.col("source") == "src1", F.col("n_chars") > 1000, distance)
    return table(spark, sf_dir, "documents").select("doc_id", score.cast("bigint").alias("score"))


@query(
    "a17_ranking_metrics",
    """
    WITH r AS (SELECT d.source AS query_id, d.doc_id AS item_id, d.n_chars AS score FROM documents d), j AS (SELECT d.source AS query_id, l.doc_id AS item_id, l.quality + l.toxic AS grade FROM labels l JOIN documents d USING (doc_id)),
    t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS pos FROM r),
    h AS (SELECT query_id, count(*) AS hits, sum((pow(2, grade) - 1) / log2(pos + 1)) AS dcg FROM t JOIN j USING (query_id, item_id) WHERE pos <= 10 AND grade > 0 GROUP BY 1),
    i AS (SELECT query_id, count(*) AS relevant, sum((pow(2, grade) - 1) / log2(pos + 1)) FILTER (pos <= 10) AS idcg FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, item_id) AS pos FROM j WHERE grade > 0) x GROUP BY 1)
    SELECT query_id, round(coalesce(hits, 0)::DOUBLE / relevant, 6) AS recall, round(coalesce(hits, 0)::DOUBLE / 10, 6) AS precision, round(coalesce(dcg / idcg, 0), 6) AS ndcg FROM i LEFT JOIN h USING (query_id)
    """,
)
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("source").alias("query_id"), F.col("doc_id").alias("item_id"), F.col("n_chars").alias("score"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"), (F.col("quality") + F.col("toxic")).alias("grade"))
    judged = documents.select("query_id", "item_id").join(labels, "item_id").select("query_id", "item_id", "grade")
    return search.ranking_metrics(documents, judged, 10)


@query("d54_excerpt", "SELECT doc_id, substr(text, 11, 50) AS excerpt, length(substr(text, 11, 50)) + 10 AS excerpt_end, 'sha256:' || sha256(substr(text, 11, 50)) AS excerpt_hash FROM documents")
def d54(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "documents").select("doc_id", tx.excerpt(F.col("text"), 10, 50).alias("e"))
    return part.select("doc_id", F.col("e.text").alias("excerpt"), F.col("e.end").cast("bigint").alias("excerpt_end"), F.col("e.sha256").alias("excerpt_hash"))


@query("d55_parse_lane", "SELECT p_partkey, CASE WHEN p_size * 2 > 80 OR p_retailprice > 1500 THEN 'large' ELSE 'small' END AS lane FROM part")
def d55(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", queues.parse_lane(F.col("p_size") * 2, F.col("p_retailprice"), 80, 1500).alias("lane"))


@query("fn_normalized_title")
def normalized_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.substring_index("text", "\n", 1)
    return table(spark, sf_dir, "documents").select("doc_id", py.nfkc_casefold(title).alias("folded"), tx.canonical_title(title).alias("canonical"), tx.numbering(title)["family"].alias("family"))


@query("fn_hashes", "SELECT doc_id, md5(text) AS digest, 'sha256:' || sha256(text) AS prefixed FROM documents")
def fn_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"), tx.prefixed_sha256(F.col("text")).alias("prefixed"))


@query(
    "fn_canonical_json",
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN '{"event":' || event_id || ',"props":' || replace(props, ' ', '') || ',"type":"' || event_type || '","user":{"id":' || user_id || ',"Été":[true,null,"a\\nb",0]}}' END AS canonical,
      CASE WHEN event_type = 'error' THEN 'not JSON' END AS error FROM events
    """,
)
def fn_canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('{"type": "'), "event_type", F.lit('", "props": '), "props", F.lit(', "user": {"Été": [true, null, "a\\nb", 0], "id": '), F.col("user_id").cast("string"), F.lit('}, "event": '), F.col("event_id").cast("string"), F.lit(" }"))
    broken = F.when(F.col("event_type") == "error", F.concat(text, F.lit("]"))).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", py.canonical_json_strict(broken).alias("c")).select("event_id", "c.canonical", "c.error")


@query("v01_enum", "SELECT event_id FROM events WHERE event_type NOT IN ('view', 'click', 'signup')")
def v01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.unknown_values(table(spark, sf_dir, "events"), "event_type", ["view", "click", "signup"]).select("event_id")


@query("v06_one_active", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 HAVING count(*) > 1")
def v06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.duplicates(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderstatus") == "P")


@query("v08_order_gaps", "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(*) OR count(DISTINCT l_linenumber) <> count(*)")
def v08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.order_gaps(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("v12_references", "SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)")
def v12(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    return validation.missing_references(line, "l_partkey", table(spark, sf_dir, "part").where("p_size > 10"), "p_partkey")


@query(
    "d22_repeated_headers",
    """
    WITH b AS (SELECT source AS document_id, doc_id AS page, split_part(text, chr(10), 1) AS text, (doc_id % 3)::DOUBLE AS x0, 0.0::DOUBLE AS y0 FROM documents),
    n AS (SELECT *, CASE WHEN page - lag(page) OVER w <= 60 AND abs(x0 - lag(x0) OVER w) <= 1 AND abs(y0 - lag(y0) OVER w) <= 1 THEN 0 ELSE 1 END AS starts FROM b WINDOW w AS (PARTITION BY document_id, text ORDER BY page, y0, x0)),
    g AS (SELECT *, sum(starts) OVER (PARTITION BY document_id, text ORDER BY page, y0, x0 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM n)
    SELECT document_id, text, count(DISTINCT page) AS pages, min(page) AS first_page, max(page) AS last_page FROM g GROUP BY document_id, text, grp HAVING count(DISTINCT page) >= 2
    """,
)
def d22(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "documents").select(
        F.col("source").alias("document_id"), F.col("doc_id").alias("page"), F.substring_index("text", "\n", 1).alias("text"), (F.col("doc_id") % 3).cast("double").alias("x0"), F.lit(0.0).alias("y0")
    )
    return structure.repeated_headers(blocks, tolerance=1.0, least_pages=2, gap=60)


@query(
    "d39_unsafe_windows",
    """
    WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS tokens FROM documents)
    SELECT doc_id, w::INTEGER AS window_index FROM (SELECT *, unnest(range(0, (len(tokens) + 199) // 200)) AS w FROM t WHERE len(tokens) > 0) x
    WHERE least(w * 200 + 200, len(tokens)) - w * 200 > 150 OR strlen(array_to_string(tokens[w * 200 + 1 : w * 200 + 200], ' ')) >= 700
    """,
)
def d39(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "documents").select("doc_id", search.index_tokens(F.col("text")).alias("tokens"))
    return search.unsafe_windows(search.windows(tokens, "doc_id", "tokens", 200), "doc_id", 150, 700)


@query(
    "d44_route_report",
    CANDIDATES + """, k AS (SELECT *, max(CASE WHEN exclusive AND score >= 700 THEN score END) OVER (PARTITION BY unit_id) AS locked FROM c WHERE score >= 55),
    r AS (SELECT unit_id, label_key, row_number() OVER (PARTITION BY unit_id ORDER BY (evidence = 'similarity'), score DESC, label_key) AS position FROM k WHERE locked IS NULL OR (exclusive AND score = locked))
    SELECT e.doc_id AS unit_id, coalesce(bool_or(r.label_key = 'risk'), false) AS found, coalesce(bool_or(r.label_key = 'risk' AND r.position = 1), false) AS is_first
    FROM (SELECT doc_id FROM documents WHERE doc_id % 3 = 0) e LEFT JOIN r ON r.unit_id = e.doc_id GROUP BY e.doc_id""",
)
def d44(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.pruned(routing.candidates(_sources(spark, sf_dir), _labels(spark)))
    expected = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.col("doc_id").alias("unit_id"), F.lit("risk").alias("expected_key"))
    return routing.route_report(routed, expected)


@query(
    "d25_retrieval_targets",
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'table' WHEN 'click' THEN 'text' WHEN 'signup' THEN 'image' END AS target FROM events",
)
def d25(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.when(F.col("event_type") == "view", "table_body").when(F.col("event_type") == "click", "text").when(F.col("event_type") == "signup", "image_caption").otherwise("unknown")
    return structure.retrieval_targets(table(spark, sf_dir, "events").select("event_id", fields.alias("field"))).select("event_id", "target")


@query("v02_neither", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'F') IS NULL AND nullif(o_orderpriority, '5-LOW') IS NULL")
def v02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("a"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("b"))
    return validation.neither(rows, "a", "b").select("o_orderkey")
