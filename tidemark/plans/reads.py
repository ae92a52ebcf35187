"""Queries of the read API: top-1 per group, filters, keysets, computed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import filters, keyset, latest
from tidemark.plans.catalog import query, table


@query(
    "w01_latest_nonblank_first",
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_type <> 'error') DESC, ts DESC, event_id DESC) AS rn FROM events) t
    WHERE rn = 1
    """,
)
def w01(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [(F.col("event_type") != "error").desc(), F.desc("ts"), F.desc("event_id")]
    return latest.latest_per_group(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], order).drop("ts")


@query(
    "w03_latest_publishable",
    """
    SELECT o_custkey, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus = 'F') t WHERE rn = 1
    """,
)
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest.latest_per_group(done, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).drop("o_orderdate")


@query(
    "w04_distinct_coded_first",
    """
    SELECT user_id, event_id, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'purchase') DESC, ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1
    """,
)
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "props", "event_type", "ts")
    order = [(F.col("event_type") == "purchase").desc(), F.desc("ts"), F.desc("event_id")]
    return latest.latest_per_group(events, ["user_id"], order).select("user_id", "event_id", "props")


@query(
    "w05_latest_failure_scalar",
    """
    SELECT c_custkey, e.last_error FROM customer LEFT JOIN (
      SELECT user_id, arg_max(event_id, struct_pack(t := ts, i := event_id)) AS last_error FROM events WHERE event_type = 'error' GROUP BY user_id) e ON e.user_id = c_custkey
    """,
)
def w05(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "events").where("event_type = 'error'")
    last = latest.latest_value(errors, ["user_id"], ["ts", "event_id"], "event_id", "last_error")
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return customer.join(last, customer.c_custkey == last.user_id, "left").select("c_custkey", "last_error")


@query(
    "w06_latest_differs",
    """
    SELECT user_id, event_id AS warning_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1 AND event_type <> 'purchase'
    """,
)
def w06(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return latest.newest_differs(events, "user_id", [F.desc("ts"), F.desc("event_id")], F.col("event_type") == "purchase")


@query(
    "w07_first_occurrence",
    "SELECT user_id, event_type, arg_min(event_id, struct_pack(t := ts, i := event_id)) AS first_event FROM events GROUP BY user_id, event_type",
)
def w07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event"))


@query("f01_optional_equality", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def f01(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return filters.where_equal(orders, {"o_orderstatus": "O", "o_orderpriority": "1-URGENT", "o_custkey": None}).select("o_orderkey")


@query("f02_multi_value", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def f02(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = filters.comma_values(" 1-URGENT, ,2-HIGH ")
    return table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin(*values)).select("o_orderkey", "o_orderpriority")


@query("f03_date_range", "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-12-31'")
def f03(spark: SparkSession, sf_dir: str) -> DataFrame:
    between = F.expr("o_orderdate between timestamp_ntz'1995-01-01' and timestamp_ntz'1995-12-31'")
    return table(spark, sf_dir, "orders").where(between).select("o_orderkey")


@query("f04_ilike_escape", r"SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' ESCAPE '\' OR p_name ILIKE '%\_1%' ESCAPE '\'")
def f04(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = filters.contains_any_case("p_name", " RED ") | filters.contains_any_case("p_name", "_1")
    return table(spark, sf_dir, "part").where(wanted).select("p_partkey", "p_name")


def _user_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("types"))


TYPES_SQL = "WITH t AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS types FROM events GROUP BY user_id) "


@query("f05_any_of", TYPES_SQL + "SELECT user_id FROM t WHERE list_has_any(types, ['signup', 'error'])")
def f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_types(spark, sf_dir).where(filters.any_of("types", ["signup", "error"])).select("user_id")


@query("f06_all_of", TYPES_SQL + "SELECT user_id FROM t WHERE list_has_all(types, ['click', 'view', 'signup'])")
def f06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_types(spark, sf_dir).where(filters.all_of("types", ["click", "view", "signup"])).select("user_id")


@query("f07_scalar_or_array", TYPES_SQL + "SELECT user_id FROM t WHERE types[1] = 'signup' OR list_contains(types, 'signup')")
def f07(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _user_types(spark, sf_dir).withColumn("first_type", F.get("types", F.lit(0)))
    return users.where(filters.scalar_or_member("first_type", "types", "signup")).select("user_id")


@query(
    "f08_object_array",
    "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING bool_or(o_orderstatus IN ('P', '5-LOW') OR o_orderpriority IN ('P', '5-LOW'))",
)
def f08(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set(F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("name"))).alias("topics"))
    return arrays.where(filters.object_matches("topics", ["code", "name"], ["P", "5-LOW"])).select("o_custkey")


@query("f09_array_prefix", "SELECT doc_id FROM documents WHERE string_split(lang || '/' || source || '/' || (doc_id % 7), '/')[1:2] = ['en', 'src1']")
def f09(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.split(F.concat_ws("/", "lang", "source", (F.col("doc_id") % 7).cast("string")), "/")
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("path")).where(filters.starts_with_path("path", ["en", "src1"])).select("doc_id")


@query(
    "f10_row_keyset",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) > (100, 2) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 101",
)
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = table(spark, sf_dir, "lineitem").where(keyset.row_after(["l_orderkey", "l_linenumber"], [100, 2]))
    return later.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").limit(101).select("l_orderkey", "l_linenumber", "l_quantity")


NULLED = "WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer) "


def _nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))


@query(
    "f11_null_keyset",
    NULLED + "SELECT c_custkey, segment FROM c WHERE segment < 'FURNITURE' OR segment IS NULL OR (segment = 'FURNITURE' AND c_custkey < 500) ORDER BY segment DESC NULLS LAST, c_custkey DESC LIMIT 300",
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [keyset.Key("segment", True), keyset.Key("c_custkey", True)]
    return keyset.ordered_page(_nulled(spark, sf_dir), keys, 300, ["FURNITURE", 500])


@query(
    "f12_null_asc_keyset",
    NULLED + "SELECT c_custkey, segment FROM c WHERE segment IS NULL AND c_custkey > 200 ORDER BY segment ASC NULLS LAST, c_custkey LIMIT 100",
)
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [keyset.Key("segment"), keyset.Key("c_custkey")]
    return keyset.ordered_page(_nulled(spark, sf_dir), keys, 100, [None, 200])


@query(
    "f16_effective_set",
    """
    WITH o AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN []::VARCHAR[] WHEN 2 THEN ['annual', 'interim'] ELSE ['annual', 'unheard'] END AS own FROM customer)
    SELECT c_custkey, array_to_string(CASE WHEN own IS NULL OR len(own) = 0 THEN ['annual'] WHEN list_has_all(['annual', 'interim', 'notice'], own) THEN own ELSE []::VARCHAR[] END, ',') AS classes FROM o
    """,
)
def f16(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.expr("case c_custkey % 4 when 0 then null when 1 then cast(array() as array<string>) when 2 then array('annual', 'interim') else array('annual', 'unheard') end")
    rows = table(spark, sf_dir, "customer").select("c_custkey", own.alias("own"))
    return rows.select("c_custkey", F.array_join(filters.effective_set("own", ["annual"], ["annual", "interim", "notice"]), ",").alias("classes"))


@query(
    "f17_retry_budget",
    """
    SELECT c_custkey, coalesce(f.failures, 0)::BIGINT AS failures FROM customer LEFT JOIN (
      SELECT user_id, count(*) FILTER (value < 50) AS failures, count(*) AS charged FROM events WHERE event_type = 'error' GROUP BY user_id) f ON f.user_id = c_custkey
    WHERE c_acctbal IS NOT NULL AND coalesce(f.failures, 0) < 3 AND coalesce(f.charged, 0) < 15
    """,
)
def f17(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy("user_id").agg(F.count_if(F.col("value") < 50).alias("failures"), F.count("*").alias("charged"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    joined = customer.join(failed, customer.c_custkey == failed.user_id, "left")
    return joined.where(filters.retry_allowed(F.col("c_acctbal").isNotNull(), F.col("failures"), F.col("charged"), 3)).select("c_custkey", F.coalesce("failures", F.lit(0)).alias("failures"))


@query(
    "f18_json_guards",
    """
    SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AND try_cast(json_extract_string(props, '$.k') AS BIGINT) > 50
    """,
)
def f18(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select("event_id", F.expr("try_variant_get(try_parse_json(props), '$.k', 'bigint')").alias("k"))
    return parsed.where("k > 50")


@query(
    "f19_null_safe",
    """
    SELECT c_custkey FROM customer LEFT JOIN (SELECT user_id, max(value) AS top FROM events GROUP BY user_id) e ON e.user_id = c_custkey
    WHERE nullif(c_nationkey, 3)::DOUBLE IS DISTINCT FROM e.top
    """,
)
def f19(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("value").alias("top"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = customer.join(top, customer.c_custkey == top.user_id, "left")
    return joined.where(~F.nullif(F.col("c_nationkey"), F.lit(3)).cast("double").eqNullSafe(F.col("top"))).select("c_custkey")


@query("f21_blank_null", "SELECT doc_id, nullif(trim(substr(text, 3, 2)), '') AS part FROM documents")
def f21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", filters.blank_to_null(F.substring("text", 3, 2)).alias("part"))


@query(
    "f22_due",
    """
    SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY user_id
    HAVING max(ts) < TIMESTAMP '2024-01-31' - to_hours(CASE WHEN user_id % 2 = 0 THEN 24 ELSE 30 END) ORDER BY max(ts) NULLS FIRST, user_id
    """,
)
def f22(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    hours = F.when(F.col("user_id") % 2 == 0, 24).otherwise(30)
    due = filters.is_due(F.col("last"), F.make_dt_interval(F.lit(0), hours), F.expr("timestamp_ntz'2024-01-31'"))
    return last.where(due).orderBy(F.asc_nulls_first("last"), "user_id").select("user_id", F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))


@query(
    "f24_download_decision",
    """
    SELECT o.o_orderkey FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_acctbal > 0
    WHERE c.c_custkey IS NULL OR o.o_orderpriority LIKE '%URGENT%' OR o.o_totalprice IS DISTINCT FROM round(o.o_totalprice, 1) AND o.o_orderdate > TIMESTAMP '1998-01-01'
    """,
)
def f24(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    joined = orders.join(known, orders.o_custkey == known.c_custkey, "left")
    differs = ~F.col("o_totalprice").eqNullSafe(F.round("o_totalprice", 1)) & F.expr("o_orderdate > timestamp_ntz'1998-01-01'")
    return joined.where(F.col("c_custkey").isNull() | F.col("o_orderpriority").contains("URGENT") | differs).select("o_orderkey")


@query(
    "f27_row_checks",
    """
    SELECT 'discount' AS check_name, l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_discount <= 0.05)
    UNION ALL SELECT 'quantity', l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_quantity >= 2)
    """,
)
def f27(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"discount": "l_discount <= 0.05", "quantity": "l_quantity >= 2"}
    return filters.violations(table(spark, sf_dir, "lineitem"), checks).select("check_name", "l_orderkey", "l_linenumber")


@query(
    "p03_body_status",
    """
    SELECT doc_id, CASE WHEN trim(regexp_replace(text, '^[^\n]*\n?', '')) = '' AND trim(split_part(text, chr(10), 1)) <> '' THEN 'heading_only'
      WHEN trim(regexp_replace(text, '^[^\n]*\n?', '')) = '' THEN 'empty' ELSE 'content' END AS body_status,
      CASE WHEN lang IN ('de', 'fr') THEN 'tier_0b' ELSE 'tier_0a' END AS source_tier
    FROM documents
    """,
)
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.trim(F.regexp_replace("text", r"^[^\n]*\n?", ""))
    title = F.trim(F.substring_index("text", "\n", 1))
    return table(spark, sf_dir, "documents").select("doc_id", tx.body_status(title, body).alias("body_status"), tx.source_tier(F.col("lang"), ["de", "fr"]).alias("source_tier"))


@query(
    "p08_json_projection",
    "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, CASE WHEN json_extract_string(props, '$.name') IS NULL THEN 'pending:' || user_id ELSE '' END AS shown FROM events",
)
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.get_json_object("props", "$.name")
    shown = F.when(name.isNull(), F.concat(F.lit("pending:"), F.col("user_id").cast("string"))).otherwise("")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), shown.alias("shown"))


@query("p11_asset_uri", "SELECT doc_id, 'asset://corpus/v1/document/' || url_encode(source || ' ' || lang || '/~' || doc_id) AS uri FROM documents")
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.concat(F.col("source"), F.lit(" "), F.col("lang"), F.lit("/~"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", tx.asset_uri("corpus", 1, "document", ident).alias("uri"))


@query(
    "p12_config_cascade",
    """
    SELECT c_custkey, coalesce(nullif(c_nationkey, 0), 14)::INTEGER AS lookback,
      CASE WHEN e.last IS NULL THEN 'never' WHEN e.last < TIMESTAMP '2024-01-29' THEN 'due' ELSE 'fresh' END AS sync_state
    FROM customer LEFT JOIN (SELECT user_id, max(ts) AS last FROM events GROUP BY user_id) e ON e.user_id = c_custkey
    """,
)
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    state = F.when(F.col("last").isNull(), "never").when(F.expr("last < timestamp_ntz'2024-01-29'"), "due").otherwise("fresh")
    joined = customer.join(last, customer.c_custkey == last.user_id, "left")
    return joined.select("c_custkey", F.coalesce(F.nullif(F.col("c_nationkey"), F.lit(0)), F.lit(14)).alias("lookback"), state.alias("sync_state"))


@query(
    "p13_canonical",
    """
    WITH c AS (SELECT c_custkey, upper(trim('  ' || lpad((c_custkey * 37 % 1000000)::VARCHAR, 6, '0') || ' ')) AS code FROM customer)
    SELECT c_custkey, code, CASE WHEN code LIKE '6%' THEN 'SSE' WHEN code LIKE '0%' OR code LIKE '3%' THEN 'SZSE' WHEN code LIKE '4%' OR code LIKE '8%' THEN 'BSE' END AS exchange FROM c
    """,
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("  "), F.lpad((F.col("c_custkey") * 37 % 1000000).cast("string"), 6, "0"), F.lit(" "))
    coded = table(spark, sf_dir, "customer").select("c_custkey", tx.canonical_code(raw).alias("code"))
    return coded.withColumn("exchange", tx.exchange_of(F.col("code")))


@query(
    "p14_period",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) || 'A' WHEN o_orderstatus = 'O' THEN year(o_orderdate) || 'Q' || quarter(o_orderdate) END AS period FROM orders
    """,
)
def p14(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit(" report Q"), F.quarter("o_orderdate").cast("string"))
    kind = F.when(F.col("o_orderstatus") == "F", "annual").when(F.col("o_orderstatus") == "O", "quarterly")
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.report_period(title, kind).alias("period"))


@query("p15_semantic_key", "SELECT o_orderkey, 'status=' || o_orderstatus || '|priority=' || coalesce(nullif(o_orderpriority, '5-LOW'), 'None') AS semantic_key FROM orders")
def p15(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"status": F.col("o_orderstatus"), "priority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))}
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.semantic_key(parts).alias("semantic_key"))


@query(
    "l01_documents_page",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC LIMIT 101",
)
def l01(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = keyset.ordered_page(table(spark, sf_dir, "orders"), [keyset.Key("o_orderdate", True), keyset.Key("o_orderkey", True)], 101)
    return page.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("l03_changes_page", "SELECT event_id, event_type FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 101")
def l03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyset.ordered_page(table(spark, sf_dir, "events").select("event_id", "event_type"), [keyset.Key("event_id")], 101, [500])


@query("l04_tracked_page", NULLED + "SELECT c_custkey, segment FROM c ORDER BY segment ASC NULLS LAST, c_custkey LIMIT 101")
def l04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyset.ordered_page(_nulled(spark, sf_dir), [keyset.Key("segment"), keyset.Key("c_custkey")], 101)


@query(
    "l07_latest_then_cursor",
    """
    SELECT o_custkey, o_orderpriority, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) t
    WHERE rn = 1 AND (o_orderdate < TIMESTAMP '1997-06-01' OR (o_orderdate = TIMESTAMP '1997-06-01' AND o_orderkey < 1000))
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 21
    """,
)
def l07(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest.latest_per_group(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    at = F.expr("timestamp_ntz'1997-06-01'")
    later = newest.where((F.col("o_orderdate") < at) | ((F.col("o_orderdate") == at) & (F.col("o_orderkey") < 1000)))
    return later.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(21).select("o_custkey", "o_orderpriority", "o_orderkey")
