"""Queries of joins, set operations and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import latest, relations, rules
from tidemark.plans.catalog import query, table


@query("j01_unit_document_run", "SELECT l_orderkey, l_linenumber, c_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE l_quantity > 45")
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_linenumber")
    orders, customer = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey).join(customer, orders.o_custkey == customer.c_custkey)
    return joined.select("l_orderkey", "l_linenumber", "c_name")


@query(
    "j03_lateral_top1",
    "SELECT n_nationkey, c.c_custkey AS richest FROM nation LEFT JOIN LATERAL (SELECT c_custkey FROM customer WHERE c_nationkey = n_nationkey ORDER BY c_acctbal DESC, c_custkey DESC LIMIT 1) c ON true",
)
def j03(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_custkey").alias("richest"), "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    return latest.left_top1(nation, customer, ["n_nationkey"], [F.desc("c_acctbal"), F.desc("richest")]).select("n_nationkey", "richest")


@query(
    "j04_self_join",
    "SELECT a.o_orderkey, b.o_orderkey AS other FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate AND a.o_orderkey <> b.o_orderkey",
)
def j04(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    a, b = orders.alias("a"), orders.alias("b")
    on = (F.col("a.o_custkey") == F.col("b.o_custkey")) & (F.col("a.o_orderdate") == F.col("b.o_orderdate")) & (F.col("a.o_orderkey") != F.col("b.o_orderkey"))
    return a.join(b, on, "left").select("a.o_orderkey", F.col("b.o_orderkey").alias("other"))


PREFIX_RULES = [("1-", "urgent", 9), ("2-", "high", 8), ("3-M", "medium", 7), ("1-URG", "critical", 10), ("4", "unspecified", 1)]
RULE_VALUES = "(VALUES " + ", ".join(f"('{p}', '{v}', {n})" for p, v, n in PREFIX_RULES) + ") AS r(prefix, value, priority)"


def _prefix_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PREFIX_RULES, "prefix string, value string, priority int")


@query("j05_prefix_rules", f"SELECT o_orderkey, value, priority FROM orders JOIN {RULE_VALUES} ON starts_with(o_orderpriority, prefix)")
def j05(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return rules.match_prefix(orders, _prefix_rules(spark), "o_orderpriority").select("o_orderkey", "value", "priority")


@query("j06_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > c_acctbal * 10)")
def j06(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    return customer.join(orders, (customer.c_custkey == orders.o_custkey) & (orders.o_totalprice > customer.c_acctbal * 10), "left_semi").select("c_custkey")


@query("j07_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def j07(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return relations.without(table(spark, sf_dir, "customer").select("c_custkey"), urgent, ["c_custkey"])


@query("j09_explode", "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents")
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))


@query(
    "j10_ordinality",
    "SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1)::BIGINT AS position FROM documents",
)
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("position", "word"))
    return words.withColumn("position", (F.col("position") + 1).cast("bigint"))


@query("j12_lateral_max", "SELECT c_custkey, e.top FROM customer LEFT JOIN LATERAL (SELECT max(value) AS top FROM events WHERE user_id = c_custkey AND event_type = 'error') e ON true")
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy("user_id").agg(F.max("value").alias("top"))
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return customer.join(top, customer.c_custkey == top.user_id, "left").select("c_custkey", "top")


@query("j13_concat_key", "SELECT c_custkey, event_id FROM customer JOIN events ON c_custkey || ':p' = user_id || ':p' WHERE event_type = 'signup'")
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, events = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "events").where("event_type = 'signup'").select("user_id", "event_id")
    key = lambda c: F.concat(c.cast("string"), F.lit(":p"))
    return customer.join(events, key(customer.c_custkey) == key(events.user_id)).select("c_custkey", "event_id")


@query(
    "j14_aggregated_children",
    """
    SELECT o_orderkey, coalesce(l.lines, 0)::BIGINT AS lines, p.cheapest FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) l ON l.l_orderkey = o_orderkey
    LEFT JOIN (SELECT l_orderkey, min(l_extendedprice) AS cheapest FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) p ON p.l_orderkey = o_orderkey
    """,
)
def j14(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))
    children = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.min(returned).alias("cheapest"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.join(children, orders.o_orderkey == children.l_orderkey, "left").select("o_orderkey", F.coalesce("lines", F.lit(0)).alias("lines"), "cheapest")


@query("j17_neighbors", "SELECT DISTINCT e.event_id FROM events e JOIN events h ON e.user_id = h.user_id AND e.event_id BETWEEN h.event_id - 40 AND h.event_id + 40 WHERE h.event_type = 'signup'")
def j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return relations.neighbours(events.where("event_type = 'signup'"), events.select("event_id", "user_id"), "user_id", "event_id", 40).select("event_id")


DIFF = """
WITH u AS (SELECT doc_id, lang AS kind, source AS content_hash, lang || (n_chars % 3) AS projection_hash, doc_id % 2 AS side FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY kind, content_hash, projection_hash ORDER BY doc_id) AS n FROM u WHERE side = 0),
w AS (SELECT *, row_number() OVER (PARTITION BY kind, content_hash, projection_hash ORDER BY doc_id) AS n FROM u WHERE side = 1),
one AS (SELECT o.doc_id AS old_id, w.doc_id AS new_id FROM o FULL JOIN w USING (kind, content_hash, projection_hash, n)),
o2 AS (SELECT u.*, row_number() OVER (PARTITION BY kind, content_hash ORDER BY doc_id) AS n FROM u WHERE doc_id IN (SELECT old_id FROM one WHERE new_id IS NULL)),
w2 AS (SELECT u.*, row_number() OVER (PARTITION BY kind, content_hash ORDER BY doc_id) AS n FROM u WHERE doc_id IN (SELECT new_id FROM one WHERE old_id IS NULL)),
two AS (SELECT o2.doc_id AS old_id, w2.doc_id AS new_id FROM o2 FULL JOIN w2 USING (kind, content_hash, n)),
pairs AS (SELECT old_id, new_id, 'unchanged' AS change FROM one WHERE old_id IS NOT NULL AND new_id IS NOT NULL
  UNION ALL SELECT old_id, new_id, CASE WHEN new_id IS NULL THEN 'removed' WHEN old_id IS NULL THEN 'created' ELSE 'changed' END FROM two)
"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("kind"), F.col("source").alias("content_hash"), F.concat("lang", (F.col("n_chars") % 3).cast("string")).alias("projection_hash")
    )
    old, new = units.where("doc_id % 2 = 0"), units.where("doc_id % 2 = 1")
    return relations.multiset_pair(old, new, "doc_id", ["kind", "content_hash", "projection_hash"], ["kind", "content_hash"], [])


@query("j18_multiset_diff", DIFF + "SELECT * FROM pairs")
def j18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(
    "d34_change_kind",
    DIFF + """SELECT count(*) FILTER (change = 'created') AS created, count(*) FILTER (change = 'removed') AS removed, count(*) FILTER (change = 'changed') AS changed,
    count(*) FILTER (change = 'unchanged') AS unchanged, CASE WHEN count(*) FILTER (change IN ('created', 'removed')) > 0 THEN 'materialized' ELSE 'observed' END AS change_kind FROM pairs""",
)
def d34(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.change_kind(_pairs(spark, sf_dir), had_previous=True)


@query(
    "d35_outbox_events",
    DIFF + """, e AS (
      SELECT CASE change WHEN 'removed' THEN 1 WHEN 'created' THEN 2 ELSE 3 END AS rank, 'unit.' || CASE change WHEN 'changed' THEN 'projection_changed' ELSE change END AS event, coalesce(new_id, old_id) AS unit_id
      FROM pairs WHERE change <> 'unchanged' UNION ALL SELECT 9, 'run.published', NULL)
    SELECT (100 + row_number() OVER (ORDER BY rank, unit_id))::BIGINT AS seq, 'run-1' AS run_id, event, unit_id FROM e""",
)
def d35(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.outbox_events(_pairs(spark, sf_dir), "run-1", 100)


@query("u01_union", "SELECT user_id, event_type FROM events WHERE coalesce(value > 10, true) UNION SELECT user_id, event_type FROM events WHERE coalesce(value <= 100, true)")
def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # The sides overlap, and each event is in one at least; one without a value is in both.
    pick = lambda side: events.where(F.coalesce(side, F.lit(True))).select("user_id", "event_type")
    return pick(F.col("value") > 10).union(pick(F.col("value") <= 100)).distinct()


@query(
    "u03_union_all_exists",
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT user_id FROM events WHERE event_type = 'signup') x WHERE x.k = c_custkey)",
)
def u03(spark: SparkSession, sf_dir: str) -> DataFrame:
    either = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    either = either.union(table(spark, sf_dir, "events").where("event_type = 'signup'").select("user_id"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(either, "c_custkey", "left_semi")


@query(
    "u05_except_all",
    """
    SELECT *, 'removed' AS side FROM (SELECT user_id, event_type FROM events WHERE event_id % 2 = 0 EXCEPT ALL SELECT user_id, event_type FROM events WHERE event_id % 2 = 1) a
    UNION ALL SELECT *, 'created' FROM (SELECT user_id, event_type FROM events WHERE event_id % 2 = 1 EXCEPT ALL SELECT user_id, event_type FROM events WHERE event_id % 2 = 0) b
    """,
)
def u05(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    side = lambda k: events.where(F.col("event_id") % 2 == k).select("user_id", "event_type")
    return relations.multiset_difference(side(0), side(1))


@query("a01_backlog_counts", "SELECT count(*) FILTER (o_orderstatus = 'O') AS open_orders, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) AS all_orders FROM orders")
def a01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count("*").alias("all_orders"))


@query("a02_distinct_by_code", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type ORDER BY users DESC, event_type")
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users")).orderBy(F.desc("users"), "event_type")


@query("a03_correlated_count", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS failed FROM customer")
def a03(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("failed"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(counts, "c_custkey", "left").select("c_custkey", F.coalesce("failed", F.lit(0)).alias("failed"))


@query("a04_having_bool_or", "SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY user_id HAVING count(*) >= 16 OR bool_or(value > 480)")
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("n"), F.bool_or(F.col("value") > 480).alias("severe"))
    return grouped.where("n >= 16 or severe").select("user_id", "n")


@query(
    "a05_filter_min_max",
    "SELECT l_returnflag, count(*) FILTER (l_quantity > 25) AS large, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY l_returnflag",
)
def a05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") > 25).alias("large"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))


@query(
    "a07_array_agg",
    "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type) FILTER (value > 450)), ',') AS types FROM events GROUP BY user_id",
)
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = F.collect_set(F.when(F.col("value") > 450, F.col("event_type")))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.when(F.size(types) > 0, F.array_join(F.sort_array(types), ",")).alias("types"))


@query("a08_listagg", "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, '>' ORDER BY o_orderdate, o_orderkey) AS path FROM orders GROUP BY o_custkey")
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(ordered, lambda x: x["o_orderkey"].cast("string")), ">").alias("path"))


@query("a09_distinct_versions", "SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS versions FROM documents GROUP BY source")
def a09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("versions"))


@query(
    "a10_object_list",
    """SELECT o_custkey, '[' || string_agg('{"code":"' || o_orderstatus || '","name":"' || o_orderpriority || '"}', ',' ORDER BY o_orderstatus, o_orderpriority) || ']' AS facets
    FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders) t GROUP BY o_custkey""",
)
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = F.sort_array(F.collect_set(F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("name"))))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(objects).alias("facets"))


@query(
    "a12_ruleset_digest",
    f"SELECT md5(string_agg('class|' || prefix || '|' || value || '|' || priority, chr(10) ORDER BY 'class|' || prefix || '|' || value || '|' || priority)) AS digest FROM {RULE_VALUES}",
)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ruleset_digest(_prefix_rules(spark).withColumn("rule_set", F.lit("class")))


@query(
    "a15_outline",
    "SELECT source, lang, count(*) AS units, count(*) FILTER (n_chars > 2000) AS long_units, min(doc_id) AS first_unit, max(doc_id) AS last_unit FROM documents GROUP BY source, lang",
)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "documents").groupBy(F.array("source", "lang").alias("path"))
    counted = grouped.agg(F.count("*").alias("units"), F.count_if(F.col("n_chars") > 2000).alias("long_units"), F.min("doc_id").alias("first_unit"), F.max("doc_id").alias("last_unit"))
    return counted.select(F.get("path", F.lit(0)).alias("source"), F.get("path", F.lit(1)).alias("lang"), "units", "long_units", "first_unit", "last_unit")


@query(
    "a18_consistency",
    """
    SELECT round((SELECT count(*) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents))::DOUBLE / (SELECT count(*) FROM documents), 6) AS coverage,
      (SELECT count(*) - count(DISTINCT text) FROM documents) AS duplicates, (SELECT count(*) FROM documents WHERE length(text) <> n_chars) AS noncanonical
    """,
)
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("labelled", F.lit(1))
    facts = documents.join(labelled, "doc_id", "left").agg(
        F.round(F.count("labelled") / F.count("*"), 6).alias("coverage"), (F.count("*") - F.countDistinct("text")).alias("duplicates"), F.count_if(F.length("text") != F.col("n_chars")).alias("noncanonical")
    )
    return facts


@query(
    "a19_gaps",
    f"""
    SELECT o_orderpriority AS code, count(DISTINCT o_orderkey) AS documents FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM {RULE_VALUES} WHERE starts_with(o_orderpriority, prefix)) AND o_orderpriority <> '9-MISC' GROUP BY 1
    """,
)
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("code"))
    return rules.uncovered_codes(coded, _prefix_rules(spark), "o_orderkey", ["9-MISC"])


@query("a20_rule_counts", f"SELECT length(prefix)::INTEGER AS prefix_length, count(*) AS n FROM {RULE_VALUES} GROUP BY 1")
def a20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prefix_rules(spark).groupBy(F.length("prefix").alias("prefix_length")).agg(F.count("*").alias("n"))


CLASSIFY_SQL = """
WITH r(rule_set, prefix, value, priority) AS (VALUES
  ('class', '01', 'annual', 90), ('class', '0101', 'annual_summary', 95), ('class', '02', 'interim', 80), ('class', '3', 'notice', 50),
  ('facet', '0', 'periodic', 10), ('facet', '3', 'event', 20), ('title', '1%URGENT', 'urgent', 1000), ('title', 'LOW', 'low', 999),
  ('title_topic', 'HIGH', 'high_topic', 85), ('title_topic', 'LOW', 'low_topic', 40)),
d AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '010' || (o_orderkey % 3) || '||02' WHEN 2 THEN ' 3' || (o_orderkey % 7) || ' || ' WHEN 3 THEN '' ELSE '77' END AS codes, o_orderpriority AS title FROM orders),
c AS (SELECT o_orderkey, nullif(trim(unnest(string_split(codes, '||'))), '') AS code FROM d),
hits AS (SELECT o_orderkey, value, priority FROM c JOIN r ON rule_set = 'class' AND starts_with(code, prefix)
  UNION SELECT o_orderkey, value, priority FROM d JOIN r ON rule_set = 'title_topic' AND title LIKE '%' || prefix || '%'),
types AS (SELECT o_orderkey, arg_min(value, struct_pack(p := -priority, v := value)) AS t FROM hits GROUP BY 1),
topics AS (SELECT o_orderkey, string_agg(DISTINCT value, ',' ORDER BY value) AS topics FROM d JOIN r ON rule_set = 'title_topic' AND title LIKE '%' || prefix || '%' GROUP BY 1),
facets AS (SELECT o_orderkey, arg_min(value, struct_pack(p := -priority, v := value)) AS facet FROM c JOIN r ON rule_set = 'facet' AND starts_with(code, prefix) GROUP BY 1),
titled AS (SELECT o_orderkey, arg_min(value, struct_pack(p := -priority, v := value)) AS t FROM d JOIN r ON rule_set = 'title' AND title LIKE '%' || prefix || '%' WHERE nullif(trim(codes), '') IS NULL GROUP BY 1)
SELECT d.o_orderkey, coalesce(types.t, titled.t, 'other') AS filing_type, topics.topics, facets.facet
FROM d LEFT JOIN types USING (o_orderkey) LEFT JOIN topics USING (o_orderkey) LEFT JOIN facets USING (o_orderkey) LEFT JOIN titled USING (o_orderkey)
"""

CLASS_RULES = [
    ("class", "01", "annual", 90), ("class", "0101", "annual_summary", 95), ("class", "02", "interim", 80), ("class", "3", "notice", 50),
    ("facet", "0", "periodic", 10), ("facet", "3", "event", 20), ("title", "1%URGENT", "urgent", 1000), ("title", "LOW", "low", 999),
    ("title_topic", "HIGH", "high_topic", 85), ("title_topic", "LOW", "low_topic", 40),
]


def coded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.expr(
        "case o_orderkey % 5 when 0 then null when 1 then concat('010', o_orderkey % 3, '||02') when 2 then concat(' 3', o_orderkey % 7, ' || ') when 3 then '' else '77' end"
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", codes.alias("codes"), F.col("o_orderpriority").alias("title"))


@query("d01_classify", CLASSIFY_SQL)
def d01(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_of_rules = spark.createDataFrame(CLASS_RULES, "rule_set string, prefix string, value string, priority int")
    classified = rules.classify(coded_orders(spark, sf_dir), table_of_rules, "o_orderkey", "codes", "title")
    return classified.withColumn("topics", F.array_join("topics", ","))


@query(
    "d03_first_match",
    """
    WITH d AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '010' || (o_orderkey % 3) || '||02' WHEN 2 THEN ' 3' || (o_orderkey % 7) || ' || ' WHEN 3 THEN '' ELSE '77' END AS codes FROM orders),
    c AS (SELECT o_orderkey, nullif(trim(unnest(string_split(codes, '||'))), '') AS code, generate_subscripts(string_split(codes, '||'), 1) AS seg FROM d),
    r(prefix, value, pos) AS (VALUES ('02', 'interim', 1), ('01', 'annual', 2), ('3', 'notice', 3))
    SELECT o_orderkey, arg_min(value, struct_pack(s := seg, p := pos)) AS category FROM c JOIN r ON starts_with(code, prefix) GROUP BY 1
    """,
)
def d03(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = spark.createDataFrame([("02", "interim", 1), ("01", "annual", 2), ("3", "notice", 3)], "prefix string, value string, pos int")
    hits = rules.match_prefix(rules.split_codes(coded_orders(spark, sf_dir), "codes"), ordered, "code")
    return hits.groupBy("o_orderkey").agg(F.min_by("value", F.struct("position", "pos")).alias("category"))


@query(
    "d05_stale_refresh",
    "SELECT o_orderkey, 'v2' AS stamp FROM orders WHERE CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'v1' ELSE 'v2' END IS DISTINCT FROM 'v2'",
)
def d05(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("case o_orderkey % 3 when 0 then null when 1 then 'v1' else 'v2' end").alias("stamp"))
    return stamped.where(~F.col("stamp").eqNullSafe(F.lit("v2"))).select("o_orderkey", F.lit("v2").alias("stamp"))


@query(
    "d14_code_audit",
    """
    WITH d AS (SELECT o_orderkey, o_custkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '010' || (o_orderkey % 3) || '||02' WHEN 2 THEN ' 3' || (o_orderkey % 7) || ' || ' WHEN 3 THEN '' ELSE '77' END AS codes, o_orderdate FROM orders),
    n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (nullif(trim(codes), '') IS NOT NULL) DESC, o_orderdate DESC, o_orderkey DESC) AS rn FROM d)
    SELECT code, count(DISTINCT o_custkey) AS documents FROM (SELECT o_custkey, nullif(trim(unnest(string_split(codes, '||'))), '') AS code FROM n WHERE rn = 1) c WHERE code IS NOT NULL GROUP BY code
    """,
)
def d14(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = coded_orders(spark, sf_dir).select("o_orderkey", "codes").join(dates, "o_orderkey")
    order = [F.nullif(F.trim("codes"), F.lit("")).isNotNull().desc(), F.desc("o_orderdate"), F.desc("o_orderkey")]
    newest = latest.latest_per_group(rows, ["o_custkey"], order)
    return rules.split_codes(newest, "codes").groupBy("code").agg(F.countDistinct("o_custkey").alias("documents"))


@query(
    "w08_ranked_hits",
    "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey)::INTEGER AS position FROM lineitem",
)
def w08(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = F.row_number().over(W.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber", "l_partkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ranked.alias("position"))
