"""Queries of the dataset registry, sources and the change feed."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import relations
from tidemark.plans.catalog import query, table
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import readers, registry
from tidemark.streaming import change_feed


@query("s01_date_windows", "SELECT s::DATE AS window_start, least(s::DATE + 29, DATE '2024-12-31') AS window_end FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2025-01-01', INTERVAL 30 DAY) t(s)")
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.date_windows(spark, date(2024, 1, 1), date(2024, 12, 31), 30)


@query(
    "s05_record_mapper",
    "SELECT o_orderkey::VARCHAR AS document_id, strftime(o_orderdate, '%Y-%m-%d')::DATE AS announced, o_orderpriority AS title FROM orders WHERE o_orderkey % 4 <> 0",
)
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.when(F.col("o_orderkey") % 4 == 0, "not a date").when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss"))
    raw = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("TEXTID"), form.alias("F001D"), F.col("o_orderpriority").alias("F002V"))
    mapped, _ = readers.map_records(raw, {"document_id": "TEXTID", "announced": "F001D", "title": "F002V"}, {}, ["announced"])
    return mapped


@query(
    "s14_upsert",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'NEW' FROM customer WHERE c_custkey % 3 = 0",
)
def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return relations.upsert(customer, customer.where("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("NEW")), ["c_custkey"])


@query("s15_replace_children", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 5 <> 0 UNION ALL SELECT l_orderkey, l_linenumber + 100 FROM lineitem WHERE l_orderkey % 10 = 0")
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    incoming = current.where("l_orderkey % 10 = 0").withColumn("l_linenumber", F.col("l_linenumber") + 100)
    return relations.replace_keys(current, incoming, "l_orderkey", current.where("l_orderkey % 5 = 0").select("l_orderkey").distinct())


QUOTES = registry.Contract(
    key="harness.quote",
    columns={"security": "bigint", "trade_date": "date", "amount": "double", "flag": "string"},
    primary_key=["security", "trade_date"],
    mapping={"security": registry.Mapped("l_partkey"), "trade_date": registry.Mapped("day", transform="yyyymmdd_to_date"), "amount": registry.Mapped("l_extendedprice", multiply=100.0), "flag": registry.Mapped("l_returnflag")},
    checks={"amount_positive": "amount > 0"},
    scope={"l_returnflag": ["A", "N"]},
    duplicates="keep_latest",
    latest_by=["amount"],
)


@query(
    "p16_registry_mapping",
    """
    SELECT security, trade_date, amount, flag FROM (
      SELECT l_partkey AS security, l_shipdate::DATE AS trade_date, l_extendedprice * 100.0::DOUBLE AS amount, l_returnflag AS flag,
        row_number() OVER (PARTITION BY l_partkey, l_shipdate::DATE ORDER BY l_extendedprice DESC, l_returnflag) AS rn FROM lineitem WHERE l_returnflag IN ('A', 'N')) t WHERE rn = 1
    """,
)
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").withColumn("day", F.date_format("l_shipdate", "yyyyMMdd"))
    return registry.apply_contract(raw, QUOTES)


@query("d51_duplicates", "SELECT l_partkey AS security, l_shipdate::DATE AS trade_date, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1, 2 HAVING count(*) > 1")
def d51(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_returnflag in ('A', 'N')").select(F.col("l_partkey").alias("security"), F.to_date("l_shipdate").alias("trade_date"))
    return registry.duplicate_keys(rows, QUOTES)


@query(
    "d49_active_table",
    "SELECT 'orders' AS name, 0 AS position, max(o_orderdate)::DATE AS newest FROM orders UNION ALL SELECT 'lineitem', 1, max(l_shipdate)::DATE FROM lineitem UNION ALL SELECT 'events', 2, max(ts)::DATE FROM events",
)
def d49(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda name, column: table(spark, sf_dir, name).select(F.to_date(column).alias("day"))
    return registry.freshest({"orders": day("orders", "o_orderdate"), "lineitem": day("lineitem", "l_shipdate"), "events": day("events", "ts")}, "day")


@query("d50_sql_template", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7 AND o_orderstatus = 'F'")
def d50(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("template_orders")
    sql = "SELECT o_orderkey, o_totalprice FROM template_orders WHERE o_custkey = :customer AND o_orderstatus = :status"
    return registry.run_template(spark, sql, {"customer": 7, "status": "F"}, "o_custkey = :customer")


@query("a21_changes_page", "SELECT event_id AS seq, event_type FROM events WHERE event_id > 9000 ORDER BY event_id LIMIT 50")
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type")
    return change_feed.changes_after(feed, cursor=9000, after_seq=1, limit=50)


@query(
    "change_feed_stream",
    """
    SELECT user_id, event_id, codes FROM (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN '01' END AS codes,
      row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'view') DESC, ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1
    """,
)
def change_feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/feed-{uuid.uuid4().hex}"
    source = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") == "view", "01").alias("codes"))
    source.repartition(4, "event_id").write.parquet(f"{folder}/feed")
    stream = change_feed.follow(spark, f"{folder}/feed", source.schema, files_per_trigger=2)
    last = [-1]
    write = change_feed.newest_state_writer(spark, f"{folder}/state", "user_id", ["ts", "event_id"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        last[0] = batch_id

    change_feed.drain(stream, handle, f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/state/{last[0]}").select("user_id", "event_id", "codes")
