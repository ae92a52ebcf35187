"""Routing units to a closed vocabulary that is an input table: scoring, pruning, sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.text import SHORTEST, blend, grams

# Scores of the evidence for a label, and the least that counts: fixed values of the route contract.
EXACT, RISK_EXACT, UNSCOPED_EXACT, CONTAINS, LABELLED_BODY, BODY, CONTEXT, SIMILAR, FLOOR = 1000, 1200, 700, 650, 900, 300, 80, 500, 55
LEAST_SIMILARITY = 0.6


def candidates(sources: DataFrame, labels: DataFrame) -> DataFrame:
    """Scored (unit_id, label_key) from sources (unit_id, title, body) and labels (label_key, name, is_risk, in_scope).

    The vocabulary is small and closed, so it is broadcast and every source meets every label; its size is the caller's contract.
    A source meets it as one list: its texts are lowered once, and a title's pairs are counted once, only where a label is not in the texts.
    """
    name = F.lower("name")
    listed = labels.agg(F.collect_list(F.struct("label_key", "exclusive", "is_risk", "in_scope", name.alias("name"), grams(name, 1).alias("one"), grams(name, 2).alias("two"))).alias("labels"))
    told = sources.select("unit_id", F.lower("title").alias("title"), F.lower("body").alias("body")).crossJoin(F.broadcast(listed))
    title, body = F.col("title"), F.col("body")

    def said(label: Column) -> Column:
        """The score of a label that the texts contain; 0 for any other."""
        name = label["name"]
        in_body = F.when(F.contains(body, F.concat(name, F.lit(":"))), LABELLED_BODY).otherwise(BODY + F.length(name))
        is_title = F.when(label["is_risk"], RISK_EXACT).when(label["in_scope"], EXACT).otherwise(UNSCOPED_EXACT)
        return F.when(title == name, is_title).when(F.contains(title, name), CONTAINS).when(F.contains(body, name), in_body).otherwise(0)

    def likened(said: Column, label: Column) -> Column:
        return (said == 0) & (F.length(label["name"]) >= SHORTEST)

    judged = told.select("unit_id", "title", F.transform("labels", lambda label: F.struct(label.alias("label"), said(label).alias("said"))).alias("judged"))
    asked = (F.length("title") >= SHORTEST) & F.exists("judged", lambda x: likened(x["said"], x["label"]))
    # Outer, because for a plain inline Spark would put a filter on the list's size below and judge every label twice.
    each = judged.withColumn("pairs", F.when(asked, F.size(grams(title, 2)))).select("unit_id", "title", "pairs", F.inline_outer("judged"))
    one, two = F.col("label.one"), F.col("label.two")
    held = lambda found: F.size(F.filter(found, lambda gram: F.contains(title, gram)))
    similarity = F.when(likened(F.col("said"), F.col("label")) & F.col("pairs").isNotNull(), blend(held(one), F.size(one), held(two), F.col("pairs"), F.size(two)))
    score = F.when(F.col("said") > 0, F.col("said")).when(similarity >= LEAST_SIMILARITY, SIMILAR + F.floor(similarity * 100).cast("int")).otherwise(0)
    evidence = F.when(F.col("said") > 0, "text").otherwise("similarity")
    return each.select("unit_id", "label.label_key", "label.exclusive", score.cast("int").alias("score"), evidence.alias("evidence")).where(F.col("score") >= FLOOR)


def pruned(scored: DataFrame) -> DataFrame:
    """Ranked candidates: an exclusive label that scores as exact keeps only itself; text evidence goes before similarity."""
    unit = W.partitionBy("unit_id")
    locked = F.max(F.when(F.col("exclusive") & (F.col("score") >= UNSCOPED_EXACT), F.col("score"))).over(unit)
    kept = scored.withColumn("_locked", locked).where(F.col("_locked").isNull() | (F.col("exclusive") & (F.col("score") == F.col("_locked"))))
    order = unit.orderBy((F.col("evidence") == "similarity").cast("int"), F.desc("score"), "label_key")
    return kept.withColumn("position", F.row_number().over(order)).drop("_locked")


def section_keys(paths: DataFrame, containers: DataFrame) -> DataFrame:
    """Ordered distinct container keys of each unit's heading path (unit_id, heading_path), at most one per heading."""
    headings = paths.select("unit_id", F.posexplode("heading_path").alias("depth", "heading"))
    matched = headings.join(F.broadcast(containers), F.lower("heading") == F.lower("name")).groupBy("unit_id", "depth").agg(F.min("label_key").alias("key"))
    ordered = F.sort_array(F.collect_list(F.struct("depth", "key")))
    return matched.groupBy("unit_id").agg(F.array_distinct(F.transform(ordered, lambda e: e["key"])).alias("section_keys"))


def route_report(routed: DataFrame, expected: DataFrame) -> DataFrame:
    """Per unit with an expected key: whether it is among the routes, and whether it is first."""
    got = routed.groupBy("unit_id").agg(F.collect_set("label_key").alias("keys"), F.min_by("label_key", "position").alias("first"))
    joined = expected.join(got, "unit_id", "left")
    return joined.select("unit_id", F.coalesce(F.array_contains("keys", F.col("expected_key")), F.lit(False)).alias("found"), F.coalesce(F.col("first") == F.col("expected_key"), F.lit(False)).alias("is_first"))


def adjudicable(scored: DataFrame) -> DataFrame:
    """Units that a model could decide: two candidates or more and none locked. Without a model they abstain."""
    return scored.groupBy("unit_id").agg(F.count("*").alias("n"), F.max("score").alias("top")).where((F.col("n") >= 2) & (F.col("top") < UNSCOPED_EXACT)).select("unit_id")
