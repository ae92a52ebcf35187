"""Classification by prefix and keyword rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_codes(rows: DataFrame, codes: str, name: str = "code") -> DataFrame:
    """One row per code of a ``||``-joined string, trimmed, without blanks, with its 1-based position; null yields no rows."""
    parts = rows.select("*", F.posexplode(F.split(codes, r"\|\|")).alias("position", name))
    return parts.withColumns({"position": F.col("position") + 1, name: F.nullif(F.trim(name), F.lit(""))}).where(F.col(name).isNotNull())


def match_prefix(rows: DataFrame, rules: DataFrame, code: str, prefix: str = "prefix") -> DataFrame:
    """Join codes with the rules whose prefix they start with, as an equi-join: a code offers all its beginnings.

    Codes are short identifiers, so this is a few rows a code; the rule table is left to the planner to broadcast or shuffle.
    """
    beginnings = rows.withColumn("_beginning", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length(code), F.lit(1))), lambda n: F.substring(F.col(code), F.lit(1), n))))
    return beginnings.join(rules, F.col("_beginning") == rules[prefix]).drop("_beginning")


def match_infix(rows: DataFrame, rules: DataFrame, text: str, pattern: str = "prefix") -> DataFrame:
    """Join texts with rules contained in them; ``%`` inside a rule joins ordered keywords. The rule side is small and fixed."""
    return rows.join(F.broadcast(rules), F.like(F.col(text), F.concat(F.lit("%"), F.col(pattern), F.lit("%"))))


def best_by_priority(value: str, priority: str) -> Column:
    """Aggregate: the value of highest priority, the least value on ties."""
    return F.min_by(value, F.struct(-F.col(priority), F.col(value)))


def ruleset_digest(rules: DataFrame) -> DataFrame:
    """md5 over the sorted rules; "empty" for none. One row."""
    line = F.concat_ws("|", "rule_set", "prefix", "value", F.col("priority").cast("string"))
    lines = rules.agg(F.sort_array(F.collect_list(line)).alias("lines"))
    return lines.select(F.when(F.size("lines") == 0, "empty").otherwise(F.md5(F.array_join("lines", "\n").cast("binary"))).alias("digest"))


def classify(documents: DataFrame, rules: DataFrame, doc: str, codes: str, title: str) -> DataFrame:
    """filing_type, topics and facet of each document; ``doc`` identifies it.

    Types are hits of class rules on codes together with title topics; the highest priority wins, then the least name. A
    document without codes may fall back on title rules, else it is "other". Topics that are absent are null, not empty.
    Hits of all rule sets and the documents themselves meet in one aggregate, so there is one shuffle.
    """
    base = documents.select(F.col(doc).alias("_doc"), F.col(codes).alias("_codes"), F.col(title).alias("_title"))
    of = lambda *names: rules.where(F.col("rule_set").isin(*names)).select("rule_set", "prefix", "value", "priority")
    hit = ["_doc", "rule_set", "value", "priority"]
    coded = match_prefix(split_codes(base, "_codes"), of("class", "facet"), "code").select(*hit)
    blank = F.nullif(F.trim("_codes"), F.lit("")).isNull()
    titled = match_infix(base, of("title_topic", "title"), "_title").where((F.col("rule_set") == "title_topic") | blank).select(*hit)
    every = base.select("_doc", *[F.lit(None).cast(dict(rules.dtypes)[c]).alias(c) for c in hit[1:]])

    def best(*names: str) -> Column:
        wanted = F.col("rule_set").isin(*names)
        return F.min_by(F.when(wanted, F.col("value")), F.when(wanted, F.struct((-F.col("priority")).alias("p"), F.col("value").alias("v"))))

    topics = F.sort_array(F.collect_set(F.when(F.col("rule_set") == "title_topic", F.col("value"))))
    found = coded.unionByName(titled).unionByName(every).groupBy("_doc").agg(best("class", "title_topic").alias("_type"), best("title").alias("_titled"), topics.alias("_topics"), best("facet").alias("facet"))
    return found.select(F.col("_doc").alias(doc), F.coalesce("_type", "_titled", F.lit("other")).alias("filing_type"), F.when(F.size("_topics") > 0, F.col("_topics")).alias("topics"), "facet")


def uncovered_codes(coded: DataFrame, rules: DataFrame, doc: str, accepted: list[str]) -> DataFrame:
    """Codes that no prefix covers and that are not accepted as miscellaneous, with their documents' number."""
    covered = match_prefix(coded.select("code").distinct(), rules.select("prefix").distinct(), "code").select("code").distinct()
    open_codes = coded.join(covered, "code", "left_anti")
    if accepted:
        open_codes = open_codes.where(~F.col("code").isin(*accepted))
    return open_codes.groupBy("code").agg(F.countDistinct(doc).alias("documents"))
