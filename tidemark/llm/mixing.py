"""Mixing sources to target weights by capped water-filling, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.shared import cut, set_aside

#: Rows of a hash bucket, about; a source's sample ends in one of its buckets, whose rows are sorted together.
BUCKET_ROWS = 20_000

#: Hexadecimal digits of a row's hash that make a bucket, at least.
LEAST_DIGITS = 3

#: Sources that may be broadcast.
MOST_BROADCAST_SOURCES = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Water-filling over a table (source, source_size): adds weight, target and whole repetitions.

    The total of all sizes is shared by weight; a target stops at ``max_epochs`` times its source's size and the
    excess goes to the others by weight, until none is above. Sorted by cap over weight, the stopped sources are
    a prefix, so two running sums find the level without a loop. Works on one row a source.
    """
    by_name = W.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    capped = ranked.withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    filling = W.orderBy("ratio", F.asc_nulls_last("source"))
    everything = W.partitionBy(F.lit(0))
    before, after = filling.rowsBetween(W.unboundedPreceding, -1), filling.rowsBetween(0, W.unboundedFollowing)
    stopped = (
        capped.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest_weight", F.sum("weight").over(after))
        .withColumn("stops", (F.col("cap") * F.col("rest_weight") <= F.col("rest") * F.col("weight")).cast("int"))
        .withColumn("stopped", F.min("stops").over(filling.rowsBetween(W.unboundedPreceding, 0)) == 1)
    )
    level = stopped.withColumn("open_words", F.col("total") - F.coalesce(F.sum(F.when(F.col("stopped"), F.col("cap"))).over(everything), F.lit(0))).withColumn(
        "open_weight", F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(everything)
    )
    shared = (F.col("weight") * F.col("open_words")).cast("double") / F.col("open_weight")
    return level.withColumn("target", F.when(F.col("stopped"), F.col("cap").cast("double")).otherwise(shared)).select("source", "source_size", "weight", "target")


def mix_sources(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """Mix a table (doc_id, source, size) towards target weights: adds source_size, target, repeats and taken.

    Sources in code point order, null last, have the ``weights`` in turn. A source's rows are repeated as often as
    its target holds its size; what is left is sampled: rows in the order of a seeded hash of doc_id until the
    words reach the target, the last row where that comes nearer. So a source's words miss its target by half of
    one document at most, reruns agree, and no row is taken more than ``max_epochs`` times.

    The sample's end is found by words per hash bucket; only rows of the one bucket of a source where it ends
    are sorted together. Empty tables give empty results; size 0 and null sources are ordinary; rows repeated
    in full share a hash and one may be taken without the other; further columns are carried along, but for input columns named like
    the four that are added, which are replaced. Sources are ranked in one task, a row each, so there may be millions, not billions.
    """
    sized, restored = set_aside(sized, ["doc_id", "source", "size"], ["source_size", "target", "repeats", "taken"])
    sized = cut(sized.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))))
    digits = max(LEAST_DIGITS, math.ceil(math.log(max(1, sized.count() / BUCKET_ROWS), 16)))
    sized = sized.withColumn("_bucket", F.substring("_hash", 1, digits))
    buckets = cut(sized.groupBy("source", "_bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    plans = (
        targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "_source")
    )
    running = buckets.withColumn("upto", F.sum("words").over(W.partitionBy("source").orderBy("_bucket")))
    ends = (
        running.join(plans.select("_source", "part"), running["source"].eqNullSafe(F.col("_source")))
        .where(F.col("upto") > F.col("part"))
        .groupBy(F.col("source").alias("_end_source"))
        .agg(F.min_by(F.struct(F.col("_bucket").alias("_end"), (F.col("part") - (F.col("upto") - F.col("words"))).alias("_need")), "_bucket").alias("_at"))
    )
    plans = plans.join(ends, plans["_source"].eqNullSafe(ends["_end_source"]), "left").select(
        "_source", "source_size", "target", "whole", F.coalesce("_at._end", F.lit("~")).alias("_end"), F.coalesce("_at._need", F.lit(0.0)).alias("_need")
    )
    plans = cut(plans)
    few = plans.count() <= MOST_BROADCAST_SOURCES
    rows = sized.join(F.broadcast(plans) if few else plans, sized["source"].eqNullSafe(plans["_source"])).drop("_source")
    ordered = W.partitionBy("source").orderBy("_hash", "doc_id", "size", F.xxhash64("_further")).rowsBetween(W.unboundedPreceding, -1)
    ending = (
        rows.where(F.col("_bucket") == F.col("_end"))
        .withColumn("_before", F.coalesce(F.sum("size").over(ordered), F.lit(0)))
        .withColumn("_extra", (2 * (F.col("_need") - F.col("_before")) >= F.col("size")).cast("long"))
        .drop("_before")
    )
    clear = rows.where(F.col("_bucket") != F.col("_end")).withColumn("_extra", (F.col("_bucket") < F.col("_end")).cast("long"))
    mixed = clear.unionByName(ending).withColumn("repeats", F.col("whole") + F.col("_extra"))
    return restored(mixed.withColumn("taken", F.col("repeats") * F.col("size")))
