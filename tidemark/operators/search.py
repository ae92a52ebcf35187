"""Search projection: tokens, postings, matching by words or exact substrings, ranking, windows, evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Weights of title, path, body and key channels.
CHANNELS: Mapping[str, str] = {"title": "A", "path": "B", "body": "C", "key": "D"}
DEFAULT_WEIGHTS: Mapping[str, float] = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}

#: Shorter atoms and queries are left to the word channel.
ATOM_CHARS = 3


def index_tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order. The tokenizer is pluggable: any column of array<string> serves."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def cjk_tokens(text: Column) -> Column:
    """Words as in ``index_tokens``, runs of Chinese characters as overlapping pairs."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+|(?<=[一-鿿])(?![一-鿿])|(?<![一-鿿])(?=[一-鿿])")
    pairs = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 1, F.lit(1))), lambda i: F.substring(w, i, F.lit(2)))
    split = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.when(w.rlike(r"^[一-鿿]{2,}$"), pairs(w)).otherwise(F.array(w)))
    return F.flatten(split)


def postings(rows: DataFrame, asset: str, channels: Mapping[str, Column]) -> DataFrame:
    """(asset, channel weight, lexeme, tf) of every token of every channel of every row, of which an asset has one.

    Tokens are counted inside their row, as runs of the sorted list, so nothing is shuffled.
    """
    parts = F.array(*[F.struct(F.lit(CHANNELS[name]).alias("weight"), F.sort_array(tokens).alias("tokens")) for name, tokens in channels.items()])
    listed = rows.select(asset, F.explode(parts).alias("_part")).select(asset, F.col("_part.weight").alias("weight"), F.col("_part.tokens").alias("_tokens")).where(F.size("_tokens") > 0)
    starts = F.filter(F.sequence(F.lit(0), F.size("_tokens") - 1), lambda i: (i == 0) | (F.get("_tokens", i) != F.get("_tokens", i - 1)))
    runs = F.transform("_starts", lambda p, k: F.struct(F.get("_tokens", p).alias("lexeme"), (F.coalesce(F.get("_starts", k + 1), F.size("_tokens")) - p).cast("long").alias("tf")))
    return listed.withColumn("_starts", starts).select(asset, "weight", F.explode(runs).alias("_run")).select(asset, "weight", "_run.lexeme", "_run.tf")


def match_words(posted: DataFrame, groups: Sequence[Sequence[str]], asset: str) -> DataFrame:
    """Assets that have a word of every group: the query's words are joined to the postings, never to the corpus.

    The word filter is on a grouping key of the postings, so it reaches below their aggregate.
    """
    spark = posted.sparkSession
    words = list(dict.fromkeys(w for group in groups for w in group))
    query = spark.createDataFrame([(k, w) for k, group in enumerate(groups) for w in dict.fromkeys(group)], "word_group int, lexeme string")
    found = posted.where(F.col("lexeme").isin(*words)).join(F.broadcast(query), "lexeme").groupBy(asset).agg(F.countDistinct("word_group").alias("_groups"))
    return found.where(F.col("_groups") == len(groups)).select(asset)


def match_atoms(atoms: DataFrame, text: str, asset: str, atom: str = "atom") -> DataFrame:
    """Assets with an atom that contains the text; atoms are never joined, and short texts match nothing here."""
    if len(text) < ATOM_CHARS:
        return atoms.limit(0).select(asset)
    return atoms.where(F.contains(atom, F.lit(text))).select(asset).distinct()


def search(posted: DataFrame, atoms: DataFrame, groups: Sequence[Sequence[str]], text: str, asset: str) -> DataFrame:
    return match_words(posted, groups, asset).union(match_atoms(atoms, text, asset)).distinct()


def weighted_rank(posted: DataFrame, words: Sequence[str], asset: str, weights: Mapping[str, float] = DEFAULT_WEIGHTS) -> DataFrame:
    """Sum of channel weights over the query's distinct words; a word counts once per channel."""
    value = F.coalesce(*[F.when(F.col("weight") == name, F.lit(w)) for name, w in weights.items()])
    hits = posted.where(F.col("lexeme").isin(*dict.fromkeys(words)))
    return hits.groupBy(asset).agg(F.round(F.sum(value), 6).alias("rank"))


def windows(tokens: DataFrame, asset: str, column: str, size: int) -> DataFrame:
    """Half-open token ranges of at most ``size`` that cover an asset's tokens without gap or overlap."""
    n = F.size(column)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(n / size).cast("int") - 1, F.lit(0)))
    cut = tokens.where(n > 0).select(asset, column, F.explode(starts).alias("window_index"))
    begin = F.col("window_index") * size
    return cut.select(asset, "window_index", begin.alias("token_start"), F.least(begin + size, n).alias("token_end"), F.array_join(F.slice(F.col(column), begin + 1, F.lit(size)), " ").alias("body"))


def window_gaps(found: DataFrame, tokens: DataFrame, asset: str, column: str) -> DataFrame:
    """Assets whose windows do not cover exactly their tokens; empty when all is well."""
    covered = found.groupBy(asset).agg(F.min("token_start").alias("lo"), F.max("token_end").alias("hi"), F.sum(F.col("token_end") - F.col("token_start")).alias("n"))
    sizes = tokens.where(F.size(column) > 0).select(asset, F.size(column).alias("size"))
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("size")) & (F.col("n") == F.col("size"))
    return sizes.join(covered, asset, "left").where(~F.coalesce(whole, F.lit(False))).select(asset)


def unsafe_windows(found: DataFrame, asset: str, most_positions: int = 16383, most_bytes: int = 1 << 20) -> DataFrame:
    """Windows over the limits of positions or bytes."""
    return found.where((F.col("token_end") - F.col("token_start") > most_positions) | (F.octet_length("body") >= most_bytes)).select(asset, "window_index")


def stale_projections(units: DataFrame, projected: DataFrame, version: str) -> DataFrame:
    """Units without a projection of this version: an anti-join, so the delta of an up-to-date corpus is empty."""
    current = projected.where(F.col("version") == version).select("asset_id")
    return units.join(current, "asset_id", "left_anti")


def orphans(projected: DataFrame, units: DataFrame) -> DataFrame:
    return projected.join(units.select("asset_id"), "asset_id", "left_anti")


def ranking_metrics(ranked: DataFrame, judged: DataFrame, k: int) -> DataFrame:
    """recall, precision and nDCG at k of each query, from (query_id, item_id, score) and graded (query_id, item_id, grade)."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    top = ranked.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
    gain = lambda position: (F.pow(F.lit(2.0), F.col("grade")) - 1) / F.log2(position + 1)
    hits = top.join(judged.where("grade > 0"), ["query_id", "item_id"]).groupBy("query_id").agg(F.count("*").alias("hits"), F.sum(gain(F.col("position"))).alias("dcg"))
    ideal_order = W.partitionBy("query_id").orderBy(F.desc("grade"), "item_id")
    ideal = judged.where("grade > 0").withColumn("position", F.row_number().over(ideal_order))
    ideal = ideal.groupBy("query_id").agg(F.count("*").alias("relevant"), F.sum(F.when(F.col("position") <= k, gain(F.col("position")))).alias("idcg"))
    joined = ideal.join(hits, "query_id", "left")
    return joined.select(
        "query_id",
        F.round(F.coalesce("hits", F.lit(0)) / F.col("relevant"), 6).alias("recall"),
        F.round(F.coalesce("hits", F.lit(0)) / k, 6).alias("precision"),
        F.round(F.coalesce(F.col("dcg") / F.col("idcg"), F.lit(0.0)), 6).alias("ndcg"),
    )


def lexical_score(query: Sequence[str], fields: Mapping[str, Column], points: Mapping[str, int]) -> Column:
    """Points of each field for each query token that the field's joined tokens contain as a substring."""
    total = F.lit(0)
    for name, joined in fields.items():
        for token in dict.fromkeys(query):
            total = total + F.when(F.contains(F.coalesce(joined, F.lit("")), F.lit(token)), points[name]).otherwise(0)
    return total


def evaluation_score(lexical: Column, direct: Column, section: Column, preferred: Column, distance: Column) -> Column:
    """Lexical points, 200 for a direct route, 100 for a section, 50 for the preferred type, and at least 1 near a hit."""
    near = F.when(distance.isNotNull(), F.greatest(F.lit(1), 6 - distance)).otherwise(0)
    return lexical + F.when(direct, 200).otherwise(0) + F.when(section, 100).otherwise(0) + F.when(preferred, 50).otherwise(0) + near
