"""N-gram Jaccard join with adaptive multi-match prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.shared import attach, cut, freed, keep_ids, python_rows
from tidemark.llm.shingles import shingle_sets

#: Prefix tokens that more than so many sets share are not joined pair by pair.
LONG_LIST = 64

#: A chunk of sets of so many tokens reports those that so many of its sets share, to order them last.
CHUNK_TOKENS, CHUNK_REPEATS = 4_000_000, 4

#: Frequent tokens that a plan may hold; the least frequent are left out, which costs time only.
MOST_FREQUENT = 400_000

#: Prefix tokens that a pair may have to share, the share of candidates that each further one leaves, and costs in list rows.
MOST_MATCHES, FALL, VERIFY_COST, PLAIN_FREQUENCY = 4, 0.3, 20.0, 1.5

#: Set keys that a task remembers, to emit copies once.
MOST_MET = 300_000

#: Parts that the rows of a frequent token are dealt over.
FREQUENT_PARTS = 64

#: Sets on either side of a block that compares the members of a long list.
BLOCK_ROWS, BLOCK_COLUMNS, BLOCK_TOKENS = 256, 512, 4096


def least_overlap(n: int, num: int, den: int) -> int:
    """Tokens that a set of n must share with any set of Jaccard similarity num / den or more."""
    return -(-n * num // den)


def prefix_lengths(frequency: np.ndarray, num: int, den: int) -> tuple[int, int]:
    """Matches to ask for and the prefix's length for a set whose tokens, in order, are so frequent.

    Asking for one more match makes the prefix one token longer, so each more list is read, but leaves fewer candidates.
    """
    n = len(frequency)
    overlap = least_overlap(n, num, den)
    best, best_cost = 1, float("inf")
    running = np.cumsum(frequency)
    for matches in range(1, min(MOST_MATCHES, overlap) + 1):
        lists = float(running[n - overlap + matches - 1])
        others = lists - (n - overlap + matches)
        cost = lists + VERIFY_COST * others * FALL ** (matches - 1)
        if cost < best_cost:
            best, best_cost = matches, cost
    return best, n - overlap + best


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """Each document's set size and set key; and, as rows without doc_id size, tokens that many sets of a chunk share."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def shared() -> pd.DataFrame:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= CHUNK_REPEATS
            return pd.DataFrame({"doc_id": None, "n": counts[often].astype(np.int64), "key": tokens[often].view(np.int64), "is_token": True})

        for batch in batches:
            sizes, keys = [], []
            for tokens in shingle_sets(batch["text"].tolist(), width):
                sizes.append(len(tokens))
                keys.append(int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True))
                held.append(tokens)
                size += len(tokens)
                if size >= CHUNK_TOKENS:
                    yield shared()
                    held.clear()
                    size = 0
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "n": np.array(sizes, dtype=np.int64), "key": np.array(keys, dtype=np.int64), "is_token": False})
        if held:
            yield shared()

    kind = dict(docs.dtypes)["doc_id"]
    # As text, an id keeps its digits in pandas, where whole numbers with nulls among them would become floating point.
    signed = python_rows(docs.select(F.col("doc_id").cast("string"), "text")).mapInPandas(freed(sign), "doc_id string, n long, key long, is_token boolean")
    return signed.withColumn("doc_id", F.col("doc_id").cast(kind))


def _prefixes(docs: DataFrame, width: int, frequent: dict[str, np.ndarray], num: int, den: int) -> DataFrame:
    """Prefix tokens of every set: frequent tokens last, else in the order of hashes. Rows: token, key, n, matches, frequent.

    A task emits a set once, however many copies it meets.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens_known, counts_known = shared.value["tokens"], shared.value["counts"]
        met: set[int] = set()
        for batch in batches:
            tokens_out, keys, sizes, asked, often = [], [], [], [], []
            if len(met) > MOST_MET:
                met.clear()
            for tokens in shingle_sets(batch["text"].tolist(), width):
                n = len(tokens)
                if not n:
                    continue
                key = int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)
                if key in met:
                    continue
                met.add(key)
                frequency = np.full(n, PLAIN_FREQUENCY)
                known = np.zeros(n, dtype=bool)
                if len(tokens_known):
                    at = np.minimum(np.searchsorted(tokens_known, tokens), len(tokens_known) - 1)
                    known = tokens_known[at] == tokens
                    if known.any():
                        frequency[known] = counts_known[at[known]]
                        order = np.argsort(known, kind="stable")
                        tokens, frequency, known = tokens[order], frequency[order], known[order]
                matches, length = prefix_lengths(frequency, num, den)
                tokens_out.append(tokens[:length].view(np.int64))
                keys.append(np.full(length, key))
                sizes.append(np.full(length, n))
                asked.append(np.full(length, matches))
                often.append(known[:length])
            if tokens_out:
                yield pd.DataFrame({"token": np.concatenate(tokens_out), "key": np.concatenate(keys), "n": np.concatenate(sizes), "matches": np.concatenate(asked), "frequent": np.concatenate(often)})

    return python_rows(docs.select("text")).mapInPandas(freed(rows), "token long, key long, n int, matches int, frequent boolean")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """key and tokens of every set."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [t for t in shingle_sets(batch["text"].tolist(), width) if len(t)]
            keys = [int.from_bytes(hashlib.blake2b(t.tobytes(), digest_size=8).digest(), "little", signed=True) for t in found]
            yield pd.DataFrame({"key": np.array(keys, dtype=np.int64), "tokens": [t.view(np.int64) for t in found]})

    return python_rows(docs.select("text")).mapInPandas(freed(rows), "key long, tokens array<long>")


def block_links(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Boolean matrix of the pairs at the threshold. Tokens of one set only can't be shared and are left out."""
    sizes = [np.array([len(t) for t in side], dtype=np.int64) for side in (left, right)]
    tokens, counts = np.unique(np.concatenate([*left, *right]), return_counts=True)
    tokens = tokens[counts > 1]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, len(tokens), BLOCK_TOKENS):
        part = tokens[first : first + BLOCK_TOKENS]
        sides = []
        for side in (left, right):
            matrix = np.zeros((len(side), len(part)), dtype=np.float32)
            for row, values in enumerate(side):
                at = np.searchsorted(part, values)
                held = at < len(part)
                held[held] = part[at[held]] == values[held]
                matrix[row, at[held]] = 1.0
            sides.append(matrix)
        common += sides[0] @ sides[1].T
    overlap = np.rint(common).astype(np.int64)
    return den * overlap >= num * (sizes[0][:, None] + sizes[1][None, :] - overlap)


def _long_list_links(members: DataFrame, sets: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of a long list that are not yet in one component.

    ``members`` (family, key) share a prefix token. All members of a family's largest component are known to be connected;
    each other member is held against all members, in blocks, and reports one partner per component.
    """
    labelled = cut(members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")))
    largest = labelled.groupBy("family", "label").count().groupBy("family").agg(F.max_by("label", F.struct("count", "label")).alias("largest"), F.sum("count").alias("members"))
    largest = cut(largest)
    # One row a family, so a family of any size is not brought together by this.
    open_members = attach(labelled, largest, "family", largest.count(), "inner").withColumn("is_open", F.col("label") != F.col("largest"))
    counts = open_members.groupBy("family").agg(F.count_if("is_open").alias("open"), F.count("*").alias("members")).where("open > 0")
    counts = counts.select("family", F.ceil(F.col("open") / BLOCK_ROWS).cast("int").alias("rows"), F.ceil(F.col("members") / BLOCK_COLUMNS).cast("int").alias("columns"))
    counts = cut(counts)
    dealt = cut(attach(open_members, counts, "family", counts.count(), "inner").select("family", "key", "label", "is_open", "rows", "columns"))
    with_sets = dealt.join(sets, "key")
    place = F.xxhash64("key")
    right = with_sets.select("family", "key", "label", "tokens", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), F.pmod(place, F.col("columns")).alias("column"), F.lit(False).alias("asks"))
    left = with_sets.where("is_open").select("family", "key", "label", "tokens", F.pmod(place, F.col("rows")).alias("row"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"), F.lit(True).alias("asks"))
    both = left.select("family", "key", "label", "tokens", F.col("row").cast("int").alias("row"), F.col("column").cast("int").alias("column"), "asks").union(
        right.select("family", "key", "label", "tokens", F.col("row").cast("int"), F.col("column").cast("int"), "asks")
    )

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        asks = block["asks"].to_numpy(dtype=bool)
        rows, columns = block[asks], block[~asks]
        if not len(rows) or not len(columns):
            return pd.DataFrame({"a": np.zeros(0, dtype=np.int64), "b": np.zeros(0, dtype=np.int64)})
        linked = block_links([np.asarray(t).view(np.uint64) for t in rows["tokens"]], [np.asarray(t).view(np.uint64) for t in columns["tokens"]], num, den)
        linked &= rows["label"].to_numpy()[:, None] != columns["label"].to_numpy()[None, :]
        at, to = np.nonzero(linked)
        found = pd.DataFrame({"a": rows["key"].to_numpy()[at], "b": columns["key"].to_numpy()[to], "label": columns["label"].to_numpy()[to]})
        return found.groupby(["a", "label"], as_index=False)["b"].min()[["a", "b"]]

    return both.groupBy("family", "row", "column").applyInPandas(compare, "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every document: the least doc_id that links reach, itself included.

    Two documents link when their sets of ``width``-word shingles (A to Z in lower case) have Jaccard similarity num / den or
    more. A text with fewer words is one shingle; without words, or null, it is empty and linked with nothing.

    Equal sets are one class and linked without being joined. Of each class's set a prefix is kept: with tokens that many sets
    share last, else in the order of hashes, the first n - overlap + m of n, where a pair must share m prefix tokens to be
    verified; m follows from the lists' estimated cost, and a pair must share the lesser of its two. Lists of up to
    ``LONG_LIST`` sets are joined. The members of a longer list are verified against its least member; those that this does not
    connect are held against all members in blocks, so that copies by the thousand yield no pairs among themselves. Counts of
    list lengths cover all documents; if they show long lists, those tokens are ordered last too and prefixes drawn anew.
    Repeated rows and ties are ordinary; an empty table gives no rows.
    """
    signed = cut(_signatures(docs, width))
    documents = signed.where("not is_token").select("doc_id", F.col("n").alias("n_shingles"), "key")
    classes = cut(documents.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("first_doc")))
    often = signed.where("is_token").groupBy("key").agg(F.sum("n").alias("count"))
    frequent = _collected(often)
    lists = cut(_list_lengths(_prefixes(docs, width, frequent, num, den)))
    new_long = lists.where(F.col("length") > LONG_LIST).select(F.col("token").alias("key"), F.col("length").alias("count"))
    more = _collected(new_long)
    unseen = ~np.isin(more["tokens"], frequent["tokens"])
    if unseen.any():
        tokens = np.concatenate([frequent["tokens"], more["tokens"][unseen]])
        order = np.argsort(tokens)
        frequent = {"tokens": tokens[order], "counts": np.concatenate([frequent["counts"], more["counts"][unseen]])[order]}
    # One exchange: a window counts each list in place. Frequent tokens' lists are long anyway; their rows are dealt over parts.
    part = F.when(F.col("frequent"), F.pmod("key", F.lit(FREQUENT_PARTS))).otherwise(F.lit(0))
    prefixes = _prefixes(docs, width, frequent, num, den).withColumn("part", part)
    together = W.partitionBy("token", "part")
    counted = prefixes.withColumns({"length": F.count("*").over(together), "lo": F.min("key").over(together), "hi": F.max("key").over(together)})
    met = counted.where("frequent or lo < hi").withColumn("length", F.when(F.col("frequent"), F.lit(LONG_LIST + 1)).otherwise(F.col("length")))
    listed = cut(met.select("token", "part", "key", "n", "matches", "length").distinct())
    light = listed.where(F.col("length") <= LONG_LIST)
    other = light.select("token", F.col("key").alias("key_b"), F.col("n").alias("n_b"), F.col("matches").alias("matches_b"))
    fitting = (den * F.least("n", "n_b") >= num * F.greatest("n", "n_b")) & (F.col("key") < F.col("key_b"))
    shared = light.join(other, "token").where(fitting).groupBy("key", "key_b").agg(F.count("*").alias("shared"), F.first(F.least("matches", "matches_b")).alias("asked"))
    pairs = shared.where("shared >= asked").select(F.col("key").alias("a"), F.col("key_b").alias("b"))
    long = listed.where(F.col("length") > LONG_LIST).select("token", "key", "n")
    pivots = long.groupBy("token").agg(F.min("key").alias("family"))
    members = cut(long.join(pivots, "token").select("family", "key").distinct())
    stars = members.where("family <> key").select(F.col("family").alias("a"), F.col("key").alias("b"))
    pairs = cut(pairs.union(stars).distinct())
    needed = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).union(members.select("key")).distinct()
    ids = cut(needed.join(classes, "key").select(F.col("first_doc").alias("doc_id")))
    some = keep_ids(docs.select("doc_id", "text"), ids, "doc_id", ids.count())
    sets = cut(_sets(some, width).dropDuplicates(["key"]))
    a, b = sets.select(F.col("key").alias("a"), F.col("tokens").alias("tokens_a")), sets.select(F.col("key").alias("b"), F.col("tokens").alias("tokens_b"))
    overlap = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - overlap
    links = cut(pairs.join(a, "a").join(b, "b").where(den * overlap >= num * union).select("a", "b"))
    labels = cut(connected_components(links))
    if members.limit(1).count():
        known = labels.select(F.col("node").alias("key"), "label")
        further = cut(_long_list_links(members, sets, known, num, den))
        if further.limit(1).count():
            labels = cut(connected_components(links.union(further)))
    linked = labels.join(classes, labels["node"] == classes["key"]).select("key", "label", "first_doc")
    least = linked.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    linked = cut(linked.join(least, "label").select("key", "component_id"))
    merged = attach(classes, linked, "key", linked.count()).select("key", F.coalesce("component_id", "first_doc").alias("component_id"))
    return documents.join(merged, "key", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _list_lengths(prefixes: DataFrame) -> DataFrame:
    """Tokens that the prefixes of two sets or more have. Copies of a set in other tasks count each; that only makes a list look longer."""
    return prefixes.groupBy("token").agg(F.count("*").alias("length"), F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("token", "length")


def _collected(counts: DataFrame) -> dict[str, np.ndarray]:
    """The most frequent tokens, at most ``MOST_FREQUENT``, sorted by token."""
    rows = counts.orderBy(F.desc("count"), "key").limit(MOST_FREQUENT).toPandas()
    tokens = rows["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return {"tokens": tokens[order], "counts": rows["count"].to_numpy(dtype=float)[order]}
