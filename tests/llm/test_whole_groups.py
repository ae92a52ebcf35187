"""Training-data operators on planted cases that a bound, a lot or a missing key would lose."""

import random

import pytest

from tidemark.llm import linededup


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def edited(rng, line, n):
    for _ in range(n):
        k = rng.randrange(len(line) + 1)
        line = rng.choice([line[:k] + "#" + line[k:], line[:k] + line[k + 1 :], line[:k] + "%" + line[k + 1 :]])
    return line


@pytest.mark.parametrize("max_edits, long_list, near_chars", [(1, 64, 20), (2, 64, 20), (2, 3, 20), (2, 3, 0), (1, 2, 0), (3, 64, 20), (3, 5, 9)])
def test_lines_within_the_edit_bound_go_and_one_beyond_stays(spark, monkeypatch, max_edits, long_list, near_chars):
    monkeypatch.setattr(linededup, "LONG_LIST", long_list)
    rng = random.Random(max_edits)
    bases = ["".join(rng.choice("abcdefghij é") for _ in range(rng.randint(24, 60))).replace(" ", "x", 1) for _ in range(8)]
    lines = list(dict.fromkeys(line for base in bases for line in [base, *[edited(rng, base, k % 5) for k in range(14)]]))
    rng.shuffle(lines)
    lines += ["the cat sat on the mat today", "the dog sat on the mat today", "the cat sat on the mat todays!", "la maison de la rue verte", "de maison de la rue verte"]
    lines += ["{", "ab", "abc", "mnopq", "mnopqrs", "xyz", "äöü€", "äö€", "12345678", "12345678901", "🙂🙂 words of a line here", "🙂🙂🙂 words of a line here"]
    far = [min((edit_distance(a, b) for b in lines[:i] if min(len(a), len(b)) >= near_chars), default=99) if len(a) >= near_chars else 99 for i, a in enumerate(lines)]
    assert max_edits in far and max_edits + 1 in far
    out = linededup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), max_edits=max_edits, near_chars=near_chars).collect()
    assert {r["doc_id"] for r in out if r["n_removed"]} == {i for i, d in enumerate(far) if d <= max_edits}


@pytest.mark.parametrize("max_edits, before, after", [(1, 26, 34), (2, 15, 15), (2, 50, 50)])
def test_lines_of_one_crowded_frame_are_not_compared_pair_by_pair(spark, monkeypatch, max_edits, before, after):
    limit, met, rounds = 4, [], []
    for name in ("LONG_LIST", "LONG_FINE_LIST"):
        monkeypatch.setattr(linededup, name, limit, raising=False)
    alike, opened = linededup._alike, getattr(linededup, "_open_items", None)

    def watched(later, members, edits):
        met.extend(r["count"] for r in members.groupBy("_key").count().collect())
        return alike(later, members, edits)

    monkeypatch.setattr(linededup, "_alike", watched)
    monkeypatch.setattr(linededup, "_open_items", lambda *a: rounds.append(a[-1]) or opened(*a), raising=False)
    rng = random.Random(before)
    head, tail = ("".join(rng.choice("abcdefghij klmnop") for _ in range(n)) for n in (before, after))
    lines = [f"{head}{''.join(rng.choice('qrstuvwx') for _ in range(5))}{tail}" for _ in range(24)]
    lines = list(dict.fromkeys(lines + [edited(rng, rng.choice(lines), 1 + k % 3) for k in range(14)]))
    rng.shuffle(lines)
    near = [any(edit_distance(a, b) <= max_edits for b in lines[:i]) for i, a in enumerate(lines)]
    assert 4 <= sum(near) <= len(lines) - 20
    out = linededup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), max_edits).collect()
    assert {r["doc_id"] for r in out if r["n_removed"]} == {i for i, gone in enumerate(near) if gone}
    assert max(met, default=0) <= limit and rounds


def test_rows_of_a_list_get_their_numbers_once(spark, monkeypatch):
    for name in ("LONG_LIST", "LONG_FINE_LIST"):
        monkeypatch.setattr(linededup, name, 4)
    alike, joined = linededup._alike, []

    def watched(later, members, edits):
        joined.extend("Join Inner" in side._jdf.queryExecution().optimizedPlan().toString() for side in (later, members))
        return alike(later, members, edits)

    monkeypatch.setattr(linededup, "_alike", watched)
    rng = random.Random(5)
    lines = [f"the order of {''.join(rng.choice('qrstuvwx') for _ in range(5))} went out" for _ in range(20)]
    lines += [line[:-1] + "!" for line in lines[5:9]]
    gone = {i for i, a in enumerate(lines) if any(edit_distance(a, b) <= 2 for b in lines[:i])}
    out = linededup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), 2).collect()
    assert {r["doc_id"] for r in out if r["n_removed"]} == gone and len(gone) >= 4
    assert len(joined) >= 4 and not any(joined)


def test_the_pipeline_bounds_the_lines_that_it_compares(spark, monkeypatch):
    import corpus_pipeline

    limit, met = 4, []
    for name in ("LONG_LIST", "LONG_FINE_LIST"):
        monkeypatch.setattr(linededup, name, limit, raising=False)
    alike = linededup._alike
    monkeypatch.setattr(linededup, "_alike", lambda later, members, edits: met.extend(r["count"] for r in members.groupBy("_key").count().collect()) or alike(later, members, edits))
    rng = random.Random(7)
    lines = [f"the order of {''.join(rng.choice('qrstuvwx') for _ in range(5))} went out" for _ in range(20)]
    lines += [line[:-1] + "!" for line in lines[5:9]]
    gone = {i for i, a in enumerate(lines) if any(edit_distance(a, b) <= 2 for b in lines[:i])}
    docs = spark.createDataFrame([(i, a, "en", "s", len(a)) for i, a in enumerate(lines)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()} == set(range(len(lines))) - gone
    assert 4 <= len(gone) and max(met, default=0) <= limit


def test_lines_of_rows_that_share_an_id_and_of_clashing_columns(spark):
    rows = [(1, "common line\nx"), (2, "common line\nrow A"), (2, "UNIQUE LINE\nrow B"), (2, "common line\nrow A"), (None, "common line"), (3, None), (4, ""), (5, "UNIQUE LINE\n\nnew one")]
    names = "_removed string, kept string, n_lines int, n_removed string, _copy string, line string, counts int"
    docs = spark.createDataFrame([(*r, "a", "b", 7, "c", "d", "e", 8) for r in rows], f"doc_id long, text string, {names}")
    out = linededup.dedup_lines(docs).collect()
    found = sorted((str(r["doc_id"]), str(r["kept"]), r["n_lines"], r["n_removed"], r["_removed"], r["_copy"], r["line"], r["counts"]) for r in out)
    expected = [(1, "common line\nx", 2, 0), (2, "row A", 2, 1), (2, "UNIQUE LINE\nrow B", 2, 1), (2, "row A", 2, 1), (None, "common line", 1, 0), (3, None, 0, 0), (4, "", 0, 0), (5, "\nnew one", 2, 1)]
    expected[2] = (2, "UNIQUE LINE", 2, 1)  # row B is within an edit of row A, which has the same doc_id and line number: neither is earlier
    expected[2] = (2, "UNIQUE LINE\nrow B", 2, 0)
    assert found == sorted((str(d), str(k), n, g, "a", "d", "e", 8) for d, k, n, g in expected)


def test_long_near_equal_lines_take_time_in_proportion(spark):
    import time

    rng = random.Random(4)
    line = "".join(rng.choice("abcdefghij éß") for _ in range(200_000))
    docs = spark.createDataFrame([(1, line), (2, line[:70_000] + "#" + line[70_001:150_000] + line[150_001:]), (3, line[:9] + "###" + line[12:])], "doc_id long, text string")
    began = time.time()
    assert {r["doc_id"]: r["n_removed"] for r in linededup.dedup_lines(docs, 2).collect()} == {1: 0, 2: 1, 3: 0}
    assert time.time() - began < 60


def test_production_uses_a_bound_of_two(spark, tmp_path):
    import corpus_pipeline
    from tidemark.llm import queries

    rows = [(1, "la maison de la rue verte", "fr", "s", 25), (2, "de maison de la rue verte", "fr", "s", 25), (3, "dans maison du la rue verte", "fr", "s", 27)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()} == {1, 3}
    assert {r["doc_id"]: r["n_removed"] for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 1, 3: 0}


def test_every_row_is_mixed_by_its_own_count(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F
    from tidemark.llm.mixing import mix_sources
    from tidemark.llm.shared import word_count

    rng = random.Random(3)
    rows = []
    for i in range(90):
        text = f"row{i} " + " ".join("w" for _ in range(rng.randint(1, 40)))
        doc_id = None if i % 5 == 0 else 1 if i % 7 == 0 else i
        rows.append((doc_id, text, "en", "abc"[i % 3], len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mix(spark, docs, "").collect()
    assert {tuple(r) for r in out} <= set(rows) and any(r["doc_id"] is None for r in out)
    planned = mix_sources(docs.select(*corpus_pipeline.COLUMNS, word_count(F.col("text")).alias("size"))).collect()
    copies = [r["text"] for r in out]
    for r in planned:
        assert copies.count(r["text"]) == r["repeats"]
    for source in "abc":
        target = next(r["target"] for r in planned if r["source"] == source)
        assert abs(sum(len(r["text"].split()) for r in out if r["source"] == source) - target) <= 41 / 2 + 1


def test_fixed_capacity_opens_few_shards_beyond_one_lot(spark):
    from pyspark.sql import functions as F
    from tidemark.llm import sharding

    n = 2 * sharding.LOT_GROUPS + 5000
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(100).cast("long").alias("size"), F.col("id").cast("string").alias("g"))
    shards = {r["shard"]: r for r in sharding.shard_groups(rows, "g", "size", capacity=100 * n).groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    assert list(shards) == [0] and shards[0]["n"] == n and shards[0]["bytes"] == 100 * n
