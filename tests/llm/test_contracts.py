"""Every registered query of the training-data operators on one awkward folder: column names, types and row counts, and rules that hold for any table."""

import random
import zlib

import pytest

from tidemark.llm import mixing, queries, sharding

COLUMNS = {
    "op1_shard_best_fit": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_pack_sequences": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op4_line_dedup": "doc_id bigint, n_lines bigint, n_removed bigint, kept_sha256 string",
    "op5_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_remove_repeats": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op9_text_media": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op10_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
}


def folder_of(spark, path, rows):
    clash = "kept string, n_removed string, shard int, slot int, target string, copy string, words string, key string, tokens string, _part int, `a.b` int"
    spark.createDataFrame([(*r, "k", "r", 1, 2, "t", "c", "w", "y", "z", 3, 4) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {clash}").write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], k % 2, 0) for k, r in enumerate(rows) if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long_text = "\n".join(say(30) for _ in range(4500))
    texts = [None, None, "", " \n", "one", long_text, long_text, say(80), say(80) + "\n" + say(3), *[say(rng.randint(0, 120)) for _ in range(60)]]
    rows = [(i, t, "en", [None, "a", "b", "hot", "hot"][i % 5], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (8, "another text of that id " + say(40), "de", "hot", 9), (None, say(50), None, None, None), (None, None, None, None, None), (2**60 + 1, say(20), "fr", "a", 1), (-5, say(20), "fr", "a", 1)]
    return folder_of(spark, tmp_path_factory.mktemp("awkward"), rows), rows


@pytest.fixture(scope="module")
def bare(spark, tmp_path_factory):
    return folder_of(spark, tmp_path_factory.mktemp("bare"), [])


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, awkward, bare, name):
    folder, rows = awkward
    out = queries.QUERIES[name](spark, folder)
    wanted = [tuple(c.rsplit(" ", 1)) for c in COLUMNS[name].split(", ")]
    assert out.dtypes[: len(wanted)] == wanted
    found = out.collect()
    if name == "op2_pack_sequences":
        assert {r["doc_id"] for r in found} == {r[0] for r in rows}
    else:
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    assert queries.QUERIES[name](spark, bare).count() == 0


def test_shards_are_even_and_checksums_right(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 2000) if i % 9 else "the same text again", "en", "s", 0) for i in range(3000)]
    folder = folder_of(spark, tmp_path, rows)
    found = queries.op1_shard_best_fit(spark, folder).collect()
    sizes = [0] * queries.SHARDS
    for r in found:
        text = rows[r["doc_id"]][1]
        assert r["size"] == len(text) + 16 and r["text_crc32"] == zlib.crc32(text.encode()) and r["law"] == "bytes"
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes) / len(sizes)
    assert max(abs(s - mean) for s in sizes) < 0.03 * mean
    for shard in range(queries.SHARDS):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))


def test_kept_follows_base_and_rules(spark, awkward):
    folder, _ = awkward
    for r in queries.op5_quality_rules(spark, folder).collect():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"]) and r["kept"] == (not failed and r["rule"] == 0)


def test_buckets_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    monkeypatch.setattr(mixing, "LEAST_DIGITS", 1)
    rows = [(i % 400, "ab"[i % 7 == 0], i % 13, "x", 1.5, 2) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long, target string, whole double, _end int")
    out = mixing.mix_sources(frame)
    assert out.columns == ["doc_id", "source", "size", "whole", "_end", "source_size", "target", "repeats", "taken"]
    found = out.collect()
    assert len(found) == 900 and {(r["whole"], r["_end"]) for r in found} == {(1.5, 2)}
    for source in "ab":
        mine = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 7
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10**6)
    assert sorted(map(tuple, mixing.mix_sources(frame).collect())) == sorted(map(tuple, found))


def test_shards_replace_columns_of_their_names(spark):
    frame = spark.createDataFrame([(1, "a", 5, 99, "s", 7), (2, "a", 5, 99, "s", 7), (3, "b", 5, 99, "s", 7)], "doc_id long, g string, size long, shard int, slot string, _part int")
    found = {r["doc_id"]: r for r in sharding.shard_groups(frame, "g", "size", n_shards=2).collect()}
    assert found[1]["shard"] == found[2]["shard"] != found[3]["shard"] and {found[1]["slot"], found[2]["slot"]} == {0, 1} and found[3]["_part"] == 7


def test_groups_stay_whole_and_the_other_shards_even(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, "hot " * 300 if i % 3 == 0 else "warm " * 60 if i % 5 == 0 else "x" * rng.randint(0, 900), "en", "s", 0) for i in range(4000)]
    found = queries.op1_shard_best_fit(spark, folder_of(spark, tmp_path, rows)).collect()
    shards, sizes = {}, [0] * queries.SHARDS
    for r in found:
        shards.setdefault(rows[r["doc_id"]][1], set()).add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shards.values())
    assert sharding.shard_rooms([50, 30, 10, 10], 100, 4) == [50, 30, 10, 10] and sharding.shard_rooms([5, 5], 10, 2) == [5, 5] and sharding.shard_rooms([], 0, 3) == [1, 1, 1]
    others = sorted(sizes)[:-2]
    mean = sum(others) / len(others)
    assert max(abs(s - mean) for s in others) < 0.03 * mean
    divided = sharding.shard_groups(spark.createDataFrame([(i, "g", 10) for i in range(400)], "doc_id long, g string, size long"), "g", "size", n_shards=4, divide_large=True)
    assert divided.select("shard").distinct().count() == 4
