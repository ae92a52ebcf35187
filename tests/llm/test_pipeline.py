"""The pipeline's stages on a small corpus with planted cases."""

import random

import pytest


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, labels = [], []
    for i in range(160):
        junk = i % 4 == 3
        text = " ".join(w + "###" for w in say(110).split()) if junk else say(80) + ".\n" + say(30)
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, 0 if junk else 1, 0))
    base = say(120).split()
    for k in range(5):
        text = " ".join(base[: 20 * k] + ["edited"] + base[20 * k + 1 :])
        rows.append((200 + k, text, "en", "src0", len(text)))
    rows += [(300, rows[0][1], "en", "src1", rows[0][4]), (301, None, "en", None, None), (302, "", "en", "src2", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_take_effect(spark, corpus):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    good = p.quality_rules(spark, docs, corpus)
    ids = {r["doc_id"] for r in good.select("doc_id").collect()}
    assert not any(i % 4 == 3 for i in ids if i < 160) and {i for i in range(160) if i % 4 != 3} <= ids and {200, 204, 300, 301, 302} <= ids
    assert good.columns == p.COLUMNS
    lined = p.line_dedup(spark, docs, corpus)
    left = {r["doc_id"] for r in lined.select("doc_id").collect()}
    assert 300 not in left and {0, 301, 302, 200} <= left and lined.columns == p.COLUMNS
    unique = p.near_duplicates(spark, docs, corpus)
    kept = {r["doc_id"] for r in unique.select("doc_id").collect()}
    assert 300 not in kept and 200 in kept and not {201, 202, 203, 204} & kept and {301, 302} <= kept
    mixed = p.mix(spark, docs, corpus)
    assert mixed.columns == p.COLUMNS and mixed.count() > 0


def test_a_row_goes_by_its_own_text(spark, corpus):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    long_texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id in (0, 1, 200)").collect()}
    rows = [(7, long_texts[0], "en", "s", 1), (9, long_texts[0] + " more", "en", "s", 1), (9, long_texts[200], "en", "s", 1), (-3, long_texts[1], "en", "s", 1), (2, long_texts[1], "en", "s", 1), (None, long_texts[1], "en", "s", 1), (9, None, "en", "s", 1)]
    out = p.near_duplicates(spark, spark.createDataFrame(rows, docs.schema), corpus).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out) == sorted((str(r[0]), r[1] or "") for r in (rows[0], rows[2], rows[3], rows[5], rows[6]))


def test_the_run_is_the_stages_in_turn_and_packs_every_token(spark, corpus):
    import corpus_pipeline as p
    from tokenizers import Tokenizer

    from tidemark.llm.queries import tokenizer_path

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for _, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, corpus).cache()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    wanted = sorted((str(r["doc_id"]), len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in docs.collect())
    out = p.run(spark, corpus).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in out if r["start"] == 0) == wanted
    assert sum(r["length"] for r in out) == sum(n for _, n in wanted)
    used = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 2048 and all(n == 2048 or n & (n - 1) == 0 for n in used.values())
