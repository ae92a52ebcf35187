"""Each training-data operator against plain Python on a small table with nulls, blanks, copies, long texts and odd columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, jaccard, linededup, mainhtml, mixing, packing, quality, repeats, sharding, shingles, tiff
from tidemark.llm.queries import base_failed, spans_text, tokenizer_path
from tidemark.llm.shared import word_count

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, line string, token long, label string"


def make_texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long_text = "\n".join(say(40) for _ in range(120))
    passage = say(45)
    base = say(150).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1 :]) for k in range(0, 150, 7)]
    lines = "This is one line of the page.\nThis is one lime of the page.\nshort\nshort\n\n \nThis is one line of the pages."
    texts = [None, "", " \n\t", "one", "two words", "two words", "a b c", long_text, long_text, long_text + " end", passage, say(30) + "\n" + passage, passage + " " + say(30)]
    texts += near + [" ".join(base)] * 3 + [lines, lines.replace("short", "shirt"), "Repeat me " * 80, "É à ü " * 30, "# * $ % | < >", "tail\x0bvertical\x0cfeed\rreturn hard"]
    return texts + [say(rng.randint(1, 200)) for _ in range(40)]


TEXTS = make_texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or ""), "k", "s", "l", i, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


# Sharding


def test_best_fit_takes_the_tightest_bin_and_the_largest_first():
    bins, left = sharding.best_fit_decreasing([5, 7, 3, 5], 10)
    assert bins == [1, 0, 0, 1] and left == [0, 0]
    bins, left = sharding.best_fit_decreasing([4, 4], 0, [5, 4])
    assert sorted(bins) == [0, 1] and sum(left) == 1


def test_capacity_tree_stays_balanced_and_sorted():
    rng = random.Random(1)
    tree, held = sharding.CapacityTree(), set()
    for _ in range(600):
        if held and rng.random() < 0.4:
            item = rng.choice(sorted(held))
            tree.remove(item)
            held.discard(item)
        else:
            item = (rng.randint(0, 50), rng.randint(0, 10**6))
            if item not in held:
                tree.add(item)
                held.add(item)
        size = rng.randint(0, 55)
        assert tree.tightest(size) == min((x for x in held if x[0] >= size), default=None)
    assert tree._height(tree.root) <= 1.45 * np.log2(len(held) + 2)


def test_shards_are_even_gapless_and_keep_groups(docs, nothing):
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"), F.coalesce(F.md5("text"), F.lit("null")).alias("text_key"))
    out = sharding.shard_groups(rows, "text_key", "size", n_shards=3).toPandas()
    assert len(out) == len(TEXTS)
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 3 and sizes.max() - sizes.min() < 0.3 * sizes.sum()
    groups = out.groupby("text_key").agg(bytes=("size", "sum"), shards=("shard", "nunique"))
    assert (groups[groups["bytes"] <= -(-sizes.sum() // 3)]["shards"] == 1).all() and (groups["shards"] > 1).sum() <= 1
    for _, part in out.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    empty = nothing.select("doc_id", F.lit(1).cast("long").alias("size"), F.lit("x").alias("text_key"))
    assert sharding.shard_groups(empty, "text_key", "size", n_shards=3).count() == 0


def test_fixed_capacity_opens_few_shards_and_large_groups_are_dealt(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(10).cast("long").alias("size"), F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    out = sharding.shard_groups(rows, "g", "size", capacity=1000, divide_large=True).toPandas()
    used = out.groupby("shard")["size"].sum()
    assert used.max() <= 1000 and len(used) <= 23 and len(out) == 2000


# Packing


@pytest.mark.parametrize("lengths", [[], [1], [2048] * 5, [1500] * 40, [5] * 300, [1, 2, 3, 2047, 1024, 1024, 600, 700, 748]])
def test_plan_fills_every_sequence(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.PackingPlan(histogram, 2048)
    filled = defaultdict(list)
    for length, n in histogram.items():
        table = np.array(plan.ranges[length]).reshape(-1, 3)
        for number in range(n):
            first, sequence, offset = table[np.searchsorted(table[:, 0], number, "right") - 1].tolist()
            if sequence >= 0:
                filled[sequence + number - first].append((offset, length))
            else:
                for _, part, at, inside in plan.stream_parts(offset + (number - first) * length, length):
                    filled[at].append((inside, part))
    assert len(filled) == plan.sequences
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048 and (end & (end - 1) == 0)


def test_least_squares_uses_combinations_of_the_histogram():
    histogram = np.zeros(101, dtype=np.int64)
    histogram[[60, 40, 50, 30, 20]] = [10, 10, 8, 6, 6]
    patterns = packing.combinations(np.flatnonzero(histogram), 100)
    counts = packing.solve_counts(patterns, histogram)
    assert (patterns.sum(axis=1) == 100).all() and (counts >= 0).all()
    used = np.zeros(101)
    for row, n in zip(patterns, counts):
        for v in row:
            used[v] += n
    assert abs(used[1:] - histogram[1:]).max() < 0.6


def test_words_are_encoded_as_the_tokenizer_does():
    import pyarrow as pa
    from tokenizers import Tokenizer

    odd = [*TEXTS, "Hello's <|endoftext|> ΑΣ ́x á İx ² don't 123 #$ naïve_a", "日本語。 नमस्ते ªʰ Ǆx ẞ Ⅷ .,. ,,", "a" * 300]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for text, ids in zip(odd, packing.WordEncoder(tokenizer_path()).encode(pa.array(odd, pa.string()))):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packed_pieces_cover_every_document(docs, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    out = packing.pack_sequences(docs, tokenizer_path(), window=64).toPandas()
    for doc_id, pieces in out.sort_values("start").groupby("doc_id"):
        ids = np.array(tokenizer.encode(TEXTS[doc_id] or "", add_special_tokens=False).ids + [1], dtype="<u4")
        end = 0
        for p in pieces.itertuples():
            assert p.start == end and p.doc_tokens == len(ids)
            end += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : end].tobytes())
        assert end == len(ids)
    assert out["doc_id"].nunique() == len(TEXTS)
    for _, parts in out.sort_values("offset").groupby("sequence_id"):
        end = 0
        for p in parts.itertuples():
            assert p.offset == end
            end += p.length
        assert end <= 64 and end & (end - 1) == 0
    assert packing.pack_sequences(nothing, tokenizer_path()).count() == 0


# Preference formatting


def test_preferences_share_a_prompt_and_mask_the_rest(spark):
    rows = [
        (1, True, 0, "user", "hi"), (1, True, 1, "assistant", "yes <|x"), (1, False, 0, "user", "hi"), (1, False, 1, "assistant", "no"), (1, False, 2, "user", None),
        (2, True, 0, "user", "alone"), (3, True, 0, "user", "a"), (3, False, 0, "user", "a"), (4, False, 1, None, "x"), (4, False, 1, None, "x"),
        (5, True, 0, "user", "a"), (5, True, 1, "assistant", "b"), (5, False, 0, "user", "a"), (None, True, 0, "user", "lost"),
    ]
    frame = spark.createDataFrame(rows, "pair_id long, is_chosen boolean, turn long, role string, text string")
    out = {r["pair_id"]: r for r in chat.format_preferences(frame).withColumn("spans", spans_text("chosen_spans")).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    one = out[1]
    assert one["status"] == "pair" and one["n_common"] == 1 and one["prompt"] == "<|user|>\nhi<|end|>\n"
    assert one["chosen"] == "<|assistant|>\nyes < |x<|end|>\n"
    begin, end = map(int, one["spans"].split(":"))
    assert one["chosen"][begin:end] == "yes < |x<|end|>"
    assert out[2]["status"] == "no_rejected" and out[2]["rejected"] is None
    assert out[3]["status"] == "identical" and out[4]["status"] == "no_chosen" and out[5]["status"] == "prefix"
    assert chat.format_preferences(frame.limit(0)).count() == 0


# Line dedup


def edit_distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def test_lines_that_come_again_or_nearly_so_go(docs, nothing):
    out = linededup.dedup_lines(docs, 1, 20).toPandas().set_index("doc_id")
    first, order = {}, []
    for doc_id, text in enumerate(TEXTS):
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\x0b\x0c\r") and line not in first:
                first[line] = len(order)
                order.append(line)
    near = {a for a in order if len(a) >= 20 and any(len(b) >= 20 and first[b] < first[a] and edit_distance_one(a, b) for b in order)}
    seen = set()
    for doc_id, text in enumerate(TEXTS):
        kept, removed = [], 0
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\x0b\x0c\r"):
                gone = line in seen or line in near
                seen.add(line)
                removed += gone
                if gone:
                    continue
            kept.append(line)
        row = out.loc[doc_id]
        assert row["n_removed"] == removed, doc_id
        assert row["kept"] == (None if text is None else "\n".join(kept))
    assert "This is one lime of the page." in near and "This is one line of the pages." in near
    assert linededup.dedup_lines(nothing).count() == 0
    assert {"key", "line", "token"} <= set(out.columns)


# Quality rules


def plain_statistics(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_statistics_and_base(docs, nothing):
    out = quality.text_statistics(docs, ["doc_id"]).withColumn("failed", base_failed()).toPandas().set_index("doc_id")
    for doc_id, text in enumerate(TEXTS):
        n, chars, symbols, dup, rep = plain_statistics(text) if len(text or "") < 20000 else quality.statistics_of(text)
        row = out.loc[doc_id]
        assert tuple(row[quality.STATISTICS]) == (n, chars, symbols, dup, rep), doc_id
        assert row["failed"] == (n < 50 or 100 * rep > 50 * n)
    assert quality.text_statistics(nothing, ["doc_id"]).count() == 0


def test_decision_list_finds_planted_rules():
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"a": rng.uniform(0, 1, 3000), "b": rng.uniform(0, 1, 3000), "c": rng.uniform(0, 1, 3000)})
    bad = ((rows["a"] > 0.9) | ((rows["b"] < 0.2) & (rows["c"] > 0.5))).to_numpy()
    rules = quality.learn_decision_list(rows[:2000], bad[:2000], ["a", "b", "c"])
    verdict = np.zeros(1000, dtype=bool)
    for rule in rules:
        verdict |= quality.covers(rule, rows[2000:])
    assert (verdict == bad[2000:]).mean() > 0.97 and (verdict & ~bad[2000:]).mean() < 0.01
    assert quality.learn_decision_list(rows[:0], bad[:0], ["a"]) == [] and quality.learn_decision_list(rows, np.zeros(3000, dtype=bool), ["a"]) == []


def test_rules_become_one_ordered_expression(spark):
    rules = [(quality.Condition("n_words", False, 3.0),), (quality.Condition("symbol_share", True, 0.5), quality.Condition("n_words", True, 4.0))]
    frame = spark.createDataFrame([(2, 0.9), (5, 0.6), (9, 0.1), (None, None)], "n_words long, symbol_share double")
    assert [r[0] for r in frame.select(quality.decision_column(rules)).collect()] == [1, 2, 0, 0]


# Mixing


def test_mix_comes_near_its_targets(docs, nothing):
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    out = mixing.mix_sources(sized).toPandas()
    again = mixing.mix_sources(sized).toPandas()
    assert out.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()
    assert out.set_index("doc_id")["size"].to_dict() == {i: len(words_of(t)) for i, t in enumerate(TEXTS)}
    assert (out["taken"] <= 3 * out["size"]).all() and (out["taken"] % out["size"].clip(1) == 0).all()
    out["source"] = out["source"].fillna("~null")
    sizes = out.groupby("source")["size"].sum()
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(sizes.index))}
    target, open_ = {}, set(sizes.index)
    while open_:
        level = (sizes.sum() - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] <= level * weight[s]}
        target |= {s: 3.0 * sizes[s] for s in full} if full else {s: level * weight[s] for s in open_}
        open_ = open_ - full if full else set()
    for source, part in out.groupby("source"):
        assert part["target"].iloc[0] == pytest.approx(target[source])
        assert abs(part["taken"].sum() - target[source]) <= part["size"].max() / 2 + 1
    assert mixing.mix_sources(nothing.select("doc_id", "source", F.lit(1).cast("long").alias("size"))).count() == 0


# HTML


PAGE = (
    "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/x>Menu</a></ul></nav>"
    "<div class='ad'>Buy, buy, buy it now, all of you.</div><article><h1>Head &amp; tail</h1><p><b>First, with   a comma.<br>Second&nbsp;line<p>Next, please, read on, and on.</p>"
    "<div class='share'>Tweet</div></article><aside>Side</aside><div id=comments><p>I think, well, that it is, hm, good.</p></div><footer>&copy; x</footer><p"
)


def test_main_text_is_the_article():
    assert mainhtml.main_text(PAGE) == "Head & tail First, with a comma. Second line Next, please, read on, and on."
    assert mainhtml.main_text(None) == "" and mainhtml.main_text("") == "" and mainhtml.main_text("<nav>x</nav>") == ""
    assert mainhtml.main_text("plain &lt;text&gt;") == "plain <text>"
    assert mainhtml.main_text("<div><p>" + "a, b. " * 30000 + "</div>").startswith("a, b.")
    assert mainhtml.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert mainhtml.main_text("<p>unclosed <i>a<p>b<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>") == "unclosed a b x y 1 2 3"


def test_main_text_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "z"), (2, None, None, "z"), (3, "v", "<p>ü", "z")], "page_id long, url string, html string, text string")
    out = {r["page_id"]: r for r in mainhtml.extract_main_text(pages).collect()}
    assert out[1]["n_chars"] == len(out[1]["text"]) and out[2]["text"] == "" and out[3]["n_chars"] == 1
    assert mainhtml.extract_main_text(pages.limit(0)).count() == 0


# Substring dedup


def test_automaton_knows_every_substring_and_its_earliest_place():
    rng = random.Random(3)
    automaton, ends = repeats.SuffixAutomaton(), defaultdict(list)
    sequences = [[rng.randint(0, 2) for _ in range(rng.randint(1, 12))] for _ in range(60)]
    for sequence in sequences:
        place = rng.randint(0, 10**6)
        automaton.add(sequence, place)
        for a in range(len(sequence)):
            for b in range(a + 1, len(sequence) + 1):
                ends[tuple(sequence[a:b])].append(place + b - 1)
    automaton.settle()
    for sequence in [*sequences, *([rng.randint(0, 3) for _ in range(15)] for _ in range(20))]:
        for end, (matched, first) in enumerate(automaton.matching_statistics(sequence, 4), 1):
            assert (matched >= 4) == (end >= 4 and tuple(sequence[end - 4 : end]) in ends)
            assert first == (min(ends[tuple(sequence[end - 4 : end])]) if matched >= 4 else repeats.NEVER)
        for end, (matched, _) in enumerate(automaton.matching_statistics(sequence, 10**6), 1):
            assert matched == max((end - s for s in range(end) if tuple(sequence[s:end]) in ends), default=0)


def without_repeats(rows, window=20):
    """Plain Python over (doc_id, text): the words left of each row, by (doc_id, text)."""
    first = {}
    for doc_id, text in rows:
        words = words_of(text)
        for start in range(len(words) - window + 1) if doc_id is not None else ():
            key = tuple(words[start : start + window])
            first[key] = min(first.get(key, (doc_id, start)), (doc_id, start))
    out = {}
    for doc_id, text in rows:
        words = words_of(text)
        gone = np.zeros(len(words), dtype=bool)
        for start in range(len(words) - window + 1) if doc_id is not None else ():
            gone[start : start + window] |= first[tuple(words[start : start + window])] < (doc_id, start)
        out[doc_id, text] = b" ".join(w for w, g in zip(words, gone) if not g).decode(), int(gone.sum())
    return out


def held_against_plain_python(frame, rows):
    out = frame.collect()
    expected = without_repeats(rows)
    assert len(out) == len(rows)
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in out)
    assert found == sorted((str(d), len(words_of(t)), expected[d, t][1], expected[d, t][0]) for d, t in rows)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in out)


def test_repeated_windows_go(docs, nothing):
    held_against_plain_python(repeats.remove_repeats(docs, 20), list(enumerate(TEXTS)))
    assert repeats.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("hot", [3, 1000])
def test_repeated_windows_of_rows_that_share_an_id_or_have_none(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_PASSAGES", hot)
    monkeypatch.setattr(repeats, "SHARD_PASSAGES", 50)
    rng = random.Random(hot)
    word = lambda: "".join(rng.choice("abcde") for _ in range(4))
    phrase, line = " ".join(word() for _ in range(16)), " ".join(word() for _ in range(30))
    say = lambda n: " ".join(word() for _ in range(n))
    a, tail = say(60), say(30)
    rows = [(1, a), (2, a + " " + tail), (2, "other " + say(40)), (2, say(7) + " " + tail), (2, a + " " + tail), (None, a), (3, None), (3, "")]
    rows += [(10 + k % 150, f"{say(rng.randint(0, 30))} {phrase} {say(rng.randint(0, 30))}") for k in range(200)]
    rows += [(400 + k, f"{say(5)} {line} {say(4)} {line}\n{line}") for k in range(60)] + [(500 + k, phrase + " x y z " + phrase) for k in range(5)]
    rows += [(600, ("a " * 300)), (601, "a b " * 100 + say(10)), (602, "b a " * 90)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "w") for d, t in rows], "doc_id long, text string, words string").repartition(5)
    held_against_plain_python(repeats.remove_repeats(docs, 20), rows)


# TIFF


@pytest.mark.parametrize("scheme", list(tiff.SCHEMES))
def test_tiff_round_trips(scheme):
    rng = np.random.default_rng(4)
    for predictor in (1, 2):
        for tile in (None, (16, 32)):
            for order in "<>":
                for kind in (np.uint8, np.uint16):
                    pages = [rng.integers(0, (3, 250)[k % 2], size=(rng.integers(1, 70), rng.integers(1, 90), (1, 3)[k % 2])).astype(kind) for k in range(3)]
                    found = list(tiff.walk_pages(tiff.encode_tiff(pages, scheme, predictor, 7, tile, order)))
                    assert [p.data for p in found] == [p.tobytes() for p in pages] and not any(p.error for p in found)
    big = rng.integers(0, 255, size=(120, 300, 1)).astype(np.uint8)
    assert next(tiff.walk_pages(tiff.encode_tiff([big], scheme))).data == big.tobytes()


def test_broken_tiff_is_an_error_row(spark):
    good = tiff.encode_tiff([np.zeros((4, 4, 1), dtype=np.uint8)] * 2)
    values = [(1, bytearray(good)), (2, None), (3, bytearray(b"")), (4, bytearray(b"II*\0")), (5, bytearray(good[:-30])), (6, bytearray(b"MM\0*\0\0\0\x08\xff\xff"))]
    out = tiff.decode_tiff(spark.createDataFrame(values, "id long, content binary"), "id", "content").toPandas()
    assert out[out["id"] == 1]["error"].isna().all() and (out["id"] == 1).sum() == 2
    assert {4, 5, 6} <= set(out[out["error"].notna()]["id"]) and not {2, 3} & set(out["id"])


def test_text_media(docs, nothing):
    out = tiff.text_media(docs).toPandas().set_index("doc_id")
    for doc_id, text in enumerate(TEXTS):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        row = out.loc[doc_id]
        assert (row["n_bytes"], row["payload_bytes"]) == (len(raw), len(payload)) and row["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        assert row["tail_crc32"] == zlib.crc32(payload[-32:])
    assert out.loc[7].drop("n_bytes").equals(out.loc[8].drop("n_bytes"))
    assert tiff.text_media(nothing).count() == 0


# Jaccard join


@pytest.mark.parametrize(("width", "num", "long_list"), [(3, 90, 64), (5, 80, 64), (3, 60, 4)])
def test_components_match_all_pairs(docs, nothing, monkeypatch, width, num, long_list):
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    out = jaccard.jaccard_components(docs, width, num, 100).toPandas().set_index("doc_id")
    sets = []
    for text in TEXTS:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    least = list(range(len(sets)))
    find = lambda x: x if least[x] == x else find(least[x])
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                least[y] = x
    assert out["n_shingles"].to_dict() == {i: len(s) for i, s in enumerate(sets)}
    assert out["component_id"].to_dict() == {i: find(i) for i in range(len(sets))}
    if num == 90:
        assert jaccard.jaccard_components(nothing).count() == 0


def test_prefixes_lengthen_with_cost():
    assert jaccard.prefix_lengths(np.full(100, 1.5), 90, 100)[0] >= 1
    frequent = np.concatenate([np.full(11, 500.0), np.full(89, 1.0)])
    assert jaccard.prefix_lengths(frequent, 90, 100)[0] > jaccard.prefix_lengths(np.full(100, 1.0), 90, 100)[0] - 1
    assert jaccard.prefix_lengths(np.ones(1), 90, 100) == (1, 1)


def test_block_links_are_exact():
    rng = np.random.default_rng(6)
    left = [np.unique(rng.integers(0, 40, size=rng.integers(1, 30)).astype(np.uint64)) for _ in range(20)]
    found = jaccard.block_links(left, left, 50, 100)
    for i, a in enumerate(left):
        for j, b in enumerate(left):
            common = len(set(a.tolist()) & set(b.tolist()))
            assert found[i, j] == (100 * common >= 50 * (len(a) + len(b) - common))


def test_shingles_lower_ascii_only():
    a, b, c = shingles.shingle_sets(["The Cat sat", "the cat SAT", "the cÀt sat"], 3)
    assert np.array_equal(a, b) and not np.array_equal(a, c)
