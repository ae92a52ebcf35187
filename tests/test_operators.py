"""Operators and functions on small inputs: cursors, filters, contracts, templates, folds, sources, streams."""

import json
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import python_side as py
from tidemark.functions import text as tx
from tidemark.operators import filters, intake, keyset, queues, relations, rules, search, structure, validation
from tidemark.sources import readers, registry, sinks
from tidemark.streaming import change_feed


def column(frame, expression):
    return [r[0] for r in frame.select(expression).collect()]


def test_pages_follow_each_other(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else i % 4) for i in range(25)], "id long, v long")
    for keys in ([keyset.Key("v", True), keyset.Key("id", True)], [keyset.Key("v"), keyset.Key("id")], [keyset.Key("v", False, False), keyset.Key("id")]):
        seen, cursor = [], None
        while True:
            page, cursor = keyset.fetch_page(rows, keys, 7, cursor)
            seen += [r["id"] for r in page]
            if cursor is None:
                break
        assert sorted(seen) == list(range(25)) and seen == [r["id"] for r in rows.orderBy(*[k.order() for k in keys]).collect()]
    with pytest.raises(keyset.CursorError):
        keyset.decode_cursor("!!", 2)
    with pytest.raises(ValueError):
        keyset.checked_limit(0)


def test_filter_arguments_are_checked():
    assert filters.comma_values(" a, ,b ") == ["a", "b"] and filters.comma_values(None) is None
    for bad in (lambda: filters.comma_values(" , "), lambda: filters.contains_any_case("x", " "), lambda: filters.checked_keys(["Bad"])):
        with pytest.raises(ValueError):
            bad()
    for bad in (lambda: filters.key_list("a,,b"), lambda: filters.key_list(""), lambda: filters.checked_keys(["abc\n"]), lambda: filters.checked_keys(["a"] * 51)):
        with pytest.raises(ValueError):
            bad()
    assert filters.key_list(" b, a,b ") == ["b", "a"] and filters.key_list(None) is None


def test_rules_on_null_and_blank_codes(spark):
    docs = spark.createDataFrame([(1, "0101||02", "x"), (2, None, "LOW"), (3, " || ", "LOW"), (4, "77", "LOW"), (5, "02", "HIGH")], "id long, codes string, title string")
    table = spark.createDataFrame([("class", "01", "annual", 90), ("class", "02", "interim", 80), ("title", "LOW", "low", 1), ("title_topic", "HIGH", "high", 85)], "rule_set string, prefix string, value string, priority int")
    out = {r["id"]: r for r in rules.classify(docs, table, "id", "codes", "title").collect()}
    assert [out[k]["filing_type"] for k in range(1, 6)] == ["annual", "low", "other", "other", "high"]
    assert out[5]["topics"] == ["high"] and out[1]["topics"] is None


def test_multisets_pair_once(spark):
    make = lambda rows: spark.createDataFrame(rows, "id long, kind string, content string, projection string")
    old = make([(1, "t", "a", "p"), (2, "t", "a", "p"), (3, "t", "a", "q"), (4, "t", "z", "p")])
    new = make([(11, "t", "a", "p"), (12, "t", "a", "r"), (13, "t", "b", "p")])
    pairs = relations.multiset_pair(old, new, "id", ["kind", "content", "projection"], ["kind", "content"], [])
    found = sorted((r["change"], r["old_id"], r["new_id"]) for r in pairs.collect())
    assert [f[0] for f in found] == ["changed", "created", "removed", "removed", "unchanged"]
    events = relations.outbox_events(pairs, "r").orderBy("seq").collect()
    assert [e["seq"] for e in events] == [1, 2, 3, 4, 5] and events[-1]["event"] == "run.published"


def test_intake_keeps_the_revert_semantics(spark):
    rows = [(k, "key", h, 1, None) for k, h in enumerate(["A", "B", "A", "C"])] + [(9, "key", "D", 0, None), (10, "key", "D", 1, "refused")]
    incoming = spark.createDataFrame(rows, "observed_at long, semantic_key string, content_hash string, n_records int, error string")
    existing = spark.createDataFrame([], "dedup_key string")
    out = {r["observed_at"]: r for r in intake.register_snapshots(incoming, existing).collect()}
    assert [out[k]["outcome"] for k in (0, 1, 2, 3, 9, 10)] == ["materialized", "materialized", "observed", "materialized", "empty", "error"]
    assert [k for k in out if out[k]["is_active"]] == [3]


def test_unit_hashes_change_with_their_part_only(spark):
    base = ("text", '{"text":"x"}', "T", ["a"], ["k"], "ok", 1)
    changed = [base, (*base[:2], "U", *base[3:]), (*base[:6], 2), (base[0], '{"text":"y"}', *base[2:])]
    schema = "payload_kind string, payload string, title string, heading_path array<string>, semantic_keys array<string>, quality_status string, order_index int"
    a, title, order, payload = intake.unit_hashes(spark.createDataFrame(changed, schema)).select("content_hash", "query_projection_hash", "structure_hash").collect()
    assert a[0] == title[0] and a[1] != title[1] and a[2] == title[2]
    assert a[0] == order[0] and a[1] == order[1] and a[2] != order[2]
    assert a[0] != payload[0]


def test_record_sets_sort_keys_as_text(spark):
    rows = spark.createDataFrame([("g", 10, "x"), ("g", 9, None)], "g string, k long, v string")
    import hashlib

    expected = hashlib.sha256(b'[{"k":10,"v":"x"},{"k":9,"v":null}]').hexdigest()
    assert column(intake.recordset_hash(rows, ["g"], ["k"], ["k", "v"]), "content_hash") == [expected]


def test_heading_fold():
    frame = pd.DataFrame({"position": [1, 2, 3, 4, 5], "rank": [1, 2, 3, 2, 1], "weak": [False, False, True, False, False], "title": list("abcde")})
    out = structure.fold_headings(frame)
    assert out["path"].tolist() == [["a"], ["a", "b"], ["a", "b", "c"], ["a", "d"], ["e"]] and out["level"].tolist() == [1, 2, 3, 2, 1]
    assert list(structure.admit_missing_member([1, 2, None, 4])) == [False, False, True, False]


def test_windows_cover_tokens(spark):
    tokens = spark.createDataFrame([(1, list("abcdefg")), (2, []), (3, ["x"])], "id long, tokens array<string>")
    found = search.windows(tokens, "id", "tokens", 3)
    assert sorted((r["id"], r["token_start"], r["token_end"], r["body"]) for r in found.collect()) == [(1, 0, 3, "a b c"), (1, 3, 6, "d e f"), (1, 6, 7, "g"), (3, 0, 1, "x")]
    assert search.window_gaps(found, tokens, "id", "tokens").count() == 0 and search.window_gaps(found.where("token_start <> 3"), tokens, "id", "tokens").count() == 1


def test_search_channels(spark):
    docs = spark.createDataFrame([(1, "alpha", "beta gamma"), (2, "beta", "alpha"), (3, "delta", "x")], "id long, title string, body string")
    posted = search.postings(docs, "id", {"title": search.index_tokens(F.col("title")), "body": search.index_tokens(F.col("body"))})
    assert sorted(column(search.match_words(posted, [["alpha"], ["beta"]], "id"), "id")) == [1, 2]
    ranked = {r["id"]: r["rank"] for r in search.weighted_rank(posted, ["alpha"], "id").collect()}
    assert ranked[1] > ranked[2]
    atoms = docs.select("id", F.col("body").alias("atom"))
    assert column(search.match_atoms(atoms, "ta ga", "id"), "id") == [1] and search.match_atoms(atoms, "ta", "id").count() == 0
    assert column(spark.range(1), search.cjk_tokens(F.lit("年度报告 2024 abc"))) == [["年度", "度报", "报告", "2024", "abc"]]


def test_functions(spark):
    one = spark.range(1)
    value = lambda c: column(one, c)[0]
    assert value(py.nfkc_casefold(F.lit("Ｓtraße"))) == "strasse"
    assert value(tx.asset_uri("s", 1, "k", F.lit("a b/ü*~"))) == "asset://s/v1/k/a%20b%2F%C3%BC%2A~"
    assert value(tx.folded_crc32(F.lit("worker"))) in range(-(2**31), 2**31)
    assert value(tx.ulid_millis(F.lit("01ARZ3NDEKTSV4RRFFQ69G5FAV"))) == 1469922850259
    assert value(tx.title_similarity(F.lit("abcdef"), F.lit("abcdef"))) == pytest.approx(1.0) and value(tx.title_similarity(F.lit("abc"), F.lit("abc"))) == 0.0
    assert value(tx.numbering(F.lit("第一章 x")))["rank"] == 1 and value(tx.numbering(F.lit("plain")))["family"] is None
    assert value(tx.canonical_security(F.lit(" 600000 "), F.lit("szse")))["error"] == "exchange mismatch"
    assert value(tx.report_period(F.lit("2024 Q3 report"), F.lit("quarterly"))) == "2024Q3" and value(tx.report_period(F.lit("none"), F.lit("annual"))) is None
    assert value(tx.suspicious_glyphs(F.lit("!@#$%^&*()_+{}|:<>?~a!b@c#d"))) is True
    assert [py.ordinal_value(t) for t in ("十", "二十三", "一百零五", "7", "x")] == [10, 23, 105, 7, None]
    assert [py.ordinal_value(t) for t in ("零", "一二", "三万", "十万零两千〇三", "零百", "", None, "万", "五x")] == [None, 2, 30000, 102003, 100, None, None, None, None]
    assert py.visible_text("<p>a<script>x</script> b<td>c</td>") == "a b c" and py.visible_segments("<td>a</td><td>b</td>") == ["a", "b"]
    assert [c["role"] for c in py.cell_roles("<table><tr><td>n</td><td>v</td><td>w</td></tr><tr><td>x</td><td>1</td><td>2</td></tr></table>")][:4] == ["header", "header", "header", "value"]
    assert py.canonical_json('{"b": 1, "a": "é"}') == '{"a":"é","b":1}' and "NaN" in py.canonical_json('{"a": NaN}', False)
    with pytest.raises(ValueError):
        py.canonical_json('{"a": NaN}')


def test_contracts_and_templates(spark):
    with pytest.raises(registry.ContractError):
        registry.Contract("k", {"a": "int"}, ["b"])
    parameters = [registry.Parameter("p", True, None, [1, 2]), registry.Parameter("q", False, 5)]
    assert registry.checked_request(parameters, {"p": 1}) == {"p": 1, "q": 5}
    for bad in ({"p": 3}, {}, {"p": 1, "z": 1}):
        with pytest.raises(registry.ContractError):
            registry.checked_request(parameters, bad)
    good = "SELECT a FROM t WHERE a = :x"
    registry.checked_template(good, ["x"], "a = :x", 10)
    for sql, binds in ((good + "; SELECT 1", ["x"]), ("SELECT * FROM t WHERE a = :x", ["x"]), ("DELETE FROM t WHERE a = :x", ["x"]), (good, ["x", "y"]), ("SELECT a FROM t WHERE b = :x", ["x"])):
        with pytest.raises(registry.ContractError):
            registry.checked_template(sql, binds, "a = :x", 10)
    frames = {"old": spark.createDataFrame([(date(2020, 1, 1),)], "d date"), "new": spark.createDataFrame([(date(2021, 1, 1),)], "d date")}
    assert registry.active_table(frames, "d") == "new" and registry.active_table(frames, "d", "old") == "old"
    assert registry.choose_variant([({"k": 1}, "one"), ({}, "other")], {"k": 2}) == "other"


def test_contract_files(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"key": "a"}))
    assert list(registry.load_contracts(str(tmp_path))) == ["a"]
    (tmp_path / "b.json").write_text(json.dumps({"key": "c"}))
    with pytest.raises(registry.ContractError):
        registry.load_contracts(str(tmp_path))


def test_snapshots_are_verified(spark, tmp_path):
    rows = spark.createDataFrame([(1, "ü"), (2, None)], "id long, t string")
    assert sinks.write_snapshot(rows, str(tmp_path / "s"))[0] == 2
    assert spark.read.schema(rows.schema).json(str(tmp_path / "s")).count() == 2
    with pytest.raises(sinks.SnapshotError):
        sinks.write_snapshot(rows, str(tmp_path / "s"))


def test_records_map_or_are_rejected(spark):
    raw = spark.createDataFrame([("1", "20240131", "t"), ("2", "2024/02/01 10:00:00", " "), ("3", "31.01.2024", "t")], "a string, b string, c string")
    mapped, rejected = readers.map_records(raw, {"id": "a", "day": "b"}, {"title": "c"}, ["day"])
    assert sorted((r["id"], r["day"], r["title"]) for r in mapped.collect()) == [("1", date(2024, 1, 31), "t"), ("2", date(2024, 2, 1), None)]
    assert column(rejected, "reasons") == ["day"]


def test_provider_source(spark):
    def fetch(request):
        yield from ((request["start"] + k, "row") for k in range(3))

    source = readers.provider_source("tidemark_test", "id int, kind string", fetch, [{"start": 0}, {"start": 10}])
    spark.dataSource.register(source)
    assert sorted(r["id"] for r in spark.read.format("tidemark_test").load().collect()) == [0, 1, 2, 10, 11, 12]


def test_orphan_files(spark):
    files = spark.createDataFrame([("a/b/c", datetime(2024, 1, 1)), ("a/x", datetime(2024, 1, 1)), ("n/new", datetime(2024, 1, 9, 23))], "path string, modified_at timestamp_ntz")
    owned = spark.createDataFrame([("a/b",)], "path string")
    now = datetime(2024, 1, 10)
    out = sinks.orphan_files(files.withColumn("modified_at", F.col("modified_at").cast("timestamp")), owned, now)
    assert column(out, "path") == ["a/x"]


def test_stream_counts_by_window(spark, tmp_path):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 5), "a"), (datetime(2024, 1, 1, 6), "a"), (datetime(2024, 1, 9), "b")], "ts timestamp_ntz, event_type string")
    rows.write.parquet(str(tmp_path / "in"))
    counts = change_feed.event_counts(change_feed.follow(spark, str(tmp_path / "in"), rows.schema))
    found = {}
    query = counts.writeStream.outputMode("update").foreachBatch(lambda b, i: found.update({(r["event_type"]): r["n"] for r in b.collect()})).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert found == {"a": 2, "b": 1}


def test_validation(spark):
    rows = spark.createDataFrame([("document_unit", "text", "a", ["a"]), ("document_unit", "note", "a", ["b"]), ("x", None, None, None)], "asset_kind string, payload_kind string, k string, ks array<string>")
    assert validation.illegal_kinds(rows).count() == 2 and validation.bad_key_sets(rows, "k", "ks").count() == 1
    errors = spark.createDataFrame([('{"stage":"parse","retryable":true}',), ("{}",), ("not json",), (None,)], "error string")
    assert validation.bad_retry_errors(errors, "error").count() == 3
    assert validation.not_exactly_one(spark.createDataFrame([(1, None), (1, 2), (None, None)], "a int, b int"), ["a", "b"]).count() == 2


def test_stale_runs(spark):
    runs = spark.createDataFrame([(1, "running", datetime(2024, 1, 1)), (2, "running", datetime(2024, 1, 2)), (3, "failed", datetime(2024, 1, 1))], "id long, status string, started_at timestamp_ntz")
    out = queues.reclaim_stale(runs.withColumn("error", F.lit(None).cast("string")), F.expr("timestamp_ntz'2024-01-02 01:00:00'"), F.expr("interval 2 hour"))
    assert {r["id"]: r["status"] for r in out.collect()} == {1: "failed", 2: "running", 3: "failed"}
