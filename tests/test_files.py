"""Readers and writers of files, on small folders."""

import datetime

from tidemark.operators import routing
from tidemark.sources import readers, sinks


def test_watchlists_and_bundles(spark, tmp_path):
    (tmp_path / "list.csv").write_text("code,exchange,name,status\n000001,SZ,One,active\n600000,SH,,\n")
    rows = readers.read_watchlist(spark, str(tmp_path / "list.csv")).collect()
    assert [(r["code"], r["name"]) for r in rows] == [("000001", "One"), ("600000", None)]
    (tmp_path / "a.json").write_text('{"id": 1,\n "blocks": [{"text": "x"}]}')
    (tmp_path / "b.json").write_text('{"id": "no number"')
    found = readers.read_bundle(spark, f"{tmp_path}/*.json", "id long, blocks array<struct<text: string>>, _corrupt_record string").collect()
    assert {(r["id"], r["_corrupt_record"] is None) for r in found} == {(1, True), (None, False)}


def test_content_is_addressed_by_its_digest(spark):
    files = spark.createDataFrame([("a", 1, bytearray(b"x")), ("a", 1, bytearray(b"y")), ("b", 1, bytearray(b"x")), ("b", 1, bytearray(b"x"))], "path string, length long, content binary")
    found = readers.content_addressed(files).collect()
    assert {(r["path"], r["conflict"]) for r in found} == {("a", True), ("b", False)} and len({r["digest"] for r in found}) == 2 and all(r["digest"].startswith("sha256:") for r in found)


def test_only_written_partitions_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    row = lambda d, v: spark.createDataFrame([(d, v)], "day string, v int")
    sinks.write_partitions(row("a", 1).union(row("b", 2)), path, "day")
    sinks.write_partitions(row("b", 3), path, "day")
    assert sorted((r["day"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]
    sinks.reload_dimension(row("c", 4), f"{tmp_path}/d")
    sinks.reload_dimension(row("c", 5), f"{tmp_path}/d")
    assert [r["v"] for r in spark.read.parquet(f"{tmp_path}/d").collect()] == [5]


def test_orphans_are_old_files_without_an_owner(spark):
    now = datetime.datetime(2024, 1, 3)
    old, new = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2, 23)
    files = spark.createDataFrame([("r/a/1", old), ("r/b/1", old), ("r/c/1", new), ("r/d", old)], "path string, modified_at timestamp_ntz")
    owned = spark.createDataFrame([("r/a",), ("r/d",)], "path string")
    assert [r["path"] for r in sinks.orphan_files(files, owned, now).select("path").collect()] == ["r/b/1"]


def test_units_that_a_model_could_decide(spark):
    scored = spark.createDataFrame([(1, "a", 60), (1, "b", 55), (2, "a", 60), (3, "a", routing.UNSCOPED_EXACT), (3, "b", 60)], "unit_id int, label_key string, score int")
    assert [r[0] for r in routing.adjudicable(scored).collect()] == [1]
