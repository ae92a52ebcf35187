"""Publication checks, rebuilt runs, queue pages and windows on planted cases."""

from datetime import date

import pytest

from tidemark.operators import intake, publication, views

UNIT = "processing_run_id string, document_id string, asset_id long, order_index int, payload_kind string, payload string, title string, heading_path array<string>, semantic_key string, quality_status string"


def units(spark):
    rows = [(run, "d", 10 * k + i, i, "text", '{"text":"%d"}' % i, "t", ["h"], "k", "ok") for k, run in enumerate(["good", "twice", "gap", "moved", "hash", "total", "json"]) for i in (1, 2)]
    rows = [(r[0], "e" if r[0] == "moved" and r[3] == 2 else r[1], 11 if r[0] == "twice" else r[2], 3 if r[0] == "gap" and r[3] == 2 else r[3], r[4], "{" if r[0] == "json" and r[3] == 1 else r[5], *r[6:]) for r in rows]
    return intake.unit_hashes(spark.createDataFrame(rows, UNIT)).drop("hash_error")


def test_every_violation_of_a_run_is_named(spark):
    from pyspark.sql import functions as F

    stored = units(spark)
    stored = stored.withColumn("structure_hash", F.when((F.col("processing_run_id") == "hash") & (F.col("order_index") == 1), "sha256:0").otherwise(F.col("structure_hash")))
    runs = intake.sorted_hash(units(spark), ["processing_run_id"], "content_hash", "content_hash_aggregate").join(intake.ordered_hash(units(spark), ["processing_run_id"], ["order_index"], "structure_hash", "structure_hash"), "processing_run_id")
    runs = runs.withColumn("document_id", F.lit("d")).withColumn("structure_hash", F.when(F.col("processing_run_id") == "total", "x").otherwise(F.col("structure_hash")))
    found = {(r["processing_run_id"], r["reason"]) for r in publication.run_violations(runs, stored).collect()}
    assert found == {
        ("twice", "duplicate_asset_id"), ("gap", "order_index_not_contiguous"), ("moved", "document_mismatch"), ("hash", "structure_hash_mismatch"), ("total", "run_structure_hash_mismatch"), ("json", "canonical_json_invalid"),
    }
    assert publication.run_violations(runs.limit(0), stored).count() == 0


def test_windows_that_callers_ask_for():
    today = date(2024, 2, 10)
    assert publication.explicit_window(today) is None
    assert publication.explicit_window(today, 0) == (today, today) and publication.explicit_window(today, 9) == (date(2024, 2, 1), today)
    assert publication.explicit_window(today, None, date(2024, 1, 1), today) == (date(2024, 1, 1), today)
    for bad in [(-1,), (3, date(2024, 1, 1), today), (None, date(2024, 1, 1)), (None, None, today), (None, today, date(2024, 1, 1)), (None, today, date(2024, 2, 11))]:
        with pytest.raises(ValueError):
            publication.explicit_window(today, *bad)


def test_queue_pages_go_on_from_a_key_or_take_ids(spark):
    queue = spark.range(6).withColumnRenamed("id", "document_id")
    keys = lambda frame: [r[0] for r in frame.orderBy("document_id").collect()]
    assert keys(publication.queue_page(queue)) == list(range(6)) and keys(publication.queue_page(queue, after=3)) == [4, 5]
    assert keys(publication.queue_page(queue, ids=[5, 9, 1])) == [1, 5] and keys(publication.queue_page(queue, ids=[])) == []
    with pytest.raises(ValueError):
        publication.queue_page(queue, 1, [2])


def test_body_status(spark):
    rows = spark.createDataFrame([("text", '{"text":""}', "t"), ("text", '{"text":""}', None), ("text", '{"text":"x"}', None), ("table", '{"text":""}', "t"), ("text", None, "t")], "kind string, payload string, title string")
    assert [r[0] for r in rows.select(views.body_status(rows.kind, rows.payload, rows.title)).collect()] == ["heading_only", "empty", "content", "content", "content"]
