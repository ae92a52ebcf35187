"""What a Python worker gets at once."""

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import python_side as py
from tidemark.operators import intake

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def hashed(spark, n, characters):
    """Units of one partition, and the bytes of the payloads that came to a worker together with each."""
    # Made here, so that the workers get it whole: they can't import the tests.
    together = F.pandas_udf(lambda payload: pd.Series([int(payload.str.len().sum())] * len(payload)), "long")
    units = spark.range(0, n, 1, 1).select(
        "id", F.lit("text").alias("payload_kind"), F.to_json(F.struct(F.concat(F.repeat(F.lit("x"), characters), F.col("id").cast("string")).alias("text"))).alias("payload"), F.lit("t").alias("title"),
        F.array(F.lit("h")).alias("heading_path"), F.lit("ok").alias("quality_status"), F.col("id").alias("order_index"),
    )
    return intake.unit_hashes(units).withColumn("together", together("payload"))


def test_units_come_to_a_worker_in_batches_of_bounded_bytes(spark):
    former = spark.conf.get(KEY, None)
    spark.conf.unset(KEY)
    try:
        rows = hashed(spark, 2_000, 20_000).select("id", "content_hash", "hash_error", "together").collect()
    finally:
        if former is not None:
            spark.conf.set(KEY, former)
    assert len(rows) == 2_000 and max(r["together"] for r in rows) < 10_000_000
    for r in rows[::500]:
        assert r["hash_error"] is None and r["content_hash"] == py.unit_identity({"payload_kind": "text"}, {"text": "x" * 20_000 + str(r["id"])})[0]


def test_a_limit_that_the_session_sets_is_kept(spark):
    former = spark.conf.get(KEY, None)
    spark.conf.set(KEY, "2m")
    try:
        assert max(r["together"] for r in hashed(spark, 400, 20_000).select("together").collect()) < 3_000_000 and spark.conf.get(KEY) == "2m"
    finally:
        spark.conf.unset(KEY) if former is None else spark.conf.set(KEY, former)
