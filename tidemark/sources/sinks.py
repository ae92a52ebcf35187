"""Writing: verified snapshots, replacement by key, overwritten dimensions, orphans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.relations import replace_keys, upsert


class SnapshotError(RuntimeError):
    """What was read back differs from what was written."""


def fingerprint(rows: DataFrame) -> tuple[int, int]:
    """Number of rows and an order-free sum of row hashes."""
    value = F.xxhash64(F.to_json(F.struct(*sorted(rows.columns)))).cast("decimal(38,0)")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(value), F.lit(0))).first()
    return int(n), int(total)


def write_snapshot(rows: DataFrame, path: str) -> tuple[int, int]:
    """JSON Lines into a staging folder beside the target, read back and compared, then renamed into place."""
    spark = rows.sparkSession
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    expected = fingerprint(rows)
    rows.write.json(staging)
    found = fingerprint(spark.read.schema(rows.schema).json(staging))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    source, target = hadoop(staging), hadoop(path)
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if found != expected:
        files.delete(source, True)
        raise SnapshotError(f"wrote {expected}, read {found}")
    if files.exists(target) or not files.rename(source, target):
        files.delete(source, True)
        raise SnapshotError(f"{path} is there already or can't be made")
    return expected


def write_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that the rows have."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merge_table(spark: SparkSession, path: str, incoming: DataFrame, key: list[str], target: str) -> None:
    """Upsert into a new version of a parquet table; the reader switches to ``target`` when it is complete."""
    upsert(spark.read.parquet(path), incoming, key).write.parquet(target)


def replace_children(spark: SparkSession, path: str, incoming: DataFrame, owner: str, owners: DataFrame, target: str) -> None:
    replace_keys(spark.read.parquet(path), incoming, owner, owners).write.parquet(target)


def reload_dimension(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def orphan_files(files: DataFrame, owned: DataFrame, now, age_hours: int = 24) -> DataFrame:
    """Files (path, modified_at) older than the age that no owner's path is or contains; what a dry run reports."""
    folders = files.withColumn("_owner", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("path", "/"))), lambda n: F.array_join(F.slice(F.split("path", "/"), F.lit(1), n), "/"))))
    kept = folders.join(owned.select(F.col("path").alias("_owner")), "_owner", "left_semi").select("path").distinct()
    return files.where(F.col("modified_at") < F.lit(now) - F.make_dt_interval(F.lit(0), F.lit(age_hours))).join(kept, "path", "left_anti")
