"""Pieces that several of the training-data operators use."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from tidemark.session import cut, ensure_checkpoint_dir, python_rows

__all__ = ["cut", "ensure_checkpoint_dir", "table", "word_count", "number_rows", "keep_ids", "attach", "attach_lists", "python_rows", "freed", "map_rows", "delete_folder", "release", "few", "set_aside", "unused", "WORD"]

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes that a side may have to be broadcast; beyond it the same join shuffles.
BROADCAST_BYTES = 32_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def freed(stage: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A Python stage that gives memory back when its task ends: workers live on and would keep it from other stages.

    Arrow uses the system's allocator, whose free memory can be given back; its own pool would keep a second reserve.
    """

    def run(batches: Iterator) -> Iterator:
        pa.set_memory_pool(pa.system_memory_pool())
        yield from stage(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark writes to."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Arrow types of the columns that ``map_rows`` adds.
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<struct<start: int, end: int>>": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))}


def map_rows(rows: DataFrame, keep: list[str], read: list[str], added: dict[str, str], measure: Callable[..., list[tuple]]) -> DataFrame:
    """The columns ``keep`` of every row, and those that ``measure`` makes of the lists of the columns ``read``, a tuple a row.

    Kept columns pass as Arrow arrays: in pandas, whole numbers with nulls among them would become floating point and lose digits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*measure(*(batch.column(c).to_pylist() for c in read)))) or [()] * len(added)
            arrays = [batch.column(c) for c in keep] + [pa.array(values, ARROW[kind]) for values, kind in zip(made, added.values())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *added])

    schema = ", ".join([f"`{c}` {t}" for c, t in rows.select(*keep).dtypes] + [f"{c} {t}" for c, t in added.items()])
    return python_rows(rows.select(*dict.fromkeys([*keep, *read]))).mapInArrow(freed(run), schema)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of frames that are no longer used; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def word_count(text: Column) -> Column:
    """Number of words, JVM-side; null and blank texts have none.

    With the leading white space off, splitting on white space leaves one piece a word, and an empty last
    piece where the text ends in white space; a blank text is one empty piece.
    """
    pieces = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]++|[\x20\x09-\x0D]++$", ""), r"[\x20\x09-\x0D]++")
    blank = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return F.when(blank, F.size(pieces)).otherwise(F.lit(0)).cast("long")


def number_rows(rows: DataFrame, group: list[str], order: list[str], name: str, n_rows: int, per_bucket: int = 4_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in buckets of about ``per_bucket`` rows.

    A hash of the order columns deals a group's rows over buckets, counts per bucket become each bucket's first
    number, and only the rows of one bucket are sorted together; so a group may hold any share of all rows.
    ``rows`` is read twice and should be materialised.
    """
    n_buckets = max(1, -(-n_rows // per_bucket))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n_buckets)))
    starts = (
        dealt.groupBy(*group, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.sum("_n").over(W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)))
        .select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_bucket").alias("_gb"), F.coalesce("_start", F.lit(0)).alias("_start"))
    )
    keys = [dealt[c].eqNullSafe(starts[f"_g{i}"]) for i, c in enumerate(group)] + [dealt["_bucket"] == starts["_gb"]]
    condition = keys[0]
    for key in keys[1:]:
        condition = condition & key
    inside = W.partitionBy(*group, "_bucket").orderBy(*order)
    return (
        dealt.join(starts, condition)
        .withColumn(name, (F.col("_start") + F.row_number().over(inside) - 1).cast("long"))
        .drop("_bucket", "_gb", "_start", *[f"_g{i}" for i in range(len(group))])
    )


def row_bytes(rows: DataFrame) -> int:
    """About what a row of fixed columns takes in a broadcast table."""
    def width(kind: T.DataType) -> int:
        return sum(width(f.dataType) for f in kind.fields) + 16 if isinstance(kind, T.StructType) else 32 if isinstance(kind, (T.StringType, T.BinaryType)) else 8

    return 32 + sum(width(f.dataType) for f in rows.schema.fields)


def few(rows: DataFrame, n_rows: int) -> bool:
    """Whether a side may be broadcast."""
    return n_rows * row_bytes(rows) <= BROADCAST_BYTES


def unused(name: str, rows: DataFrame) -> str:
    """A column name that the rows don't have."""
    there = {c.lower() for c in rows.columns}
    while name in there:
        name += "_"
    return name


def set_aside(rows: DataFrame, own: list[str], made: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows with the columns that an operator reads, all others in one struct, so that no name clashes; and what restores them.

    Columns named like those that the operator makes are replaced by these.
    """
    taken = {c.lower() for c in (*own, *made)}
    further = [c for c in rows.columns if c.lower() not in taken]
    held = F.struct(*[F.col(f"`{c}`") for c in further]) if further else F.lit(None).cast("int")

    def restored(out: DataFrame) -> DataFrame:
        return out.select(*own, *[F.col("_further").getField(c).alias(c) for c in further], *made)

    return rows.select(*own, held.alias("_further")), restored


def keep_ids(rows: DataFrame, ids: DataFrame, key: str, n_ids: int) -> DataFrame:
    """Rows whose key is among ``ids``: map-side while there are few ids, by a shuffle beyond."""
    side = ids.select(key)
    return rows.join(F.broadcast(side) if few(side, n_ids) else side, key, "left_semi")


def attach_lists(rows: DataFrame, facts: DataFrame, key: str | list[str], numbers: str, how: str = "left") -> DataFrame:
    """Join facts with an array of numbers a key: map-side if rows and numbers are few in bytes, by a shuffle beyond."""
    n_rows, n_numbers = facts.agg(F.count("*"), F.coalesce(F.sum(F.size(numbers)), F.lit(0))).first()
    small = n_rows * row_bytes(facts) + 8 * n_numbers <= BROADCAST_BYTES
    return rows.join(F.broadcast(facts) if small else facts, key, how)


def attach(rows: DataFrame, facts: DataFrame, key: str | list[str], n_facts: int, how: str = "left") -> DataFrame:
    """Join ``facts`` (one row a key) to rows: map-side while they are few in bytes, by a shuffle beyond."""
    return rows.join(F.broadcast(facts) if few(facts, n_facts) else facts, key, how)
