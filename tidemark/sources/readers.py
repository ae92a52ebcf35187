"""Reading: date windows, record mapping with rejects, watchlists, providers behind the Python Data Source API."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

WATCHLIST = "code string, exchange string, name string, status string"


def date_windows(spark: SparkSession, start: date, end: date, chunk_days: int) -> DataFrame:
    """Consecutive windows of at most ``chunk_days`` that cover [start, end], both ends inclusive."""
    if end < start or chunk_days < 1:
        raise ValueError("the range or the chunk is empty")
    step = f"interval {int(chunk_days)} day"
    starts = F.expr(f"explode(sequence(date'{start}', date'{end}', {step}))")
    return spark.range(1).select(starts.alias("window_start")).withColumn("window_end", F.least(F.date_add("window_start", chunk_days - 1), F.lit(end)))


def parsed_date(text: Column) -> Column:
    """20240131, 2024-01-31 and 2024/01/31, with or without a time; null for anything else."""
    day = F.replace(F.split(F.trim(text), " ")[0], F.lit("/"), F.lit("-"))
    return F.when(day.rlike(r"^\d{8}$"), F.try_to_date(day, "yyyyMMdd")).when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(day, "yyyy-MM-dd"))


def map_records(rows: DataFrame, required: Mapping[str, str], optional: Mapping[str, str], dates: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Provider records as (mapped, rejected). Blank strings are null; a record without a required field, or a date that can't be read, is rejected with its reasons."""
    clean = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    columns = {name: parsed_date(clean(source)) if name in dates else clean(source) for name, source in {**required, **optional}.items()}
    missing = [F.when(columns[name].isNull(), F.lit(name)) for name in required]
    unreadable = [F.when(clean(optional[name]).isNotNull() & columns[name].isNull(), F.lit(name)) for name in dates if name in optional]
    judged = rows.select("*", F.array_compact(F.array(*missing, *unreadable)).alias("_reasons"), F.struct(*[c.alias(n) for n, c in columns.items()]).alias("_mapped"))
    return judged.where(F.size("_reasons") == 0).select("_mapped.*"), judged.where(F.size("_reasons") > 0).withColumn("reasons", F.array_join("_reasons", ",")).drop("_reasons", "_mapped")


def combined(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Two channels in one frame with the name of the channel; columns that one lacks are null."""
    return first.withColumn("channel", F.lit(names[0])).unionByName(second.withColumn("channel", F.lit(names[1])), allowMissingColumns=True)


def read_watchlist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WATCHLIST).option("header", True).csv(path)


def content_addressed(files: DataFrame) -> DataFrame:
    """binaryFile rows with their content's digest; rows of one path and different digests are in conflict."""
    hashed = files.select("path", "length", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("digest"))
    conflicts = hashed.groupBy("path").agg((F.countDistinct("digest") > 1).alias("conflict"))
    return hashed.join(conflicts, "path")


def read_bundle(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Parser output: multi-line JSON under an explicit schema; records that don't fit land in ``_corrupt_record``."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


class _Part(InputPartition):
    def __init__(self, request: dict):
        self.request = request


def provider_source(name: str, schema: str, fetch: Callable[[dict], Iterator[tuple]], requests: Sequence[dict]) -> type[DataSource]:
    """A batch data source of one partition per request; ``fetch`` runs on executors, yields tuples and never writes."""

    class Reader(DataSourceReader):
        def partitions(self):
            return [_Part(dict(request)) for request in requests]

        def read(self, partition):
            yield from fetch(partition.request)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

    return Source
