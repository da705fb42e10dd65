"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lograil.shipping import ensure_shipped
from lograil.storage import discard, materialize, new_path

__all__ = ["append_columns", "digest64", "discard", "fresh", "heavy_limit", "join_heavy", "map_batches", "materialize", "new_path", "table"]

#: Rows that a Python function gets at a time, and an Arrow batch holds at most: what bounds a worker's memory.
ROWS_AT_ONCE = 1000


def fresh(columns: list[str], name: str) -> str:
    """name, with underscores before it until no column is called so in any letter case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _prepare(spark: SparkSession) -> None:
    ensure_shipped(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_AT_ONCE:
        spark.conf.set(key, ROWS_AT_ONCE)


def _give_back() -> None:
    """Returns what a finished task held to the machine: a worker lives on for the next one, whatever that needs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no such call where there is no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def append_columns(df: DataFrame, inputs: list[str], fields: list[StructField], make: Callable[[], Callable[..., list[pa.Array]]]) -> DataFrame:
    """df with further columns that a Python function makes of whole Arrow batches.

    make() runs once in each task and returns the function from the input columns to the new ones. No row moves.
    """
    _prepare(df.sparkSession)
    at = [df.columns.index(c) for c in inputs]
    names = [*df.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            for lo in range(0, b.num_rows, ROWS_AT_ONCE):
                part = b.slice(lo, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(*(part.column(i) for i in at))], names=names)
        del fn
        _give_back()

    return df.mapInArrow(run, StructType([*df.schema.fields, *fields]))


def map_batches(df: DataFrame, schema: StructType, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]]) -> DataFrame:
    """Rows that a Python function makes of whole Arrow batches; make() runs once in each task."""
    _prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            if b.num_rows:
                yield from fn(b)
        del fn
        _give_back()

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heavy_limit(spark: SparkSession, rows: int) -> int:
    """Rows of one key beyond which it is heavy: what a shuffle partition holds on average, so no more keys are heavy than there are partitions."""
    return max(1000, rows // max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))


def join_heavy(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, limit: int) -> DataFrame:
    """left joined with the one row that right has for each key (keys that right lacks go), heavy keys without a shuffle.

    counts: keys and `rows`, how many of left's rows a key has, or more. Rows of keys with more than `limit` meet theirs by a broadcast of at
    most rows(left) / limit rows; all others are shuffled. So no task gets more than its share, whatever one key holds. Without heavy keys,
    which a look at counts tells, it is a plain join.
    """
    heavy = counts.where(F.col("rows") > limit).select(*keys)
    if heavy.isEmpty():
        return left.join(right, keys)
    heavy = F.broadcast(heavy)
    light = left.join(heavy, keys, "left_anti").join(right, keys)
    return light.unionByName(left.join(F.broadcast(right.join(heavy, keys, "left_semi")), keys))


def digest64(*columns: str):
    """A 64-bit value of some columns, nulls apart from empty texts."""
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))
