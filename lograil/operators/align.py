"""Joins, sets and orders that bring rows of two sources together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lograil.functions import text as T


def align(truth: DataFrame, parsed: DataFrame, key: str = "LineId") -> DataFrame:
    """key, content, gt, parsed of the rows that both have; ids that repeat multiply."""
    right = parsed.select(key, F.col("EventTemplate").alias("parsed"))
    return truth.select(key, F.col("Content").alias("content"), F.col("EventTemplate").alias("gt")).join(right, key)


def correct_truth(truth: DataFrame) -> DataFrame:
    """Contents without white space at the ends, templates with single spaces."""
    return truth.withColumns({"Content": T.strip("Content"), "EventTemplate": T.squeeze("EventTemplate")})


def align_by_content(left: DataFrame, right: DataFrame, seq: str = "seq") -> DataFrame:
    """left's rows in their order with the first row of right that has the same Content."""
    first = right.withColumn("_turn", F.row_number().over(Window.partitionBy("Content").orderBy(seq))).where("_turn = 1").drop("_turn", seq)
    return left.select("Content", seq).join(first, "Content", "left").orderBy(seq)


def pair_occurrences(a: DataFrame, b: DataFrame, key: str, order_a: str, order_b: str) -> DataFrame:
    """The k-th row of each key in a with its k-th row in b."""
    turn = lambda df, order: df.withColumn("_turn", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return turn(a, order_a).join(turn(b, order_b), [key, "_turn"]).drop("_turn")


def last_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    return df.groupBy(key).agg(F.max_by(F.struct(*(c for c in df.columns if c != key)), order).alias("_r")).select(key, "_r.*")


def first_seen(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values by where each was first seen."""
    return df.groupBy(value).agg(F.min(order).alias(order)).orderBy(order)


def top_of(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    return df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank_col) <= n)


def merge_new(existing: DataFrame, new: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """existing's rows, then those of new whose keys it lacks, each key once, by where it was first seen."""
    fresh = new.join(existing, keys, "left_anti").withColumn("_turn", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_turn = 1").drop("_turn")
    return existing.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1))).orderBy("_new", order).drop("_new")


def subtract_bag(a: DataFrame, b: DataFrame) -> DataFrame:
    """a's rows without as many of each as b has."""
    return a.exceptAll(b)


def interleave(df: DataFrame, dataset: str, order: str | None = None, seed: int | None = None, chunk: int = 1) -> DataFrame:
    """`turn` and `first`: datasets take turns of `chunk` rows, those seen first before the others.

    Rows of a dataset keep their order, or with a seed get one that depends on the seed and the row's `order` alone.
    """
    by = F.xxhash64(F.lit(seed), order) if seed is not None else F.col(order)
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(dataset).orderBy(by, order)))
    first = df.groupBy(dataset).agg(F.min(order).alias("first"))
    return numbered.join(F.broadcast(first), dataset).withColumn("turn", F.floor((F.col("_rn") - 1) / chunk)).withColumnRenamed("_rn", "place")


def history(df: DataFrame, dataset: str, order: str, counters: list[str]) -> DataFrame:
    """Running totals of counters within each dataset."""
    w = Window.partitionBy(dataset).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({f"total_{c}": F.sum(c).over(w) for c in counters})


def newest(df: DataFrame, last_used: str, capacity: int, key: str) -> DataFrame:
    """The `capacity` entries used last; of those used at one time the smallest keys."""
    return df.orderBy(F.desc(last_used), key).limit(capacity)


def unexpired(df: DataFrame, last_used: str, now: Column, days: int = 30) -> DataFrame:
    return df.where(F.col(last_used) >= now - F.make_interval(days=F.lit(days)))


def unmapped(df: DataFrame, since: Column, until: Column, ts: str = "@timestamp", message: str = "message", category: str = "category", dataset: str = "dataset") -> DataFrame:
    """Messages that no pipeline has mapped, of datasets that are worth it, after `since` and up to `until`."""
    noise = F.col(dataset).rlike(r"^(elastic_agent|windows\.perfmon|system\.cpu)")
    return df.where(F.col(message).isNotNull() & F.col(category).isNull() & ~F.coalesce(noise, F.lit(False)) & (F.col(ts) > since) & (F.col(ts) <= until))


def cursor(df: DataFrame, ts: str = "@timestamp") -> DataFrame:
    """The greatest timestamp: where the next extraction goes on. No row for no rows."""
    return df.agg(F.max(ts).alias("last_timestamp")).where("last_timestamp IS NOT NULL")
