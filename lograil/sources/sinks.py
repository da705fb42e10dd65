"""Writers of records, results, caches and profiles."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograil.functions.imperative import nest
from lograil.operators.align import last_of, merge_new


def json_lines(df: DataFrame, path: str, order: str | None = None, mode: str = "overwrite") -> None:
    """One JSON object a line. With `order` the files follow it from first to last, without being one file."""
    out = df.repartitionByRange(order).sortWithinPartitions(order).drop(order) if order else df
    out.write.mode(mode).option("ignoreNullFields", True).json(path)


def nested_json(df: DataFrame, extracted: str = "extracted") -> DataFrame:
    """value: each record as JSON, its extracted fields nested by their dotted paths."""

    @F.udf("string")
    def join(record: str, fields: dict | None) -> str:
        return json.dumps(nest(json.loads(record), fields or {}), ensure_ascii=False)

    rest = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns if c != extracted)))
    return df.select(join(rest, extracted).alias("value"))


def parsed_json(inputs: DataFrame, results: DataFrame, path: str, key: str = "id", order: str = "seq") -> None:
    """Inputs that have a result, with the last one for their id, in the inputs' order."""
    json_lines(inputs.join(last_of(results, key, "result_seq").drop("result_seq"), key), path, order)


def parsed_csv(rows: DataFrame, path: str, order: str = "seq") -> None:
    """LineId, Content, EventTemplate of the parsed rows, in order."""
    ordered = rows.where("EventTemplate IS NOT NULL").repartitionByRange(order).sortWithinPartitions(order)
    ordered.select("LineId", "Content", "EventTemplate").write.mode("overwrite").options(header=True, escape='"').csv(path)


def cache(existing: DataFrame, new: DataFrame, keys: list[str], path: str, order: str = "seq") -> None:
    """Existing entries and the new ones whose keys they lack, written beside what was read (`path` must be another)."""
    merge_new(existing, new, keys, order).write.mode("overwrite").json(path)


def quarantine(df: DataFrame, path: str) -> None:
    """Masked noise, added to what is there."""
    df.write.mode("append").json(path)


def profile(values: dict, df: DataFrame, path: str) -> None:
    """A profile of one row: `values`, with volume and counts from the rows of df (llm, cached: whether a row's template came so)."""
    counts = df.agg(F.count("*").alias("log_volume"), F.sum(F.col("llm").cast("long")).alias("llm_invocations"), F.sum(F.col("cached").cast("long")).alias("cache_hits"))
    counts.select("*", *(F.lit(v).alias(k) for k, v in values.items())).coalesce(1).write.mode("overwrite").json(path)


def groups(df: DataFrame, path: str) -> None:
    """A grouping kept for a later run."""
    df.write.mode("overwrite").parquet(path)
