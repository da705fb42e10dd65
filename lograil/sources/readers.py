"""Readers: log exports, truth, parsed results, caches and profiles, as frames of one schema.

Paths are whatever Spark reads. Malformed lines are skipped, as a log source must; files of a folder are one frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lograil.functions import text as T
from lograil.schema import PROFILE_SCHEMA, dataset_key

ROWS_PER_FILE = 100_000


def dataset_of_file(path: Column) -> Column:
    """A file's dataset: its name without what export tools add to it."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(_sample\.csv|_full\.log_structured\.csv|\.csv)$", "")


def _first_of_each_file(df: DataFrame, n: int | None) -> DataFrame:
    """At most n rows of each file, in the file's order."""
    numbered = df.withColumn("_pos", F.monotonically_increasing_id())
    if n is None:
        return numbered
    return numbered.withColumn("_rn", F.row_number().over(Window.partitionBy("_file").orderBy("_pos"))).where(F.col("_rn") <= n).drop("_rn")


def _csv(spark: SparkSession, path, **options) -> DataFrame:
    return spark.read.options(header=True, multiLine=True, escape='"', mode="PERMISSIVE", **options).csv(path).withColumn("_file", F.col("_metadata.file_path"))


def _pick(df: DataFrame, *names: str) -> Column:
    """The first of the columns that is there and not null."""
    have = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def record(ts=None, message=None, level=None, logger=None, event_id=None, dataset=None, reason=None, host=None) -> list[Column]:
    s = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    return [
        s(ts).alias("@timestamp"),
        s(message).alias("message"),
        F.struct(s(level).alias("level"), s(logger).alias("logger")).alias("log"),
        F.struct(s(event_id).alias("id"), s(dataset).alias("dataset"), s(reason).alias("reason")).alias("event"),
        F.struct(s(host).alias("name")).alias("host"),
    ]


def structured_logs(spark: SparkSession, path, rows_per_file: int | None = ROWS_PER_FILE) -> DataFrame:
    """Records of structured log CSVs (Date, Time, Content, Level, Component, LineId): id = dataset_LineId, the row's number without LineId."""
    df = _first_of_each_file(_csv(spark, path), rows_per_file)
    number = F.row_number().over(Window.partitionBy("_file").orderBy("_pos")).cast("string")
    dataset = dataset_of_file(F.col("_file"))
    when = T.strip(F.concat(F.coalesce(_pick(df, "Date"), F.lit("")), F.lit(" "), F.coalesce(_pick(df, "Time"), F.lit(""))))
    return df.select(*record(when, F.coalesce(_pick(df, "Content"), F.lit("")), _pick(df, "Level"), _pick(df, "Component"), F.concat(dataset, F.lit("_"), F.coalesce(_pick(df, "LineId"), number))))


def event_export(spark: SparkSession, path) -> DataFrame:
    """Records of an event export (_time, _raw, sourcetype, host; Latin-1); nulls are empty texts."""
    df = _csv(spark, path, encoding="ISO-8859-1").select("_time", "_raw", "sourcetype", "host").na.fill("")
    return df.select(*record(F.col("_time"), F.col("_raw"), dataset=F.col("sourcetype"), host=F.col("host")))


def json_lines(spark: SparkSession, path, schema: str) -> DataFrame:
    """Records of JSON lines with their place, `seq`; lines that are no JSON are gone."""
    lines = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id())
    parsed = lines.withColumn("_r", F.from_json("value", schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    return parsed.where("_r IS NOT NULL AND _r._bad IS NULL").select("_r.*", "seq").drop("_bad")


def log_lines(spark: SparkSession, path) -> DataFrame:
    """id, message, dataset, seq of JSON lines in either shape; without an id, the line's place."""
    schema = "message string, Content string, LineId string, event struct<id:string>"
    df = json_lines(spark, path, schema)
    rid = F.coalesce("event.id", "LineId", F.col("seq").cast("string"))
    return df.select(rid.alias("id"), F.coalesce("message", "Content", F.lit("")).alias("message"), dataset_key(rid).alias("dataset"), "seq")


def _truth_columns(df: DataFrame) -> DataFrame | None:
    content, template = [c for c in ("Content", "message", "_raw") if c in df.columns], [c for c in ("EventTemplate", "template", "parsed_template") if c in df.columns]
    return (content and template or None) and df


def truth(spark: SparkSession, paths: list[str], nrows: int | None = None) -> DataFrame:
    """LineId, Content, EventTemplate of ground-truth CSVs; files without content or template are left out. Nulls become `nan`."""
    parts = []
    for p in paths:
        df = _truth_columns(_csv(spark, p))
        if df is None:
            continue
        df = _first_of_each_file(df, nrows)
        number = F.row_number().over(Window.partitionBy("_file").orderBy("_pos")).cast("string")
        rid = F.concat(dataset_of_file(F.col("_file")), F.lit("_"), F.coalesce(_pick(df, "LineId", "event.id"), number))
        text = lambda *n, df=df: T.strip(F.coalesce(_pick(df, *n), F.lit("nan")))
        parts.append(df.select(rid.alias("LineId"), text("Content", "message", "_raw").alias("Content"), text("EventTemplate", "template").alias("EventTemplate")))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "LineId string, Content string, EventTemplate string")


def parsed_results(spark: SparkSession, csv_paths: list[str] = (), jsonl_paths: list[str] = (), nrows: int | None = None) -> DataFrame:
    """LineId, Content, EventTemplate of parser output, tags as plain wildcards; the debug log is no output."""
    parts = []
    for p in csv_paths:
        df = _first_of_each_file(_csv(spark, p), nrows)
        parts.append(df.select(_pick(df, "LineId").alias("LineId"), _pick(df, "Content").alias("Content"), _pick(df, "EventTemplate").alias("EventTemplate")))
    for p in jsonl_paths:
        if p.endswith("llm_debug.jsonl"):
            continue
        df = json_lines(spark, p, "message string, Content string, LineId string, event struct<id:string>, parsed_template string, EventTemplate string")
        df = df.select(F.coalesce("event.id", "LineId", F.col("seq").cast("string")).alias("LineId"), F.coalesce("message", "Content").alias("Content"), F.coalesce("parsed_template", "EventTemplate").alias("EventTemplate"))
        parts.append(df.limit(nrows) if nrows else df)
    out = reduce(DataFrame.unionByName, parts)
    clean = {c: T.strip(F.coalesce(c, F.lit("None"))) for c in ("LineId", "Content")}
    return out.withColumns(clean | {"EventTemplate": T.untag(T.strip(F.coalesce("EventTemplate", F.lit("None"))))})


def template_list(spark: SparkSession, path: str) -> DataFrame:
    """template, seq of a JSON list of texts, or of entries with a `template`."""
    whole = spark.read.text(path, wholetext=True)
    texts = F.from_json("value", "array<string>")
    item = F.posexplode(texts).alias("seq", "_t")
    entry = F.get_json_object("_t", "$.template")
    return whole.select(item).select(F.coalesce(entry, F.col("_t")).alias("template"), "seq").where("template IS NOT NULL")


def template_entries(spark: SparkSession, path: str) -> DataFrame:
    """template, ref_log, frequency, seq of a cache of entries, in their order."""
    whole = spark.read.text(path, wholetext=True)
    kind = "array<struct<template:string, ref_log:string, frequency:int>>"
    return whole.select(F.posexplode(F.from_json("value", kind)).alias("seq", "_e")).select("_e.*", "seq")


def group_memory(spark: SparkSession, path: str) -> DataFrame:
    """raw_log, template, group_key, seq of a group memory."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", "array<struct<raw_log:string, template:string, group_key:string>>")).alias("seq", "_e")).select("_e.*", "seq")


def profile(spark: SparkSession, path: str) -> DataFrame:
    """One row of counters; zeros and unknown names if there is no such file."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(PROFILE_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException:
        return spark.createDataFrame([(0.0, 0, 0, 0, 0, 0, 0, 0, 0, [], "unknown-model", "unknown-method")], PROFILE_SCHEMA)


# Examples for categories without any of their own.
_SEEDS = {
    "ecs_10": (("User <USR> logged in from <LOI>", "User admin logged in from 1.2.3.4"), ("mice: PS/2 mouse device version <VER>", "mice: PS/2 mouse device version v1.2.3"), ("bindcache: failed init IPS on port <POR>: <STA> (<OID>)", "bindcache: failed init IPS on port 8080: failure (Out of memory)")),
    "paper_10": (("User <OID> logged in from <LOI>", "User admin logged in from 1.2.3.4"), ("mice: PS/2 mouse device version <OTP>", "mice: PS/2 mouse device version v1.2.3"), ("bindcache: failed init IPS on port <CRS>: <STC> (<OTP>)", "bindcache: failed init IPS on port 8080: failure (Out of memory)")),
    "ecs_3": (("User <LOI> logged in", "User admin logged in"), ("mice: PS/2 mouse device common for all mice", "mice: PS/2 mouse device common for all mice"), ("bindcache: failed init IPS: <TDA> (<OID>)", "bindcache: failed init IPS: 0x5 (Out of memory)")),
}


def example_pool(spark: SparkSession, categories: str = "ecs_3", cached: DataFrame | None = None, seeds: DataFrame | None = None) -> DataFrame:
    """template, ref_log, seq: seeds (last one first), then cached entries; three built-in examples if both are empty."""
    parts = [df.select("template", "ref_log", F.lit(k).alias("_k"), (F.negative("seq") if k == 0 else F.col("seq")).alias("_s")) for k, df in enumerate((seeds, cached)) if df is not None]
    pool = reduce(DataFrame.unionByName, parts) if parts else None
    if pool is None or pool.isEmpty():
        return spark.createDataFrame([(t, r, k) for k, (t, r) in enumerate(_SEEDS[categories])], "template string, ref_log string, seq int")
    return pool.withColumn("seq", F.row_number().over(Window.orderBy("_k", "_s"))).select("template", "ref_log", "seq")  # a pool is some rows


def dead_letters(spark: SparkSession, path: str, decode) -> DataFrame:
    """Records of dead-letter segments. decode: bytes -> JSON lines; a segment that it fails on is skipped.

    Segments are read whole, one row each, and decoded where they are read.
    """
    import pandas as pd

    def run(batches):
        for b in batches:
            for raw in b["content"]:
                try:
                    lines = list(decode(bytes(raw)))
                except Exception:  # noqa: BLE001  an undecodable segment is data, not a fault of ours
                    continue
                yield pd.DataFrame({"line": lines})

    lines = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "line string")
    return dead_letter_lines(lines)


def dead_letter_lines(lines: DataFrame) -> DataFrame:
    """Records of decoded dead letters (line): message and reason; without a message, the event's data as JSON."""
    from lograil.functions.imperative import unwrap_tagged

    @F.udf("struct<message:string, reason:string>")
    def read(line: str):
        import json

        try:
            got = json.loads(line)
            data = unwrap_tagged(got.get("event"))
            data = data.get("DATA", data) if isinstance(data, dict) else {}
        except (ValueError, AttributeError):
            return None
        message = data.get("message") if isinstance(data, dict) else None
        return (message if message is not None else json.dumps(data), got.get("reason"))

    got = lines.withColumn("_r", read("line")).where("_r IS NOT NULL").withColumn("_k", F.monotonically_increasing_id())
    return got.select(*record(message=F.col("_r.message"), event_id=F.concat(F.lit("so_dlq_"), F.col("_k").cast("string")), dataset=F.lit("so_dlq"), reason=F.col("_r.reason")))
