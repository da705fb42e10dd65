"""Streams of logs: micro-batches against a growing dictionary, increments behind a cursor, and recency state that expires."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lograil.plans.pipelines import DICTIONARY, cluster_batches, route
from lograil.schema import Settings
from lograil.shipping import ensure_shipped


def newest_before(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """The dictionary that the last batch before `number` left, whether or not numbers were skipped; None if there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    found = [k for k in (int(n.split("=")[1]) for n in names if n.startswith("batch=")) if k < number]
    return spark.read.parquet(f"{path}/batch={max(found)}") if found else None


def parse_stream(logs: DataFrame, dictionary_path: str, out_path: str, checkpoint: str, source=None, settings: Settings | None = None, method: str = "route", once: bool = True) -> StreamingQuery:
    """Parses a stream of (id, message, seq): each micro-batch reads what the one before it learned, and writes results and what it learned.

    With `once` the stream ends when all that is there is read; else a batch begins whenever `buffer_max_age_s` are over, and the source's own
    option (maxFilesPerTrigger, maxOffsetsPerTrigger) bounds its rows. method: `route`, or `batch`, which clusters `buffer_size` rows at a time.
    Results and versions carry the batch's number, so a batch that is run again overwrites its own output and nothing doubles.
    """
    s = settings or Settings()
    if method not in ("route", "batch"):
        raise ValueError(f"no such method: {method}")
    ensure_shipped(logs.sparkSession)

    def batch(df: DataFrame, number: int) -> None:
        spark, df = df.sparkSession, df.persist()
        known = newest_before(spark, dictionary_path, number)
        if method == "route":
            done = route(df, known if known is not None else spark.createDataFrame([], DICTIONARY), source, s.router)
        else:
            done = cluster_batches(df, s.batch, source, known)
        done.learned.write.mode("overwrite").parquet(f"{dictionary_path}/batch={number}")
        done.rows.write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        df.unpersist()

    when = {"availableNow": True} if once else {"processingTime": f"{s.batch.buffer_max_age_s:g} seconds"}
    return logs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**when).start()


def counts_by_window(events: DataFrame, ts: str = "ts", key: str = "template", window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Rows for each template and window; rows later than `late` are too late."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window), key).count().select("window.start", "window.end", key, "count")


def last_matched(hits: DataFrame, key: str = "template", seq: str = "seq", expire: str = "30 days") -> DataFrame:
    """template, hits, last_seq as they change; a template without a hit for so long is forgotten."""
    ensure_shipped(hits.sparkSession)
    ms = int(pd.Timedelta(expire).total_seconds() * 1000)

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, last = state.get if state.exists else (0, -1)
        for b in batches:
            n, last = n + len(b), max(last, int(b[seq].max()))
        state.update((n, last))
        state.setTimeoutDuration(ms)
        yield pd.DataFrame({key: [k[0]], "hits": [n], "last_seq": [last]})

    return hits.groupBy(key).applyInPandasWithState(update, f"`{key}` string, hits long, last_seq long", "hits long, last_seq long", "update", GroupStateTimeout.ProcessingTimeTimeout)


def increments(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """A folder of JSON lines as a stream; the checkpoint of its query is the cursor."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
