"""A search index as a Spark data source, for batches and streams.

The index is behind a function that gives pages of hits, so that any transport will do. `register(spark, pages)` makes the format
`search_hits`; options `since` and `until` bound the timestamps (the first excluded, the second included).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from lograil.shipping import ensure_shipped

SCHEMA = "`@timestamp` string, message string, dataset string, host string, category string, event_id string"
FIELDS = ("@timestamp", "message", "event.dataset", "host.name", "event.category")
Pages = Callable[[str | None, str | None], Iterator[list[dict]]]


def query(since: str | None, until: str | None) -> dict:
    """The question to the index: messages that nothing has mapped, of datasets that are worth it."""
    bounds = {k: v for k, v in (("gt", since), ("lte", until)) if v is not None}
    never = [{"exists": {"field": "event.category"}}, *({"wildcard": {"event.dataset": d}} for d in ("elastic_agent*", "windows.perfmon*", "system.cpu*"))]
    must = [{"exists": {"field": "message"}}, *([{"range": {"@timestamp": bounds}}] if bounds else [])]
    return {"query": {"bool": {"must": must, "must_not": never}}, "sort": [{"@timestamp": "asc"}], "_source": list(FIELDS)}


def _value(hit: dict, path: str):
    if path in hit:
        return hit[path]
    for key in path.split("."):
        hit = hit.get(key) if isinstance(hit, dict) else None
    return hit if hit is None or isinstance(hit, str) else json.dumps(hit)


def rows(pages: Pages, since: str | None, until: str | None) -> Iterator[tuple]:
    k = 0
    for page in pages(since, until):
        for hit in page:
            yield (*(_value(hit, f) for f in FIELDS[:2]), *(_value(hit, f) for f in FIELDS[2:]), f"so_unmapped_{k}")
            k += 1


class _Range(InputPartition):
    def __init__(self, since, until):
        self.since, self.until = since, until


class _Reader(DataSourceReader):
    def __init__(self, pages: Pages, options: dict):
        self.pages, self.options = pages, options

    def partitions(self):
        return [_Range(self.options.get("since"), self.options.get("until"))]

    def read(self, partition):
        yield from rows(self.pages, partition.since, partition.until)


class _Stream(DataSourceStreamReader):
    """The offset is the greatest timestamp so far: a restart goes on behind it."""

    def __init__(self, pages: Pages, options: dict):
        self.pages, self.options = pages, options
        self.last = options.get("since")

    def initialOffset(self):
        return {"ts": self.options.get("since")}

    def latestOffset(self):
        for page in self.pages(self.last, self.options.get("until")):
            for hit in page:
                ts = _value(hit, "@timestamp")
                if ts is not None and (self.last is None or ts > self.last):
                    self.last = ts
        return {"ts": self.last}

    def partitions(self, start, end):
        return [_Range(start["ts"], end["ts"])] if end["ts"] is not None and start != end else []

    def read(self, partition):
        yield from rows(self.pages, partition.since, partition.until)

    def commit(self, end):
        pass


def register(spark: SparkSession, pages: Pages, name: str = "search_hits") -> None:
    ensure_shipped(spark)

    class SearchHits(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return _Reader(pages, dict(self.options))

        def streamReader(self, schema):
            return _Stream(pages, dict(self.options))

    spark.dataSource.register(SearchHits)
