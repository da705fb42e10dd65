"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the test strings: each run of `WINDOW` words, or the whole of a shorter string. Patterns of one
length m share a table: for each block of two neighbouring words, how far the search window may move on until that block can
stand at a place that it has in a pattern. A block that ends no pattern skips positions that cannot match, unread. Where the
shift is 0, the bucket of that suffix block names the candidates; the first word, then the whole window are compared with the
document's words, so that a hash never decides.

A benchmark of more than a chunk takes several searches. Each gives only the documents that it hits, by a hash of 128 bits of their texts (equal
texts are hit alike), so that documents are read again but neither moved nor written for a chunk; their hits are joined at the end. A worker
builds the tables of a chunk once.

Null and empty texts have no words: such documents are not hit, such items have no window. An item without an id hits words but
is never named. Repeated rows are handled row by row. Any further columns stay.
"""

from __future__ import annotations

import itertools
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from .common import append_columns, fresh, materialize, table

WINDOW = 10
#: Pattern tables are broadcast in chunks of at most so many bytes of benchmark text.
CHUNK_BYTES = 4 << 20
#: Lower-cases A-Z; whatever is not a digit, an ASCII letter or part of a non-ASCII character becomes a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


class WuManber:
    """Patterns of m words each: (words of the item, start of the window, numbers of the items that hold it)."""

    def __init__(self, m: int, windows: list[tuple[list[bytes], int, list[int]]]):
        self.m, self.block = m, min(2, m)
        #: last word of a block -> word before it -> shift
        self.shift: dict[bytes, dict[bytes, int]] = {}
        #: suffix block -> candidates
        self.bucket: dict[tuple[bytes, ...], list[tuple[bytes, list[bytes], list[int]]]] = {}
        for words, at, items in windows:
            window = words[at : at + m]
            for end in range(self.block - 1, m):
                before = window[end - 1] if self.block == 2 else b""
                row, move = self.shift.setdefault(window[end], {}), m - 1 - end
                row[before] = min(row.get(before, m), move)
            if self.block == 2:
                self.shift.setdefault(window[0], {})
            self.bucket.setdefault(tuple(window[-self.block :]), []).append((window[0], window, items))

    def search(self, words: list[bytes]):
        """(start, items) of each occurrence, from left to right."""
        m, pair, shift, bucket = self.m, self.block == 2, self.shift, self.bucket
        i, n, unseen = m - 1, len(words), m - self.block + 1
        while i < n:
            row = shift.get(words[i])
            if row is None:  # the word is in no pattern, so no pattern covers it
                i += m
                continue
            move = row.get(words[i - 1] if pair else b"", unseen)
            if move:
                i += move
                continue
            start = i - m + 1
            for first, window, items in bucket.get(tuple(words[i - self.block + 1 : i + 1]), ()):
                if words[start] == first and words[start : i + 1] == window:
                    yield start, items
            i += 1


def build(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> list[WuManber]:
    """A searcher for each pattern length that occurs."""
    of: dict[int, dict[tuple[bytes, ...], tuple[list[bytes], int, list[int]]]] = {}
    for k, (_, text) in enumerate(items):
        words = words_of(text)
        m = min(window, len(words))
        for at in range(len(words) - m + 1) if m else ():
            held = of.setdefault(m, {}).setdefault(tuple(words[at : at + m]), (words, at, []))[2]
            if not held or held[-1] != k:
                held.append(k)
    return [WuManber(m, list(windows.values())) for m, windows in sorted(of.items())]


def hits(words: list[bytes], searchers: list[WuManber]) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged spans of hit words, end exclusive, and the numbers of the items that occur."""
    spans, found = [], set()
    for one in searchers:
        for start, items in one.search(words):
            spans.append((start, start + one.m))
            found.update(items)
    return _merge(spans), found


def _chunks(benchmark: DataFrame, text_col: str, id_col: str, most: int):
    """The benchmark's rows in lists of at most `most` bytes each (a longer text is a list of its own)."""
    held, size = [], 0
    for r in benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        k = len(r["t"] or "") * 2
        if held and size + k > most:
            yield held
            held, size = [], 0
        held.append((r["i"], r["t"]))
        size += k
    yield held


#: The searchers of the chunk that this worker process built last.
_built: dict = {}


def _searchers(key: str, items: list, window: int) -> list[WuManber]:
    if key not in _built:
        _built.clear()
        _built[key] = build(items, window)
    return _built[key]


def _found(text: str | None, items: list, searchers: list[WuManber]) -> tuple[int, list[int], list[int]]:
    """Number of words, flat merged spans and sorted ids of the items found in a document."""
    words = words_of(text)
    spans, numbers = hits(words, searchers) if words else ([], set())
    return len(words), [x for s in spans for x in s], sorted({items[k][0] for k in numbers if items[k][0] is not None})


_LONGS = pa.list_(pa.int64())


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """docs with number of words, spans of hit words (flat start, end, start, end ...) and ids of the items found.

    Returns the frame and the names of its new columns by "words", "spans" and "items". With one chunk of benchmark no row moves.
    """
    name = {k: fresh(docs.columns, v) for k, v in (("words", "n_words"), ("spans", "hit_spans"), ("items", "hit_items"))}
    fields = [StructField(name["words"], LongType()), StructField(name["spans"], ArrayType(LongType())), StructField(name["items"], ArrayType(LongType()))]
    sc = docs.sparkSession.sparkContext
    chunks = _chunks(benchmark, text_col, item_col, chunk_bytes)
    first, second = next(chunks, []), next(chunks, None)
    if second is None:
        shared, key = sc.broadcast(first), uuid.uuid4().hex

        def make():
            items = shared.value
            searchers = _searchers(key, items, window)

            def fn(texts):
                n, spans, named = zip(*(_found(t.as_py(), items, searchers) for t in texts), strict=True)
                return [pa.array(n, pa.int64()), pa.array(spans, _LONGS), pa.array(named, _LONGS)]

            return fn

        return append_columns(docs, [text_col], fields, make), name
    slim = docs.select(F.col(text_col).alias("t"))
    parts = [_hit_texts(slim, chunk, window) for chunk in itertools.chain([first, second], chunks)]
    one = reduce(DataFrame.unionByName, parts).groupBy("h", "g").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    h, g = fresh(docs.columns, "_h"), fresh(docs.columns, "_g")
    joined = docs.withColumns({h: F.xxhash64(text_col), g: F.xxhash64(F.lit(1), text_col)})
    one = materialize(one, "decon").select(F.col("h").alias(h), F.col("g").alias(g), F.col("spans").alias(name["spans"]), F.col("items").alias(name["items"]))
    joined = joined.join(one, [h, g], "left").drop(h, g)

    def count():
        def fn(texts, spans, items):
            merged = [[x for s in _merge(list(zip(f[::2], f[1::2], strict=True))) for x in s] for f in (s.as_py() or [] for s in spans)]
            return [pa.array([len(words_of(t.as_py())) for t in texts], pa.int64()), pa.array(merged, _LONGS), pa.array([i.as_py() or [] for i in items], _LONGS)]

        return fn

    renamed = {name["spans"]: fresh([*docs.columns, *name.values()], "_spans"), name["items"]: fresh([*docs.columns, *name.values()], "_items")}
    out = append_columns(joined.withColumnsRenamed(renamed), [text_col, *renamed.values()], fields, count)
    return out.drop(*renamed.values()), name


def _hit_texts(texts: DataFrame, chunk: list, window: int) -> DataFrame:
    """h, g, spans, items: the distinct texts that a chunk of the benchmark hits."""
    shared, key = texts.sparkSession.sparkContext.broadcast(chunk), uuid.uuid4().hex

    def make():
        items = shared.value
        searchers = _searchers(key, items, window)

        def fn(t):
            _, spans, named = zip(*(_found(x.as_py(), items, searchers) for x in t), strict=True)
            return [pa.array(spans, _LONGS), pa.array(named, _LONGS)]

        return fn

    found = append_columns(texts, ["t"], [StructField("spans", ArrayType(LongType())), StructField("items", ArrayType(LongType()))], make)
    return found.where(F.size("spans") > 0).select(F.xxhash64("t").alias("h"), F.xxhash64(F.lit(1), "t").alias("g"), "spans", "items").dropDuplicates(["h", "g"])


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit word, as they came."""
    found, name = find_benchmark(docs, benchmark)
    return found.where(F.size(name["spans"]) == 0).select(*docs.columns)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of all documents against all benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = find_benchmark(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    spans = F.col(name["spans"])
    n_hit = F.aggregate(F.sequence(F.lit(1), F.size(spans).cast("int")), F.lit(0).cast("long"), lambda a, k: a + F.when(k % 2 == 0, F.element_at(spans, k)).otherwise(-F.element_at(spans, k)))
    ids = F.array_join(F.array_sort(F.transform(name["items"], lambda x: x.cast("string"))), ",")
    return found.select("doc_id", F.col(name["words"]).alias("n_words"), F.when(F.size(spans) == 0, F.lit(0).cast("long")).otherwise(n_hit).alias("n_hit"), F.size(name["items"]).cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.size(spans) > 0).alias("contaminated"))


ORACLE_OP3 = r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bm AS (SELECT item_id, w, least(10, len(w)) AS m FROM bw WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS p FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM bm)),
lens AS (SELECT DISTINCT m FROM pat),
win AS (SELECT rid, i, m, array_to_string(w[i : i + m - 1], ' ') AS p FROM (SELECT rid, w, lens.m AS m, unnest(range(1, len(w) - lens.m + 2)) AS i FROM dw, lens WHERE len(w) >= lens.m)),
occ AS (SELECT rid, i, win.m AS m, item_id FROM win JOIN pat ON win.p = pat.p AND win.m = pat.m),
hit AS (SELECT rid, count(DISTINCT k) AS n FROM (SELECT rid, unnest(range(i, i + m)) AS k FROM occ) GROUP BY rid),
its AS (SELECT rid, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM occ WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
