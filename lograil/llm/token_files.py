"""Token files with directly addressable codes.

A segment holds up to SEGMENT_TOKENS ids. Level 1 has the low byte of each id and a bitmap that tells which ids go on; level 2 has the next
byte of those, with its own bitmap, and so on. A rank directory beside each bitmap counts the ones before every 512 bits, so the place of
an id's next byte is a lookup and a count inside one 512-bit word: any token is read without decoding a block.

Segment bytes: magic `DAC1`, number of levels (1 byte), number of ids (8 bytes); then for each level its length (8), the level's bytes, the
bitmap (length / 8, rounded up, low bit first) and the rank directory (4 bytes for every 512 bits). All little-endian.

A file set is a folder that any Hadoop store can hold. `segments` has rows of (part, segment, tokens before it in the part, ids of its
documents, their ends in the segment, the segment's bytes), stored as they are: without compression or dictionary, in row groups of a few
segments, so that a reader with a part and a segment number skips all others by their statistics. `directory` has the place of each
segment in the whole corpus (part, segment, start, n_tokens): `tokens_at` finds the segments of given places there, reads these alone and looks
up the tokens. Parts are ranges of ascending doc_id; a document never straddles two segments. The end id closes each document. A null text is an empty one; rows that repeat an id are documents of their own, in the order of their texts' hashes; null
ids come first. An empty table has an empty file set.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, new_path, table
from .word_bpe import encoder

END_ID = 2
SEGMENT_TOKENS = 1 << 16
#: So many segments are named in the filter that a reader pushes down; more are joined.
NAMED = 200
#: Bytes of text, or one text, that are encoded at a time.
TEXT_AT_ONCE = 1 << 21
_RANK_BITS = 512


def pack(ids: np.ndarray) -> bytes:
    """The segment of some ids (unsigned, up to 32 bits)."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little").tobytes()
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), _RANK_BITS), dtype=np.uint32))])[:-1] if len(more) else []
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits + np.array(ranks, dtype="<u4").tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    return b"DAC1" + struct.pack("<BQ", len(levels), len(ids)) + b"".join(levels)


class Segment:
    """Reads ids of a segment by their place."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"DAC1":
            raise ValueError("not a segment")
        count, self.n = struct.unpack_from("<BQ", raw, 4)
        at, self.levels = 13, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", raw, at)
            at += 8
            low = np.frombuffer(raw, np.uint8, n, at)
            at += n
            bits = np.frombuffer(raw, np.uint8, (n + 7) // 8, at)
            at += (n + 7) // 8
            ranks = np.frombuffer(raw, "<u4", (n + _RANK_BITS - 1) // _RANK_BITS, at)
            at += 4 * len(ranks)
            self.levels.append((low, bits, ranks))

    def _goes_on(self, level: int, lo: int, hi: int) -> np.ndarray:
        bits = self.levels[level][1]
        return np.unpackbits(bits[lo // 8 : (hi + 7) // 8], bitorder="little")[lo % 8 : lo % 8 + hi - lo].astype(bool)

    def _rank(self, level: int, at: int) -> int:
        _, bits, ranks = self.levels[level]
        if at // _RANK_BITS >= len(ranks):  # the end of a level that fills its last word
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        word = at // _RANK_BITS
        return int(ranks[word]) + int(np.unpackbits(bits[word * _RANK_BITS // 8 : (at + 7) // 8], bitorder="little")[: at - word * _RANK_BITS].sum())

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """The ids at lo .. hi - 1."""
        out = np.zeros(hi - lo, dtype=np.uint32)
        places = np.arange(hi - lo)
        for level, (low, _, _) in enumerate(self.levels):
            if hi <= lo:
                break
            out[places] |= low[lo:hi].astype(np.uint32) << np.uint32(8 * level)
            on = self._goes_on(level, lo, hi)
            places = places[on]
            lo, hi = self._rank(level, lo), 0
            hi = lo + len(places)
        return out

    def __getitem__(self, at: int) -> int:
        return int(self.slice(at, at + 1)[0])


_DIRECTORY = "part int, segment int, start long, n_tokens long"
_SEGMENTS = "part int, segment int, before long, n_tokens long, doc_ids array<long>, ends array<int>, raw binary"


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes the texts and writes them to `path` in ascending order of id."""
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    slim = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("m"), F.col(text_col).alias("t"))
    # The row's number parts rows that repeat id and text, however many there are.
    ordered = slim.repartitionByRange(n, "i", "h", "m").sortWithinPartitions("i", "h", "m").select("i", "t")

    def encode():
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        state = {"segment": 0, "before": 0}

        def fn(b):
            ids, ends, held, size = [], [], [], 0
            run = np.cumsum(pc.fill_null(pc.binary_length(b.column("t")), 0).to_numpy(), dtype=np.int64) // TEXT_AT_ONCE
            for lo, hi in pairwise([0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), b.num_rows]):
                rows = b.slice(lo, hi - lo)
                for i, e in zip(rows.column("i").to_pylist(), enc.encode([t or "" for t in rows.column("t").to_pylist()]), strict=True):
                    held += [e, np.array([end_id], dtype=np.uint32)]
                    size += len(e) + 1
                    ids.append(i)
                    ends.append(size)
                    if size >= SEGMENT_TOKENS:
                        yield segment(ids, ends, held)
                        ids, ends, held, size = [], [], [], 0
            if ids:
                yield segment(ids, ends, held)

        def segment(ids, ends, held):
            row = [part, state["segment"], state["before"], ends[-1], ids, ends, pack(np.concatenate(held))]
            state["segment"] += 1
            state["before"] += ends[-1]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["part", "segment", "before", "n_tokens", "doc_ids", "ends", "raw"])

        return fn

    plain = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.block.size": str(1 << 20), "parquet.page.size": str(1 << 16)}
    map_batches(ordered, _SEGMENTS, encode).write.mode("overwrite").options(**plain).parquet(f"{path}/segments")
    files = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments").select("part", "segment", "before", "n_tokens")
    # One number for each part that was written, so that the driver gets no more than that.
    starts, at = [], 0
    for part, count in sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        starts.append((part, at))
        at += count
    begins = spark.createDataFrame(starts, "part int, at long")
    files.join(F.broadcast(begins), "part").select("part", "segment", (F.col("at") + F.col("before")).alias("start"), "n_tokens").write.mode("overwrite").parquet(f"{path}/directory")


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """id, start, n_tokens, ids_crc32 (and the ids themselves) of each document in the files at `path`."""
    files = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    directory = spark.read.schema(_DIRECTORY).parquet(f"{path}/directory")
    starts = {r["part"]: r["start"] for r in directory.where("segment = 0").select("part", "start").collect()}  # one for each part

    def decode():
        def fn(b):
            for part, before, docs, ends, raw in zip(*(b.column(c).to_pylist() for c in ("part", "before", "doc_ids", "ends", "raw")), strict=True):
                segment, lo, rows, start = Segment(raw), 0, [], starts[part] + before
                every = segment.slice(0, segment.n).astype("<u4")
                for i, hi in zip(docs, ends, strict=True):
                    ids = every[lo:hi]
                    rows.append((i, start + lo, hi - lo, zlib.crc32(ids), ids.tolist() if with_ids else None))
                    lo = hi
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())][: 4 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=[id_col, "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

        return fn

    return map_batches(files.select("part", "before", "doc_ids", "ends", "raw"), f"{id_col} long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids, decode)


def tokens_at(places: DataFrame, path: str, place_col: str = "place") -> DataFrame:
    """place, doc_id, id: the token at each wanted place of the whole corpus (from 0), and its document; places beyond the end have no row."""
    spark = places.sparkSession
    directory = spark.read.schema(_DIRECTORY).parquet(f"{path}/directory")
    cell = lambda c: F.floor(c / F.lit(SEGMENT_TOKENS)).cast("long")
    covered = directory.withColumn("cell", F.explode(F.sequence(cell(F.col("start")), cell(F.col("start") + F.col("n_tokens") - 1))))
    wanted = places.select(F.col(place_col).cast("long").alias("place")).distinct().withColumn("cell", cell(F.col("place")))
    inside = (F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("n_tokens"))
    found = wanted.join(covered, "cell").where(inside).groupBy("part", "segment").agg(F.collect_list(F.struct("place", (F.col("place") - F.col("start")).cast("int").alias("at"))).alias("places"))
    found = materialize(found, "token-places")
    files = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    few = [tuple(r) for r in found.select("part", "segment").limit(NAMED + 1).collect()]
    if len(few) <= NAMED:
        named = F.lit(False)
        for part, segment in few:
            named = named | ((F.col("part") == part) & (F.col("segment") == segment))
        files = files.where(named)

    def look():
        def fn(b):
            for docs, ends, raw, places_ in zip(*(b.column(c).to_pylist() for c in ("doc_ids", "ends", "raw", "places")), strict=True):
                segment = Segment(raw)
                rows = [(p["place"], docs[bisect_right(ends, p["at"])], segment[p["at"]]) for p in places_]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["place", "doc_id", "id"])

        return fn

    joined = files.join(found, ["part", "segment"]).select("doc_ids", "ends", "raw", "places")
    return map_batches(joined, "place long, doc_id long, id long", look)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents, read back from the files."""
    import public_tokenizers

    path = new_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), str(public_tokenizers.path("word_bpe_49k.json")), path)
    return read_token_files(spark, path)
