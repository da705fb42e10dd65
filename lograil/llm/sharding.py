"""Sharding: a uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in source parts of known size. Target blocks have exact sizes too. How many rows of each part go to each block
is drawn first, exactly: row by row a multivariate hypergeometric draw from what the blocks still lack. Then each part
permutes its rows and deals them out by its row of the matrix, the exchange moves them, and each block permutes what
came. The outcome is a uniform random permutation with gapless slots, although no task sees more than one block.

Nulls are values like any other, repeated rows are rows of their own, an empty table gives an empty result with the
added columns. Added columns whose names exist get underscores before them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField

from .common import append_columns, fresh, materialize, table

SHARDS = 24
SEED = 20_261_126
#: A part or block has at least so many rows, unless there are fewer, and there are at most so many of either, so that the
#: matrix has 4 million counts at most (32 MB) however large the table is.
LEAST_ROWS, MOST_PARTS = 1024, 2000


def shard_sizes(n: int, shards: int) -> list[int]:
    """Counts at most one apart; the first shards take the remainder."""
    return [n // shards + (j < n % shards) for j in range(shards)]


def split_even(n: int, pieces: int) -> list[int]:
    return [n // pieces + (j < n % pieces) for j in range(pieces)]


def communication_matrix(parts: list[int], blocks: list[int], seed: int = SEED) -> np.ndarray:
    """counts[p, b], rows that go from part p to block b, distributed as in a uniform permutation.

    Row sums are parts, column sums are blocks, both exactly.
    """
    rng, left = np.random.default_rng(seed), np.array(blocks, dtype=np.int64)
    out = np.zeros((len(parts), len(blocks)), dtype=np.int64)
    for p, n in enumerate(parts):
        if left.sum() < 1_000_000_000:
            out[p] = rng.multivariate_hypergeometric(left, n, method="marginals")
        else:  # beyond what numpy's sampler takes: which n of the free slots are taken, then in which blocks they lie
            slots = rng.choice(left.sum(), n, replace=False, shuffle=False)
            out[p] = np.bincount(np.searchsorted(np.cumsum(left), slots, side="right"), minlength=len(left))
        left -= out[p]
    return out


def shuffle_to_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """df with the shard and the slot of each row: shard sizes at most one apart, slots from 0 without gaps."""
    shard_col, slot_col = fresh(df.columns, shard_col), fresh(df.columns, slot_col)
    taken = [*df.columns, shard_col, slot_col]
    mid, part, block, turn, in_p, in_s, to, begin = (fresh(taken, c) for c in ("_mid", "_part", "_block", "_turn", "_in_p", "_in_s", "_to", "_begin"))
    # Written first: the numbers must be the same however often a lost task is run again.
    base = materialize(df.withColumn(mid, F.monotonically_increasing_id()), "shard")
    low = (1 << 33) - 1
    n = base.count()
    size = max(LEAST_ROWS, math.ceil(n / (MOST_PARTS // 2)))
    piece = [F.shiftright(mid, 33).alias("p"), F.floor(F.col(mid).bitwiseAND(F.lit(low)) / size).alias("s")]
    # One row for each input partition and piece of it: this bounds what the driver gets.
    pieces = sorted((r["p"], r["s"], r["count"]) for r in base.groupBy(*piece).count().collect())
    parts: list[int] = []
    of: list[tuple[int, int, int]] = []
    for p, s, k in pieces:  # small neighbours share a part
        if not parts or parts[-1] + k > size:
            parts.append(0)
        parts[-1] += k
        of.append((p, s, len(parts) - 1))
    blocks: list[int] = []
    starts: list[tuple[int, int]] = []
    for j, total in enumerate(shard_sizes(n, shards)):
        at = 0
        for k in split_even(total, max(1, math.ceil(total / size))):
            blocks.append(k)
            starts.append((j, at))
            at += k
    upto = np.cumsum(communication_matrix(parts, blocks, seed), axis=1) if parts else np.zeros((0, len(blocks)), dtype=np.int64)
    spark = df.sparkSession
    upto_b = spark.sparkContext.broadcast(upto)
    names = spark.createDataFrame(of or [(-1, -1, -1)], f"`{in_p}` long, `{in_s}` long, `{part}` int")
    rows = base.join(F.broadcast(names), (piece[0] == F.col(in_p)) & (piece[1] == F.col(in_s))).drop(in_p, in_s)
    # Permute inside the part; a key is a hash of seed and row number, so that it is the same in every attempt.
    rows = rows.withColumn(turn, F.row_number().over(Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed), mid), mid)) - 1)

    def deal():
        limits = upto_b.value

        def fn(parts_, turns):
            p, t = parts_.to_numpy(zero_copy_only=False), turns.to_numpy(zero_copy_only=False)
            out = np.zeros(len(p), dtype=np.int32)
            for one in np.unique(p):
                mine = p == one
                out[mine] = np.searchsorted(limits[one], t[mine], side="right")
            return [pa.array(out)]

        return fn

    rows = append_columns(rows, [part, turn], [StructField(block, IntegerType())], deal)
    places = spark.createDataFrame([(b, j, at) for b, (j, at) in enumerate(starts)], f"`{to}` int, `{shard_col}` int, `{begin}` long")
    within = F.row_number().over(Window.partitionBy(block).orderBy(F.xxhash64(F.lit(seed + 1), mid), mid)) - 1
    rows = rows.withColumn(turn, within).join(F.broadcast(places), F.col(block) == F.col(to))
    return rows.select(*(F.col(f"`{c}`") for c in df.columns), shard_col, (F.col(begin) + F.col(turn)).cast("long").alias(slot_col))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents, under the law `rows`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shuffle_to_shards(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
