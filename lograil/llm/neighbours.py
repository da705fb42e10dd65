"""Approximate nearest neighbours by shifted space-filling curves.

Nearness is the largest inner product. One more coordinate, sqrt(longest^2 - |x|^2) for candidates and 0 for queries, makes it
nearness in space. Each of several curves projects the vectors on a few random directions, spreads the projections evenly over
the unit cube, shifts the cube at random and sorts by Hilbert key. Spark range-partitions the keys; every fourth step of a curve is the
border of a key window. A vector goes to its one window on each curve; a query goes to its own window and, in the first or last step of
that, to the neighbouring one too, so that no neighbour is lost at an edge. Each window compares its queries with its vectors; windows of all
curves merge, and the best by the exact measure stay. Vectors travel as they came, single or double precision; scores are double.

Equal vectors are one node, with the k + 1 rows of the smallest ids; nodes are indexed, compared and ranked, then expanded to their rows.
So copies, however many, take one place in a window, and each of a node's query rows has the node's answer without itself.

A query meets six steps on average. A step is HALO * sqrt(n), or HALO * n^POWER / PART where that is more (from about 80,000 vectors on): vectors
without low-dimensional structure need windows that grow nearly as the table does, or recall falls. The work per query node is
curves * 6 * step, so that of a whole table grows as n^1.9. A window of more than TILE vectors or queries is compared in several tasks, each
with a block of its queries and a share of its vectors, so a task's memory does not grow. `exact` compares all queries with all vectors, in
blocks: one curve, whose one window is the table.

Vectors that are null, empty, zero, of another length than most, or hold a null or non-finite component take no part. Equal scores
go to the smaller id. Repeated rows are candidates of their own; each repeated query row has its own answer. An empty table has
an empty result. A null id is never a query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize, table

CURVES, DIMS, BITS, HALO, SEED = 28, 8, 4, 1.2, 77
#: The projections' spread is taken from so many vectors at most, those with the smallest hashes. All vectors are indexed.
SPREAD_SAMPLE = 4096
#: Growth of the steps that keeps recall, from measurements at 50,000 to 600,000 random vectors of 64 numbers.
POWER, PART = 0.9, 92
#: Query rows of one vector that one task answers.
SALT_ROWS = 256
#: Vectors that one task compares with a window's queries.
TILE = 65_536


def step_of(n: int, halo: float = HALO) -> int:
    """A sixth of a window over n vectors."""
    return max(1, math.ceil(halo * max(math.sqrt(n), n**POWER / PART)))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (rows of d coordinates of `bits` bits; d * bits <= 63).

    The Gray-code construction: from the top bit down, each coordinate either inverts or exchanges the lower bits of the first.
    """
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(d):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[d - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """Fixed projections and shifts, with the spread of the projections on a sample."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.longest, self.bits = longest, bits
        self.axes = rng.standard_normal((curves, dim + 1, dims)) / math.sqrt(dim)
        self.shift = rng.random((curves, dims)) / 2
        spread = self.lift(sample, False)
        self.marks = [np.sort(spread @ a, axis=0) for a in self.axes]

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.longest**2 - np.einsum("ij,ij->i", x, x)))
        return np.column_stack([x, rest])

    def keys(self, x: np.ndarray, query: bool) -> list[np.ndarray]:
        up, out = self.lift(x, query), []
        for axes, marks, shift in zip(self.axes, self.marks, self.shift, strict=True):
            y = up @ axes
            even = np.column_stack([np.searchsorted(marks[:, j], y[:, j]) / (len(marks) + 1) for j in range(y.shape[1])])
            out.append(hilbert_keys((even / 2 + shift) * (1 << self.bits), self.bits))
        return out


def vectors_of(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """rid, vid, v (doubles) of the vectors that take part."""
    v = F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0))  # no negative zeros
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vid"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(whole, F.lit(False)))


def _nodes(rows: DataFrame, most: int) -> DataFrame:
    """One row for each distinct vector: rid (a number of the node), vid (its smallest), v, h, g, ids (its `most` rows of smallest ids), asked, n_asked.

    The limit is taken in each partition before the shuffle, so a vector of many rows is never gathered.
    """
    same = ["h", "g"]
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy(*same).orderBy(F.asc_nulls_last("vid"), "rid"))).where(F.col("place") <= most)
    ids = first.groupBy(*same).agg(F.min_by("v", "place").alias("v"), F.min("rid").alias("rid"), F.min("vid").alias("vid"), F.array_sort(F.collect_list(F.struct("place", "vid", "rid"))).alias("ids"))
    asked = rows.where("asked").groupBy(*same).agg(F.count("*").alias("n_asked"))
    ids = ids.withColumn("ids", F.transform("ids", lambda x: F.struct(x["vid"].alias("vid"), x["rid"].alias("rid"))))
    return ids.join(asked, same, "left").withColumn("n_asked", F.coalesce("n_asked", F.lit(0))).withColumn("asked", F.col("n_asked") > 0)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", curves: int = CURVES, halo: float = HALO, seed: int = SEED, exact: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by `every`, among all other rows."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    usable = _usable(vectors, id_col, vector_col).withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(SEED), "v")})
    rows = materialize(usable.withColumn("asked", F.coalesce(F.col("vid") % every == 0, F.lit(False))), "ann")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == lengths[0]["n"])
    base = materialize(_nodes(rows, k + 1), "ann-nodes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, longest, n_asked = base.agg(F.count("*"), F.max(norm), F.sum(F.col("asked").cast("int"))).first()
    single = vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
    sample = np.array([r["v"] for r in base.orderBy("g", "h").limit(SPREAD_SAMPLE).select("v").collect()])
    curves, step = (1, n) if exact else (curves, step_of(n, halo))
    shared = spark.sparkContext.broadcast(Curves(sample, longest, curves, DIMS, BITS, seed))
    window = min(n, 4 * step)
    # A window's share of the queries is that of the table, or a little more: blocks are by number, so they may be larger by as much.
    tiles, blocks, most = math.ceil(window / TILE), math.ceil(n_asked * window / n / TILE), k + 1

    def keyed_rows(b: pa.RecordBatch):
        """(rows, their vectors, their keys on each curve, whether they are queries): candidates, then queries."""
        lists = b.column("v")
        x = np.array(lists.flatten()).reshape(b.num_rows, -1)
        asked = b.column("asked").to_numpy(zero_copy_only=False)
        yield np.arange(b.num_rows), x, shared.value.keys(x, False), False
        at = np.flatnonzero(asked)
        if len(at):
            yield at, x[at], shared.value.keys(x[at], True), True

    def keys():
        def fn(b):
            rid = b.column("rid").to_numpy()
            for at, _, per_curve, query in keyed_rows(b):
                if not query:
                    for c, key in enumerate(per_curve):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), c, dtype=np.int32)), pa.array(key), pa.array(rid[at])], names=["c", "key", "rid"])

        return fn

    # The order of each curve: sorted key ranges, then the number of rows before each range.
    slim = map_batches(base.select("rid", "asked", "v"), "c int, key long, rid long", keys)
    ranged = materialize(slim.repartitionByRange("c", "key", "rid").sortWithinPartitions("c", "key", "rid").withColumn("m", F.monotonically_increasing_id()), "ann-keys")
    p = F.shiftright("m", 33)
    firsts = ranged.groupBy(p.alias("p"), "c").agg(F.min("m").alias("first"), F.count("*").alias("k")).collect()
    before: dict[int, int] = {}
    offsets = []
    for r in sorted(firsts, key=lambda r: (r["c"], r["p"])):
        offsets.append((r["p"], r["c"], before.get(r["c"], 0) - r["first"]))
        before[r["c"]] = before.get(r["c"], 0) + r["k"]
    at = spark.createDataFrame(offsets, "p long, oc int, shift long")
    pos = ranged.withColumn("p", p).join(F.broadcast(at), ["p"]).where(F.col("c") == F.col("oc")).withColumn("pos", F.col("m") + F.col("shift"))
    # Borders at every `step`-th position: at most sqrt(n) / HALO for each curve.
    borders: list[list[tuple[int, int]]] = [[] for _ in range(curves)]
    for r in pos.where((F.col("pos") % step == 0) & (F.col("pos") > 0)).select("c", "key", "rid").collect():
        borders[r["c"]].append((r["key"], r["rid"]))
    marks_b = spark.sparkContext.broadcast([np.array(sorted(b), dtype=[("k", np.int64), ("r", np.int64)]) for b in borders])

    def deal():
        """Vectors to their windows, queries to theirs and at an edge to the next one; both to as many tasks as share a window."""

        def fn(b):
            rid = b.column("rid").to_numpy()
            vid = b.column("vid")
            for at_, x, per_curve, query in keyed_rows(b):
                raw = [v.tobytes() for v in (x.astype(np.float32) if single else x)]
                for c, key in enumerate(per_curve):
                    mark = marks_b.value[c]
                    mine = np.empty(len(at_), dtype=mark.dtype)
                    mine["k"], mine["r"] = key, rid[at_]
                    s = np.searchsorted(mark, mine, side="right")
                    own, last = s // 4, len(mark) // 4
                    targets = [(own, np.ones(len(s), bool))]
                    if query:
                        targets += [(own - 1, (s % 4 == 0) & (own > 0)), (own + 1, (s % 4 == 3) & (own < last))]
                    for w, keep in targets:
                        i = np.flatnonzero(keep)
                        if not len(i):
                            continue
                        share, number = (blocks, tiles) if query else (tiles, blocks)
                        for other in range(number):
                            fixed, mixed = np.full(len(i), other), rid[at_[i]] % share
                            tile, block = (fixed, mixed) if query else (mixed, fixed)
                            longs = [pa.array(a.astype(np.int32)) for a in (np.full(len(i), c), w[i], tile, block)]
                            yield pa.RecordBatch.from_arrays([*longs, pa.array(np.full(len(i), query)), pa.array(rid[at_[i]]), vid.take(pa.array(at_[i])), pa.array([raw[j] for j in i], pa.binary())], names=["c", "w", "t", "b", "q", "rid", "vid", "v"])

        return fn

    dealt = map_batches(base.select("rid", "vid", "asked", "v"), "c int, w int, t int, b int, q boolean, rid long, vid long, v binary", deal)

    def rerank(rows: pa.Table) -> pa.Table:
        x = vectors_of(rows.column("v"), np.float32 if single else np.float64)
        q, rid = rows.column("q").to_numpy(), rows.column("rid").to_numpy()
        vid, has = rows.column("vid").to_pylist(), np.flatnonzero(q)
        rest = np.flatnonzero(~q)
        order = rest[np.lexsort((rid[rest], [math.inf if vid[i] is None else vid[i] for i in rest]))]
        own, found = x[order], []
        for lo in range(0, len(has), 128):
            asked = has[lo : lo + 128]
            near = x[asked] @ own.T
            for i, row in zip(asked, near, strict=True):
                top = np.argsort(-row, kind="stable")[: most + 8] if len(row) <= 4 * most else (t := np.flatnonzero(row >= np.partition(row, -most)[-most] - 1e-12))[np.argsort(-row[t], kind="stable")]
                exact = np.einsum("ij,j->i", own[top], x[i])
                best = np.lexsort((top, -exact))[:most]
                found.append((i, order[top[best]], exact[best]))
        qs = np.concatenate([np.full(len(c), i) for i, c, _ in found]).astype(int) if found else np.zeros(0, int)
        cs = np.concatenate([c for _, c, _ in found]).astype(int) if found else np.zeros(0, int)
        return pa.table({"q": pa.array(rid[qs]), "rid": pa.array(rid[cs]), "vid": pa.array([vid[i] for i in cs], pa.int64()), "score": pa.array(np.concatenate([s for _, _, s in found]) if found else np.zeros(0))})

    pairs = dealt.groupBy("c", "w", "t", "b").applyInArrow(rerank, "q long, rid long, vid long, score double")
    # A query lies elsewhere than its own node if that is not of the greatest length; its copies are candidates all the same.
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    pairs = pairs.union(base.where(F.col("asked") & (F.size("ids") > 1)).select(F.col("rid").alias("q"), "rid", "vid", norm2.alias("score")))
    merged = pairs.groupBy("q", "rid").agg(F.first("vid").alias("vid"), F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vid"), "rid")
    near = merged.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most).select("q", "rid", "score")
    # Nodes to rows: the best k + 1 of a query node hold the best k of each of its rows.
    found = near.join(base.select("rid", "ids"), "rid").select("q", "score", F.inline("ids"))
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    answers = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "vid", "rid", "score"))).alias("found"))
    heads = base.where("asked").select(F.col("rid").alias("q"), "h", "g", F.ceil(F.col("n_asked") / SALT_ROWS).cast("int").alias("salts"))
    answers = answers.join(heads, "q").select("h", "g", "found", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    # Vectors with more query rows than SALT_ROWS: fewer than the queries by that factor.
    hot = heads.where("salts > 1").select("h", "g", "salts")
    asked = rows.where("asked").select("h", "g", F.col("vid").alias("query_id"), F.col("rid").alias("own")).join(F.broadcast(hot), ["h", "g"], "left")
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("own"), F.coalesce("salts", F.lit(1))).cast("int"))
    others = F.slice(F.filter("found", lambda x: x["rid"] != F.col("own")), 1, k)
    out = asked.join(answers, ["h", "g", "salt"]).select("query_id", F.posexplode(others).alias("at", "one"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.vid").alias("vec_id"), F.col("one.score").alias("score"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of each vector whose vec_id is divisible by 20, among all other vectors."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
