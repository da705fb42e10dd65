"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

Texts are lower-cased and everything but letters and digits becomes one space. Features are the distinct character n-grams of 3 to 6,
hashed to 2^20 columns. Each column is scaled by r = log((p / |p|) / (q / |q|)), where p and q count (plus a prior) the toxic and the
other training documents that have it. Columns that fewer than LEAST_DOCS training documents have, or whose ratio is smaller than LEAST_RATIO
in size, are left out: the first are chance, and scaled by so little the others would weigh next to nothing. A logistic regression with an L2 penalty then weighs the scaled columns. Both classes weigh the
same in it. Slope and intercept of the scores are calibrated on margins out of the fold, where the labels weigh as they are.

The model is fitted on a bounded sample: at most TRAIN_ROWS documents a class, those with the smallest hashes of their ids, and of
these no more than TRAIN_CHARS characters a class; of rows that repeat an id the one whose text has the smallest hash. Every document is scored on its whole text; only the text enters the score.

Null and empty texts have no n-grams and score what the intercept says of any text. Repeated rows get equal scores. An id with several labels counts
as toxic if one of them is 1; null labels and ids are not learned from. With no toxic or no other training document, every score is 0. An
empty table has an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .common import append_columns, fresh, map_batches, table

NGRAMS = (3, 4, 5, 6)
LOG_COLUMNS = 20
COLUMNS = 1 << LOG_COLUMNS
TRAIN_ROWS, TRAIN_CHARS = 2500, 5_000_000
#: Training documents that must have a column, and the least size of its ratio.
LEAST_DOCS, LEAST_RATIO = 3, 1.0
PRIOR, PENALTY, ROUNDS, FOLDS = 1.0, 0.02, 120, 4
_OTHER = re.compile(r"[\W_]+")
_BASE = np.uint32(0x01000193)
_SPREAD = (np.arange(1, 2 * max(NGRAMS) + 4, 2, dtype=np.uint64) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)


class Features:
    """Distinct feature columns of a text; keeps a table for finding the distinct ones without sorting."""

    def __init__(self):
        self.last = np.zeros(COLUMNS, dtype=np.int32)

    def columns(self, text: str | None) -> np.ndarray:
        clean = " " + _OTHER.sub(" ", (text or "").lower()).strip() + " "
        if len(clean) < 3:
            return np.zeros(0, np.int32)
        code = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        h, found = code * _BASE + np.uint32(1), []
        for n in range(2, max(NGRAMS) + 1):
            if len(h) < 2:
                break
            h = (h[:-1] * _BASE) ^ (code[n - 1 :] * _SPREAD[0])
            if n in NGRAMS:
                c = h ^ (h >> np.uint32(15))
                found.append(((c * _SPREAD[n]) >> np.uint32(32 - LOG_COLUMNS)).astype(np.int32))
        if not found:
            return np.zeros(0, np.int32)
        every = np.concatenate(found)
        place = np.arange(len(every), dtype=np.int32)
        self.last[every] = place
        return every[self.last[every] == place]


class Model:
    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self, columns: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[columns].sum(dtype=np.float64), -700, 700))))


def fit(rows: list[np.ndarray], toxic: np.ndarray) -> Model | None:
    """The model from feature columns and labels, not yet calibrated: its intercept is 0. None unless both labels occur."""
    if not toxic.any() or toxic.all():
        return None
    y = toxic.astype(np.float64)
    p, q = np.full(COLUMNS, PRIOR), np.full(COLUMNS, PRIOR)
    for r, t in zip(rows, toxic, strict=True):  # a row has each of its columns once
        (p if t else q)[r] += 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    seen = np.flatnonzero((p + q - 2 * PRIOR >= LEAST_DOCS) & (np.abs(ratio) >= LEAST_RATIO))
    new = np.full(COLUMNS, -1, dtype=np.int32)
    new[seen] = np.arange(len(seen), dtype=np.int32)
    kept = [c[c >= 0] for c in (new[r] for r in rows)]
    cols = np.concatenate(kept)
    owner = np.repeat(np.arange(len(kept), dtype=np.int32), [len(c) for c in kept])
    del kept
    x, n = ratio[seen], len(rows)
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))  # both classes weigh the same
    w, b = np.zeros(len(seen)), float(np.log(y.mean() / (1 - y.mean())))
    mw, vw = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, ROUNDS + 1):
        margin = np.bincount(owner, weights=(w * x)[cols], minlength=n) + b
        slope = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - y) * each
        gw = x * np.bincount(cols, weights=slope[owner], minlength=len(seen)) + PENALTY * w
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        a = 0.05 / (1 + t / 60) * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= a * mw / (np.sqrt(vw) + 1e-8)
    full = np.zeros(COLUMNS, dtype=np.float32)
    full[seen] = w * x
    return Model(full, 0.0)


def calibrated(rows: list[np.ndarray], toxic: np.ndarray) -> Model | None:
    """The model fitted on all rows, with slope and intercept that make scores probabilities.

    These are fitted on margins that models of the other FOLDS - 1 parts give each part of the rows (Platt's scaling, with his targets
    short of 0 and 1), so that what the model knows of its own training rows by heart does not count.
    """
    model = fit(rows, toxic)
    if model is None:
        return None
    margins, fold = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
    for label in (False, True):  # each fold has its share of both labels
        at = np.random.default_rng(FOLDS).permutation(np.flatnonzero(toxic == label))
        fold[at] = np.arange(len(at)) % FOLDS
    for k in range(FOLDS):
        part, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        other = fit([rows[i] for i in rest], toxic[rest])
        if other is None or not len(part):
            share = toxic.mean()
            return Model(model.weights, float(np.log(share / (1 - share))))
        margins[part] = [other.weights[rows[i]].sum(dtype=np.float64) for i in part]
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    at = np.array([1.0, np.log(n1 / n0)])

    def loss(ab: np.ndarray) -> float:  # with a little weight on a slope of 1
        z = ab[0] * margins + ab[1]
        return float((np.logaddexp(0, z) - target * z).sum() + 0.005 * (ab[0] - 1) ** 2)

    for _ in range(50):  # Newton's steps, halved until they gain
        s = 1 / (1 + np.exp(-np.clip(at[0] * margins + at[1], -60, 60)))
        h = s * (1 - s)
        slope = np.array([((s - target) * margins).sum() + 0.01 * (at[0] - 1), (s - target).sum()])
        curve = np.array([[(h * margins**2).sum() + 0.01, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-6]])
        step, before = np.linalg.solve(curve, slope), loss(at)
        while loss(at - step) > before and np.abs(step).max() > 1e-9:
            step = step / 2
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    a, b = max(at[0], 0.01), at[1]
    return Model((a * model.weights).astype(np.float32), float(b))


def held_out(id_col: str):
    """Whether crc32 of the id as text, modulo 5, is 0; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    picked = [known.where(F.col("_y") == y).orderBy(F.xxhash64(id_col), id_col).limit(TRAIN_ROWS).withColumn("_o", F.xxhash64(id_col)) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).select(F.col(id_col).alias("_i"), "_y", "_o")
    slim = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
    first = lambda c: F.min_by(c, F.xxhash64("_t"))  # noqa: E731  one row for each id, before anything moves
    sizes = slim.join(F.broadcast(chosen), "_i").groupBy("_i", "_y", "_o").agg(first(F.length("_t")).alias("_n")).select("_i", "_y", "_o", F.coalesce("_n", F.lit(0)).alias("_n")).collect()
    ids, used = [], {0: 0, 1: 0}
    for r in sorted(sizes, key=lambda r: (r["_o"], r["_i"])):
        if used[r["_y"]] + r["_n"] <= TRAIN_CHARS or not used[r["_y"]]:
            used[r["_y"]] += r["_n"]
            ids.append((r["_i"], r["_y"]))
    if not ids:
        return None
    few = docs.sparkSession.createDataFrame(ids, "_i long, _y int")

    def features():
        maker = Features()

        def fn(b):
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                yield pa.RecordBatch.from_arrays([pa.array([maker.columns(t.as_py()).tobytes() for t in part.column("_t")], pa.binary()), part.column("_y"), part.column("_i")], names=["f", "y", "i"])

        return fn

    # Dealt to as many tasks as there are partitions, so that each makes a small part of the features.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    texts = slim.join(F.broadcast(few), "_i").groupBy("_i", "_y").agg(first("_t").alias("_t")).repartition(parts, "_i").select("_t", "_y", "_i")
    rows = map_batches(texts, "f binary, y int, i long", features)
    # At most 2 * TRAIN_ROWS rows, and 2 * TRAIN_CHARS * len(NGRAMS) columns of 4 bytes, come to the driver.
    got = rows.toArrow().combine_chunks()
    if not got.num_rows:
        return None
    y, fields = got["y"].to_numpy() == 1, got["f"].chunk(0)
    ends = np.frombuffer(fields.buffers()[1], np.int32, len(fields) + 1, fields.offset * 4) // 4
    columns = np.frombuffer(fields.buffers()[2], np.int32)  # no copy: rows are views of what came
    # Columns of too few documents are no columns of any fold's model either.
    often = np.bincount(columns[ends[0] : ends[-1]], minlength=COLUMNS) >= LEAST_DOCS
    order = np.lexsort((got["y"].to_numpy(), got["i"].to_numpy())).tolist()
    held = [columns[ends[k] : ends[k + 1]] for k in order]
    held = [r[often[r]] for r in held]
    del got, fields, columns
    return calibrated(held, y[order])


def score(self, columns: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[columns].sum(dtype=np.float64), -700, 700))))


def fit(rows: list[np.ndarray], toxic: np.ndarray) -> Model | None:
    """The model from feature columns and labels, not yet calibrated: its intercept is 0. None unless both labels occur."""
    if not toxic.any() or toxic.all():
        return None
    y = toxic.astype(np.float64)
    p, q = np.full(COLUMNS, PRIOR), np.full(COLUMNS, PRIOR)
    for r, t in zip(rows, toxic, strict=True):  # a row has each of its columns once
        (p if t else q)[r] += 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    seen = np.flatnonzero((p + q - 2 * PRIOR >= LEAST_DOCS) & (np.abs(ratio) >= LEAST_RATIO))
    new = np.full(COLUMNS, -1, dtype=np.int32)
    new[seen] = np.arange(len(seen), dtype=np.int32)
    kept = [c[c >= 0] for c in (new[r] for r in rows)]
    cols = np.concatenate(kept)
    owner = np.repeat(np.arange(len(kept), dtype=np.int32), [len(c) for c in kept])
    del kept
    x, n = ratio[seen], len(rows)
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))  # both classes weigh the same
    w, b = np.zeros(len(seen)), float(np.log(y.mean() / (1 - y.mean())))
    mw, vw = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, ROUNDS + 1):
        margin = np.bincount(owner, weights=(w * x)[cols], minlength=n) + b
        slope = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - y) * each
        gw = x * np.bincount(cols, weights=slope[owner], minlength=len(seen)) + PENALTY * w
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        a = 0.05 / (1 + t / 60) * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= a * mw / (np.sqrt(vw) + 1e-8)
    full = np.zeros(COLUMNS, dtype=np.float32)
    full[seen] = w * x
    return Model(full, 0.0)


def calibrated(rows: list[np.ndarray], toxic: np.ndarray) -> Model | None:
    """The model fitted on all rows, with slope and intercept that make scores probabilities.

    These are fitted on margins that models of the other FOLDS - 1 parts give each part of the rows (Platt's scaling, with his targets
    short of 0 and 1), so that what the model knows of its own training rows by heart does not count.
    """
    model = fit(rows, toxic)
    if model is None:
        return None
    margins, fold = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
    for label in (False, True):  # each fold has its share of both labels
        at = np.random.default_rng(FOLDS).permutation(np.flatnonzero(toxic == label))
        fold[at] = np.arange(len(at)) % FOLDS
    for k in range(FOLDS):
        part, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        other = fit([rows[i] for i in rest], toxic[rest])
        if other is None or not len(part):
            share = toxic.mean()
            return Model(model.weights, float(np.log(share / (1 - share))))
        margins[part] = [other.weights[rows[i]].sum(dtype=np.float64) for i in part]
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    at = np.array([1.0, np.log(n1 / n0)])

    def loss(ab: np.ndarray) -> float:  # with a little weight on a slope of 1
        z = ab[0] * margins + ab[1]
        return float((np.logaddexp(0, z) - target * z).sum() + 0.005 * (ab[0] - 1) ** 2)

    for _ in range(50):  # Newton's steps, halved until they gain
        s = 1 / (1 + np.exp(-np.clip(at[0] * margins + at[1], -60, 60)))
        h = s * (1 - s)
        slope = np.array([((s - target) * margins).sum() + 0.01 * (at[0] - 1), (s - target).sum()])
        curve = np.array([[(h * margins**2).sum() + 0.01, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-6]])
        step, before = np.linalg.solve(curve, slope), loss(at)
        while loss(at - step) > before and np.abs(step).max() > 1e-9:
            step = step / 2
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    a, b = max(at[0], 0.01), at[1]
    return Model((a * model.weights).astype(np.float32), float(b))


def held_out(id_col: str):
    """Whether crc32 of the id as text, modulo 5, is 0; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    picked = [known.where(F.col("_y") == y).orderBy(F.xxhash64(id_col), id_col).limit(TRAIN_ROWS).withColumn("_o", F.xxhash64(id_col)) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).select(F.col(id_col).alias("_i"), "_y", "_o")
    slim = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
    first = lambda c: F.min_by(c, F.xxhash64("_t"))  # noqa: E731  one row for each id, before anything moves
    sizes = slim.join(F.broadcast(chosen), "_i").groupBy("_i", "_y", "_o").agg(first(F.length("_t")).alias("_n")).select("_i", "_y", "_o", F.coalesce("_n", F.lit(0)).alias("_n")).collect()
    ids, used = [], {0: 0, 1: 0}
    for r in sorted(sizes, key=lambda r: (r["_o"], r["_i"])):
        if used[r["_y"]] + r["_n"] <= TRAIN_CHARS or not used[r["_y"]]:
            used[r["_y"]] += r["_n"]
            ids.append((r["_i"], r["_y"]))
    if not ids:
        return None
    few = docs.sparkSession.createDataFrame(ids, "_i long, _y int")

    def features():
        maker = Features()

        def fn(b):
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                yield pa.RecordBatch.from_arrays([pa.array([maker.columns(t.as_py()).tobytes() for t in part.column("_t")], pa.binary()), part.column("_y"), part.column("_i")], names=["f", "y", "i"])

        return fn

    # Dealt to as many tasks as there are partitions, so that each makes a small part of the features.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    texts = slim.join(F.broadcast(few), "_i").groupBy("_i", "_y").agg(first("_t").alias("_t")).repartition(parts, "_i").select("_t", "_y", "_i")
    rows = map_batches(texts, "f binary, y int, i long", features)
    # At most 2 * TRAIN_ROWS rows, and 2 * TRAIN_CHARS * len(NGRAMS) columns of 4 bytes, come to the driver.
    got = rows.toArrow()
    order = np.lexsort((got["y"].to_numpy(), got["i"].to_numpy())).tolist()
    fields, y = got["f"], got["y"].to_numpy() == 1
    return calibrated([np.frombuffer(fields[k].as_py(), dtype=np.int32) for k in order], y[order])


def score(docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> tuple[DataFrame, str]:
    """docs with a column of scores, and that column's name."""
    name = fresh(docs.columns, score_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m, maker = shared.value, Features()

        def fn(texts):
            return [pa.array([m.score(maker.columns(t.as_py())) if m else 0.0 for t in texts], pa.float64())]

        return fn

    return append_columns(docs, [text_col], [StructField(name, DoubleType())], make), name


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that score below `least`, as they came."""
    scored, name = score(docs, train(docs, labels))
    return scored.where(F.col(name) < least).select(*docs.columns)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, name = score(docs, train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col(name).alias("score"), (F.col(name) >= 0.5).cast("int").alias("predicted"))
