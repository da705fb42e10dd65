"""Samples of a cluster, for a template source to look at.

A sampler works on the messages of one cluster, which a micro-batch bounds; `sample_clusters` runs it on all clusters in parallel. All
choices by chance depend on an explicit seed.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lograil.shipping import ensure_shipped


def _sets(messages: list[str]) -> list[set[str]]:
    return [set(m.split()) for m in messages]


def jaccard_matrix(messages: list[str]) -> np.ndarray:
    """Jaccard distances; two messages without words are at distance 0."""
    vocabulary = {t: k for k, t in enumerate(sorted({t for s in _sets(messages) for t in s}))}
    x = np.zeros((len(messages), max(1, len(vocabulary))))
    for i, s in enumerate(_sets(messages)):
        x[i, [vocabulary[t] for t in s]] = 1
    common, size = x @ x.T, x.sum(axis=1)
    union = size[:, None] + size[None, :] - common
    return 1 - np.divide(common, union, out=np.ones_like(common), where=union > 0)


def near_medoid(messages: list[str], count: int) -> list[int]:
    """The medoid and what is nearest to it."""
    if len(messages) <= count:
        return list(range(len(messages)))
    d = jaccard_matrix(messages)
    return np.argsort(d[d.sum(axis=1).round(12).argmin()], kind="stable")[:count].tolist()


def tfidf(messages: list[str], pattern: str = r"(?u)\b\w\w+\b") -> np.ndarray | None:
    """Unit tf-idf rows (lower case, smooth idf plus one); None without any word."""
    words = [re.findall(pattern, m.lower()) for m in messages]
    vocabulary = {t: k for k, t in enumerate(sorted({t for w in words for t in w}))}
    if not vocabulary:
        return None
    x = np.zeros((len(messages), len(vocabulary)))
    for i, w in enumerate(words):
        for t, n in Counter(w).items():
            x[i, vocabulary[t]] = n
    x *= np.log((1 + len(messages)) / (1 + (x > 0).sum(axis=0))) + 1
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def cosine(x: np.ndarray) -> np.ndarray:
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    return unit @ unit.T


def most_diverse(kernel: np.ndarray, k: int) -> list[int]:
    """Greedy choice of the rows whose kernel has the largest determinant, the first of equals.

    A row's gain is what is left of its diagonal after projecting out the chosen ones, so no determinant is ever taken.
    """
    left, chosen = np.diag(kernel).astype(float).copy(), []
    basis = np.zeros((len(kernel), 0))
    while len(chosen) < min(k, len(kernel)):
        gain = left.copy()
        gain[chosen] = -np.inf
        i = int(np.argmax(np.round(gain, 12)))
        chosen.append(i)
        row = (kernel[:, i] - basis @ basis[i]) / np.sqrt(max(left[i], 1e-12))
        basis = np.column_stack([basis, row])
        left = np.maximum(left - row**2, 0)
    return chosen


def hashed_embedding(message: str, size: int = 64) -> np.ndarray:
    """A deterministic stand-in for an embedding model: hashed words with signs."""
    import zlib

    v = np.zeros(size)
    for t in message.split():
        h = zlib.crc32(t.encode())
        v[h % size] += 1 if h & 0x80000000 else -1
    return v


def dpp(messages: list[str], count: int, seed: int = 0, kernel: str = "embedding", embed=hashed_embedding, pool: int = 100, longest: int | None = 4000) -> list[int]:
    """A diverse choice from a pool of at most `pool` messages (drawn with the seed); too long ones come in by nearness to their medoid."""
    if len(messages) <= count:
        return list(range(len(messages)))
    rng = np.random.default_rng(seed)
    at = sorted(rng.choice(len(messages), pool, replace=False).tolist()) if len(messages) > pool else list(range(len(messages)))
    if kernel == "tfidf":
        x = tfidf([messages[i] for i in at])
        return rng.choice(len(messages), count, replace=False).tolist() if x is None else [at[i] for i in most_diverse(cosine(x), count)]
    short = [i for i in at if longest is None or len(messages[i]) <= longest]
    rest = [i for i in at if i not in set(short)]
    chosen = [short[i] for i in most_diverse(cosine(np.array([embed(messages[i]) for i in short])), count)] if short else []
    return chosen + [rest[i] for i in near_medoid([messages[i] for i in rest], count - len(chosen))] if len(chosen) < count and rest else chosen


def _kmeans(x: np.ndarray, k: int, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Labels and centres, from starts that are far apart."""
    starts = [0]
    while len(starts) < k:
        d = np.min(((x[:, None, :] - x[starts][None, :, :]) ** 2).sum(axis=2), axis=1)
        d[starts] = -1
        starts.append(int(d.argmax()))
    centres = x[starts].copy()
    labels = np.full(len(x), -1)
    for _ in range(rounds):
        new = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        if (new == labels).all():
            break
        labels = new
        for j in range(k):
            if (labels == j).any():
                centres[j] = x[labels == j].mean(axis=0)
    return labels, centres


def balanced_groups(x: np.ndarray, size: int) -> list[list[int]]:
    """Groups of at most `size` rows: k-means, then the least similar members of full groups move on to the next best with room."""
    k = max(1, -(-len(x) // size))
    labels, centres = _kmeans(x, k)
    near = 0.5 + 0.5 * np.nan_to_num((x @ centres.T) / np.maximum(np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(centres, axis=1)[None, :], 1e-300))
    groups = [np.flatnonzero(labels == j).tolist() for j in range(k)]
    for j in range(k):
        if len(groups[j]) > size:
            groups[j].sort(key=lambda i: -near[i, j])
            groups[j], moving = groups[j][:size], groups[j][size:]
            for i in moving:
                to = next((c for c in np.argsort(-near[i], kind="stable") if len(groups[c]) < size), None)
                if to is not None:
                    groups[to].append(i)
    return groups


def similar(messages: list[str], count: int, seed: int = 0, mode: str = "production") -> list[int]:
    """Messages like each other: near the medoid, or the first of the balanced groups."""
    if len(messages) <= count:
        return list(range(len(messages)))
    x = tfidf(messages) if mode == "original" else None
    return near_medoid(messages, count) if x is None else balanced_groups(x, count)[0]


def at_random(messages: list[str], count: int, seed: int = 0) -> list[int]:
    if len(messages) <= count:
        return list(range(len(messages)))
    return np.random.default_rng(seed).choice(len(messages), count, replace=False).tolist()


def _bag_similarity(a: Counter, b: Counter) -> float:
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def adaptive(messages: list[str], count: int = 3, seed: int = 0, similarity: str = "jaccard", most: int = 200, nearest: bool = False) -> list[int]:
    """The longest message first, then always the one farthest from those chosen (or nearest), by Jaccard of tokens or by cosine."""
    if similarity not in ("jaccard", "cosine", "random"):
        raise ValueError(f"no such similarity: {similarity}")
    at = at_random(messages, most, seed)
    if similarity == "random":
        return [at[i] for i in at_random([messages[i] for i in at], count, seed)]
    bags = [Counter(re.findall(r"\w+|[^\w\s]", messages[i])) for i in at]
    if similarity == "jaccard":
        near = lambda i, j: _bag_similarity(bags[i], bags[j])
    else:
        norm = [sum(v * v for v in b.values()) ** 0.5 for b in bags]
        near = lambda i, j: sum(v * bags[j][t] for t, v in bags[i].items()) / (norm[i] * norm[j]) if norm[i] * norm[j] else 0.0
    left = list(range(len(at)))
    chosen = [max(left, key=lambda i: len(messages[at[i]].split()))] if left else []
    while len(chosen) < min(count, len(at)):
        rest = [i for i in left if i not in chosen]
        apart = {i: min(1 - near(i, j) for j in chosen) for i in rest}
        chosen.append(min(rest, key=apart.get) if nearest else max(rest, key=apart.get))
    return [at[i] for i in chosen]


def diverse_examples(references: list[str], count: int = 3, seed: int = 0) -> list[int]:
    """A first example by chance, then always the one least like the most similar of those chosen."""
    if len(references) <= count:
        return list(range(len(references)))
    like = 1 - jaccard_matrix(references)
    chosen = [int(np.random.default_rng(seed).integers(len(references)))]
    while len(chosen) < count:
        worst = like[:, chosen].max(axis=1)
        worst[chosen] = np.inf
        chosen.append(int(worst.argmin()))
    return chosen


def truncate_batch(messages: list[str], to: int = 3) -> list[str]:
    """The first three of a batch that differs in digits alone."""
    return messages[:to] if len({re.sub(r"\d+", "", m) for m in messages}) == 1 else messages


#: Samplers by name: (messages, count, seed) -> places.
SAMPLERS = {"DPPSampler": dpp, "SimilarSampler": similar, "RandomSampler": at_random, "AdaptiveSampler": adaptive}


def sampler(name: str):
    if name not in SAMPLERS:
        raise ValueError(f"no such sampler: {name}")
    return SAMPLERS[name]


#: Messages of a cluster that a sampler sees at most, where it has no such setting of its own.
POOLS = {"DPPSampler": 100, "AdaptiveSampler": 200, "SimilarSampler": 1000}


def options(settings) -> dict:
    """What the settings of the batch method say to their sampler."""
    if settings.sampler == "DPPSampler":
        return {"kernel": "tfidf" if settings.dpp_kernel_mode == "original" else "embedding", "pool": settings.dpp_pool, "longest": settings.embedding_length}
    return {"mode": settings.similar_sampler_mode} if settings.sampler == "SimilarSampler" else {}


def sample_clusters(clustered: DataFrame, name: str, count: int, cluster: str = "cluster", message: str = "message", order: str = "id", seed: int = 0, **more) -> DataFrame:
    """cluster, rank, message: the sample of each cluster. Messages enter distinct, in the order of their first copy.

    Of a large cluster a pool comes to the sampler, by a hash of seed and message: each partition keeps its share before anything moves, so no
    cluster is ever gathered.
    """
    choose = sampler(name)
    ensure_shipped(clustered.sparkSession)
    pool = more.get("pool") or more.get("most") or POOLS.get(name, count)
    kind = clustered.schema[cluster].dataType.simpleString()
    distinct = clustered.groupBy(cluster, message).agg(F.min(order).alias("_o"))
    turn = F.row_number().over(Window.partitionBy(cluster).orderBy(F.xxhash64(F.lit(seed), message), message))
    pooled = distinct.withColumn("_t", turn).where(F.col("_t") <= pool).drop("_t")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        messages = rows.sort_values("_o")[message].tolist()
        picked = [messages[i] for i in choose(messages, count, seed, **more)]
        return pd.DataFrame({cluster: [key[0]] * len(picked), "rank": range(1, len(picked) + 1), message: picked})

    return pooled.groupBy(cluster).applyInPandas(run, f"`{cluster}` {kind}, rank int, `{message}` string")
