"""Clusters of messages: by length, by similarity, and what becomes of the noise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lograil.functions import text as T
from lograil.storage import discard, materialize

def by_length(logs: DataFrame, message: str = "message", dataset: str | None = None) -> DataFrame:
    """logs with n_tokens and cluster: one cluster for each dataset and number of words."""
    n = F.size(T.word_tokens(message))
    keys = ([F.col(dataset)] if dataset else [F.lit("unknown")]) + [n]
    return logs.withColumn("n_tokens", n).withColumn("cluster", F.concat_ws("_", *keys))


def vectors(logs: DataFrame, id_col: str, message: str = "message", weighting: str = "binary") -> DataFrame:
    """id, token, w: unit vectors of lower-cased words, binary or by tf-idf (smooth idf, plus one)."""
    words = logs.select(id_col, F.explode(T.word_tokens(F.lower(F.col(message)))).alias("token"))
    tf = words.groupBy(id_col, "token").agg(F.count("*").alias("tf"))
    if weighting == "binary":
        return tf.select(id_col, "token", F.lit(1.0).alias("w"))
    n = logs.agg(F.count("*").alias("n"))
    df = tf.groupBy("token").agg(F.count("*").alias("df"))
    raw = tf.join(df, "token").crossJoin(F.broadcast(n)).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))  # n is one row
    norm = raw.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, id_col).select(id_col, "token", (F.col("w") / F.col("norm")).alias("w"))


def distances(logs: DataFrame, id_col: str = "id", message: str = "message", weighting: str = "binary", within: str | None = None) -> DataFrame:
    """a, b, d of the pairs (a < b) that share a word: Jaccard distance of binary vectors, cosine distance of tf-idf ones.

    Pairs come from an inverted index, so that what shares nothing, at distance 1, is never a row. This is for a micro-batch's distinct
    messages: the number of pairs is what the index holds. With `within` only pairs of one group are made.
    """
    v = vectors(logs, id_col, message, weighting)
    same = F.col("x.token") == F.col("y.token")
    if within:
        v = v.join(logs.select(id_col, F.col(within).alias("_g")), id_col)
        same = same & (F.col("x._g") == F.col("y._g"))
    pairs = v.alias("x").join(v.alias("y"), same).where(F.col(f"x.{id_col}") < F.col(f"y.{id_col}"))
    shared = pairs.groupBy(F.col(f"x.{id_col}").alias("a"), F.col(f"y.{id_col}").alias("b")).agg(F.count("*").alias("c"), F.sum(F.col("x.w") * F.col("y.w")).alias("dot"))
    if weighting != "binary":
        return shared.select("a", "b", F.greatest(F.lit(0.0), 1 - F.col("dot")).alias("d"))
    size = v.groupBy(id_col).agg(F.count("*").alias("n"))
    sized = shared.join(size.select(F.col(id_col).alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col(id_col).alias("b"), F.col("n").alias("nb")), "b")
    return sized.select("a", "b", (1 - F.col("c") / (F.col("na") + F.col("nb") - F.col("c"))).alias("d"))


def dynamic_eps(logs: DataFrame, threshold: float, message: str = "message") -> float:
    """The radius that grows with the spread of the messages' lengths in words, between 0.05 and 0.5."""
    spread = logs.agg(F.stddev_pop(F.size(T.word_tokens(message))).alias("s")).first()["s"] or 0.0
    return min(0.5, max(0.05, (1 - threshold) * (1 + 0.1 * spread)))


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node that can be reached; links: a, b."""
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")).withColumnRenamed("a", "node"), "labels")
    while True:
        # A node takes the least label among its neighbours', then that label's own label: paths halve.
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("l").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("l", "m").alias("n"), "l")
        up = step.select(F.col("node").alias("p"), F.col("n").alias("q"))
        old, new = labels, materialize(step.join(up, step["n"] == up["p"], "left").select("node", F.least("n", F.coalesce("q", "n")).alias("n"), "l"), "labels")
        changed = not new.where("n <> l").isEmpty()
        labels = new.select("node", F.col("n").alias("l"))
        discard(old)
        if not changed:
            return labels.withColumnRenamed("l", "component")


def near_pairs(nodes: DataFrame, radius: str, id_col: str = "id", message: str = "message", weighting: str = "binary", within: str | None = None) -> DataFrame:
    """a, b of the pairs (a < b) no farther apart than the column `radius` of a says. With `within` only pairs of one group.

    Of two sets that share the part t of their union, one shares a word with the n - ceil(t n) + 1 rarest of the other's n: only these are
    indexed, so that words which all messages have make no pairs. Cosine distances come from the whole index.
    """
    group = F.col(within) if within else F.lit(0)
    if weighting != "binary":
        bound = nodes.select(F.col(id_col).alias("a"), F.col(radius).alias("_r"))
        return distances(nodes, id_col, message, weighting, within).join(bound, "a").where(F.col("d") <= F.col("_r") + 1e-12).select("a", "b")
    words = nodes.select(F.col(id_col).alias("i"), group.alias("g"), F.col(radius).alias("r"), F.explode(F.array_distinct(T.word_tokens(F.lower(F.col(message))))).alias("w"))
    often = words.groupBy("g", "w").agg(F.count("*").alias("k"))
    sets = words.join(often, ["g", "w"]).groupBy("i", "g", "r").agg(F.array_sort(F.collect_list(F.struct("k", "w"))).alias("s"))
    sets = materialize(sets.select("i", "g", "r", F.transform("s", lambda x: x["w"]).alias("s")), "word-sets")
    few = F.size("s") - F.ceil((1 - F.col("r")) * F.size("s") - 1e-9).cast("int") + 1
    rare = sets.select("i", "g", F.explode(F.slice("s", 1, F.least(few, F.size("s")))).alias("w"))
    met = rare.alias("x").join(rare.alias("y"), (F.col("x.g") == F.col("y.g")) & (F.col("x.w") == F.col("y.w"))).where(F.col("x.i") < F.col("y.i"))
    met = met.select(F.col("x.i").alias("a"), F.col("y.i").alias("b")).distinct()
    both = met.join(sets.select(F.col("i").alias("a"), "r", F.col("s").alias("p")), "a").join(sets.select(F.col("i").alias("b"), F.col("s").alias("q")), "b")
    return both.where(1 - T.jaccard(F.col("p"), F.col("q")) <= F.col("r") + 1e-12).select("a", "b")


def by_similarity(logs: DataFrame, threshold: float = 0.8, id_col: str = "id", message: str = "message", weighting: str = "binary", dynamic: bool = False, within: str | None = None) -> DataFrame:
    """logs with cluster: the least id of a cluster, null for noise. With `within` groups (batches) cluster apart from each other.

    Density clustering with neighbourhoods of two is the components of the graph of near pairs, singletons being noise. Equal messages are one
    node; a message that occurs twice is a cluster even without a near one. `dynamic`: each group's radius follows its own spread of lengths.
    """
    keys = ([within] if within else []) + [message]
    nodes = logs.groupBy(*keys).agg(F.min(id_col).alias("_node"), F.count("*").alias("_copies"))
    if dynamic:
        spread = logs.groupBy(*keys[:-1]).agg(F.coalesce(F.stddev_pop(F.size(T.word_tokens(message))), F.lit(0.0)).alias("_sd"))
        nodes = nodes.join(spread, within) if within else nodes.join(F.broadcast(spread), F.lit(True))  # one row
        nodes = nodes.withColumn("_eps", F.least(F.lit(0.5), F.greatest(F.lit(0.05), (1 - threshold) * (1 + 0.1 * F.col("_sd"))))).drop("_sd")
    else:
        nodes = nodes.withColumn("_eps", F.lit(1 - threshold))
    found = components(near_pairs(nodes, "_eps", "_node", message, weighting, within))
    of = nodes.join(found, nodes["_node"] == found["node"], "left").select(*keys, F.coalesce("component", F.when(F.col("_copies") > 1, F.col("_node"))).alias("cluster"))
    return logs.join(of, keys)


def settle_noise(clustered: DataFrame, id_col: str = "id", message: str = "message") -> DataFrame:
    """Noise joins others with equal words (values, numbers and paths aside), or is a cluster of its own."""
    key = T.noise_key(message)
    first = clustered.where("cluster IS NULL").groupBy(key.alias("_key")).agg(F.min(id_col).alias("_c"))
    out = clustered.withColumn("_key", F.when(F.col("cluster").isNull(), key)).join(first, "_key", "left")
    return out.withColumn("cluster", F.coalesce("cluster", "_c")).drop("_key", "_c")


def noise_tiers(noise: DataFrame, matched: DataFrame, message: str = "message", retries: str = "retries", most_retries: int = 2, last: bool = False) -> DataFrame:
    """noise with tier and template: of the cache (`matched`: message, template), to be tried again, or masked and for quarantine."""
    out = noise.join(matched.select(message, F.col("template").alias("_t")), message, "left")
    again = (F.coalesce(F.col(retries), F.lit(0)) < most_retries) & F.lit(not last)
    tier = F.when(F.col("_t").isNotNull(), "cache").when(again, "again").otherwise("masked")
    return out.withColumn("tier", tier).withColumn("template", F.when(F.col("tier") == "cache", F.col("_t")).when(F.col("tier") == "masked", T.premask(message))).drop("_t")


def medoids(clustered: DataFrame, id_col: str = "id", message: str = "message", weighting: str = "binary") -> DataFrame:
    """cluster, id, message: the member with the least sum of distances to the others, the first of equals."""
    inside = distances(clustered.where("cluster IS NOT NULL"), id_col, message, weighting, "cluster")
    # A pair that shares nothing is at distance 1: what a member saves against that, summed, ranks the members just as well.
    saved = inside.select(F.explode(F.array("a", "b")).alias("_i"), (1 - F.col("d")).alias("s")).groupBy("_i").agg(F.sum("s").alias("s"))
    scored = clustered.join(saved, clustered[id_col] == saved["_i"], "left").withColumn("s", F.round(F.coalesce("s", F.lit(0.0)), 9))
    best = scored.where("cluster IS NOT NULL").withColumn("_r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("s"), id_col)))
    return best.where("_r = 1").select("cluster", id_col, message)


#: Clusterers by name.
CLUSTERERS = {"LengthCluster": by_length, "SimilarityCluster": by_similarity}


def clusterer(name: str):
    if name not in CLUSTERERS:
        raise ValueError(f"no such clusterer: {name}")
    return CLUSTERERS[name]
