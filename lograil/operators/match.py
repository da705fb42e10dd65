"""Matching of logs with a dictionary of templates.

Dictionaries are far smaller than the logs and bounded (see `align.newest`), but their size is checked all the same: up to
BROADCAST_ROWS templates go to every task, beyond it Spark joins by the number of tokens. Logs are made distinct first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lograil.functions import imperative as I
from lograil.functions import text as T
from lograil.operators.align import top_of
from lograil.operators.memory import HashedTree, RegexMemory
from lograil.shipping import ensure_shipped

BROADCAST_ROWS = 20_000

#: Similarities of a loose match, by name.
METRICS = {"positional_uniform": T.positional_uniform, "positional_decay": T.positional_decay, "jaccard": T.jaccard}


def small(dictionary: DataFrame) -> DataFrame:
    """With a broadcast hint if it has few rows. Reads no more of it than tells that."""
    return F.broadcast(dictionary) if dictionary.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else dictionary


def _parts(templates: DataFrame) -> DataFrame:
    """template, seq, n tokens, places of the fixed ones (from 0) and these tokens themselves."""
    t = templates.select("template", "seq", T.space_tokens("template").alias("_t"))
    fixed = F.filter(F.transform("_t", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: ~T.is_variable(p["x"]))
    return t.withColumn("_f", fixed).select("template", "seq", F.size("_t").alias("_n"), F.transform("_f", lambda p: p["i"]).alias("_at"), F.transform("_f", lambda p: p["x"]).alias("_ft"))


def _logs(logs: DataFrame, message: str) -> DataFrame:
    return logs.select(message).distinct().withColumn("_tok", T.space_tokens(message)).withColumn("_n", F.size("_tok"))


def _score(pairs: DataFrame, metric: str) -> DataFrame:
    """pairs with score: the template's fixed tokens against what the log has in their places."""
    return pairs.withColumn("_fl", F.transform("_at", lambda i: F.get("_tok", i))).withColumn("score", METRICS[metric](F.col("_ft"), F.col("_fl"))).drop("_fl")


def loose_scores(logs: DataFrame, templates: DataFrame, metric: str = "positional_uniform", message: str = "message") -> DataFrame:
    """message, template, seq, score of all templates with as many tokens as the message. templates: template, seq."""
    if metric not in METRICS:
        raise ValueError(f"no such metric: {metric}")
    return _score(_logs(logs, message).join(small(_parts(templates)), "_n"), metric).select(message, "template", "seq", "score")


def _probes(parts: DataFrame, metric: str, threshold: float) -> DataFrame:
    """parts with one row for each probe (_p, _w): a log that scores above the threshold has at least one of a template's probes.

    Probes are its fixed tokens that the fewest templates have, as many as would have to differ for the score to fall to the threshold. The
    positional metrics look for them at their places, Jaccard anywhere (_p is -1).
    """
    place = F.lit(-1) if metric == "jaccard" else F.col("_x.i")
    tokens = parts.select("*", F.explode(F.arrays_zip(F.col("_at").alias("i"), F.col("_ft").alias("w"))).alias("_x")).withColumns({"_p": place, "_w": F.col("_x.w")})
    often = tokens.groupBy("_n", "_p", "_w").agg(F.count_distinct("template").alias("_k"))
    weight = F.exp(-0.15 * F.array_position("_at", F.col("_x.i")).cast("double")) if metric == "positional_decay" else F.lit(1.0)
    each = tokens.join(often, ["_n", "_p", "_w"]).groupBy("template", "seq", "_n", "_at", "_ft", "_p", "_w").agg(F.max("_k").alias("_k"), F.max(weight).alias("_g"))
    order = Window.partitionBy("template", "seq").orderBy("_k", "_p", "_w")
    total = F.sum("_g").over(Window.partitionBy("template", "seq"))
    before = F.coalesce(F.sum("_g").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return each.withColumns({"_all": total, "_b": before}).where(F.col("_b") <= (1 - threshold) * F.col("_all") + 1e-9).drop("_k", "_g", "_all", "_b")


def loose_match(logs: DataFrame, templates: DataFrame, threshold: float = 0.8, metric: str = "positional_uniform", message: str = "message") -> DataFrame:
    """message, template, score: the best template above the threshold, the first of equals."""
    best = _above(logs, templates, threshold, metric, message).groupBy(message).agg(F.max(F.struct(F.round("score", 12).alias("r"), F.negative("seq").alias("o"), "template", "score")).alias("_b"))
    return best.select(message, "_b.template", "_b.score")


def loose_candidates(logs: DataFrame, templates: DataFrame, threshold: float = 0.8, metric: str = "positional_uniform", n: int = 3, message: str = "message") -> DataFrame:
    """The n best templates above the threshold, by score and then by the dictionary's order."""
    scored = _above(logs, templates, threshold, metric, message).distinct()
    return top_of(scored, [message], [F.desc(F.round("score", 12)), F.asc("seq")], n).select(message, "template", "score", "rank")


def _above(logs: DataFrame, templates: DataFrame, threshold: float, metric: str, message: str) -> DataFrame:
    """message, template, seq, score above the threshold; a pair may be there once for each probe that it shares."""
    if metric not in METRICS:
        raise ValueError(f"no such metric: {metric}")
    left, parts = _logs(logs, message), _parts(templates)
    if threshold < 0:  # a score of 0 is above it, so nothing can be looked up
        return _score(left.join(small(parts), "_n"), metric).where(F.col("score") > threshold).select(message, "template", "seq", "score")
    tokens = F.transform("_tok", lambda w, i: F.struct((F.lit(-1) if metric == "jaccard" else i).alias("_p"), w.alias("_w")))
    probes = small(_probes(parts.where(F.size("_ft") > 0), metric, threshold))
    # Joined with the tokens alone first: a message's row is widened only where a probe is met.
    met = left.withColumn("_x", F.explode(F.array_distinct(tokens))).select(message, "_tok", "_n", "_x.*").join(probes, ["_n", "_p", "_w"]).drop("_p", "_w")
    if metric == "jaccard":  # two empty sets are alike: a template of wildcards alone takes every log of its length
        bare = left.join(small(parts.where(F.size("_ft") == 0)), "_n")
        met = met.select(*bare.columns).unionByName(bare)
    return _score(met, metric).where(F.col("score") > threshold).select(message, "template", "seq", "score")


def _sent(rows: DataFrame, columns: list[str], what: str) -> list[tuple]:
    """The rows of a bounded table, for all tasks; a larger one than BROADCAST_ROWS is refused."""
    got = [tuple(r) for r in rows.select(*columns).limit(BROADCAST_ROWS + 1).collect()]
    if len(got) > BROADCAST_ROWS:
        raise ValueError(f"{what} has at most {BROADCAST_ROWS} rows; prune it first")
    return got


def _by_task(df: DataFrame, column: str, name: str, make: Callable[[], Callable[[str | None], str | None]]) -> DataFrame:
    """df with a text column that a function makes of another one; make() runs once in each task."""
    ensure_shipped(df.sparkSession)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = make()
        for b in batches:
            yield b.map(fn)

    return df.withColumn(name, run(F.col(column)))


def takes(df: DataFrame, pattern: Column, text: Column, anywhere: bool = False) -> Column:
    """Whether a regex takes a text from its start (or anywhere). Broken patterns, matches that take too long and nulls don't."""
    ensure_shipped(df.sparkSession)

    @F.pandas_udf("boolean")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for patterns, texts in batches:
            both = zip(patterns, texts, strict=True)
            yield pd.Series([isinstance(p, str) and isinstance(t, str) and I.safe_match(p, t, not anywhere) is not None for p, t in both], dtype=bool)

    return run(pattern, text)


def settled(df: DataFrame, answer: str, message: str) -> Column:
    """Answers in their normal form, or that of the message where an answer says nothing."""
    ensure_shipped(df.sparkSession)

    @F.pandas_udf("string")
    def run(answers: pd.Series, messages: pd.Series) -> pd.Series:
        return pd.Series([I.settle_template(a or "", m or "") for a, m in zip(answers, messages, strict=True)])

    return run(answer, message)


def strict_match(logs: DataFrame, templates: DataFrame, message: str = "message") -> DataFrame:
    """message, template: as a walk down the prefix tree that never turns back finds it.

    At each token the walk takes the equal child, else the plain wildcard, else the first tagged wildcard. The tree is small and is built
    once in each task from the broadcast dictionary.
    """
    rows = [t for (t,) in _sent(templates.orderBy("seq"), ["template"], "a strict dictionary")]
    shared = logs.sparkSession.sparkContext.broadcast(rows)
    return _by_task(logs.select(message).distinct(), message, "template", lambda: PrefixTree(shared.value).match).where(F.col("template").isNotNull())


def hashed_match(logs: DataFrame, cache: DataFrame, message: str = "message") -> DataFrame:
    """message, template: of the hashed tree over the cache (template, ref_log, seq), whose wildcards may stand for several tokens."""
    rows = _sent(cache.orderBy("seq"), ["template", "ref_log"], "a cache")
    shared = logs.sparkSession.sparkContext.broadcast(rows)

    def make():
        tree = HashedTree()
        for template, ref_log in shared.value:
            tree.insert(template, ref_log or "")
        return lambda m: (m is not None and tree.match(m) or (None,))[0]

    return _by_task(logs.select(message).distinct(), message, "template", make).where(F.col("template").isNotNull())


def remembered(logs: DataFrame, regexes: DataFrame, message: str = "message") -> DataFrame:
    """message, regex: what a memory of regexes (regex, seq) finds: those one word longer first, then those as long, in their order."""
    rows = [r for (r,) in _sent(regexes.orderBy("seq"), ["regex"], "a memory of regexes")]
    shared = logs.sparkSession.sparkContext.broadcast(rows)

    def make():
        memory = RegexMemory.of(shared.value)
        return lambda m: None if m is None else memory.find(m)

    return _by_task(logs.select(message).distinct(), message, "regex", make).where(F.col("regex").isNotNull())


class PrefixTree:
    """Templates by their tokens."""

    def __init__(self, templates: list[str] = ()):
        self.root: dict = {}
        for t in templates:
            self.insert(t)

    def insert(self, template: str) -> None:
        at = self.root
        for token in template.split(" "):
            at = at.setdefault(token, {})
        at.setdefault(None, template)

    def match(self, message: str | None) -> str | None:
        at = self.root
        for token in (message or "").split(" "):
            after = at.get(token) or at.get(T.WILD) or next((v for k, v in at.items() if k and k[0] == "<" and k[-1] == ">"), None)
            if after is None:
                return None
            at = after
        return at.get(None)


def regex_match(logs: DataFrame, templates: DataFrame, message: str = "message") -> DataFrame:
    """message, template: the most recently used template with as many words whose regex matches. templates: template, mru (1 first)."""
    left = logs.select(message).distinct().withColumn("_n", F.size(T.word_tokens(message)))
    right = templates.select("template", "mru", T.template_to_regex("template").alias("_rx"), F.size(T.word_tokens("template")).alias("_n"))
    hits = left.join(small(right), "_n").where(F.expr(f"`{message}` rlike _rx"))
    return hits.groupBy(message).agg(F.min_by("template", "mru").alias("template"))


def regex_by_length(logs: DataFrame, templates: DataFrame, message: str = "message") -> DataFrame:
    """message, regex: the first regex that matches the whole message, of those one space longer first, then of those as long.

    templates: regex, wc (its spaces + 1), seq.
    """
    left = logs.select(message).distinct().withColumn("_n", F.size(T.space_tokens(message))).withColumn("wc", F.explode(F.array(F.col("_n") + 1, F.col("_n"))))
    hits = left.join(small(templates), "wc").where(F.expr(f"`{message}` rlike concat('^(?:', regex, ')$')"))
    return hits.groupBy(message).agg(F.min_by("regex", F.struct(F.negative("wc"), "seq")).alias("regex"))


def split_by_template(logs: DataFrame, template: str, message: str = "message") -> tuple[DataFrame, DataFrame]:
    """The logs that a template's regex matches, and the others."""
    marked = logs.withColumn("_hit", F.coalesce(F.expr(f"`{message}` rlike _rx"), F.lit(False))) if "_rx" in logs.columns else logs.withColumn("_rx", T.template_to_regex(F.lit(template))).withColumn("_hit", F.coalesce(F.expr(f"`{message}` rlike _rx"), F.lit(False)))
    return marked.where("_hit").drop("_hit", "_rx"), marked.where("NOT _hit").drop("_hit", "_rx")


def nearest_example(messages: DataFrame, pool: DataFrame, k: int = 3, message: str = "message") -> DataFrame:
    """The k examples of a bounded pool (template, ref_log, seq) most like each message by Jaccard; the first of equals.

    The pool is a handful of rows by nature: a larger one than BROADCAST_ROWS is refused. Each task gets its inverted index, so a message
    meets only what the postings of its own words name, and costs as many additions.
    """
    rows = _sent(pool.orderBy("seq").withColumn("_b", F.array_distinct(T.word_tokens("ref_log"))), ["template", "ref_log", "_b"], "a pool of examples")
    spark = messages.sparkSession
    ensure_shipped(spark)
    postings: dict[str, list[int]] = {}
    for j, (_, _, words) in enumerate(rows):
        for w in words or ():
            postings.setdefault(w, []).append(j)
    shared = spark.sparkContext.broadcast(({w: np.array(p, dtype=np.int32) for w, p in postings.items()}, np.array([len(r[2] or ()) for r in rows], dtype=np.int64)))
    left = messages.select(message).distinct().withColumn("_a", F.array_distinct(T.word_tokens(message)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sizes = shared.value
        for b in batches:
            at, rank, example, similarity = [], [], [], []
            for i, words in enumerate(b.column("_a").to_pylist()):
                if words is None:
                    continue
                lists = [index[w] for w in words if w in index]
                common = np.bincount(np.concatenate(lists), minlength=len(sizes)) if lists else np.zeros(len(sizes), np.int64)
                union = sizes + len(words) - common
                like = np.where(union > 0, common / np.maximum(union, 1), 0.0)
                best = np.argsort(-like, kind="stable")[:k]
                at += [i] * len(best)
                rank += range(1, len(best) + 1)
                example += best.tolist()
                similarity += like[best].tolist()
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(example, pa.int32()), pa.array(similarity, pa.float64()), pa.array(rank, pa.int32())], names=[message, "_e", "similarity", "rank"])

    found = left.mapInArrow(run, f"`{message}` string, _e int, similarity double, rank int")
    known = spark.createDataFrame([(j, t, r) for j, (t, r, _) in enumerate(rows)], "_e int, template string, ref_log string")
    return found.join(F.broadcast(known), "_e").select(message, "template", "ref_log", "similarity", "rank")


def reconcile(medoids: DataFrame, cache: DataFrame, threshold: float = 0.8, message: str = "message") -> DataFrame:
    """message, template: of the cached entry whose reference log is most like the medoid, if it is like enough."""
    best = nearest_example(medoids, cache, 1, message)
    return best.where(F.col("similarity") >= threshold).select(message, "template", "similarity")
