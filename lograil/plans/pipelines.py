"""The three parsing methods, from logs to templates, and how they run over batches within a time limit.

Each returns its rows, what it has learned, and what its template source was asked. Messages enter distinct; every step that others build on is
written to the shared folder once, so that a Python function runs once for each row.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lograil.functions import imperative as I
from lograil.functions import text as T
from lograil.operators import align, drain, match, memory, merge, sample
from lograil.operators import cluster as C
from lograil.plans.template_source import USAGE, Deterministic, TemplateSource
from lograil.schema import BatchSettings, RouterSettings, TreeSettings
from lograil.shipping import ensure_shipped
from lograil.storage import materialize

#: What a dictionary of the router holds; `seq` is its order, `last_used` the greatest order of a log that an entry matched.
DICTIONARY = "template string, seq long, last_used long, last_matched timestamp"
#: What a cache of the batch method holds.
CACHE = "template string, ref_log string, frequency long, seq long"
ASKED = ", ".join(f"{c} long" for c in USAGE) + ", calls array<string>"


class Parsed(NamedTuple):
    """rows: the logs with template and tier. learned: dictionary, cache or regexes for a next run. asked: a row for each question."""

    rows: DataFrame
    learned: DataFrame
    asked: DataFrame
    #: Batch method: masked noise. Tree method: entries of the exact memory.
    more: DataFrame | None = None


def totals(*asked: DataFrame) -> DataFrame:
    """One row: questions, tokens and failures of all questions."""
    every = reduce(DataFrame.unionByName, (a.select(*USAGE) for a in asked))
    return every.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in USAGE))


def _known(df: DataFrame, schema: str) -> DataFrame:
    """df in a schema's columns, those that it lacks null."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    return df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(kind).alias(n) for n, kind in fields))


def _ask(groups: DataFrame, keys: list[str], source: TemplateSource, count: int, name: str, seed: int = 0, regex: bool = False, truncate: bool = True, **options) -> DataFrame:
    """keys, template (or regex), first, and usage: a source's answer to a sample of each group. groups: keys, message, seq.

    Sources run where the groups are; what they count and record there comes back as columns.
    """
    one = F.to_json(F.struct(*keys))
    sampled = sample.sample_clusters(groups.withColumn("_k", one), name, count, "_k", "message", "seq", seed, **options)

    def ask(k: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        messages = rows.sort_values("rank")["message"].tolist()
        before = dict(getattr(source, "usage", {}))
        answer = source.template(sample.truncate_batch(messages) if truncate else messages)
        used = {c: getattr(source, "usage", {}).get(c, 0) - before.get(c, 0) for c in USAGE} if before else {"llm_invocations": 1}
        if regex:
            answer = I.tidy_regex(I.answer_to_regex(answer), messages[0])
        calls = [json.dumps(c, ensure_ascii=False) for c in source.recorded()]
        return pd.DataFrame({"_k": [k[0]], "template": [answer], "first": [messages[0]], **{c: [used.get(c, 0)] for c in USAGE}, "calls": [calls]})

    asked = materialize(sampled.groupBy("_k").applyInPandas(ask, f"_k string, template string, first string, {ASKED}"), "asked")
    fields = ", ".join(f"`{c}` {groups.schema[c].dataType.simpleString()}" for c in keys)
    return asked.select(F.from_json("_k", fields).alias("_s"), "*").select("_s.*", "template", "first", *USAGE, "calls")


def _texts(logs: DataFrame) -> DataFrame:
    """message, seq, last: the distinct messages that are not empty, with their first and last places."""
    return logs.where(F.length("message") > 0).groupBy("message").agg(F.min("seq").alias("seq"), F.max("seq").alias("last"))


def _fits(df: DataFrame, template: str = "template") -> Column:
    """Whether a template's regex takes the message; a match has a time limit."""
    return match.takes(df, F.col("_rx"), F.col("message")) if "_rx" in df.columns else match.takes(df, T.template_to_regex(template), F.col("message"))


def route(logs: DataFrame, dictionary: DataFrame, source: TemplateSource | None = None, settings: RouterSettings | None = None, now: Column | None = None) -> Parsed:
    """Dictionary routing of one batch of logs (id, message, seq); dictionary: template, seq, and what else of DICTIONARY there is.

    Distinct messages go down the prefix tree, then (match_mode `production`) to the best loose match; what is left is grouped by its masked
    form and a source gives each group a template. With match_mode `original` a loose match never answers: the new template is compared with
    the candidates and unified with the first that is like enough. At the batch's end the dictionary is merged, and with `now` entries
    unused for `max_age_days` go; the `capacity` used last stay. Empty messages have an empty template, tier `empty`.
    """
    s, source, spark = settings or RouterSettings(), source or Deterministic(), logs.sparkSession
    known = _known(dictionary, DICTIONARY)
    distinct = _texts(logs)
    strict = match.strict_match(distinct, known).withColumn("tier", F.lit("strict"))
    found = materialize(distinct.join(strict, "message", "left"), "route-strict")
    if s.match_mode == "production":
        rest = found.where("template IS NULL").select("message", "seq", "last")
        loose = match.loose_match(rest, known, s.loose_match_threshold, s.loose_match_metric).select("message", F.col("template").alias("_l"))
        joined = found.join(loose, "message", "left")
        tier = F.when(F.col("_l").isNotNull(), "loose").otherwise(F.col("tier"))
        found = materialize(joined.select("message", "seq", "last", F.coalesce("template", "_l").alias("template"), tier.alias("tier")), "route-loose")
    missed = found.where("template IS NULL").select("message", "seq", "last", T.premask("message").alias("_mask"))
    asked = _ask(missed, ["_mask"], source, s.k_shots, "AdaptiveSampler")
    made = asked.select("_mask", "template")
    if s.match_mode != "production":
        made = _unified(made, missed, known, s)
    answer = F.when(T.is_template("template"), F.col("template")).otherwise(F.col("message"))
    new = missed.join(made, "_mask").select("message", "seq", "last", answer.alias("template"), F.lit("new").alias("tier"))
    found = materialize(found.where("template IS NOT NULL").unionByName(new), "route-found")
    empty = logs.where("message IS NULL OR length(message) = 0").withColumns({"template": F.lit(""), "tier": F.lit("empty")})
    rows = logs.join(found.select("message", "template", "tier"), "message").select(*logs.columns, "template", "tier").unionByName(empty)
    return Parsed(rows, _grown(spark, known, found, source, s, now), asked)


def _unified(made: DataFrame, missed: DataFrame, known: DataFrame, s: RouterSettings) -> DataFrame:
    """Each new template as one with the best of its group's loose candidates that is like enough."""
    heads = missed.groupBy("_mask").agg(F.min_by("message", "seq").alias("message"))
    candidates = match.loose_candidates(heads, known, s.loose_match_threshold, s.loose_match_metric).select("message", F.col("template").alias("_c"), "rank")
    pairs = made.join(heads, "_mask").join(candidates, "message", "left").withColumns({"_x": T.space_tokens("template"), "_y": T.space_tokens("_c")})
    alike = (F.col("template") == F.col("_c")) | (T.structural(F.col("_x"), F.col("_y")) >= s.merge_threshold)
    merged = F.array_join(T.merge_tokens(F.col("_x"), F.col("_y")), " ")
    best = pairs.groupBy("_mask", "template").agg(F.min(F.when(alike, F.struct("rank", merged.alias("m")))).alias("_b"))
    return best.select("_mask", F.coalesce("_b.m", "template").alias("template"))


def _grown(spark: SparkSession, known: DataFrame, found: DataFrame, source: TemplateSource, s: RouterSettings, now: Column | None) -> DataFrame:
    """The dictionary after a batch: recency brought up to date, new templates behind the known ones, merged and pruned."""
    used = found.groupBy("template").agg(F.max("last").alias("_l"), F.min("seq").alias("_s"), F.max((F.col("tier") == "new").cast("int")).alias("_new"))
    top = known.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("top")).first()["top"]
    moment = now if now is not None else F.lit(None).cast("timestamp")
    both = known.join(used, "template", "full_outer").where("seq IS NOT NULL OR _new = 1")
    grown = both.select(
        "template",
        F.coalesce("seq", F.lit(top) + F.col("_s")).alias("seq"),
        F.greatest("last_used", "_l", F.when(F.col("last_used").isNull() & F.col("_l").isNull(), F.col("seq"))).alias("last_used"),
        F.when(F.col("_l").isNotNull(), F.coalesce(moment, "last_matched")).otherwise(F.col("last_matched")).alias("last_matched"),
    )
    grown = materialize(grown, "dictionary")
    if s.merge_mode == "production":
        merged = merge.calibrate(grown.select("template", "seq"), s.merge_threshold).select("template", "merged")
    else:
        merged = merge.calibrate_by_source(grown.select("template", "seq"), source, s.merge_prefilter).select("template", "merged")
    out = grown.join(merged, "template").groupBy(F.col("merged").alias("template")).agg(F.min("seq").alias("seq"), F.max("last_used").alias("last_used"), F.max("last_matched").alias("last_matched"))
    if now is not None:
        out = out.where(F.col("last_matched").isNull() | (F.col("last_matched") >= now - F.make_interval(days=F.lit(s.max_age_days))))
    return align.newest(out, "last_used", s.capacity, "template")


def cluster_batches(logs: DataFrame, settings: BatchSettings | None = None, source: TemplateSource | None = None, cache: DataFrame | None = None, most_rounds: int = 20) -> Parsed:
    """Micro-batched clustering of logs (id, message, seq): template and tier (cache, cluster, raw, masked); cache: what there is of CACHE.

    A message belongs to the batch of its first copy; batches never mix. All batches cluster at once. Noise moves on to the next batch, at most
    `noise_retries` times, then takes a cached template or its masked form (`more` holds the latter). Clusters are a queue: the medoid's most
    alike cache entry (cache_mode `original`: the first member that the hashed tree knows) gives a template to the members that its regex
    takes; where there is none, or it takes nobody, a source sees a sample. The members left over queue again, as new clusters, until none
    are; what `most_rounds` rounds leave keeps its raw message. Clusters of one round don't see each other's templates, later rounds do.
    """
    s, source, spark = settings or BatchSettings(), source or Deterministic(), logs.sparkSession
    distinct = _texts(logs).select("message", "seq", F.floor(F.col("seq") / s.buffer_size).alias("batch"), T.premask("message").alias("masked"))
    members = materialize(_clustered(materialize(distinct, "batch-texts"), s), "batch-members")
    held = _known(cache if cache is not None else spark.createDataFrame([], CACHE), CACHE)
    noise = members.where("cluster IS NULL")
    queue = members.where("cluster IS NOT NULL").select("message", "masked", "seq", F.concat_ws(":", F.col("batch").cast("string"), F.col("cluster").cast("string")).alias("group"))
    done: list[DataFrame] = []
    asked: list[DataFrame] = []
    for _ in range(most_rounds):
        if queue.isEmpty():
            break
        settled, queue, held, question = _round(queue, held, source, s)
        done.append(settled)
        asked.append(question)
    done.append(queue.select("message", F.col("message").alias("template"), F.lit("raw").alias("tier")))
    held = align.newest(held, "seq", s.cache_size, "template")
    of_cache = match.hashed_match(noise, held) if s.cache_mode == "original" else match.regex_match(noise, held.withColumn("mru", F.negative("seq")))
    left = noise.select("message", "masked").join(of_cache, "message", "left")
    settled = left.select("message", F.coalesce("template", "masked").alias("template"), F.when(F.col("template").isNull(), "masked").otherwise("cache").alias("tier"))
    done.append(materialize(settled, "batch-noise"))
    rows = logs.join(reduce(DataFrame.unionByName, done), "message")
    return Parsed(rows, held, reduce(DataFrame.unionByName, asked) if asked else spark.createDataFrame([], ASKED), rows.where("tier = 'masked'"))


def _clustered(distinct: DataFrame, s: BatchSettings) -> DataFrame:
    """distinct with batch (where a noise row ended) and cluster, null for noise."""
    if s.clusterer == "LengthCluster":
        return C.by_length(distinct).drop("n_tokens")
    # Clusters are of masked forms, far fewer than messages: what differs in variables alone is together from the start.
    forms = distinct.groupBy("batch", "masked").agg(F.min("seq").alias("id"), F.count("*").alias("n")).withColumn("home", F.col("batch"))
    last = F.lit(distinct.agg(F.max("batch")).first()[0] or 0)
    for turn in range(s.noise_retries + 1):
        found = C.by_similarity(forms.select("id", "home", "batch", "n", F.col("masked").alias("message")), s.similarity_threshold, weighting=s.vectorizer, dynamic=s.dynamic_eps, within="batch")
        several = F.when(F.col("cluster").isNull() & (F.col("n") > 1), F.col("id")).otherwise(F.col("cluster"))
        found = materialize(found.select("id", "home", "batch", "n", F.col("message").alias("masked"), several.alias("cluster")), "batch-forms")
        moving = F.col("cluster").isNull() & (F.col("batch") < last)
        if turn == s.noise_retries or s.noise_mode == "original" or found.where(moving).isEmpty():
            break
        forms = found.withColumn("batch", F.when(moving, F.col("batch") + 1).otherwise(F.col("batch"))).drop("cluster")
    if s.noise_mode == "original":
        found = C.settle_noise(found.withColumn("message", F.concat_ws(" ", F.col("batch").cast("string"), "masked")), "id").drop("message")
    return distinct.withColumnRenamed("batch", "home").join(found.select("home", "masked", "batch", "cluster"), ["home", "masked"]).drop("home")


def _round(queue: DataFrame, held: DataFrame, source: TemplateSource, s: BatchSettings) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What one turn of the queue settles (message, template, tier), leaves (as queue), the cache after it, and what was asked."""
    forms = queue.groupBy("group", "masked").agg(F.min("seq").alias("id"), F.min_by("message", "seq").alias("first"))
    middles = C.medoids(forms.select(F.col("group").alias("cluster"), "id", F.col("masked").alias("message")))
    medoids = materialize(forms.join(middles.select(F.col("cluster").alias("group"), "id"), ["group", "id"]).select("group", F.col("first").alias("medoid"), F.col("id").alias("seq")), "batch-medoids")
    if s.cache_mode == "original":
        hits = queue.join(match.hashed_match(queue, held), "message").groupBy("group").agg(F.min_by("template", "seq").alias("template"))
    else:
        near = match.reconcile(medoids.select(F.col("medoid").alias("message")), held, s.similarity_threshold)
        hits = medoids.join(near.select(F.col("message").alias("medoid"), "template"), "medoid").select("group", "template")
    known = queue.join(hits, "group", "left").withColumn("_rx", T.template_to_regex("template"))
    known = materialize(known.withColumn("hit", F.coalesce(_fits(known), F.lit(False))).drop("_rx"), "batch-known")
    served = known.where("hit").select("group").distinct()
    # A cached template that takes no member was alike by words alone: the group asks like one without a hit.
    missed = known.join(served, "group", "left_anti").select("group", "message", "masked", "seq")
    asked = _ask(missed, ["group"], source, s.batch_size, s.sampler, truncate=s.batch_truncation_mode == "original", **sample.options(s))
    answer = match.settled(asked, "template", "first") if s.postprocess_mode == "original" else T.unfence("template")
    tried = missed.join(asked.select("group", answer.alias("template")), "group").withColumn("_rx", T.template_to_regex("template"))
    tried = materialize(tried.withColumn("hit", F.coalesce(_fits(tried), F.lit(False))).drop("_rx"), "batch-tried")
    good = tried.where("hit").select("group", "template").distinct()
    cached = known.where("hit").select("message", "template", F.lit("cache").alias("tier"))
    made = tried.where("hit").select("message", "template", F.lit("cluster").alias("tier"))
    raw = tried.join(good, "group", "left_anti").select("message", F.col("message").alias("template"), F.lit("raw").alias("tier"))
    settled = materialize(cached.unionByName(made).unionByName(raw), "batch-settled")
    rest = known.where("NOT hit").join(served, "group", "left_semi").unionByName(tried.where("NOT hit").join(good.select("group"), "group", "left_semi"))
    used = good.join(medoids, "group").select("template", F.col("medoid").alias("ref_log"), F.lit(1).cast("long").alias("frequency"), "seq")
    used = used.unionByName(hits.join(served, "group").join(medoids.select("group", "seq"), "group").select("template", F.lit(None).cast("string").alias("ref_log"), F.lit(1).cast("long").alias("frequency"), "seq"))
    merged = held.unionByName(used).groupBy("template").agg(F.min_by("ref_log", F.when(F.col("ref_log").isNotNull(), F.col("seq"))).alias("ref_log"), F.sum("frequency").alias("frequency"), F.max("seq").alias("seq"))
    return settled, materialize(rest.select("message", "masked", "seq", "group"), "batch-queue"), materialize(merged, "batch-cache"), asked.select(*USAGE, "calls")


def tree_groups(logs: DataFrame, regexes: DataFrame | None = None, source: TemplateSource | None = None, settings: TreeSettings | None = None, entries: DataFrame | None = None, groups: DataFrame | None = None) -> Parsed:
    """Tree grouping with regex memory of logs (id, message, dataset, seq): event_id, regex, template and tier (cache, constant, memory, group, raw).

    regexes: regex, seq of earlier runs. entries: raw_log, template, seq of the exact memory (memory_mode `production`): one entry that equals a
    message of a group gives its template to the whole group. groups: dataset, message, event_id, event_template of an earlier grouping.
    A group of one message that nothing in it could vary keeps it. Else the memory is tried, then a source's regex on a sample; messages
    that it doesn't take are tried with what other groups have learned, and asked about again, with another sample, up to three times while
    that makes no progress. What is left has its group's last regex. Groups are in the order of their first message's words, then place.
    """
    s, source, spark = settings or TreeSettings(), source or Deterministic(), logs.sparkSession
    texts = logs.where(F.length("message") > 0)
    grouped = drain.tree_groups(texts.select("dataset", "message", "seq")) if groups is None else texts.join(groups, ["dataset", "message"])
    distinct = materialize(grouped.groupBy("dataset", "event_id", "message").agg(F.min("seq").alias("seq"), F.first("event_template").alias("event_template")), "tree-groups")
    key = ["dataset", "event_id"]
    per = distinct.groupBy(*key).agg(F.count("*").alias("n"), F.min_by("message", "seq").alias("first"), F.min("seq").alias("at"))
    words = F.size(T.word_tokens("first"))
    order = materialize(per.withColumn("constant", (F.col("n") == 1) & T.is_constant("first")).select(*key, "first", "at", words.alias("words"), "constant"), "tree-order")
    done: list[DataFrame] = []
    open_ = distinct.select(*key, "message", "seq")
    if s.memory_mode == "production" and entries is not None:
        whole = open_.join(entries.select(F.col("raw_log").alias("message"), "template"), "message").groupBy(*key).agg(F.min_by("template", "seq").alias("template"))
        done.append(open_.join(whole, key).select(*key, "message", F.lit(None).cast("string").alias("regex"), "template", F.lit("cache").alias("tier")))
        open_ = open_.join(whole, key, "left_anti")
    constant = open_.join(order.where("constant").select(*key), key, "left_semi")
    done.append(_solved(constant, key, T.escape_regex("message"), "constant"))
    open_ = open_.join(order.where("constant").select(*key), key, "left_anti")
    held = (regexes.select("regex", F.col("seq").cast("long").alias("seq")) if regexes is not None else spark.createDataFrame([], "regex string, seq long")).withColumn("words", F.lit(-1))
    held = memory.fifo(held, s.max_memory)
    found = materialize(open_.join(match.remembered(open_, held), "message", "left"), "tree-memory")
    done.append(_solved(found.where("regex IS NOT NULL"), key, F.col("regex"), "memory"))
    open_, last = found.where("regex IS NULL").drop("regex"), None
    asked: list[DataFrame] = []
    for attempt in range(4 if s.reflection else 1):
        answer = _ask(open_, key, source, s.sample_size, "AdaptiveSampler", attempt, regex=True, similarity=s.similarity, most=s.max_sample_logs)
        asked.append(answer)
        tried = open_.join(answer.select(*key, F.col("template").alias("regex")), key)
        tried = materialize(tried.withColumn("hit", match.takes(tried, F.col("regex"), F.col("message"), anywhere=True)), "tree-tried")
        ahead = tried.where("hit") if s.reflection else tried
        done.append(_solved(ahead, key, F.col("regex"), "group"))
        learned = memory.admit_regexes(tried.where("hit").join(order.select(*key, F.col("at")), key).select("regex", "message", F.col("at").alias("seq")))
        learned = learned.select("regex", "seq", F.col("wc").cast("int").alias("words"))
        before, held = held, materialize(held.unionByName(learned.join(held.select("regex"), "regex", "left_anti")), "tree-regexes")
        left = tried.where("NOT hit").drop("hit")
        if not s.reflection or left.isEmpty():
            open_ = left.limit(0)
            break
        others = match.remembered(left, learned.join(before.select("regex"), "regex", "left_anti"))
        left = materialize(left.join(others.select("message", F.col("regex").alias("_other")), "message", "left"), "tree-left")
        done.append(_solved(left.where("_other IS NOT NULL"), key, F.col("_other"), "memory"))
        left = left.where("_other IS NULL").drop("_other")
        # From the second question on a group that made progress asks no more: what it still has keeps its last regex.
        stop = tried.where("hit").select(*key).distinct() if attempt else order.limit(0).select(*key)
        last = left if attempt == 3 else left.join(stop, key, "left_semi")
        done.append(_solved(last, key, F.col("regex"), "raw"))
        open_ = left.limit(0) if attempt == 3 else materialize(left.join(stop, key, "left_anti").drop("regex"), "tree-open")
        if open_.isEmpty():
            break
    solved = materialize(reduce(DataFrame.unionByName, done), "tree-solved")
    rows = logs.join(solved, ["dataset", "message"])
    first = F.get(T.word_tokens("message"), 0)
    new = solved.join(distinct.select("dataset", "message", "seq"), ["dataset", "message"]).where("tier <> 'cache'")
    new = new.select(F.col("message").alias("raw_log"), "template", F.struct(F.size(T.word_tokens("message")).alias("words"), first.alias("first")).alias("group_key"), "seq")
    kept = memory.fifo(new, s.max_memory) if s.memory_mode == "production" else new.limit(0)
    # The order in which a later run tries them: by the words of the group that they came from, then its place.
    ranked = held.withColumn("seq", F.row_number().over(Window.orderBy("words", "seq")).cast("long")).select("regex", "seq")  # a bounded memory
    return Parsed(rows, ranked, reduce(DataFrame.unionByName, (a.select(*USAGE, "calls") for a in asked)), kept)


def _solved(rows: DataFrame, key: list[str], regex: Column, tier: str) -> DataFrame:
    return rows.select(*key, "message", regex.alias("regex"), T.regex_to_template(regex).alias("template"), F.lit(tier).alias("tier"))


def in_batches(logs: DataFrame, step: Callable[[DataFrame, int], DataFrame], path: str, rows: int, seconds: float | None = None, order: str = "seq") -> DataFrame:
    """Runs step(batch, number) on the logs by order, `rows` of them at a time, until all are done or `seconds` are over.

    Results are written to `path` by batch; after the time limit it holds those of the batches that began in time, perhaps none, and is read
    back as it is. A batch is whole or not there.
    """
    spark, began, number = logs.sparkSession, time.monotonic(), F.floor(F.col(order) / rows).cast("long")
    at = logs.withColumn("_batch", number)
    schema = None
    for (k,) in sorted(tuple(r) for r in at.select("_batch").distinct().collect()):  # one number for each batch
        if seconds is not None and time.monotonic() - began > seconds:
            break
        out = step(at.where(F.col("_batch") == k).drop("_batch"), int(k))
        out.write.mode("overwrite").parquet(f"{path}/batch={k}")
        schema = out.schema
    if schema is None:
        schema = logs.schema.add("template", "string").add("tier", "string")
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/batch=-1")
    return spark.read.schema(schema).parquet(path)


def route_in_batches(logs: DataFrame, path: str, dictionary: DataFrame | None = None, source: TemplateSource | None = None, settings: RouterSettings | None = None, seconds: float | None = None) -> Parsed:
    """`route` over batches of `calibrate_every` logs, each with the dictionary that the one before it left."""
    s = settings or RouterSettings()
    ensure_shipped(logs.sparkSession)
    state = {"known": _known(dictionary, DICTIONARY) if dictionary is not None else logs.sparkSession.createDataFrame([], DICTIONARY), "asked": []}

    def step(batch: DataFrame, number: int) -> DataFrame:
        done = route(batch, state["known"], source, s)
        state["known"] = materialize(done.learned, "dictionary")
        state["asked"].append(done.asked.select(*USAGE, "calls"))
        return done.rows

    rows = in_batches(logs, step, path, s.calibrate_every, seconds)
    asked = reduce(DataFrame.unionByName, state["asked"]) if state["asked"] else logs.sparkSession.createDataFrame([], ASKED)
    return Parsed(rows, state["known"], asked)
