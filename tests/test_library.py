"""The log library: fixed values, and differential tests against plain Python."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lograil.functions import imperative as I
from lograil.functions import text as T
from lograil.operators import align, cluster, drain, match, memory, merge, metrics, sample
from lograil.plans import grok, pipelines, report, template_source
from lograil.schema import PRESET_LARGE, PROFILE_SCHEMA, Settings, dataset_key, load_settings
from lograil.sources import readers, search, sinks

TRUTH = [("1", "User 1 logged in", "User <*> logged in"), ("2", "User 2 logged in", "User <*> logged in"), ("3", "Connection failed from 10.0.0.1", "Connection failed from <*>")]


def rows_of(spark, gts, parsed, contents=None):
    return spark.createDataFrame(list(zip(contents or gts, gts, parsed)), "content string, gt string, parsed string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def value(df, name):
    return df.first()[name]


# Metrics


@pytest.mark.parametrize(("parsed", "want"), [(["User <*> logged in"] * 2 + ["Connection failed from <*>"], 1.0), (["User <*> logged in", "User 2 logged in", "Connection failed from <*>"], 2 / 3)])
def test_accuracy(spark, parsed, want):
    pairs = metrics.pair_counts(rows_of(spark, [t for _, _, t in TRUTH], parsed), [])
    assert value(metrics.accuracy(pairs, []), "pa") == pytest.approx(want)


def test_grouping(spark):
    good, bad = rows_of(spark, ["T1", "T1", "T2"], ["a", "a", "b"]), rows_of(spark, ["T1", "T1", "T2"], ["T1", "T2", "T2"])
    assert metrics.grouping(metrics.pair_counts(good, []), []).first().asDict() == {"ga": 1.0, "fga": 1.0}
    assert metrics.grouping(metrics.pair_counts(bad, []), []).first().asDict() == {"ga": 0.0, "fga": 0.0}
    only = spark.createDataFrame([("T2",)], "gt string")
    assert value(metrics.grouping(metrics.pair_counts(good, []), [], only), "ga") == 1.0


def test_grouping_against_plain(spark):
    rng = random.Random(0)
    for _ in range(3):
        rows = [(rng.choice("ABCD"), rng.choice("abcd")) for _ in range(40)]
        ok = total = 0
        for g in {g for g, _ in rows}:
            mine = [p for x, p in rows if x == g]
            if len(set(mine)) == 1 and sum(p == mine[0] for _, p in rows) == len(mine):
                ok, total = ok + 1, total + len(mine)
        got = metrics.grouping(metrics.pair_counts(rows_of(spark, *zip(*rows)), []), []).first()
        assert got["ga"] == pytest.approx(total / 40) and got["fga"] == pytest.approx(2 * ok / (len({g for g, _ in rows}) + len({p for _, p in rows})))


def test_edit_distance_and_granularity(spark):
    rows = rows_of(spark, ["User <*> logged in"], ["User 1 logged in"])
    assert value(metrics.edit_distance(metrics.pair_counts(rows, []), []), "ed") == 3
    three = rows_of(spark, ["a b", "a b", "c"], ["T1", "T2", "T3"])
    assert value(metrics.granularity(metrics.pair_counts(three, []), []), "ggd") == pytest.approx(0.5)


def test_template_f1(spark):
    f = lambda g, p: value(metrics.template_f1(metrics.pair_counts(rows_of(spark, g, p), []), []), "fta")
    assert f(["A", "B"], ["A", "B"]) == 1.0 and f(["A", "A", "B"], ["A", "different A", "B"]) == pytest.approx(0.8)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_silhouette_against_plain(spark):
    rng = random.Random(1)
    text = lambda: "".join(rng.choice("abcde <*>") for _ in range(rng.randint(1, 12)))
    templates = [text() for _ in range(6)]
    rows = [(text(), "", rng.choice(templates)) for _ in range(40)]
    far = lambda a, b: levenshtein(a, b) / max(len(a), len(b), 1)
    used = {p for _, _, p in rows}
    scores = []
    for c, _, p in rows:
        a, b = far(c, p), min(far(c, q) for q in used if q != p)
        scores.append((b - a) / max(a, b) if max(a, b) else 0)
    df = spark.createDataFrame(rows, "content string, gt string, parsed string")
    assert value(metrics.silhouette(df, []), "pmss") == pytest.approx(sum(scores) / 40, abs=1e-9)
    assert value(metrics.silhouette(df.withColumn("parsed", F.lit("t")), []), "pmss") == 0.0


def test_levels(spark):
    f = lambda s, lv: one(spark, T.at_level(F.lit(s), lv))
    assert f("Template  A.", "spaced") == "Template A." and f("Template  A.", "lowercase") == "template a."
    assert f("Template  A.", "regex_clean") == "template a" and f("Template B:", "regex_clean") == "template b" and f(" x ", "raw") == " x "


def test_bundle_and_spearman(spark):
    rows = rows_of(spark, [t for _, _, t in TRUTH], [t for _, _, t in TRUTH], [c for _, c, _ in TRUTH]).withColumn("segment", F.lit("s"))
    got = metrics.bundle(rows, ["segment"]).first().asDict()
    assert got["ga"] == got["pa"] == got["fta"] == got["pa_regex_clean"] == got["ned"] == 1.0 and got["ed"] == got["ggd"] == got["pgd"] == 0.0
    assert metrics.tidy(metrics.bundle(rows, ["segment"], False), ["segment"]).where("metric = 'pmss'").first()["value"] == 0.0
    pts = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], "x double, y double")
    assert value(metrics.spearman(pts, "x", "y"), "rho") == pytest.approx(-1) and value(metrics.spearman(pts.limit(1), "x", "y"), "rho") == 0.0
    assert metrics.spearman_matrix(pts.withColumn("z", F.col("x")), ["x", "y", "z"]).count() == 3


def test_profile_rates_fall_back_to_history(spark):
    p = spark.createDataFrame([(2.0, 0, 0, 0, 0, 1, 1, 0, 0, [(5, 1, 2), (10, 2, 8)], None, None)], PROFILE_SCHEMA)
    r = metrics.profile_rates(p).first()
    assert (r["log_volume"], r["cache_hit_rate"], r["throughput"], r["failure_rate"], r["model_used"]) == (10, 0.8, 5.0, 0.5, "unknown-model")
    empty = metrics.profile_rates(spark.createDataFrame([(0.0, 0, 0, 0, 0, 0, 0, 0, 0, [], "m", "x")], PROFILE_SCHEMA)).first()
    assert empty["cache_hit_rate"] == empty["throughput"] == empty["failure_rate"] == 0.0


# Expressions


def test_similarities(spark):
    arr = lambda s: F.split(F.lit(s), " ")
    assert one(spark, T.jaccard(arr("hello world"), arr("hello python"))) == pytest.approx(1 / 3)
    assert one(spark, T.positional_uniform(arr("A B C D"), arr("A B X Y"))) == 0.5 and one(spark, T.positional_uniform(arr("A B C D"), arr("B A C D"))) == 0.5
    first, last = one(spark, T.positional_decay(arr("A B C"), arr("X B C"))), one(spark, T.positional_decay(arr("A B C"), arr("A B X")))
    w = np.exp(-0.15 * np.arange(3))
    assert first == pytest.approx(w[1:].sum() / w.sum()) and last == pytest.approx(w[:2].sum() / w.sum())
    assert one(spark, T.structural(arr("a <*> c"), arr("a <XYZ> d"))) == pytest.approx(2 / 3) and one(spark, T.structural(arr("a"), arr("a b"))) == 0
    d = one(spark, T.sequence_distance(arr("a <*> c"), arr("a b c")))
    assert d["similarity"] == pytest.approx(2 / 3) and d["wildcards"] == 1


def test_masks(spark):
    f = lambda s: one(spark, T.premask(F.lit(s)))
    assert f("at 2024-01-02T03:04:05Z from 10.0.0.1 code 0xFF n 3.5 7") == "at <*> from <*> code <*> n <*>"
    assert f("id 123e4567-e89b-12d3-a456-426614174000 x") == "id <*> x"
    m = lambda s, d: one(spark, T.dataset_mask(F.lit(s), F.lit(d)))
    assert m("blk_-12 at 5", "HDFS") == "<*> at 5" and m("blk_-12 at 5", "custom") == "blk_-<*> at <*>" and m("n 5", "HealthApp") == "n 5"
    assert one(spark, T.untag(F.lit("a <LOI> <*> <**>"))) == "a <*> <*> <**>"


def test_template_regex_collapses(spark):
    f = lambda s: one(spark, T.template_to_regex(F.lit(s)))
    for t in ("[<*>,<*>,<*>]", '{"a":<*>,"b":<*>}', "a <*> <*> b.c", "User <*> logged in", "<*>", "x|y (z) $1 -5_"):
        assert I.safe_match(f(t), t) and memory.regex_of(t).count("(.*?)") == f(t).count("(.*?)")
    assert f("[<*>,<*>,<*>]").count("(.*?)") == 1 and f('{"a":<*>,"b":<*>}').count("(.*?)") == 2
    assert one(spark, T.regex_to_template(F.lit(r"a\.b (.*?) \[c\]$"))) == "a.b <*> [c]" and one(spark, T.regex_to_template(F.lit(None).cast("string"))) == ""


def test_guard_against_endless_matches():
    assert I.safe_match("^(a+)+b$", "a" * 35 + "c") is None and I.safe_match("(", "x") is None


def test_predicates(spark):
    f = lambda c, s: one(spark, c(F.lit(s)))
    assert f(T.is_digit_heavy, "12345") and not f(T.is_digit_heavy, "abc123") and not f(T.is_digit_heavy, "a1") and I.digit_heavy("12345")
    assert not f(T.says_something, "<*> <*>") and f(T.says_something, "User <*> logged in")
    assert f(T.is_template, "User <*>") and not any(f(T.is_template, s) for s in ("", "Sure, here", "a {{b}}", '{"template": 1}'))
    assert f(T.is_constant, "plain words") and not any(f(T.is_constant, s) for s in ("a is b", "k=v", "n 1", "a-b", "x:y"))
    assert f(T.is_thin, "(.*?)") and not f(T.is_thin, "abc (.*?)")
    assert f(T.duration, 3725.0) == "1h 2m 5.0s" and f(T.duration, 65.0) == "1m 5.0s" and f(T.duration, -1.0) == "0s"
    assert one(spark, T.clip_words(F.lit("aa bb cc"), 5, "...")) == "aa..." and one(spark, T.unfence(F.lit("```json\nx `y`\n```"))) == "x y"
    assert one(spark, dataset_key(F.lit("so_dlq_7"))) == "so" and one(spark, dataset_key(F.lit("7"))) == "default"
    assert one(spark, T.noise_key(F.lit("open k=v file 12 (tmp) a/b now"))) == "open k file now"


def test_python_functions():
    assert I.lcs_similarity("a b c d e f".split(), "a x c d e f".split()) == pytest.approx(10 / 12)
    assert I.punctuation_tokens("User <*> logged in from <*>, ok=1") == ["User", "<*>", "logged", "in", "from", "<*>", "ok", "=", "1"]
    assert I.normalise_template("flag true at /var/log/x.log <*><*> size <*> KB") == "flag <*> at <*> <*> size <*>"
    assert I.settle_template("<*>", "User 12345 in") == "User <*> in"
    assert I.answer_to_regex("`user <*> in <*`") == r"user (.*?) in (.*?)"
    assert I.answer_to_regex("a " + "<*> " * 12 + "b").count("(.*?)") <= 11 and I.cut_captures("(.*?) " * 40).count("(.*?)") == 30
    assert I.tidy_regex(r"user (.*?) in (.*?)", "user bob in x") == "user (.*?) in (.*?)$"
    assert I.template_of_answer('```json\n{"template": "a <LOI>"}\n```', "m") == "a <LOI>" and I.template_of_answer('{"template": "a b', "m") == "a b..." and I.template_of_answer("", "m") == "m"
    assert I.variables_of("User <LOI> logged in", "User admin logged in") == [{"category": "<LOI>", "value": "admin"}]
    tagged = ["java.util.HashMap", {"DATA": ["org.logstash.ConvertedMap", {"message": ["org.jruby.RubyString", "hi"], "l": ["a", "b"], "n": None}]}]
    assert I.unwrap_tagged(tagged) == {"DATA": {"message": "hi", "l": ["a", "b"], "n": None}}
    assert I.nest({"a": 1}, {"a.b": "x", "c.d.e": "y"}) == {"a": {"b": "x"}, "c": {"d": {"e": "y"}}}
    assert I.plain_answer('Parsed Log: "a <*>"') == "a <*>" and I.longest_quoted("x\n`ab` `abc`") == "abc" and I.answer_of_batch("take `a ${x} {{y}}` or `b`") == "a <*> <*>"


# Matching


def templates_of(spark, *ts):
    return spark.createDataFrame(list(zip(ts, range(len(ts)))), "template string, seq long")


def messages_of(spark, *ms):
    return spark.createDataFrame([(m,) for m in ms], "message string")


def test_loose_matches(spark):
    t = templates_of(spark, "ERROR connection from <*> closed", "User <*> logged in", "User <*> logged out")
    got = {r["message"]: r["template"] for r in match.loose_match(messages_of(spark, "WARN connection from x closed", "ERROR connection from x opened"), t, 0.7, "positional_decay").collect()}
    assert got == {"ERROR connection from x opened": "ERROR connection from <*> closed"}
    assert match.loose_candidates(messages_of(spark, "User bob logged in"), t, 0.5).count() == 2
    with pytest.raises(ValueError):
        match.loose_match(messages_of(spark, "x"), t, 0.5, "other")


def test_strict_match_never_turns_back(spark):
    t = templates_of(spark, "a <*> c", "a b d", "x <LOI>")
    got = {r["message"]: r["template"] for r in match.strict_match(messages_of(spark, "a q c", "a b c", "a b d", "x 1", "nope"), t).collect()}
    assert got == {"a q c": "a <*> c", "a b d": "a b d", "x 1": "x <LOI>"}


def test_regex_joins(spark):
    t = spark.createDataFrame([("a <*>", 2), ("a b", 1)], "template string, mru int")
    assert {r["message"]: r["template"] for r in match.regex_match(messages_of(spark, "a b", "a c"), t).collect()} == {"a b": "a b", "a c": "a <*>"}
    r = spark.createDataFrame([("a (.*?)", 2, 0), ("a b(.*?) ?x?", 3, 1)], "regex string, wc int, seq int")
    assert match.regex_by_length(messages_of(spark, "a b"), r).first()["regex"] == "a b(.*?) ?x?"
    hit, missed = match.split_by_template(messages_of(spark, "a 1", "b 1"), "a <*>")
    assert [x["message"] for x in hit.collect()] == ["a 1"] and [x["message"] for x in missed.collect()] == ["b 1"]
    cache = spark.createDataFrame([("T", "a b c d e", 0)], "template string, ref_log string, seq int")
    assert match.reconcile(messages_of(spark, "a b c d e", "a b c x y"), cache).count() == 1


# Grouping, clustering, sampling


def plain_drain(logs, depth, st):
    tree = {}
    for tokens in logs:
        tree.setdefault(len(tokens), drain.Tree(depth, st))
    owner = [(len(t), tree[len(t)].add(list(t))) for t in logs]
    return [" ".join(tree[n].clusters[k]) for n, k in owner]


def test_drain_groups(spark):
    rng = random.Random(2)
    logs = ["a"]
    logs += [f"user {rng.randint(0, 99)} did {rng.choice(['view', 'click'])} of {rng.choice(['x', 'y'])}" for _ in range(60)]
    df = spark.createDataFrame([("d", m, k) for k, m in enumerate(logs)], "dataset string, message string, seq long")
    made = drain.tree_groups(df, settings={"default": (0.5, 4)}, mask=F.col("message")).orderBy("seq").collect()
    distinct = list(dict.fromkeys(logs))
    want = dict(zip(distinct, plain_drain([m.split() for m in distinct], 4, 0.5)))
    assert [r["event_template"] for r in made] == [want[m] for m in logs]
    assert drain.parameters_of("user <*> did <*>", "user 7 did go") == ["7", "go"]
    t = drain.Tree(4, 0.5)
    assert t.add(["x"]) == 0 and t.add(["x"]) == 1  # too short for a leaf


def test_similarity_clusters(spark):
    rows = [(1, "hello world"), (2, "hello world"), (3, "hello python"), (4, "a b c d"), (5, "a b c d e")]
    df = spark.createDataFrame(rows, "id long, message string")
    d = {(r["a"], r["b"]): r["d"] for r in cluster.distances(df).collect()}
    assert d[1, 2] == pytest.approx(0) and d[1, 3] == pytest.approx(2 / 3) and (1, 4) not in d
    got = {r["id"]: r["cluster"] for r in cluster.by_similarity(df, 0.8).collect()}
    assert got == {1: 1, 2: 1, 3: None, 4: 4, 5: 4}
    m = spark.createDataFrame([(1, "hello world", "c"), (2, "hello world python", "c"), (3, "hello world java", "c")], "id long, message string, cluster string")
    assert cluster.medoids(m).first()["id"] == 1
    noise = spark.createDataFrame([(1, "job 5 done", None), (2, "job 7 done", None), (3, "other", None)], "id long, message string, cluster long")
    assert {r["id"]: r["cluster"] for r in cluster.settle_noise(noise).collect()} == {1: 1, 2: 1, 3: 3}
    assert cluster.dynamic_eps(df, 0.8) > 0.2 and cluster.clusterer("LengthCluster")(df).select("cluster").distinct().count() == 3
    with pytest.raises(ValueError):
        cluster.clusterer("x")
    tiers = cluster.noise_tiers(noise.withColumn("retries", F.col("id") - 1), spark.createDataFrame([("other", "other")], "message string, template string"), most_retries=1)
    assert {r["id"]: (r["tier"], r["template"]) for r in tiers.collect()} == {1: ("again", None), 2: ("masked", "job <*> done"), 3: ("cache", "other")}


def test_samplers():
    k = np.array([[1.0, 0.9, 0.1], [0.9, 1.0, 0.1], [0.1, 0.1, 1.0]])
    assert sample.most_diverse(k, 2) == [0, 2]
    ms = ["a b c", "a b d", "x y z w", "q"]
    assert sample.near_medoid(["hello world", "hello world python", "hello world java"], 1) == [0]
    for name in sample.SAMPLERS:
        got = sample.sampler(name)(ms, 2, 1)
        assert len(got) == 2 == len(set(got)) and got == sample.sampler(name)(ms, 2, 1)
    assert sample.adaptive(ms, 2)[0] == 2 and sorted(i for g in sample.balanced_groups(sample.tfidf([m + " word" for m in ms]), 2) for i in g) == [0, 1, 2, 3]
    assert sample.truncate_batch(["a 1", "a 2", "a 3", "a 4"]) == ["a 1", "a 2", "a 3"] and len(sample.diverse_examples(ms, 3)) == 3
    with pytest.raises(ValueError):
        sample.sampler("x")
    with pytest.raises(ValueError):
        sample.adaptive(ms, 2, similarity="x")


def test_merging(spark):
    assert merge.merge_pair("User admin logged in", "User system logged in", 0.75) == "User <*> logged in" and merge.merge_pair("a b", "c d") is None
    got = merge.calibrate(templates_of(spark, "User admin logged in", "x", "User system logged in"), 0.75)
    assert {r["template"]: r["merged"] for r in got.collect()} == {"User admin logged in": "User <*> logged in", "User system logged in": "User <*> logged in", "x": "x"}
    asked = merge.calibrate_by_source(templates_of(spark, "a b c", "a b d", "q"), template_source.Deterministic())
    assert {r["template"]: r["merged"] for r in asked.collect()} == {"a b c": "a b <*>", "a b d": "a b <*>", "q": "q"}


def test_memories(spark):
    c = memory.RecentCache(3)
    for t in ("t1", "t2", "t3"):
        c.add(t, t)
    c.add("t2", "t2")
    c.add("t4", "t4")
    c.add("t5", "t5")
    assert [e["template"] for e in c.entries()] == ["t5", "t4", "t2"]
    d = memory.RecentCache()
    d.load(c.entries())
    assert d.entries() == c.entries()
    h = memory.HashedTree()
    h.insert("User <*> logged in from <*>", "User bob logged in from here")
    assert h.match("User eve logged in from there")[0] == "User <*> logged in from <*>" and h.match("something else") is None and h.insert("<*>") == -1
    b = memory.HashedTree()
    b.insert("User bob logged in successfully today")
    assert b.add("User alice logged in successfully today", ["User bob logged in successfully today"]) == 0 and b.templates == ["User <*> logged in successfully today"]
    r = memory.RegexMemory()
    assert r.add("user (.*?) in", "user bob in") and not r.add("user (.*?) in", "user bob in") and not r.add("(.*?)", "x") and not r.add("user (.*?) out", "user bob in")
    assert r.find("user eve in") == "user (.*?) in" and r.find("nothing") is None
    some = spark.createDataFrame([(k,) for k in range(3)], "seq long")
    assert sorted(x["seq"] for x in memory.fifo(some, 2).collect()) == [1, 2] and memory.fifo(some, None).count() == 3
    proposed = spark.createDataFrame([("a (.*?) bcd", "a x bcd", 1), ("(.*?)", "x", 2), ("zzz", "y", 3)], "regex string, message string, seq long")
    assert [x["regex"] for x in memory.admit_regexes(proposed).collect()] == ["a (.*?) bcd"]


def test_aligning(spark):
    a = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3)], "key string, oa int")
    b = spark.createDataFrame([("k", 9), ("m", 8), ("m", 7)], "key string, ob int")
    assert sorted((r["oa"], r["ob"]) for r in align.pair_occurrences(a, b, "key", "oa", "ob").collect()) == [(1, 9), (3, 7)]
    left = spark.createDataFrame([("c", 1), ("d", 2)], "Content string, seq int")
    right = spark.createDataFrame([("c", 5, "second"), ("c", 4, "first")], "Content string, seq int, v string")
    assert [(r["Content"], r["v"]) for r in align.align_by_content(left, right).collect()] == [("c", "first"), ("d", None)]
    fixed = align.correct_truth(spark.createDataFrame([("1", " c\t", "User   <*> logged in\t")], "LineId string, Content string, EventTemplate string")).first()
    assert (fixed["Content"], fixed["EventTemplate"]) == ("c", "User <*> logged in")
    rows = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3), ("B", 4)], "ds string, seq int")
    order = align.interleave(rows, "ds", "seq").orderBy("turn", "first").collect()
    assert [r["seq"] for r in order] == [1, 2, 3, 4]
    assert align.interleave(rows, "ds", "seq", seed=3).count() == 4
    assert [r["t"] for r in align.newest(spark.createDataFrame([("t1", 1), ("t2", 2), ("t3", 3)], "t string, u int"), "u", 2, "t").collect()] == ["t3", "t2"]


# Sources, sinks, pipelines


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "Apache_sample.csv").write_text('Date,Time,Content,Level,Component,LineId,EventTemplate\n2026-01-01,12:00:00,"User admin\nlogged in",INFO,Auth,1,User <*> logged in\n2026-01-01,12:00:01,x,INFO,Auth,2,x\n')
    got = readers.structured_logs(spark, f"file://{tmp_path}/Apache_sample.csv").collect()
    assert got[0]["event"]["id"] == "Apache_1" and got[0]["message"] == "User admin\nlogged in" and got[0]["@timestamp"] == "2026-01-01 12:00:00" and got[0]["log"]["logger"] == "Auth"
    assert readers.structured_logs(spark, f"file://{tmp_path}/Apache_sample.csv", 1).count() == 1
    t = readers.truth(spark, [f"file://{tmp_path}/Apache_sample.csv"]).orderBy("LineId").collect()
    assert t[0]["LineId"] == "Apache_1" and t[1]["EventTemplate"] == "x"
    (tmp_path / "e.csv").write_bytes("_time,_raw,sourcetype,host\n2023-01-01T12:00:00Z,caf\xe9,winlog,\n".encode("latin-1"))
    e = readers.event_export(spark, f"file://{tmp_path}/e.csv").first()
    assert e["message"] == "café" and e["event"]["dataset"] == "winlog" and e["host"]["name"] == ""
    (tmp_path / "l.jsonl").write_text('{"message": "a", "event": {"id": "HDFS_1"}}\nnot json\n{"Content": "b", "LineId": "9"}\n{"message": "c"}\n')
    lines = readers.log_lines(spark, f"file://{tmp_path}/l.jsonl").orderBy("seq").collect()
    assert [(r["message"], r["dataset"]) for r in lines] == [("a", "HDFS"), ("b", "default"), ("c", "default")] and lines[0]["id"] == "HDFS_1"
    (tmp_path / "p.jsonl").write_text('{"message": " a ", "event": {"id": "1"}, "parsed_template": "a <LOI>"}\n')
    p = readers.parsed_results(spark, [], [f"file://{tmp_path}/p.jsonl"]).first()
    assert (p["Content"], p["EventTemplate"]) == ("a", "a <*>")
    (tmp_path / "t.json").write_text('["x <*>", "y"]')
    assert [r["template"] for r in readers.template_list(spark, f"file://{tmp_path}/t.json").orderBy("seq").collect()] == ["x <*>", "y"]
    (tmp_path / "c.json").write_text('[{"template": "x", "ref_log": "r", "frequency": 2}]')
    assert readers.template_entries(spark, f"file://{tmp_path}/c.json").first()["ref_log"] == "r" and readers.template_list(spark, f"file://{tmp_path}/c.json").first()["template"] == "x"
    assert readers.profile(spark, f"file://{tmp_path}/none.json").first()["model_used"] == "unknown-model"
    assert readers.example_pool(spark, "ecs_10").count() == 3
    line = json.dumps({"event": ["java.util.HashMap", {"DATA": ["org.logstash.ConvertedMap", {"message": ["t.S", "dummy dlq log"]}]}], "reason": "why"})
    (tmp_path / "1.log").write_bytes(line.encode())
    (tmp_path / "2.log").write_bytes(b"\xff")
    dlq = readers.dead_letters(spark, f"file://{tmp_path}/*.log", lambda raw: raw.decode().split("\n")).collect()
    assert len(dlq) == 1 and dlq[0]["message"] == "dummy dlq log" and dlq[0]["event"]["reason"] == "why"
    rows = spark.createDataFrame([("2", "b", "t2", 2), ("1", "a", "t1", 1), ("3", "c", None, 3)], "LineId string, Content string, EventTemplate string, seq long")
    sinks.parsed_csv(rows, f"file://{tmp_path}/out")
    assert [r["LineId"] for r in spark.read.csv(f"file://{tmp_path}/out", header=True).orderBy("LineId").collect()] == ["1", "2"]
    nested = sinks.nested_json(spark.createDataFrame([("m", {"source.ip": "1"})], "message string, extracted map<string,string>")).first()["value"]
    assert json.loads(nested) == {"message": "m", "source": {"ip": "1"}}


def test_search_source(spark):
    hits = [{"@timestamp": f"2024-01-0{k}", "message": f"m{k}", "event": {"dataset": "d"}, "host": {"name": "h"}} for k in range(1, 5)]

    def pages(since, until):
        yield [h for h in hits if (since is None or h["@timestamp"] > since) and (until is None or h["@timestamp"] <= until)]

    search.register(spark, pages)
    got = spark.read.format("search_hits").option("since", "2024-01-01").option("until", "2024-01-03").load().collect()
    assert [r["message"] for r in got] == ["m2", "m3"] and got[0]["host"] == "h"
    assert search.query("a", "b")["query"]["bool"]["must"][1]["range"]["@timestamp"] == {"gt": "a", "lte": "b"}


def logs_of(spark, messages):
    return spark.createDataFrame([(f"d_{k}", m, "d", k) for k, m in enumerate(messages)], "id string, message string, dataset string, seq long")


def test_sources_of_templates():
    calls = []

    def ask(messages):
        calls.append(messages)
        if len(calls) == 1:
            raise OSError
        return '{"template": "a <LOI>"}', 3, 2

    s = template_source.Asked(ask, lambda ms: template_source.categories_prompt(ms[0], [("r", "t")]))
    assert s.template(["a 1"]) == "a <LOI>" and s.usage["llm_invocations"] == 1 and s.usage["prompt_tokens"] == 3 and len(calls) == 2
    assert "<LOI>" in calls[0][0]["content"] and template_source.batch_prompt(["a"], ["v"])[0]["content"].endswith("v.") and "a b" in template_source.group_prompt(["a, b"])[1]["content"]
    assert template_source.Fixed().template([]) == "User <*> logged in"


def test_grok_and_report(spark):
    t = "[client <LOI>] script not found or unable to stat: <OBN>"
    assert one(spark, T.grok_pattern(F.lit(t))) == r"\[client %{IP:source.ip}\] script not found or unable to stat: %{NOTSPACE:process.name}"
    parsed = spark.createDataFrame([(t, 2), ("a <*>", 1), (t, 3), ("", 0)], "parsed_template string, seq int")
    body = grok.pipeline(parsed, "p")
    assert body["processors"][0]["grok"]["patterns"][0] == "a %{GREEDYDATA:custom_field}" and len(body["processors"][0]["grok"]["patterns"]) == 2
    assert grok.simulate(body, "[client 1.2.3.4] script not found or unable to stat: /x") == {"source.ip": "1.2.3.4", "process.name": "/x"} and grok.changed(body, None) and not grok.changed(body, dict(body))
    old = {"version": 3, "processors": [{"set": {}}]}
    new, did = grok.wire(old, "p", "c")
    assert did and "version" not in new and len(new["processors"]) == 2 and old["processors"] == [{"set": {}}]
    assert grok.wire(new, "p", "c") == (new, False) and grok.wire({}, "p", "c")[1]
    assert grok.unwire(new, "p") == ({"processors": [{"set": {}}]}, True) and grok.unwire(old, "p") == (old, False)
    doc = report.document(spark.createDataFrame([("m", "Overall", 1.0)], "parser string, segment string, ga double"))
    assert doc == {"m_Overall": {"ga": 1.0}} and "1.0000" in report.table(doc) and "m_Overall" in report.page(doc, {"x": 0.5})
    assert report.models(spark.createDataFrame([("b",), ("a",), ("b",)], "model_used string")) == "a+b"


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("batch:\n  batch_size: 7\n  other: 1\n")
    assert load_settings(str(tmp_path / "c.yaml")).batch.batch_size == 7 and load_settings("none").batch.batch_size == 10
    assert Settings.from_dict(PRESET_LARGE).batch.buffer_size == 10_000


def test_streams(spark, tmp_path):
    from lograil.streaming import microbatch

    base = f"file://{tmp_path}"
    logs_of(spark, [f"User {n} logged in" for n in range(6)]).repartition(2).write.json(f"{base}/in")
    stream = microbatch.increments(spark, f"{base}/in", "id string, message string, dataset string, seq long", 1)
    microbatch.parse_stream(stream, f"{base}/dict", f"{base}/out", f"{base}/cp").awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == 6 and {r["template"] for r in out.collect()} == {"User <*> logged in"}
    hits = microbatch.last_matched(microbatch.increments(spark, f"{base}/in", "message string, seq long").withColumn("template", F.lit("t")))
    q = hits.writeStream.format("memory").queryName("hits").outputMode("update").trigger(once=True).option("checkpointLocation", f"{base}/cp2").start()
    assert q.awaitTermination(120)  # state that may expire keeps other triggers running
    assert spark.table("hits").agg(F.max("hits")).first()[0] == 6


def test_entry_has_all_queries(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() == 6
