"""The three parsing methods: batches, caches, memories, modes, time limits and what their sources were asked."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lograil.operators import cluster, match, memory, sample
from lograil.plans import pipelines
from lograil.plans.template_source import Asked, Deterministic, Fixed, Memoised, shots
from lograil.schema import BatchSettings, RouterSettings, TreeSettings, load_settings

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # sources of this file run in workers that don't have it
TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
USERS = [f"User {n} logged in" for n in ("1", "2", "3")] * 2


def logs_of(spark, messages, dataset="d"):
    return spark.createDataFrame([(f"{dataset}_{k}", m, dataset, k) for k, m in enumerate(messages)], "id string, message string, dataset string, seq long")


def templates_of(spark, *templates):
    return spark.createDataFrame([(t, k) for k, t in enumerate(templates)], "template string, seq long")


def found(rows):
    return {r["message"]: (r["template"], r["tier"]) for r in rows.collect()}


class Words(Deterministic):
    """A source that leaves words as they are and makes only equal places constant."""

    def template(self, messages):
        split = [m.split(" ") for m in messages]
        same = [s for s in split if len(s) == len(split[0])]
        return " ".join(t[0] if len(set(t)) == 1 else "<*>" for t in zip(*same, strict=True))


# Routing


def test_routing_grows_a_dictionary(spark):
    logs = logs_of(spark, [*USERS, "disk 5 is full", "disk 6 is full", "quite another thing", ""])
    done = pipelines.route(logs, templates_of(spark, "quite another thing"))
    got = found(done.rows)
    assert got["User 1 logged in"] == ("User <*> logged in", "new") and got["quite another thing"] == ("quite another thing", "strict") and got[""] == ("", "empty")
    learned = {r["template"]: r for r in done.learned.collect()}
    assert set(learned) == {"User <*> logged in", "disk <*> is full", "quite another thing"}
    assert learned["User <*> logged in"]["last_used"] == 5 and learned["quite another thing"]["seq"] == 0 and learned["quite another thing"]["last_used"] == 8
    assert done.rows.count() == 10 and pipelines.totals(done.asked).first()["llm_invocations"] == 2
    assert {r["tier"] for r in pipelines.route(logs, done.learned).rows.where("message <> ''").collect()} == {"strict"}


def test_routing_forgets_and_keeps_the_newest(spark):
    old = spark.createDataFrame([("gone <*>", 0, 0, "2024-01-01 00:00:00"), ("kept <*>", 1, 1, "2024-02-10 00:00:00")], "template string, seq long, last_used long, at string")
    old = old.withColumn("last_matched", F.col("at").cast("timestamp")).drop("at")
    now = F.lit("2024-02-20 00:00:00").cast("timestamp")
    left = pipelines.route(logs_of(spark, ["a thing"]), old, now=now).learned.collect()
    assert {r["template"] for r in left} == {"kept <*>", "a thing"}
    assert [r["template"] for r in pipelines.route(logs_of(spark, ["b thing here"]), old, settings=RouterSettings(capacity=1)).learned.collect()] == ["kept <*>"]


def test_original_routing_unifies_new_templates(spark):
    s = RouterSettings(match_mode="original", loose_match_metric="positional_uniform", loose_match_threshold=0.5, merge_threshold=0.7)
    known = templates_of(spark, "User admin logged in")
    got = found(pipelines.route(logs_of(spark, ["User system logged in"]), known, Words(), s).rows)
    assert got == {"User system logged in": ("User <*> logged in", "new")}
    assert found(pipelines.route(logs_of(spark, ["User system logged in"]), known, Words(), RouterSettings(loose_match_metric="positional_uniform", loose_match_threshold=0.5)).rows) == {"User system logged in": ("User admin logged in", "loose")}


def test_time_limit_leaves_whole_batches(spark, tmp_path):
    logs = logs_of(spark, USERS)
    none = pipelines.route_in_batches(logs, f"file://{tmp_path}/none", seconds=-1)
    assert none.rows.count() == 0 and "template" in none.rows.columns and os.path.isdir(tmp_path / "none")
    every = pipelines.route_in_batches(logs, f"file://{tmp_path}/all", settings=RouterSettings(calibrate_every=4))
    assert sorted(r["tier"] for r in every.rows.collect()) == ["new"] * 4 + ["strict"] * 2
    assert [r["template"] for r in every.learned.collect()] == ["User <*> logged in"]


# Micro-batches


def brute_clusters(rows, eps):
    """Density clusters with neighbourhoods of two, by pairs: id -> least id of its cluster or None."""
    sets = {i: set(m.lower().split()) for i, _, m in rows}
    of = {i: b for i, b, _ in rows}
    near = {i: [j for j in sets if of[j] == of[i] and 1 - len(sets[i] & sets[j]) / max(len(sets[i] | sets[j]), 1) <= eps + 1e-12] for i in sets}
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = min(seen) if len(seen) > 1 else None
    return out


@pytest.mark.parametrize("threshold", [0.5, 0.65, 0.8])
def test_batches_cluster_apart(spark, threshold):
    import random

    rng = random.Random(3)
    words = [f"w{k}" for k in range(9)]
    texts = {(b, " ".join(rng.sample(words, rng.randint(1, 7)))) for b in range(3) for _ in range(40)}
    rows = [(k, b, m) for k, (b, m) in enumerate(sorted(texts))]
    df = spark.createDataFrame(rows, "id long, batch long, message string")
    got = {r["id"]: r["cluster"] for r in cluster.by_similarity(df, threshold, within="batch").collect()}
    assert got == brute_clusters(rows, 1 - threshold)


def test_forms_of_different_batches_stay_noise(spark):
    shared = "a b c d e f g h i"
    logs = spark.createDataFrame([("1", shared + " x", 0), ("2", shared + " y", 10_000)], "id string, message string, seq long")
    s = BatchSettings(buffer_size=10_000, clusterer="SimilarityCluster", similarity_threshold=0.6, noise_retries=0)
    done = pipelines.cluster_batches(logs, s)
    assert {r["tier"] for r in done.rows.collect()} == {"masked"} and done.more.count() == 2
    moved = pipelines.cluster_batches(logs, BatchSettings(buffer_size=10_000, clusterer="SimilarityCluster", similarity_threshold=0.6, noise_retries=2), Words())
    assert {r["template"] for r in moved.rows.collect()} == {shared + " <*>"}  # noise of the first batch came into the second
    inside = spark.createDataFrame([("1", "u v w x", 0), ("2", "u v w y", 1)], "id string, message string, seq long")
    tiers = {r["tier"] for r in pipelines.cluster_batches(inside, BatchSettings(buffer_size=10_000, clusterer="SimilarityCluster", similarity_threshold=0.65)).rows.collect()}
    assert tiers == {"masked"}


def test_noise_takes_cached_templates(spark):
    cache = spark.createDataFrame([("odd <*> one", "odd red one", 1, 0)], pipelines.CACHE)
    s = BatchSettings(clusterer="SimilarityCluster", similarity_threshold=0.99, noise_retries=0)
    got = found(pipelines.cluster_batches(logs_of(spark, ["odd blue one", "nothing like it 5"]), s, cache=cache).rows)
    assert got == {"odd blue one": ("odd <*> one", "cache"), "nothing like it 5": ("nothing like it <*>", "masked")}


@pytest.mark.parametrize("mode", ["production", "original"])
def test_queue_settles_every_message(spark, mode):
    logs = logs_of(spark, [*USERS, "disk 5 is full", "disk 6 is full", "alpha beta gamma delta", "alpha beta gamma delta"])
    s = BatchSettings(cache_mode=mode, similarity_threshold=0.6)
    done = pipelines.cluster_batches(logs, s, Words())
    assert done.rows.count() == logs.count() and done.rows.where("template IS NULL").count() == 0
    again = pipelines.cluster_batches(logs, s, Fixed("never <*> this"), done.learned)
    assert {r["tier"] for r in again.rows.where("message LIKE 'User%'").collect()} == {"cache"}


def test_left_over_members_queue_again(spark):
    """One length, two kinds: the first template takes one kind, the other kind is a cluster of its own in the next round."""

    class First(Words):
        def template(self, messages):
            return super().template([m for m in messages if m.split(" ")[0] == messages[0].split(" ")[0]])

    logs = logs_of(spark, ["go a now", "go b now", "go c now", "up x late", "up y late"])
    got = found(pipelines.cluster_batches(logs, BatchSettings(), First()).rows)
    assert got["go a now"] == ("go <*> now", "cluster") and got["up x late"] == ("up <*> late", "cluster")
    raw = found(pipelines.cluster_batches(logs, BatchSettings(), Fixed("never <*> this")).rows)
    assert set(raw.values()) == {(m, "raw") for m in raw}


# Trees


def test_tree_memories(spark):
    logs = logs_of(spark, [*USERS, "disk 5 is full", "disk 6 is full", "quite another thing"])
    done = pipelines.tree_groups(logs)
    got = found(done.rows)
    assert got["User 1 logged in"] == ("User <*> logged in", "group") and got["quite another thing"] == ("quite another thing", "constant") and done.rows.count() == 9
    again = found(pipelines.tree_groups(logs, done.learned).rows)
    assert again["disk 5 is full"] == ("disk <*> is full", "memory") and again["User 3 logged in"][1] == "memory"
    entries = spark.createDataFrame([("disk 6 is full", "a template of old", 0)], "raw_log string, template string, seq long")
    exact = pipelines.tree_groups(logs, settings=TreeSettings(memory_mode="production", max_memory=2), entries=entries)
    assert found(exact.rows)["disk 5 is full"] == ("a template of old", "cache") and exact.more.count() == 2


def test_what_no_regex_takes_has_its_groups_last_one(spark):
    logs = logs_of(spark, ["open file 1 ok", "open file 2 ok"])
    done = pipelines.tree_groups(logs, source=Fixed("never this"))
    assert found(done.rows) == {m: ("never this", "raw") for m in ("open file 1 ok", "open file 2 ok")}
    assert pipelines.totals(done.asked).first()["llm_invocations"] == 4  # the first question and three more
    once = pipelines.tree_groups(logs, source=Fixed("never this"), settings=TreeSettings(reflection=False))
    assert pipelines.totals(once.asked).first()["llm_invocations"] == 1 and {t for _, t in found(once.rows).values()} == {"group"}


# Sources


def test_usage_and_calls_come_back_from_workers(spark):
    source = Asked(lambda messages: ("`User <*> logged in`", 7, 2), lambda ms: [{"role": "user", "content": ms[0]}], record=True)
    done = pipelines.cluster_batches(logs_of(spark, USERS), BatchSettings(), source)
    used = pipelines.totals(done.asked).first()
    assert (used["llm_invocations"], used["prompt_tokens"], used["completion_tokens"]) == (1, 7, 2)
    assert "request" in done.asked.first()["calls"][0] and found(done.rows)["User 1 logged in"] == ("User <*> logged in", "cluster")


def test_examples_and_embeddings():
    pool = [("User admin logged in", "A"), ("disk full", "B"), ("User root logged out", "C")]
    assert shots(pool, "User x logged in", 1) == [pool[0]] and len(shots(pool, "User x logged in", 2, "diversity")) == 2
    calls = []
    embed = Memoised(lambda t: calls.append(t) or [1.0])
    assert embed("a") == embed("a") == [1.0] and calls == ["a"]


def test_matching_by_probes_equals_all_pairs(spark):
    import random

    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "c", "d", "<*>", "<NUM>"])
    templates = templates_of(spark, *dict.fromkeys(" ".join(word() for _ in range(rng.randint(1, 5))) for _ in range(60)))
    logs = spark.createDataFrame([(" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 5))),) for _ in range(80)], "message string")
    for metric in match.METRICS:
        for threshold in (0.0, 0.4, 0.8):
            every = match.loose_scores(logs, templates, metric).where(F.col("score") > threshold)
            want = {}
            for r in every.collect():
                want.setdefault(r["message"], []).append((-round(r["score"], 12), r["seq"], r["template"]))
            got = {r["message"]: r["template"] for r in match.loose_match(logs, templates, threshold, metric).collect()}
            assert got == {m: min(v)[2] for m, v in want.items()}, (metric, threshold)
            three = match.loose_candidates(logs, templates, threshold, metric).groupBy("message").count().collect()
            assert {r["message"]: r["count"] for r in three} == {m: min(3, len(v)) for m, v in want.items()}


def test_large_clusters_send_a_pool(spark):
    rows = spark.range(5000).selectExpr("'c' AS cluster", "concat('m ', id) AS message", "id")
    for name in sample.SAMPLERS:
        assert sample.sample_clusters(rows, name, 4).count() == 4


def test_settings_from_the_environment(tmp_path):
    (tmp_path / "c.yaml").write_text("tree:\n  sample_size: 7\n")
    s = load_settings(str(tmp_path / "c.yaml"), env={"LOGRAIL_TREE_REFLECTION": "false", "LOGRAIL_BATCH_SIMILARITY_THRESHOLD": "0.5", "LOGRAIL_TREE_MAX_MEMORY": "9"})
    assert s.tree == TreeSettings(sample_size=7, reflection=False, max_memory=9) and s.batch.similarity_threshold == 0.5


def test_queries_run_outside_the_repository(tmp_path):
    """The package reaches the Python workers whatever folder a session starts in."""
    code = f"""
import sys
sys.path.insert(0, {TOP!r})
import __spark_entry__
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.checkpoint.dir", "file://{tmp_path}/shared").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
for name in ("structural_merge", "strict_match", "drain_groups", "dpp_sample", "historical_variables", "icl_topk", "route_method", "batch_method", "tree_method"):
    assert __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in ran.stdout, ran.stderr[-3000:]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from lograil.storage import scratch

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})

    assert scratch(Session(spark__checkpoint__dir="hdfs://x/y/", spark__master="yarn")) == "hdfs://x/y"
    assert scratch(Session(spark__master="local[4]")).startswith("file://")
    for master in ("yarn", "spark://m:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch(Session(spark__master=master))


def test_memory_of_regexes_orders(spark):
    held = memory.RegexMemory.of(["a (.*?)", "a (.*?) c", "a b c"])
    assert held.find("a b c") == "a (.*?) c" and held.find("a x") == "a (.*?)"
