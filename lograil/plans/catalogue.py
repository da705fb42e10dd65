"""Named queries over the driver's tables, and the SQL that gives the same rows.

Log lines come from `events`: content, truth and the output of a parser with some deliberate faults, for five datasets.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lograil.functions import text as T
from lograil.operators import align, cluster, drain, match, memory, merge, metrics, sample
from lograil.plans import grok, pipelines
from lograil.schema import BatchSettings, dataset_key
from lograil.sources.readers import record
from lograil.storage import new_path

FLAGSHIP = "metrics_by_segment"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def logs(spark: SparkSession, d: str) -> DataFrame:
    """line_id, ds, seq, content, gt, parsed."""
    e = table(spark, d, "events")
    v, kind, n = (F.col("event_id") % 97).cast("string"), F.col("event_type"), F.col("event_id")
    plain = F.concat(F.lit("user <*> did "), kind, F.lit(" value <*>"))
    faulty = F.concat(F.lit("user <*> did "), kind, F.lit(" value "), v)
    gt = F.when(kind == "click", plain).when(n % 10 == 0, faulty).otherwise(plain)
    parsed = F.when((kind == "view") & (n % 2 == 0), F.lit("user <*> did <*> value <*>")).when((kind == "error") & (n % 7 == 0), F.lit("user <*>  did error")).when((kind == "signup") & (n % 3 == 0), F.lit("User <*> did signup value <*>:")).otherwise(plain)
    return e.select(F.concat(kind, F.lit("_"), n.cast("string")).alias("line_id"), kind.alias("ds"), n.alias("seq"), F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" did "), kind, F.lit(" value "), v).alias("content"), gt.alias("gt"), parsed.alias("parsed"))


LOGS = """logs AS (SELECT concat(event_type, '_', event_id) AS line_id, event_type AS ds, event_id AS seq,
  concat('user ', user_id, ' did ', event_type, ' value ', CAST(event_id % 97 AS VARCHAR)) AS content,
  CASE WHEN event_type = 'click' THEN concat('user <*> did ', event_type, ' value <*>') WHEN event_id % 10 = 0 THEN concat('user <*> did ', event_type, ' value ', CAST(event_id % 97 AS VARCHAR)) ELSE concat('user <*> did ', event_type, ' value <*>') END AS gt,
  CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'user <*> did <*> value <*>' WHEN event_type = 'error' AND event_id % 7 = 0 THEN 'user <*>  did error' WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'User <*> did signup value <*>:' ELSE concat('user <*> did ', event_type, ' value <*>') END AS parsed
FROM events)"""
SPACED = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
SEGMENTED = f"""{LOGS}, al AS (SELECT unnest(['Overall', ds]) AS segment, content, {SPACED.format('gt')} AS gt, {SPACED.format('parsed')} AS parsed FROM logs),
pc AS (SELECT segment, gt, parsed, count(*) AS n FROM al GROUP BY ALL)"""
GROUPING = """g AS (SELECT segment, gt, sum(n) AS size, count(*) AS kinds, min(parsed) AS parsed FROM pc GROUP BY ALL), p AS (SELECT segment, parsed, sum(n) AS total FROM pc GROUP BY ALL),
gr AS (SELECT g.segment, sum(CASE WHEN kinds = 1 AND size = total THEN size ELSE 0 END) AS okr, sum(size) AS r, sum((kinds = 1 AND size = total)::INT) AS ok, count(*) AS ng FROM g JOIN p USING (segment, parsed) GROUP BY g.segment),
np AS (SELECT segment, count(*) AS np FROM p GROUP BY segment),
ga AS (SELECT segment, okr * 1e0 / r AS ga, 2e0 * ok / (ng + np) AS fga FROM gr JOIN np USING (segment))"""
PA = "pa AS (SELECT segment, sum(CASE WHEN gt = parsed THEN n ELSE 0 END) * 1e0 / sum(n) AS pa FROM pc GROUP BY segment)"
FTA = """st AS (SELECT segment, gt AS t, 1 AS a, 0 AS b FROM pc UNION SELECT segment, parsed, 0, 1 FROM pc), s2 AS (SELECT segment, t, max(a) AS a, max(b) AS b FROM st GROUP BY ALL),
fta AS (SELECT segment, 2e0 * sum(a * b) / (sum(a) + sum(b)) AS fta FROM s2 GROUP BY segment)"""
ED = """ed AS (SELECT segment, sum(levenshtein(gt, parsed) * n) * 1e0 / sum(n) AS ed, sum((1 - levenshtein(gt, parsed) * 1e0 / greatest(len(gt), len(parsed))) * n) / sum(n) AS ned FROM pc GROUP BY segment)"""
GD = """md AS (SELECT segment, parsed, gt, row_number() OVER (PARTITION BY segment, parsed ORDER BY n DESC, gt) AS k FROM pc),
pg AS (SELECT segment, avg(abs(len(list_filter(string_split(gt, ' '), lambda x: x <> '')) - len(list_filter(string_split(parsed, ' '), lambda x: x <> '')))) AS pgd FROM md WHERE k = 1 GROUP BY segment),
gd AS (SELECT segment, abs(count(DISTINCT parsed) - count(DISTINCT gt)) * 1e0 / count(DISTINCT gt) AS ggd FROM pc GROUP BY segment)"""
PMSS = """cn AS (SELECT segment, content, parsed, count(*) AS n FROM al GROUP BY ALL), tp AS (SELECT DISTINCT segment, parsed AS other FROM cn),
di AS (SELECT cn.segment, content, parsed, n, min(levenshtein(content, other) * 1e0 / greatest(len(content), len(other), 1)) AS b, any_value(levenshtein(content, parsed) * 1e0 / greatest(len(content), len(parsed), 1)) AS a FROM cn JOIN tp ON tp.segment = cn.segment AND other <> parsed GROUP BY ALL),
sm AS (SELECT segment, sum(CASE WHEN greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END * n) / sum(n) AS pmss FROM di GROUP BY segment),
pm AS (SELECT s.segment, coalesce(pmss, 0) AS pmss FROM (SELECT DISTINCT segment FROM al) s LEFT JOIN sm USING (segment))"""


def aligned(spark: SparkSession, d: str) -> DataFrame:
    return metrics.with_overall(logs(spark, d).select("ds", "content", "gt", "parsed"), "ds").select("segment", "content", "gt", "parsed")


def _pairs(spark: SparkSession, d: str, level: str = "spaced") -> DataFrame:
    return metrics.pair_counts(metrics.at_level(aligned(spark, d), level), ["segment"])


def _rounded(df: DataFrame, keys=("segment",)) -> DataFrame:
    return df.select(*keys, *(F.round(c, 9).alias(c) for c in df.columns if c not in keys))


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SEGMENTED, *ctes]) + "\n" + body


MASKED = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\\b0[xX][a-fA-F0-9]+\\b', '<*>', 'g'), '\\b(?:\\d{{1,3}}\\.){{3}}\\d{{1,3}}\\b', '<*>', 'g'), '\\b\\d+(?:\\.\\d+)?\\b', '<*>', 'g'), '<\\*>\\s*(?:<\\*>\\s*)+', '<*> ', 'g'))"


@query(f"WITH {LOGS} SELECT {MASKED.format('content')} AS template, count(*) AS n FROM logs GROUP BY 1")
def template_histogram(spark, d):
    """Masked messages and how many there are of each."""
    return logs(spark, d).groupBy(T.premask("content").alias("template")).agg(F.count("*").alias("n"))


@query(f"WITH {LOGS} SELECT line_id AS id, content AS message, ds AS dataset, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM logs JOIN events ON event_id = seq")
def ecs_projection(spark, d):
    """Records in the common shape, flat again for the comparison."""
    e = table(spark, d, "events").select(F.col("event_id").alias("seq"), "ts")
    made = logs(spark, d).join(e, "seq").select(*record(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("content"), event_id=F.col("line_id"), dataset=F.col("ds")))
    return made.select(F.col("event.id").alias("id"), "message", F.col("event.dataset").alias("dataset"), F.col("`@timestamp`").alias("ts"))


@query(f"WITH {LOGS}, k AS (SELECT CASE WHEN seq % 50 = 0 THEN CAST(seq AS VARCHAR) WHEN seq % 50 = 1 THEN 'so_dlq_' || seq ELSE line_id END AS i FROM logs) SELECT CASE WHEN contains(i, '_') THEN split_part(i, '_', 1) ELSE 'default' END AS dataset, count(*) AS n FROM k GROUP BY 1")
def dataset_key_counts(spark, d):
    """Rows of each dataset key."""
    s = F.col("seq")
    rid = F.when(s % 50 == 0, s.cast("string")).when(s % 50 == 1, F.concat(F.lit("so_dlq_"), s.cast("string"))).otherwise(F.col("line_id"))
    return logs(spark, d).groupBy(dataset_key(rid).alias("dataset")).agg(F.count("*").alias("n"))


@query("SELECT event_id FROM events WHERE props IS NOT NULL AND event_type NOT LIKE 'view%' AND ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'")
def unmapped_filter(spark, d):
    """What an extraction takes: the predicate reaches the scan."""
    e = table(spark, d, "events")
    kept = e.withColumn("category", F.when(F.col("event_type") == "view", F.lit("web")))
    day = lambda n: F.lit(datetime.datetime(2024, 1, n))
    return align.unmapped(kept, day(5), day(20), "ts", "props", "category", "event_type").select("event_id")


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_timestamp, count(*) AS n FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def cursor_incremental(spark, d):
    """Where the next extraction goes on, and how much this one took."""
    e = table(spark, d, "events").where(F.col("ts") > F.lit(datetime.datetime(2024, 1, 15)))
    return e.agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_timestamp"), F.count("*").alias("n"))


@query(f"WITH {LOGS} SELECT line_id AS LineId, a.content, a.gt, b.parsed FROM logs a JOIN (SELECT line_id, parsed FROM logs WHERE seq % 3 <> 0) b USING (line_id)")
def align_join(spark, d):
    """Truth and parsed rows that share an id."""
    base = logs(spark, d)
    truth = base.select(F.col("line_id").alias("LineId"), F.col("content").alias("Content"), F.col("gt").alias("EventTemplate"))
    parsed = base.where("seq % 3 <> 0").select(F.col("line_id").alias("LineId"), F.col("parsed").alias("EventTemplate"))
    return align.align(truth, parsed)


@query("""WITH a AS (SELECT role, conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS k FROM conversations), b AS (SELECT role, conv_id AS other, row_number() OVER (PARTITION BY role ORDER BY conv_id DESC, turn DESC) AS k FROM conversations)
SELECT role, conv_id, turn, other FROM a JOIN b USING (role, k)""")
def bag_join(spark, d):
    """The k-th row of a key with the k-th of another order."""
    c = table(spark, d, "conversations")
    a = c.select("role", "conv_id", "turn", F.struct("conv_id", "turn").alias("oa"))
    b = c.select("role", F.col("conv_id").alias("other"), F.struct(-F.col("conv_id"), -F.col("turn")).alias("ob"))
    return align.pair_occurrences(a, b, "role", "oa", "ob").select("role", "conv_id", "turn", "other")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def last_wins(spark, d):
    """The last row of each key."""
    e = table(spark, d, "events").select("user_id", "event_type", "event_id")
    return align.last_of(e, "user_id", "event_id")


@query(_with("SELECT segment, round(ga, 9) AS ga, round(fga, 9) AS fga FROM ga", GROUPING))
def grouping_accuracy(spark, d):
    """ga and fga by segment."""
    return _rounded(metrics.grouping(_pairs(spark, d), ["segment"]))


@query(f"""WITH {LOGS}, lv AS (SELECT unnest(['Overall', ds]) AS segment, unnest(['raw', 'spaced', 'lowercase', 'regex_clean']) AS level, gt, parsed FROM (SELECT * FROM logs) WHERE false),
x AS (SELECT segment, level, CASE level WHEN 'raw' THEN gt WHEN 'spaced' THEN {SPACED.format('gt')} WHEN 'lowercase' THEN lower({SPACED.format('gt')}) ELSE lower(regexp_replace({SPACED.format('gt')}, '[.\\s,:;()\\[\\]{{}}|]+$', '')) END AS gt,
 CASE level WHEN 'raw' THEN parsed WHEN 'spaced' THEN {SPACED.format('parsed')} WHEN 'lowercase' THEN lower({SPACED.format('parsed')}) ELSE lower(regexp_replace({SPACED.format('parsed')}, '[.\\s,:;()\\[\\]{{}}|]+$', '')) END AS parsed
 FROM (SELECT unnest(['Overall', ds]) AS segment, gt, parsed FROM logs) s, (SELECT unnest(['raw', 'spaced', 'lowercase', 'regex_clean']) AS level) l)
SELECT segment, level, round(avg((gt = parsed)::INT), 9) AS pa FROM x GROUP BY ALL""")
def parsing_accuracy_by_level(spark, d):
    """pa by segment on all four levels, in one pass over the rows."""
    rows = aligned(spark, d)
    levels = F.array(*(F.struct(F.lit(lv).alias("level"), T.at_level("gt", lv).alias("gt"), T.at_level("parsed", lv).alias("parsed")) for lv in T.LEVELS))
    exploded = rows.select("segment", F.explode(levels).alias("x")).select("segment", "x.*")
    return _rounded(metrics.accuracy(metrics.pair_counts(exploded, ["segment", "level"]), ["segment", "level"]), ("segment", "level"))


@query(_with("SELECT segment, round(fta, 9) AS fta FROM fta", FTA))
def template_accuracy_f1(spark, d):
    """fta by segment."""
    return _rounded(metrics.template_f1(_pairs(spark, d), ["segment"]))


@query(_with("SELECT segment, round(ed, 9) AS ed, round(ned, 9) AS ned FROM ed", ED))
def edit_distance(spark, d):
    """ed and ned by segment."""
    return _rounded(metrics.edit_distance(_pairs(spark, d), ["segment"]))


@query(_with("SELECT segment, round(ggd, 9) AS ggd, round(pgd, 9) AS pgd FROM gd JOIN pg USING (segment)", GD))
def granularity(spark, d):
    """ggd and pgd by segment."""
    return _rounded(metrics.granularity(_pairs(spark, d), ["segment"]))


@query(_with("SELECT segment, round(pmss, 9) AS pmss FROM pm", PMSS))
def pmss(spark, d):
    """The silhouette by segment."""
    return _rounded(metrics.silhouette(metrics.at_level(aligned(spark, d), "spaced"), ["segment"]))


_LEVEL = {
    "raw": "{0}",
    "spaced": SPACED,
    "lowercase": f"lower({SPACED})",
    "regex_clean": f"lower(regexp_replace({SPACED}, '[.\\s,:;()\\[\\]{{{{}}}}|]+$', ''))",
}
_RATES = ",\n".join(
    f"""x_{lv} AS (SELECT segment, {sql.format('gt')} AS gt, {sql.format('parsed')} AS parsed FROM (SELECT unnest(['Overall', ds]) AS segment, gt, parsed FROM logs)),
 a_{lv} AS (SELECT segment, avg((gt = parsed)::INT) AS pa FROM x_{lv} GROUP BY segment),
 f_{lv} AS (SELECT segment, 2e0 * sum(g * p) / (sum(g) + sum(p)) AS fta FROM (SELECT segment, t, max(g) AS g, max(p) AS p FROM (SELECT segment, gt AS t, 1 AS g, 0 AS p FROM x_{lv} UNION ALL SELECT segment, parsed, 0, 1 FROM x_{lv}) GROUP BY ALL) GROUP BY segment)"""
    for lv, sql in _LEVEL.items()
)
_RATE_COLUMNS = ", ".join(f"round(a_{lv}.pa, 9) AS pa_{lv}, round(f_{lv}.fta, 9) AS fta_{lv}" for lv in T.LEVELS)
_RATE_JOINS = " ".join(f"JOIN a_{lv} USING (segment) JOIN f_{lv} USING (segment)" for lv in T.LEVELS)
_NAMES = ("ga", "fga", "pa", "fta", "ed", "ned", "ggd", "pgd", "pmss")
_METRICS = ", ".join(f"round({k}.{c}, 9) AS {c}" for c, k in zip(_NAMES, ("ga", "ga", "pa", "fta", "ed", "ed", "gd", "pg", "pm"), strict=True))
_METRIC_JOINS = "ga JOIN pa USING (segment) JOIN fta USING (segment) JOIN ed USING (segment) JOIN gd USING (segment) JOIN pg USING (segment) JOIN pm USING (segment)"


@query(_with(f"SELECT segment, {_METRICS}, {_RATE_COLUMNS} FROM {_METRIC_JOINS} {_RATE_JOINS}", GROUPING, PA, FTA, ED, GD, PMSS, _RATES))
def metrics_by_segment(spark, d):
    """All metrics by segment, pa and fta on all levels."""
    return _rounded(metrics.bundle(logs(spark, d).select("ds", "content", "gt", "parsed"), ["segment"], dataset="ds"))


@query(_with("""SELECT round(coalesce(corr(x, y), 0), 9) AS rho FROM (SELECT rank() OVER (ORDER BY round(pa, 9)) + (count(*) OVER (PARTITION BY round(pa, 9)) - 1) / 2e0 AS x, rank() OVER (ORDER BY round(ned, 9)) + (count(*) OVER (PARTITION BY round(ned, 9)) - 1) / 2e0 AS y FROM pa JOIN ed USING (segment))""", PA, ED))
def spearman_pa_ned(spark, d):
    """Rank correlation of two metrics over segments."""
    p = _pairs(spark, d)
    both = _rounded(metrics.accuracy(p, ["segment"]).join(metrics.edit_distance(p, ["segment"]), "segment"))
    return metrics.spearman(both, "pa", "ned").select(F.round("rho", 9).alias("rho"))


@query(f"""WITH {LOGS} SELECT ds, count(*) AS log_volume, CAST(sum((seq % 10 = 0)::INT) AS BIGINT) AS llm_invocations, CAST(sum((seq % 10 <> 0)::INT) AS BIGINT) AS cache_hits, round(avg((seq % 10 <> 0)::INT), 9) AS cache_hit_rate, round(count(*) / 12.5e0, 9) AS throughput,
 round(sum((seq % 100 = 0)::INT) * 1e0 / (sum((seq % 10 = 0)::INT) + sum((seq % 100 = 0)::INT)), 9) AS failure_rate FROM logs GROUP BY ds""")
def profile_rates(spark, d):
    """Derived rates of a run's counters."""
    s = F.col("seq")
    counts = logs(spark, d).groupBy("ds").agg(F.count("*").alias("log_volume"), F.sum((s % 10 == 0).cast("long")).alias("llm_invocations"), F.sum((s % 10 != 0).cast("long")).alias("cache_hits"), F.sum((s % 100 == 0).cast("long")).alias("failed_invocations"))
    kind = "array<struct<log_volume:long, llm_invocations:long, cache_hits:long>>"
    full = counts.withColumns({"time_taken_seconds": F.lit(12.5), "llm_timeouts": F.lit(0).cast("long"), "history": F.array().cast(kind), "model_used": F.lit("m"), "method_used": F.lit("x")})
    return metrics.profile_rates(full).select("ds", "log_volume", "llm_invocations", "cache_hits", *(F.round(c, 9).alias(c) for c in ("cache_hit_rate", "throughput", "failure_rate")))


def _dictionary(spark: SparkSession, d: str) -> DataFrame:
    """template, seq: the parser's templates, by where each was first seen."""
    return logs(spark, d).groupBy(F.col("parsed").alias("template")).agg(F.min("seq").alias("seq"))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return logs(spark, d).select(F.col("content").alias("message"), "seq")


_LOOSE = f"""{LOGS}, dc AS (SELECT parsed AS template, min(seq) AS seq, string_split(parsed, ' ') AS tt FROM logs GROUP BY parsed), ms AS (SELECT DISTINCT content AS message, string_split(content, ' ') AS mt FROM logs),
j AS (SELECT message, template, seq, list_filter(list_zip(tt, mt), lambda p: NOT regexp_matches(p[1], '^<.*>$')) AS f FROM ms JOIN dc ON len(tt) = len(mt))"""
_UNIFORM = "CASE WHEN len(f) = 0 THEN 0 ELSE len(list_filter(f, lambda p: p[1] = p[2])) * 1e0 / len(f) END"
_DECAY = "CASE WHEN len(f) = 0 THEN 0 ELSE list_sum(list_transform(range(1, len(f) + 1), lambda i: CASE WHEN f[i][1] = f[i][2] THEN exp(-0.15e0 * (i - 1)) ELSE 0e0 END)) / list_sum(list_transform(range(1, len(f) + 1), lambda i: exp(-0.15e0 * (i - 1)))) END"
_JACCARD = "CASE WHEN len(f) = 0 THEN 1 ELSE len(list_intersect(list_transform(f, lambda p: p[1]), list_transform(f, lambda p: p[2]))) * 1e0 / len(list_distinct(list_concat(list_transform(f, lambda p: p[1]), list_transform(f, lambda p: p[2])))) END"


def _loose_sql(score: str, n: int, threshold: float) -> str:
    return f"WITH {_LOOSE}, s AS (SELECT message, template, seq, {score} AS score FROM j), r AS (SELECT *, row_number() OVER (PARTITION BY message ORDER BY round(score, 9) DESC, seq) AS rank FROM s WHERE score > {threshold}) SELECT message, template, round(score, 9) AS score, CAST(rank AS INT) AS rank FROM r WHERE rank <= {n}"


def _loose(metric: str, threshold: float, n: int):
    def f(spark, d):
        found = match.loose_candidates(_messages(spark, d), _dictionary(spark, d), threshold, metric, n)
        return found.select("message", "template", F.round("score", 9).alias("score"), "rank")

    return f


for _name, _metric, _sql, _n, _t in (("loose_match_uniform", "positional_uniform", _UNIFORM, 1, 0.8), ("loose_match_decay", "positional_decay", _DECAY, 1, 0.6), ("loose_match_jaccard", "jaccard", _JACCARD, 1, 0.8), ("loose_candidates_top3", "positional_uniform", _UNIFORM, 3, 0.4)):
    QUERIES[_name], ORACLES[_name] = _loose(_metric, _t, _n), _loose_sql(_sql, _n, _t)


@query(f"WITH {_LOOSE}, m AS (SELECT message, template, seq FROM j WHERE list_aggregate(list_transform(f, lambda p: p[1] = p[2]), 'bool_and')), r AS (SELECT *, row_number() OVER (PARTITION BY message ORDER BY len(list_filter(string_split(template, ' '), lambda x: x = '<*>')), seq) AS k FROM m) SELECT message, template FROM r WHERE k = 1")
def strict_match(spark, d):
    """The walk down the prefix tree; on this dictionary it ends at the match with fewest wildcards."""
    return match.strict_match(_messages(spark, d), _dictionary(spark, d))


@query("""WITH p AS (SELECT item_id, list_distinct(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS b FROM benchmark), m AS (SELECT conv_id, turn, text, list_distinct(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS a FROM conversations),
s AS (SELECT DISTINCT text, item_id, len(list_intersect(a, b)) * 1e0 / len(list_distinct(list_concat(a, b))) AS sim FROM m, p), r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY sim DESC, item_id) AS rank FROM s)
SELECT md5(text) AS message, item_id AS example, round(sim, 9) AS similarity, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3""")
def icl_topk(spark, d):
    """The three examples most like each message."""
    pool = table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("template"), F.col("text").alias("ref_log"), F.col("item_id").alias("seq"))
    found = match.nearest_example(table(spark, d, "conversations").select(F.col("text").alias("message")), pool)
    return found.select(F.md5("message").alias("message"), F.col("template").cast("long").alias("example"), F.round("similarity", 9).alias("similarity"), "rank")


@query(f"WITH {LOGS} SELECT ds, CAST(sum(regexp_matches(content, '^user (.*?) did view value (.*?)$')::INT) AS BIGINT) AS hit, CAST(sum((NOT regexp_matches(content, '^user (.*?) did view value (.*?)$'))::INT) AS BIGINT) AS missed FROM logs GROUP BY ds")
def regex_match_split(spark, d):
    """Logs that a template's regex matches, and the others, by dataset."""
    base = logs(spark, d).select("ds", F.col("content").alias("message"))
    hit, missed = match.split_by_template(base, "user <*> did view value <*>")
    both = hit.select("ds", F.lit(1).alias("h"), F.lit(0).alias("m")).unionByName(missed.select("ds", F.lit(0).alias("h"), F.lit(1).alias("m")))
    return both.groupBy("ds").agg(F.sum("h").alias("hit"), F.sum("m").alias("missed"))


@query(f"""WITH {LOGS}, dc AS (SELECT parsed AS template, row_number() OVER (ORDER BY min(seq)) AS mru FROM logs GROUP BY parsed), ms AS (SELECT DISTINCT content AS message FROM logs),
h AS (SELECT message, template, mru FROM ms JOIN dc ON len(list_filter(string_split(message, ' '), lambda x: x <> '')) = len(list_filter(string_split(template, ' '), lambda x: x <> '')) AND regexp_matches(message, '^' || replace(regexp_replace(template, '<\\*>(?:\\s*[^\\w\\s<]{{1,3}}\\s*<\\*>)+', '<*>', 'g'), '<*>', '(.*?)') || '$'))
SELECT message, arg_min(template, mru) AS template FROM h GROUP BY message""")
def regex_dictionary_match(spark, d):
    """The first template of as many words whose regex matches."""
    dictionary = _dictionary(spark, d)
    return match.regex_match(_messages(spark, d), dictionary.withColumnRenamed("seq", "mru"))


@query("SELECT CAST(len(w) AS INT) AS n_tokens, count(*) AS n FROM (SELECT list_filter(string_split_regex(unnest(string_split(text, chr(10))), '[ \\t\\r\\x0b\\x0c]+'), lambda x: x <> '') AS w FROM documents) GROUP BY 1")
def length_clusters(spark, d):
    """Lines of documents by number of words."""
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n", -1)).alias("message"))
    return cluster.by_length(lines).groupBy("n_tokens").agg(F.count("*").alias("n"))


@query()
def drain_groups(spark, d):
    """Tree groups of the logs: event id, template, rows."""
    made = drain.tree_groups(logs(spark, d).select(F.col("ds").alias("dataset"), F.col("content").alias("message"), "seq"))
    return made.groupBy("dataset", "event_id", "event_template").agg(F.count("*").alias("n"))


def _forms(spark: SparkSession, d: str) -> DataFrame:
    """id, message: the distinct contents without their user, with the event's name twice, each by its first row."""
    c = F.regexp_replace(F.regexp_replace("content", r"^user \d+", "user x"), " did ([a-z]+)", " did $1 $1-event")
    return logs(spark, d).groupBy(c.alias("message")).agg(F.min("seq").alias("id"))


@query(f"""WITH RECURSIVE {LOGS}, n AS (SELECT regexp_replace(regexp_replace(content, '^user \\d+', 'user x'), ' did ([a-z]+)', ' did \\1 \\1-event') AS message, min(seq) AS id FROM logs GROUP BY 1), w AS (SELECT id, message, list_distinct(string_split(lower(message), ' ')) AS s FROM n),
e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM w a JOIN w b ON a.id <> b.id AND 1 - len(list_intersect(a.s, b.s)) * 1e0 / len(list_distinct(list_concat(a.s, b.s))) <= 0.3e0 + 1e-12),
r(a, b) AS (SELECT id, id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT message, CASE WHEN count(*) > 1 THEN min(b) END AS cluster FROM r JOIN n ON n.id = r.a GROUP BY message""")
def dbscan_components(spark, d):
    """Clusters by similarity, noise null."""
    return cluster.by_similarity(_forms(spark, d), 0.7).select("message", "cluster")


@query(f"""WITH {LOGS}, n AS (SELECT regexp_replace(regexp_replace(content, '^user \\d+', 'user x'), ' did ([a-z]+)', ' did \\1 \\1-event') AS message, min(seq) AS id FROM logs GROUP BY 1), k AS (SELECT message, id, array_to_string(list_filter(list_transform(string_split(message, ' '), lambda w: CASE WHEN regexp_matches(w, '\\d') THEN '' ELSE w END), lambda w: w <> ''), ' ') AS key FROM n)
SELECT message, min(id) OVER (PARTITION BY key) AS cluster FROM k""")
def noise_fallback(spark, d):
    """Noise that joins others with equal words."""
    noise = _forms(spark, d).withColumn("cluster", F.lit(None).cast("long"))
    return cluster.settle_noise(noise).select("message", "cluster")


@query(f"""WITH {LOGS}, n AS (SELECT ds, regexp_replace(content, '^user \\d+', 'user x') AS message, min(seq) AS id FROM logs GROUP BY ALL), w AS (SELECT *, list_distinct(string_split(lower(message), ' ')) AS s FROM n),
d AS (SELECT a.ds, a.id, a.message, round(sum(CASE WHEN a.id = b.id THEN 0 ELSE len(list_intersect(a.s, b.s)) * 1e0 / len(list_distinct(list_concat(a.s, b.s))) END), 9) AS near FROM w a JOIN w b ON a.ds = b.ds GROUP BY ALL)
SELECT ds AS cluster, arg_min(id, k) AS id, arg_min(message, k) AS message FROM (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY near DESC, id) AS k FROM d) GROUP BY ds""")
def cluster_medoids(spark, d):
    """The medoid of each dataset's distinct contents."""
    c = F.regexp_replace("content", r"^user \d+", "user x")
    distinct = logs(spark, d).groupBy(F.col("ds").alias("cluster"), c.alias("message")).agg(F.min("seq").alias("id"))
    return cluster.medoids(distinct)


@query()
def structural_merge(spark, d):
    """True templates merged where they are variants of one."""
    t = logs(spark, d).groupBy(F.col("gt").alias("template")).agg(F.min("seq").alias("seq"))
    return merge.calibrate(t, 0.8)


@query(f"""WITH {LOGS}, t AS (SELECT gt AS template, min(seq) AS seq, string_split(gt, ' ') AS k FROM logs GROUP BY gt),
p AS (SELECT a.template AS a, b.template AS b, list_transform(list_zip(a.k, b.k), lambda z: CASE WHEN z[1] = z[2] THEN z[1] ELSE '<*>' END) AS m, list_transform(list_zip(a.k, b.k), lambda z: z[1] = z[2] OR (regexp_matches(z[1], '^<.*>$') AND regexp_matches(z[2], '^<.*>$'))) AS e FROM t a JOIN t b ON len(a.k) = len(b.k) AND a.seq < b.seq)
SELECT a, b, round(len(list_filter(e, lambda x: x)) * 1e0 / len(e), 9) AS similarity, array_to_string(m, ' ') AS merged FROM p WHERE len(list_filter(e, lambda x: x)) * 1e0 / len(e) >= 0.8""")
def merge_pairs(spark, d):
    """Pairs of templates that are alike enough, merged."""
    t = logs(spark, d).groupBy(F.col("gt").alias("template")).agg(F.min("seq").alias("seq"))
    return merge.similar_pairs(t, 0.8).withColumn("similarity", F.round("similarity", 9))


@query()
def dpp_sample(spark, d):
    """A diverse sample of each dataset."""
    rows = logs(spark, d).select(F.col("ds").alias("cluster"), F.col("content").alias("message"), F.col("seq").alias("id"))
    return sample.sample_clusters(rows, "DPPSampler", 5)


@query()
def adaptive_sample(spark, d):
    """A farthest-first sample of each dataset."""
    rows = logs(spark, d).select(F.col("ds").alias("cluster"), F.col("content").alias("message"), F.col("seq").alias("id"))
    return sample.sample_clusters(rows, "AdaptiveSampler", 3)


@query(f"WITH {LOGS}, n AS (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY seq) AS place, min(seq) OVER (PARTITION BY ds) AS first FROM logs) SELECT line_id, CAST(place AS INT) AS place, CAST((place - 1) // 100 AS BIGINT) AS turn, first FROM n")
def round_robin_interleave(spark, d):
    """Datasets take turns of a hundred rows."""
    return align.interleave(logs(spark, d), "ds", "seq", chunk=100).select("line_id", "place", "turn", "first")


@query("SELECT user_id, max(event_id) AS last_used, count(*) AS frequency FROM events GROUP BY user_id ORDER BY last_used DESC, user_id LIMIT 1000")
def lru_topk(spark, d):
    """What a cache of 1000 entries holds after all accesses."""
    used = table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("last_used"), F.count("*").alias("frequency"))
    return align.newest(used, "last_used", 1000, "user_id")


@query("SELECT event_id, user_id FROM events ORDER BY event_id DESC LIMIT 500")
def fifo_memory(spark, d):
    """What a memory of 500 entries holds that forgets its oldest."""
    return memory.fifo(table(spark, d, "events").select("event_id", "user_id"), 500, "event_id")


@query("""WITH p AS (SELECT item_id, list_distinct(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS b FROM benchmark), m AS (SELECT DISTINCT text, list_distinct(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS a FROM conversations WHERE conv_id % 3 = 0),
s AS (SELECT text, item_id, len(list_intersect(a, b)) * 1e0 / len(list_distinct(list_concat(a, b))) AS sim FROM m, p), r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY sim DESC, item_id) AS rank FROM s)
SELECT md5(text) AS message, CAST(item_id AS VARCHAR) AS template, round(sim, 9) AS similarity FROM r WHERE rank = 1 AND sim >= 0.1e0""")
def medoid_reconcile(spark, d):
    """Messages that are like enough to the reference log of a cached entry, and its template."""
    cache = table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("template"), F.col("text").alias("ref_log"), F.col("item_id").alias("seq"))
    found = match.reconcile(table(spark, d, "conversations").where("conv_id % 3 = 0").select(F.col("text").alias("message")), cache, 0.1)
    return found.select(F.md5("message").alias("message"), "template", F.round("similarity", 9).alias("similarity"))


@query("SELECT user_id, max(ts) AS last_matched FROM events GROUP BY user_id HAVING max(ts) >= TIMESTAMP '2024-02-20' - INTERVAL 30 DAY")
def ttl_prune(spark, d):
    """Entries used in the last 30 days."""
    used = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last_matched"))
    return align.unexpired(used, "last_matched", F.lit(datetime.datetime(2024, 2, 20)))


@query(f"WITH {LOGS} SELECT line_id, unnest(['<USR>', '<TID>', '<NUM>']) AS tag, unnest([regexp_extract(content, '^user (.*?) did (.*?) value (.*?)$', 1), regexp_extract(content, '^user (.*?) did (.*?) value (.*?)$', 2), regexp_extract(content, '^user (.*?) did (.*?) value (.*?)$', 3)]) AS value, unnest(['user.name', NULL, 'event.duration']) AS field FROM logs")
def variable_extraction(spark, d):
    """Tags of a template, what fills them, and the record fields they mean."""
    template = "user <USR> did <TID> value <NUM>"
    rx = "^user (.*?) did (.*?) value (.*?)$"
    values = F.arrays_zip(T.tags_of(F.lit(template)).alias("tag"), F.array(*(F.regexp_extract("content", rx, k) for k in (1, 2, 3))).alias("value"))
    out = logs(spark, d).select("line_id", F.explode(values).alias("x")).select("line_id", "x.tag", "x.value")
    return out.withColumn("field", T.category_field("tag", "ecs_10"))


@query(f"WITH {LOGS}, o AS (SELECT parsed AS template, min(seq) AS seq FROM logs WHERE seq < 50 GROUP BY 1), n AS (SELECT gt AS template, min(seq) AS seq FROM logs GROUP BY 1) SELECT * FROM o UNION ALL SELECT * FROM n WHERE template NOT IN (SELECT template FROM o)")
def cache_merge(spark, d):
    """Cached templates, and new ones that they lack."""
    old = logs(spark, d).where("seq < 50").groupBy(F.col("parsed").alias("template")).agg(F.min("seq").alias("seq"))
    new = logs(spark, d).select(F.col("gt").alias("template"), "seq")
    return align.merge_new(old, new, ["template"])


@query(f"WITH {LOGS} SELECT replace(replace(replace(p, '<LOI>', '%{{IP:source.ip}}'), '<NUM>', '%{{NUMBER:event.duration}}'), '<*>', '%{{GREEDYDATA:custom_field}}') AS pattern, min(seq) AS seq FROM (SELECT concat('\\[user <LOI>\\] ', ds, '\\? ', CASE WHEN seq % 2 = 0 THEN '<NUM>' ELSE '<*>' END) AS p, seq FROM logs) GROUP BY 1")
def grok_patterns(spark, d):
    """Distinct ingest patterns of templates, by where each was first seen."""
    t = F.concat(F.lit("[user <LOI>] "), F.col("ds"), F.lit("? "), F.when(F.col("seq") % 2 == 0, "<NUM>").otherwise("<*>"))
    return grok.patterns(logs(spark, d).select(t.alias("parsed_template"), "seq"))


@query(f"WITH {LOGS} SELECT line_id, CAST(sum(1) OVER w AS BIGINT) AS total_volume, CAST(sum((seq % 10 = 0)::INT) OVER w AS BIGINT) AS total_llm FROM logs WINDOW w AS (PARTITION BY ds ORDER BY seq)")
def cumulative_history(spark, d):
    """Running counters of each dataset."""
    rows = logs(spark, d).withColumns({"volume": F.lit(1), "llm": (F.col("seq") % 10 == 0).cast("int")})
    return align.history(rows, "ds", "seq", ["volume", "llm"]).select("line_id", "total_volume", "total_llm")


@query(f"WITH {LOGS} SELECT sha256(regexp_replace(regexp_replace(regexp_replace(content, '\\d', '', 'g'), '[/:,._-]+', '', 'g'), '\\s', '', 'g')) AS h, count(*) AS n, min(seq) AS first FROM logs GROUP BY 1")
def hash_fast_path(spark, d):
    """Messages by the hash of what is constant in them."""
    return logs(spark, d).groupBy(T.standard_hash("content").alias("h")).agg(F.count("*").alias("n"), F.min("seq").alias("first"))


@query(f"""WITH {LOGS} SELECT line_id, substr(md5(gt), 1, 8) AS event_id, CAST(len(string_split(gt, ' ')) AS INT) AS n_tokens, CAST(levenshtein(gt, content) AS INT) AS distance, round(1 - levenshtein(gt, content) * 1e0 / greatest(len(gt), len(content)), 9) AS near,
 replace(gt, '<*>', '(.*?)') AS rx, CASE WHEN seq >= 3600 THEN concat(seq // 3600, 'h ', (seq % 3600) // 60, 'm ', printf('%.1f', seq % 60), 's') WHEN seq >= 60 THEN concat(seq // 60, 'm ', printf('%.1f', seq % 60), 's') ELSE concat(printf('%.1f', seq * 1e0), 's') END AS took FROM (SELECT *, seq * 1e0 AS s FROM logs)""".replace("printf('%.1f', seq % 60)", "printf('%.1f', (seq % 60) * 1e0)"))
def scalar_functions(spark, d):
    """Scalar expressions on the logs."""
    rx = F.regexp_replace(T.template_to_regex("gt"), r"^\^|\$$", "")
    return logs(spark, d).select("line_id", T.event_id("gt").alias("event_id"), F.size(T.space_tokens("gt")).alias("n_tokens"), F.levenshtein("gt", "content").alias("distance"), F.round(T.edit_similarity(F.col("gt"), F.col("content")), 9).alias("near"), rx.alias("rx"), T.duration("seq").alias("took"))


@query(f"WITH {LOGS}, x AS (SELECT gt AS t FROM logs UNION ALL SELECT parsed FROM logs WHERE seq % 2 = 0), y AS (SELECT parsed AS t FROM logs UNION ALL SELECT gt FROM logs WHERE seq % 3 = 0) SELECT t, count(*) AS n FROM (SELECT * FROM x EXCEPT ALL SELECT * FROM y) GROUP BY t")
def bag_difference(spark, d):
    """A multiset of templates without another."""
    b = logs(spark, d)
    x = b.select(F.col("gt").alias("t")).unionAll(b.where("seq % 2 = 0").select("parsed"))
    y = b.select(F.col("parsed").alias("t")).unionAll(b.where("seq % 3 = 0").select("gt"))
    return align.subtract_bag(x, y).groupBy("t").agg(F.count("*").alias("n"))


@query(f"""WITH {LOGS}, v AS (SELECT seq, regexp_extract(content, '^user (.*?) did', 1) AS a, regexp_extract(content, 'did (.*?) value', 1) || ' ' || regexp_extract(content, 'value (.*?)$', 1) AS b FROM logs),
u AS (SELECT b AS value, min(seq) AS seq FROM v GROUP BY b) SELECT value, seq FROM u ORDER BY seq DESC LIMIT 100""")
def historical_variables(spark, d):
    """The last hundred values that templates' wildcards stood for, plain numbers left out."""
    rows = logs(spark, d).select(F.col("content").alias("message"), F.lit("user <*> did <*>").alias("template"), "seq")
    value = F.regexp_replace("value", " value ", " ")
    return memory.variable_candidates(rows).select(value.alias("value"), F.col("first._o").alias("seq"))


def _lines(spark: SparkSession, d: str, *more: Column) -> DataFrame:
    return logs(spark, d).select(F.col("line_id").alias("id"), F.col("content").alias("message"), "seq", *more)


@query(f"WITH {LOGS}, m AS (SELECT {MASKED.format('content')} AS template, content, seq FROM logs) SELECT template, 'new' AS tier, count(*) AS n FROM m GROUP BY 1")
def route_method(spark, d):
    """Dictionary routing from an empty dictionary: templates, how they came, rows. In one batch all that is new comes from the source."""
    done = pipelines.route(_lines(spark, d), spark.createDataFrame([], pipelines.DICTIONARY))
    return done.rows.groupBy("template", "tier").agg(F.count("*").alias("n"))


_BATCHED = """WITH RECURSIVE {logs}, t AS (SELECT content AS message, min(seq) AS seq FROM logs GROUP BY 1), f AS (SELECT seq // 10000 AS batch, {masked} AS masked, min(seq) AS id, count(*) AS n FROM (SELECT message AS content, seq FROM t) GROUP BY ALL),
w AS (SELECT *, list_distinct(string_split(lower(masked), ' ')) AS s FROM f),
e AS (SELECT a.id AS a, b.id AS b FROM w a JOIN w b ON a.batch = b.batch AND a.id <> b.id AND 1 - len(list_intersect(a.s, b.s)) * 1e0 / len(list_distinct(list_concat(a.s, b.s))) <= 0.2e0 + 1e-12),
r(a, b) AS (SELECT id, id FROM f UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), c AS (SELECT a AS id, min(b) AS cluster, count(*) AS k FROM r GROUP BY a)
SELECT f.masked AS template, CASE WHEN c.k > 1 OR f.n > 1 THEN 'cluster' ELSE 'masked' END AS tier, count(*) AS n
FROM logs JOIN t ON t.message = logs.content JOIN f ON f.batch = t.seq // 10000 AND f.masked = {masked} JOIN c ON c.id = f.id GROUP BY ALL""".format(logs=LOGS, masked=MASKED.format("content"))


@query(_BATCHED)
def batch_method(spark, d):
    """Micro-batched clustering: templates, how they came, rows. Forms of one event differ in no word, so a cluster's template is its form."""
    s = BatchSettings(buffer_size=10_000, clusterer="SimilarityCluster")
    return pipelines.cluster_batches(_lines(spark, d), s).rows.groupBy("template", "tier").agg(F.count("*").alias("n"))


@query(f"WITH {LOGS}, m AS (SELECT ds AS dataset, {MASKED.format('content')} AS template FROM logs) SELECT dataset, template, 'group' AS tier, count(*) AS n FROM m GROUP BY ALL")
def tree_method(spark, d):
    """Tree grouping with regex memory: templates, how they came, rows. Each dataset's messages are one group, taken by one regex."""
    return pipelines.tree_groups(_lines(spark, d, F.col("ds").alias("dataset"))).rows.groupBy("dataset", "template", "tier").agg(F.count("*").alias("n"))


@query()
def streaming_microbatch(spark, d):
    """The routing method as a stream over the events, until all are read: rows of each template."""
    from lograil.streaming.microbatch import parse_stream

    place = new_path(spark, "stream")
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/events.parquet*")
    content: Column = F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" did "), F.col("event_type"))
    lines = stream.select(F.concat(F.col("event_type"), F.lit("_"), F.col("event_id").cast("string")).alias("id"), content.alias("message"), F.col("event_id").alias("seq"))
    parse_stream(lines, f"{place}/dictionary", f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{place}/out").groupBy("template").agg(F.count("*").alias("n"))
