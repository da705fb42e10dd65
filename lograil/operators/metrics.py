"""Quality metrics of parsed logs, each a grouped aggregate over aligned rows.

An aligned frame has the grouping columns, `gt` and `parsed` (templates), and for the silhouette `content`. All segments are grouped at
once: there is no loop over segments, and rows shrink to distinct (gt, parsed) pairs with counts before anything dear is computed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lograil.functions import text as T
from lograil.storage import materialize

#: Templates that go to every task.
MOST_TEMPLATES = 20_000


def _by(keys: list[str], *more: str) -> list[str]:
    return [*keys, *more]


def with_overall(rows: DataFrame, dataset_col: str, segment_col: str = "segment") -> DataFrame:
    """Each row in its dataset's segment and in `Overall`."""
    return rows.withColumn(segment_col, F.explode(F.array(F.lit("Overall"), F.col(dataset_col))))


def at_level(rows: DataFrame, level: str) -> DataFrame:
    return rows.withColumns({"gt": T.at_level("gt", level), "parsed": T.at_level("parsed", level)})


def pair_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, gt, parsed, n: what all metrics but the silhouette are made of."""
    return rows.where(F.col("gt").isNotNull()).groupBy(*_by(keys, "gt", "parsed")).agg(F.count("*").alias("n"))


def _choose(pairs: DataFrame, templates: DataFrame | None) -> DataFrame:
    """Only rows whose truth is among `templates` (one column, gt)."""
    return pairs if templates is None else pairs.join(templates, "gt", "left_semi")


def grouping(pairs: DataFrame, keys: list[str], templates: DataFrame | None = None) -> DataFrame:
    """ga and fga: a true group is right if one parsed template has all its rows and no other rows.

    With `templates` only those true groups count; parsed templates are those that touch them, with all of their rows.
    """
    per_gt = pairs.groupBy(*_by(keys, "gt")).agg(F.sum("n").alias("size"), F.count("*").alias("kinds"), F.min("parsed").alias("parsed"))
    per_parsed = pairs.groupBy(*_by(keys, "parsed")).agg(F.sum("n").alias("total"))
    per_gt = _choose(per_gt, templates)
    right = per_gt.join(per_parsed, _by(keys, "parsed"), "left").withColumn("ok", (F.col("kinds") == 1) & (F.col("size") == F.col("total")))
    gts = right.groupBy(*keys).agg(F.sum(F.when(F.col("ok"), F.col("size")).otherwise(0)).alias("ok_rows"), F.sum("size").alias("rows"), F.sum(F.col("ok").cast("int")).alias("ok"), F.count("*").alias("n_gt"))
    parsed = _choose(pairs, templates).groupBy(*keys).agg(F.count_distinct("parsed").alias("n_parsed"))
    both = gts.join(parsed, keys) if keys else gts.crossJoin(parsed)  # one row each
    ga = F.when(F.col("rows") == 0, 0.0).otherwise(F.col("ok_rows") / F.col("rows"))
    fga = T.rate(2 * F.col("ok"), F.col("n_gt") + F.col("n_parsed"))
    return both.select(*keys, F.coalesce(ga, F.lit(0.0)).alias("ga"), fga.alias("fga"))


def accuracy(pairs: DataFrame, keys: list[str], templates: DataFrame | None = None) -> DataFrame:
    """pa: the share of rows whose parsed template is the true one."""
    same = F.sum(F.when(F.col("gt") == F.col("parsed"), F.col("n")).otherwise(0))
    return _choose(pairs, templates).groupBy(*keys).agg(T.rate(same, F.sum("n")).alias("pa"))


def template_f1(pairs: DataFrame, keys: list[str], templates: DataFrame | None = None) -> DataFrame:
    """fta: F1 of the set of parsed templates against the set of true ones."""
    pairs = _choose(pairs, templates)
    sides = pairs.select(*keys, F.col("gt").alias("t"), F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(pairs.select(*keys, F.col("parsed").alias("t"), F.lit(0).alias("g"), F.lit(1).alias("p")))
    sets = sides.groupBy(*_by(keys, "t")).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    return sets.groupBy(*keys).agg(T.rate(2 * F.sum(F.col("g") * F.col("p")), F.sum("g") + F.sum("p")).alias("fta"))


def edit_distance(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """ed and ned: mean edit distance of the templates, and mean of 1 - distance / the longer length; once for each distinct pair."""
    d = F.when(F.col("gt") == F.col("parsed"), 0).otherwise(F.levenshtein("gt", "parsed"))
    near = T.edit_similarity(F.col("gt"), F.col("parsed"))
    return pairs.groupBy(*keys).agg(T.rate(F.sum(d * F.col("n")), F.sum("n")).alias("ed"), T.rate(F.sum(near * F.col("n")), F.sum("n")).alias("ned"))


def granularity(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """ggd: |parsed templates - true ones| / true ones. pgd: how many tokens a parsed template and its most frequent truth (the smallest
    of equals) differ by, on average over parsed templates."""
    ggd = pairs.groupBy(*keys).agg(F.count_distinct("gt").alias("ng"), F.count_distinct("parsed").alias("np"))
    top = pairs.groupBy(*_by(keys, "parsed")).agg(F.min_by("gt", F.struct(F.negative("n"), "gt")).alias("gt"))
    apart = F.abs(F.size(T.word_tokens("gt")) - F.size(T.word_tokens("parsed")))
    pgd = top.groupBy(*keys).agg(F.avg(apart).alias("pgd"))
    both = ggd.join(pgd, keys) if keys else ggd.crossJoin(pgd)
    return both.select(*keys, T.rate(F.abs(F.col("np") - F.col("ng")), F.col("ng")).alias("ggd"), "pgd")


def silhouette(rows: DataFrame, keys: list[str]) -> DataFrame:
    """pmss: mean of (b - a) / max(a, b), a the edit dissimilarity of a content to its template and b that to the nearest other template.

    Contents are made distinct first. Each meets its group's templates, a dictionary of checked size that goes to all tasks in the order of
    their lengths; a template whose length alone puts it no nearer than the nearest so far is not compared. A larger dictionary is joined by
    group. A segment with one row or one template has 0. Two equal distances of 0 count as 0.
    """
    seen = rows.groupBy(*_by(keys, "content", "parsed")).agg(F.count("*").alias("n"))
    templates = seen.select(*keys, "parsed").distinct()
    length = F.length("content")
    longest = lambda t: F.greatest(length, F.length(t), F.lit(1))
    far = lambda t: F.levenshtein("content", t) / longest(t)
    if templates.limit(MOST_TEMPLATES + 1).count() <= MOST_TEMPLATES:
        sized = F.transform(F.array_sort(F.collect_set(F.struct(F.length("parsed").alias("k"), "parsed"))), lambda x: x["parsed"])
        lists = templates.groupBy(*keys).agg(sized.alias("others"))
        met = seen.join(F.broadcast(lists), keys) if keys else seen.join(F.broadcast(lists), F.lit(True))  # one row
        none = (lambda acc, t: (t == F.col("parsed")) | (F.abs(length - F.length(t)) / longest(t) >= acc))
        nearest = F.aggregate("others", F.lit(2.0), lambda acc, t: F.when(none(acc, t), acc).otherwise(F.least(acc, far(t))))
        per = met.where(F.size("others") > 1).select(*_by(keys, "n"), far("parsed").alias("a"), nearest.alias("b"))
    else:
        other = templates.withColumnRenamed("parsed", "other")
        pairs = (seen.join(other, keys) if keys else seen.join(other, F.lit(True))).where(F.col("other") != F.col("parsed"))
        per = pairs.groupBy(*_by(keys, "content", "parsed", "n")).agg(F.min(far("other")).alias("b")).withColumn("a", far("parsed"))
    score = F.when(F.greatest("a", "b") == 0, 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    scored = per.groupBy(*keys).agg(F.sum(score * F.col("n")).alias("s"), F.sum("n").alias("m"))
    sizes = seen.groupBy(*keys).agg(F.sum("n").alias("rows"))
    both = sizes.join(scored, keys, "left") if keys else sizes.crossJoin(scored)
    return both.select(*keys, F.when(F.col("rows") <= 1, 0.0).otherwise(F.coalesce(F.col("s") / F.col("m"), F.lit(0.0))).alias("pmss"))


def rejoined(rows: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """keys, gt, parsed of aligned rows whose truth meets the parsed side by id once more: k rows of one id become k * k."""
    on = _by(keys, id_col)
    return rows.select(*on, "gt").join(rows.select(*on, "parsed"), on).select(*keys, "gt", "parsed")


def bundle(rows: DataFrame, keys: list[str], with_silhouette: bool = True, dataset: str | None = None) -> DataFrame:
    """All metrics of each group on the level `spaced`, and pa and fta on all four levels (pa_raw, fta_raw, ...).

    The rows are grouped once, as they came; levels are made of the distinct pairs. With `dataset` groups are that column's segments and
    `Overall` (`segment`), which doubles the pairs and not the rows.
    """
    raw = pair_counts(rows, [dataset] if dataset else keys)
    if dataset:
        keys = ["segment"]
        raw = with_overall(raw, dataset).groupBy("segment", "gt", "parsed").agg(F.sum("n").alias("n"))
    raw = materialize(raw, "pairs")
    levels = F.array(*(F.struct(F.lit(lv).alias("level"), T.at_level("gt", lv).alias("gt"), T.at_level("parsed", lv).alias("parsed")) for lv in T.LEVELS))
    every = raw.select(*keys, "n", F.explode(levels).alias("x")).select(*keys, "n", "x.*").groupBy(*_by(keys, "level", "gt", "parsed")).agg(F.sum("n").alias("n"))
    every = materialize(every, "levels")
    spaced = every.where("level = 'spaced'").drop("level")
    rates = accuracy(every, _by(keys, "level")).join(template_f1(every, _by(keys, "level")), _by(keys, "level"))
    at = lambda c, lv: F.max(F.when(F.col("level") == lv, F.col(c)))
    named = [at(c, lv).alias(f"{c}_{lv}") for lv in T.LEVELS for c in ("pa", "fta")]
    by_level = rates.groupBy(*keys).agg(at("pa", "spaced").alias("pa"), at("fta", "spaced").alias("fta"), *named)
    parts = [grouping(spaced, keys), by_level, edit_distance(spaced, keys), granularity(spaced, keys)]
    if with_silhouette:
        of = with_overall(rows, dataset) if dataset else rows
        parts.append(silhouette(at_level(of, "spaced"), keys))
    out = reduce(lambda a, b: a.join(b, keys, "left") if keys else a.crossJoin(b), parts)
    if not with_silhouette:
        out = out.withColumn("pmss", F.lit(0.0))
    return out.na.fill(0.0)


def tidy(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, value) of a wide frame of metrics."""
    names = [c for c in metrics.columns if c not in keys]
    return metrics.select(*keys, F.explode(F.create_map(*(x for c in names for x in (F.lit(c), F.col(c).cast("double"))))).alias("metric", "value"))


def spearman(rows: DataFrame, x: str, y: str) -> DataFrame:
    """rho: rank correlation of two columns, ties by mean rank; 0 if it is undefined or there are fewer than two rows.

    The rows are those of a report: one for each parser and segment.
    """
    mean_rank = lambda c: F.rank().over(Window.orderBy(c)) + (F.count("*").over(Window.partitionBy(c)) - 1) / 2
    ranked = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(mean_rank(x).alias("rx"), mean_rank(y).alias("ry"))
    rho = F.corr("rx", "ry")
    return ranked.agg(F.when(rho.isNull() | F.isnan(rho) | (F.count("*") < 2), 0.0).otherwise(rho).alias("rho"))


def spearman_matrix(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, rho) of each pair of columns."""
    parts = [spearman(rows, a, b).select(F.lit(a).alias("x"), F.lit(b).alias("y"), "rho") for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return reduce(DataFrame.unionByName, parts)


def token_overlap(a: Column, b: Column) -> Column:
    """Shared tokens of two templates by all tokens of either."""
    return T.jaccard(T.word_tokens(a), T.word_tokens(b), 0.0)


def profile_rates(profile: DataFrame) -> DataFrame:
    """A profile with cache_hit_rate, throughput and failure_rate; counts that are missing come from the last entry of its history."""
    last = F.try_element_at("history", F.lit(-1))
    filled = profile.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit(0)), last[c], F.lit(0)) for c in ("log_volume", "llm_invocations", "cache_hits")})
    failed = F.coalesce("llm_timeouts", F.lit(0)) + F.coalesce("failed_invocations", F.lit(0))
    return filled.withColumns(
        {
            "cache_hit_rate": T.rate(F.col("cache_hits"), F.col("log_volume")),
            "throughput": T.rate(F.col("log_volume"), F.col("time_taken_seconds")),
            "failure_rate": T.rate(failed, F.col("llm_invocations") + failed),
            "model_used": F.coalesce("model_used", F.lit("unknown-model")),
            "method_used": F.coalesce("method_used", F.lit("unknown-method")),
        }
    )
