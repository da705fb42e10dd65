"""Merging of templates that are variants of one."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograil.functions import text as T
from lograil.shipping import ensure_shipped

WILD = T.WILD


def _variable(t: str) -> bool:
    return t.startswith("<") and t.endswith(">")


def structural_similarity(a: list[str], b: list[str]) -> float:
    if len(a) != len(b) or not a:
        return 0.0
    return sum(x == y or _variable(x) and _variable(y) for x, y in zip(a, b, strict=True)) / len(a)


def combine(a: list[str], b: list[str]) -> list[str]:
    return [x if x == y else WILD for x, y in zip(a, b, strict=True)]


def merge_pair(a: str, b: str, threshold: float = 0.95) -> str | None:
    """Two templates as one, if they are alike enough."""
    x, y = a.split(" "), b.split(" ")
    return " ".join(combine(x, y)) if structural_similarity(x, y) >= threshold else None


def merge_greedily(templates: list[str], threshold: float = 0.95) -> list[tuple[str, str]]:
    """(template, merged): in order, each template takes in the later ones that are alike to what it has become."""
    tokens, out, left = {t: t.split(" ") for t in templates}, {}, list(dict.fromkeys(templates))
    while left:
        head, *rest = left
        merged, taken, left = tokens[head], [head], []
        for t in rest:
            if structural_similarity(merged, tokens[t]) >= threshold:
                merged = combine(merged, tokens[t])
                taken.append(t)
            else:
                left.append(t)
        out.update((t, " ".join(merged)) for t in taken)
    return [(t, out[t]) for t in dict.fromkeys(templates)]


def calibrate(templates: DataFrame, threshold: float = 0.95) -> DataFrame:
    """template, seq, merged. templates: template, seq. Lengths never mix, so each number of tokens is a group of its own."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seq")
        merged = dict(merge_greedily(rows["template"].tolist(), threshold))
        return pd.DataFrame({"template": rows["template"], "seq": rows["seq"], "merged": rows["template"].map(merged)})

    ensure_shipped(templates.sparkSession)
    sized = templates.select("template", F.col("seq").cast("long").alias("seq"), F.size(T.space_tokens("template")).alias("_n"))
    return sized.groupBy("_n").applyInPandas(run, "template string, seq long, merged string")


def similar_pairs(templates: DataFrame, threshold: float = 0.95) -> DataFrame:
    """a, b, similarity, merged of the pairs (a before b) of one length that are alike enough."""
    t = templates.select("template", "seq", T.space_tokens("template").alias("tok")).withColumn("_n", F.size("tok"))
    both = t.alias("x").join(t.alias("y"), F.col("x._n") == F.col("y._n")).where(F.col("x.seq") < F.col("y.seq"))
    scored = both.withColumn("similarity", T.structural(F.col("x.tok"), F.col("y.tok"))).where(F.col("similarity") >= threshold)
    return scored.select(F.col("x.template").alias("a"), F.col("y.template").alias("b"), "similarity", F.array_join(T.merge_tokens(F.col("x.tok"), F.col("y.tok")), " ").alias("merged"))


def merge_candidates(templates: DataFrame, least: float = 0.3) -> DataFrame:
    """a, b, similarity: the pairs that share enough words to be worth a question, found through their words."""
    t = templates.select("template", "seq", F.array_distinct(T.space_tokens("template")).alias("tok"))
    words = t.select("template", "seq", F.size("tok").alias("n"), F.explode("tok").alias("w"))
    both = words.alias("x").join(words.alias("y"), F.col("x.w") == F.col("y.w")).where(F.col("x.seq") < F.col("y.seq"))
    shared = both.groupBy(F.col("x.template").alias("a"), F.col("y.template").alias("b"), F.col("x.seq").alias("sa"), F.col("y.seq").alias("sb"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).agg(F.count("*").alias("c"))
    scored = shared.withColumn("similarity", F.col("c") / (F.col("na") + F.col("nb") - F.col("c"))).where(F.col("similarity") >= least)
    return scored.select("a", "b", "sa", "sb", "similarity")


def calibrate_by_source(templates: DataFrame, source, least: float = 0.3) -> DataFrame:
    """template, merged: pairs worth a question go to a template source, in order; a template merges once.

    The dictionary is bounded (1000 templates by default), and so are the questions.
    """
    merged: dict[str, str] = {}
    for r in merge_candidates(templates, least).orderBy("sa", "sb").collect():
        if r["a"] not in merged and r["b"] not in merged and source.same_event(r["a"], r["b"]):
            merged[r["a"]] = merged[r["b"]] = source.unify(r["a"], r["b"])
    rows = list(merged.items()) or [("", "")]
    known = templates.sparkSession.createDataFrame(rows, "template string, _m string")
    return templates.join(F.broadcast(known), "template", "left").withColumn("merged", F.coalesce("_m", "template")).drop("_m")
