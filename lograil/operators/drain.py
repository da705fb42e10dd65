"""Grouping of logs by a parse tree of fixed depth.

The tree's first level is the number of tokens and datasets have trees of their own, so (dataset, number of tokens) are independent: Spark
groups by both and each group grows its tree in the logs' order, which decides the templates. Logs enter distinct, by the place of their
first copy: a copy finds the cluster of the first one, and leaves its template as it is.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograil.functions import text as T
from lograil.shipping import ensure_shipped

WILD = T.WILD


class Tree:
    """Clusters of token lists of one length."""

    def __init__(self, depth: int = 4, similarity: float = 0.5, most_children: int = 100):
        self.levels, self.similarity, self.most = depth - 2, similarity, most_children
        self.root: dict = {}
        self.clusters: list[list[str]] = []

    def _leaf(self, tokens: list[str]) -> list[int] | None:
        at = self.root
        for token in tokens[: self.levels]:
            at = at.get(token) or at.get(WILD)
            if at is None:
                return None
        return at.get(None)

    def _grow(self, tokens: list[str]) -> list[int]:
        at = self.root
        for token in tokens[: self.levels]:
            if token not in at:
                wild = WILD in at
                full = len(at) + (not wild) >= self.most
                token = WILD if any(c.isdigit() for c in token) or full else token
            at = at.setdefault(token, {})
        return at.setdefault(None, [])

    def add(self, tokens: list[str]) -> int:
        """The number of the cluster that takes the tokens."""
        best, top = None, (-1.0, -1)
        for k in (self._leaf(tokens) or ()) if tokens else ():
            fixed = [(a, b) for a, b in zip(self.clusters[k], tokens, strict=True) if a != WILD]
            score = (sum(a == b for a, b in fixed) / len(tokens), len(tokens) - len(fixed))
            if score > top:
                best, top = k, score
        if best is not None and top[0] >= self.similarity:
            self.clusters[best] = [a if a == b else WILD for a, b in zip(self.clusters[best], tokens, strict=True)]
            return best
        self.clusters.append(list(tokens))
        if len(tokens) > self.levels:  # shorter ones never come to a leaf: each is a cluster of its own
            self._grow(tokens).append(len(self.clusters) - 1)
        return len(self.clusters) - 1


def tree_groups(logs: DataFrame, dataset: str = "dataset", message: str = "message", seq: str = "seq", settings: dict[str, tuple[float, int]] | None = None, mask: Column | None = None) -> DataFrame:
    """logs with event_id and event_template. settings: (similarity, depth) by dataset, with `default` for the others."""
    known = settings or T.DATASET_TREES
    masked = T.word_tokens(T.dataset_mask(message, dataset) if mask is None else mask)
    distinct = logs.withColumn("_tok", masked).groupBy(dataset, "_tok").agg(F.min(seq).alias("_first")).withColumn("_n", F.size("_tok"))

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        similarity, depth = known.get(key[0], known["default"])
        tree = Tree(depth, similarity)
        rows = rows.sort_values("_first")
        at = [tree.add(list(t)) for t in rows["_tok"]]
        return pd.DataFrame({dataset: rows[dataset], "_tok": rows["_tok"], "event_template": [" ".join(tree.clusters[k]) for k in at]})

    ensure_shipped(logs.sparkSession)
    kind = logs.schema[dataset].dataType.simpleString()
    grown = distinct.groupBy(dataset, "_n").applyInPandas(grow, f"`{dataset}` {kind}, _tok array<string>, event_template string")
    out = logs.withColumn("_tok", masked).join(grown, [dataset, "_tok"])
    return out.drop("_tok").withColumn("event_id", T.event_id("event_template"))


def parameters(template: Column, message: Column) -> Column:
    """What the message has in the places of the template's wildcards; none if it doesn't match."""

    ensure_shipped()

    @F.pandas_udf("array<string>")
    def find(templates: pd.Series, messages: pd.Series) -> pd.Series:
        return pd.Series([parameters_of(t, m) for t, m in zip(templates, messages, strict=True)])

    return find(template, message)


def parameters_of(template: str | None, message: str | None) -> list[str]:
    if not template or message is None or WILD not in template:
        return []
    pattern = re.sub(r"\\ +", r"\\s+", re.escape(template)).replace(r"<\*>", "(.*?)")
    found = re.match(f"^{pattern}$", message)
    return list(found.groups()) if found else []
