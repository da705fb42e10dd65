"""Memories of templates: how they grow, match and forget."""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lograil.functions import imperative as I
from lograil.functions import text as T
from lograil.shipping import ensure_shipped

WILD = T.WILD


class RecentCache:
    """Templates with a reference log and a frequency; the least recently used one goes when there are too many."""

    def __init__(self, most: int = 5000):
        self.most = most
        self._of: OrderedDict[str, dict] = OrderedDict()

    def add(self, template: str, ref_log: str) -> None:
        if template in self._of:
            self._of[template]["frequency"] += 1
            self._of.move_to_end(template)
            return
        while len(self._of) >= self.most:
            self._of.popitem(last=False)
        self._of[template] = {"ref_log": ref_log, "frequency": 1}

    def entries(self) -> list[dict]:
        """Most recently used first."""
        return [{"template": t, **e} for t, e in reversed(self._of.items())]

    def load(self, entries: list[dict]) -> None:
        """Entries as `entries` gives them."""
        self._of = OrderedDict((e["template"], {"ref_log": e["ref_log"], "frequency": e.get("frequency", 1)}) for e in reversed(entries))

    def match(self, message: str) -> str | None:
        """The most recently used template of as many words that matches; it counts as used."""
        n = len(message.split())
        for t in reversed(self._of):
            if len(t.split()) == n and I.safe_match(regex_of(t), message):
                self.add(t, message)
                return t
        return None


def regex_of(template: str) -> str:
    """The regex that `functions.text.template_to_regex` makes, for a single template."""
    import re

    one = re.sub(r"<\*>\s*(?:<\*>\s*)+", "<*> ", template)
    one = re.sub(r"<\*>(?:\s*[^\w\s<]{1,3}\s*<\*>)+", WILD, one).strip()
    return "^" + re.escape(one).replace(r"<\*>", "(.*?)") + "$"


@dataclass
class RegexMemory:
    """Regexes of whole messages, by words: the longest first, then in the order in which they came."""

    known: list[tuple[int, str]] = field(default_factory=list)
    _seen: set[str] = field(default_factory=set)

    def add(self, regex: str, message: str) -> bool:
        """Whether the regex came in: it must say something, be new, and match the whole message."""
        bare = "".join(c for c in regex if c not in I.string.punctuation + " ")
        if len(bare) < 3 or regex in self._seen or not I.safe_match(f"(?:{regex})\\Z", message):
            return False
        self._seen.add(regex)
        wc = regex.count(" ") + 1
        at = next((k for k, (w, _) in enumerate(self.known) if w < wc), len(self.known))
        self.known.insert(at, (wc, regex))
        return True

    @classmethod
    def of(cls, regexes: list[str]) -> RegexMemory:
        """Admitted regexes, in their order."""
        known = sorted(((r.count(" ") + 1, r) for r in dict.fromkeys(regexes)), key=lambda e: -e[0])
        return cls(known, set(regexes))

    def find(self, message: str) -> str | None:
        n = message.count(" ") + 1
        for wc, regex in self.known:
            if wc in (n, n + 1) and I.safe_match(f"(?:{regex})\\Z", message):
                return regex
        return None


class HashedTree:
    """Templates by punctuation-aware tokens, where a wildcard may stand for several tokens; answers are kept by the hash of what is constant."""

    def __init__(self):
        self.templates: list[str] = []
        self._tree: dict = {}
        self._answers: dict[str, tuple[str, int]] = {}

    @staticmethod
    def _standard(text: str) -> str:
        import re

        for p in (r"/([^/]*)(?=/)", r"\d", r"[/:,._-]+", r"\s"):
            text = re.sub(p, "", text)
        return text

    def insert(self, template: str, ref_log: str = "") -> int:
        """The template's number; -1 for one that holds nothing but a wildcard."""
        tokens = I.punctuation_tokens(template)
        if not tokens or template == WILD:
            return -1
        self.templates.append(template)
        self._place(template, tokens, len(self.templates) - 1, ref_log)
        return len(self.templates) - 1

    def _place(self, template: str, tokens: list[str], number: int, ref_log: str) -> None:
        self._answers[self._standard(template)] = (template, number)
        at = self._tree
        for t in tokens:
            at = at.setdefault(t, {})
        fixed = sum(t != WILD for t in tokens)
        at[None] = (-fixed, len(tokens) - fixed, template, number, ref_log)

    def add(self, template: str, relevant: list[str], ref_log: str = "") -> int:
        """Merges with the most alike of the relevant templates of equal length if more than 0.8 alike, else inserts."""
        words = template.split()
        alike = [(I.lcs_similarity(r.split(), words), -k, r) for k, r in enumerate(relevant) if len(r.split()) == len(words)]
        if alike and max(alike)[0] > 0.8:
            old = max(alike)[2]
            merged = " ".join(a if a == b else WILD for a, b in zip(old.split(), words, strict=True))
            number = self.delete(old)
            if number is not None:
                self._place(merged, I.punctuation_tokens(merged), number, ref_log)
                self.templates[number] = merged
                return number
        return self.insert(template, ref_log)

    def delete(self, template: str) -> int | None:
        at = self._tree
        for t in I.punctuation_tokens(template):
            at = at.get(t)
            if at is None:
                return None
        entry = at.pop(None, None)
        return entry and entry[3]

    def match(self, message: str) -> tuple[str, int] | None:
        """template and number: known by hash, or the tree's match with most constants and fewest wildcards."""
        key = self._standard(message)
        if key not in self._answers:
            found = self._walk(message)
            if found is None:
                return None
            self._answers[key] = found
        return self._answers[key]

    def _walk(self, message: str) -> tuple[str, int] | None:
        tokens, found, seen = I.punctuation_tokens(message), [], set()
        todo = [(self._tree, 0)]
        while todo:
            node, at = todo.pop()
            if (id(node), at) in seen:
                continue
            seen.add((id(node), at))
            if at == len(tokens) and None in node:
                found.append(node[None])
            if at < len(tokens) and tokens[at] in node:
                todo.append((node[tokens[at]], at + 1))
            if WILD in node:
                below = node[WILD]
                todo += [(below, k) for k in range(at, len(tokens) + 1)]
        if not found:
            return None
        best = min(found, key=lambda e: e[:2])
        return (best[2], best[3]) if abs(len(message.split()) - len(best[4].split())) <= 1 else None


def variable_candidates(logs_and_templates: DataFrame, cap: int | None = 100, message: str = "message", template: str = "template", order: str = "seq") -> DataFrame:
    """value, first: what templates' wildcards stood for, new values by their first place, the last `cap` of them.

    Plain numbers and words, values of more than three words and empty ones are no candidates; a bracket around a value goes.
    """
    ensure_shipped(logs_and_templates.sparkSession)

    @F.pandas_udf("array<string>")
    def captures(templates: pd.Series, messages: pd.Series) -> pd.Series:
        found = (I.safe_match(regex_of(t), m) if t is not None and m is not None else None for t, m in zip(templates, messages, strict=True))
        return pd.Series([list(f.groups()) if f else [] for f in found])

    values = logs_and_templates.select(F.col(order).alias("_o"), F.posexplode(captures(template, message)).alias("_p", "_v"))
    v = F.regexp_replace("_v", r"^\((.*)\)$|^\[(.*)\]$", "$1$2")
    good = (F.length("value") > 0) & ~F.col("value").rlike(r"(?U)^(\d+|\p{L}+)$") & (F.size(T.word_tokens("value")) <= 3)
    first = values.select(v.alias("value"), F.struct("_o", "_p").alias("first")).where(good).groupBy("value").agg(F.min("first").alias("first"))
    return first.orderBy(F.desc("first")).limit(cap) if cap is not None else first


def fifo(entries: DataFrame, most: int | None, order: str = "seq") -> DataFrame:
    """What a memory holds that forgets its oldest entries: the last `most` by their order, all of them without a bound."""
    return entries.orderBy(F.desc(order)).limit(most) if most is not None else entries


def admit_regexes(proposed: DataFrame, message: str = "message") -> DataFrame:
    """regex, wc, seq of the proposed regexes (regex, message, seq) that say something and match their whole message, each once."""
    ok = ~T.is_thin("regex") & F.expr(f"`{message}` rlike concat('^(?:', regex, ')$')")
    once = proposed.where(ok).groupBy("regex").agg(F.min("seq").alias("seq"))
    wc = F.size(T.space_tokens("regex"))
    return once.withColumn("wc", wc).select("regex", "wc", F.row_number().over(Window.partitionBy("wc").orderBy("seq")).alias("seq"))
