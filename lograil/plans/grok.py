"""Templates as ingest pipelines."""

from __future__ import annotations

import copy
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograil.functions import text as T
from lograil.operators.align import first_seen


def patterns(parsed: DataFrame, template: str = "parsed_template", order: str = "seq") -> DataFrame:
    """pattern, seq: the distinct patterns of the templates, by where each was first seen."""
    some = parsed.where(F.length(template) > 0).select(T.grok_pattern(template).alias("pattern"), order)
    return first_seen(some, "pattern", order)


def pipeline(parsed: DataFrame, name: str, template: str = "parsed_template", order: str = "seq") -> dict:
    """The pipeline's definition. Templates are a bounded dictionary."""
    found = [r["pattern"] for r in patterns(parsed, template, order).collect()]
    failed = [{"append": {"field": "tags", "value": ["_llm_grok_parse_failure"]}}]
    return {"description": f"Custom LLM-compiled Grok ingest pipeline '{name}'", "processors": [{"grok": {"field": "message", "patterns": found, "ignore_missing": True, "on_failure": failed}}]}


def changed(new: dict, deployed: dict | None) -> bool:
    """Whether a pipeline's processors differ from those in use."""
    return deployed is None or new.get("processors") != deployed.get("processors")


def routes_to(body: dict, target: str) -> bool:
    return any(isinstance(p, dict) and p.get("pipeline", {}).get("name") == target for p in body.get("processors", []))


def _with(body: dict, processors: list) -> dict:
    out = {k: v for k, v in copy.deepcopy(body).items() if k != "version"}
    out["processors"] = processors
    return out


def wire(body: dict, target: str, condition: str) -> tuple[dict, bool]:
    """The pipeline with a processor that routes to `target`, and whether it is new."""
    if routes_to(body, target):
        return body, False
    step = {"name": target, "if": condition, "ignore_missing_pipeline": True, "description": f"Route logs the standard pipeline left unmapped through {target}"}
    return _with(body, [*copy.deepcopy(body.get("processors", [])), {"pipeline": step}]), True


def unwire(body: dict, target: str) -> tuple[dict, bool]:
    """The pipeline without what routes to `target`, and whether there was any."""
    if not routes_to(body, target):
        return body, False
    return _with(body, [p for p in copy.deepcopy(body["processors"]) if not routes_to({"processors": [p]}, target)]), True


# What the pattern names of the compiler match.
_NAMES = {"IP": r"[0-9A-Fa-f:.]+", "TIMESTAMP_ISO8601": r"\d{4}-\d{2}-\d{2}[T ]\d{2}:?\d{2}(?::?\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?", "NOTSPACE": r"\S+", "NUMBER": r"[+-]?\d+(?:\.\d+)?", "WORD": r"\b\w+\b", "GREEDYDATA": r".*"}


def simulate(body: dict, message: str) -> dict | None:
    """What the first pattern that matches takes from a message, without a server; None if none does."""
    for p in body["processors"][0]["grok"]["patterns"]:
        names: list[str] = []

        def group(m, names=names):
            names.append(m[2])
            return f"({_NAMES[m[1]]})"

        found = re.search(re.sub(r"%\{(\w+):([\w.]+)\}", group, p), message)
        if found:
            return dict(zip(names, found.groups(), strict=True))
    return None
