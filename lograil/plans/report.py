"""Reports of metrics: JSON, HTML and a table. What comes here is a row for each parser and segment."""

from __future__ import annotations

import html
import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def document(metrics: DataFrame, keys: tuple[str, ...] = ("parser", "segment")) -> dict:
    """{parser_segment: {metric: value}}."""
    out = {}
    for r in metrics.collect():
        row = r.asDict()
        out["_".join(str(row.pop(k)) for k in keys if k in row)] = row
    return dict(sorted(out.items()))


def models(profiles: DataFrame) -> str:
    """The distinct models in use, sorted, joined with a plus."""
    return profiles.agg(F.array_join(F.array_sort(F.collect_set("model_used")), "+").alias("m")).first()["m"]


def file_name(now: datetime) -> str:
    return now.strftime("%y%m%d_%H%M") + ".json"


def table(doc: dict, columns: list[str] | None = None, width: int = 12) -> str:
    names = columns or sorted({k for v in doc.values() for k in v})
    head = "parser".ljust(28) + "".join(n[: width - 1].rjust(width) for n in names)
    cell = lambda v: (f"{v:.4f}" if isinstance(v, float) else str(v)).rjust(width)
    return "\n".join([head, "-" * len(head), *(k[:27].ljust(28) + "".join(cell(v.get(n, "")) for n in names) for k, v in doc.items())])


def page(doc: dict, correlations: dict[str, float] | None = None, title: str = "Log parsing report") -> str:
    """One HTML file: a bar for each metric of each parser, the figures as a table, and correlations."""
    names = sorted({k for v in doc.values() for k, x in v.items() if isinstance(x, (int, float))})
    e = html.escape
    rows = "".join(f"<tr><th>{e(k)}</th>" + "".join(f"<td>{v.get(n, 0):.4f}</td>" for n in names) + "</tr>" for k, v in doc.items())
    bars = ""
    for n in names:
        top = max((abs(float(v.get(n, 0))) for v in doc.values()), default=0) or 1
        bars += f"<h3>{e(n)}</h3>" + "".join(f'<div class="bar"><span style="width:{100 * abs(float(v.get(n, 0))) / top:.1f}%"></span>{e(k)} {float(v.get(n, 0)):.4f}</div>' for k, v in doc.items())
    rho = "".join(f"<tr><th>{e(k)}</th><td>{v:.4f}</td></tr>" for k, v in (correlations or {}).items())
    style = "body{font-family:sans-serif;margin:2em}td,th{padding:.2em .6em;text-align:right}.bar span{display:inline-block;background:#4878a8;height:.8em;margin-right:.5em}.bar{max-width:60em}"
    head = "".join(f"<th>{e(n)}</th>" for n in names)
    return f"<!doctype html><meta charset=utf-8><title>{e(title)}</title><style>{style}</style><h1>{e(title)}</h1><table><tr><th></th>{head}</tr>{rows}</table>{bars}<h2>Rank correlations</h2><table>{rho}</table><script>const data={json.dumps(doc)}</script>"
