"""Line dedup by a log-template tree.

Each line is parsed down a tree of fixed depth. Level 1 is its number of tokens, level 2 its LEAD leading tokens; tokens that look like
variable fields (they hold a digit, an @ or ://) are a wildcard already on the way down. In the leaf the tokens behind the lead fall into at
most PARTS parts of equal size (single tokens while there are no more of them). A template fixes all parts but a few, and generalises these:
one part of a line of 5 to 9 tokens, two parts of a longer one, none of a shorter one (tokens / 5, at most 2). So two lines are instances of one template if
they have the same number of tokens and the same lead and differ in no more than about a fifth of the line. Blank lines and lines of wildcards alone have no template.

A template recurs if lines of at least two documents are instances of it. The document with the smallest id keeps its instances, and
all other documents lose theirs. Which templates a line has depends on the line alone, so the tree needs no order and all counts are
plain aggregates of numbers. Equal lines are one node; only nodes whose leaf holds another node are generalised at all. Not found is what
varies in the lead, or in more parts than may vary.

With `leave_copies` (the pipeline, whose next stage is for whole documents) a document most of which is in one earlier document is a copy
and no document with boilerplate: of the lines that a template's first document has kept, those that come from its one best partner stay,
if they are at least COPY of what it would keep with them, and of what the partner keeps.

A null text stays null, an empty one empty; a document may lose all its lines and is then an empty text; no document is dropped. Rows of one id
are one document. Rows without an id are documents told apart by their texts, and come after all ids. An empty table has an empty result.
Columns of any name are carried through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fresh, heavy_limit, join_heavy, map_batches, materialize, table

LEAD, PARTS = 3, 10
COPY = 0.8
WILD = "<*>"
NO_ID = 1 << 62
_FIELD = re.compile(r"[0-9@]|://")
_SPACE = re.compile("[ \t\r\x0b\x0c]+")


def tokens_of(line: str) -> list[str]:
    """The line's tokens, variable fields as wildcards."""
    tokens = [t for t in _SPACE.split(line) if t]
    if _FIELD.search(line):
        tokens = [WILD if _FIELD.search(t) else t for t in tokens]
    return tokens


def parts_of(tokens: list[str]) -> list[list[str]]:
    """What stands behind the lead, in parts."""
    rest = tokens[LEAD:]
    k = min(PARTS, len(rest))
    return [rest[j * len(rest) // k : (j + 1) * len(rest) // k] for j in range(k)]


def free_parts(n: int) -> int:
    """How many parts a template of n tokens generalises."""
    return min(2, n // 5)


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


_HASHES = [f"p{k}" for k in range(PARTS)]
_LINES = "leaf long, node long, n int, " + ", ".join(f"{p} int" for p in _HASHES) + ", o long, h long, place int"


def _parse():
    """A row of _LINES for each line that has a template; p0, p1 ...: hashes of its parts (32 bits will do beside the leaf's 64), 0 for those that it lacks."""

    def fn(b):
        for lo in range(0, b.num_rows, 250):
            part = b.slice(lo, 250)
            row, place, leaf, node, n, parts, where = [], [], [], [], [], [], []
            for i, text in enumerate(part.column("_t").to_pylist()):
                for k, line in enumerate(text.split("\n")) if text else ():
                    tokens = tokens_of(line)
                    if all(t == WILD for t in tokens):
                        continue
                    size, at = len(tokens), len(row) * PARTS
                    row.append(i)
                    place.append(k)
                    n.append(size)
                    leaf.append(_digest(f"{size} {' '.join(tokens[:LEAD])}"))
                    if not free_parts(size):
                        node.append(_digest(" ".join(tokens)))
                    else:
                        own = [_digest(" ".join(p)) for p in parts_of(tokens)]
                        parts += own
                        where += range(at, at + len(own))
                        node.append(xxhash.xxh3_64_intdigest(np.array(own, np.uint64).tobytes()))
            at = pa.array(row, pa.int32())
            longs = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
            every = np.zeros(len(row) * PARTS, np.uint64)
            every[where] = np.array(parts, np.uint64)
            hashes = [pa.array(c) for c in np.ascontiguousarray(every.astype(np.uint32).view(np.int32).reshape(-1, PARTS).T)]
            columns = [longs(leaf), longs(node), pa.array(n, pa.int32()), *hashes, part.column("_o").take(at), part.column("_h").take(at), pa.array(place, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["leaf", "node", "n", *_HASHES, "o", "h", "place"])

    return fn


def _order(id_col: str | Column, text_col: str | Column) -> Column:
    """Ids as they are; without one, a number beyond them that the text decides."""
    one = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(one.cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text_col), 3))


def _forms() -> Column:
    """The keys of a node's templates that generalise parts (columns leaf, n, parts): one for each choice of the free parts."""
    k = F.size("parts")

    def form(i: Column, j: Column) -> Column:
        return F.xxhash64("leaf", i, j, F.transform("parts", lambda p, at: F.when((at == i) | (at == j), F.lit(0)).otherwise(p)))

    one = F.transform(F.sequence(F.lit(0), k - 1), lambda i: form(i, F.lit(-1)))
    two = F.flatten(F.transform(F.sequence(F.lit(0), k - 2), lambda i: F.transform(F.sequence(i + 1, k - 1), lambda j: form(i, j))))
    return F.when(F.col("n") < 10, one).otherwise(two)


def _heads(lines: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """leaf, node, head: of each node that recurs, the first document of its templates; and leaf, node, rows: how many lines a node has."""
    same = ["leaf", "node"]
    nodes = materialize(lines.groupBy(*same).agg(F.min("o").alias("first"), F.max("o").alias("last"), F.count("*").alias("rows")), "line-nodes")
    leaves = materialize(nodes.groupBy("leaf").agg(F.count("*").alias("k"), F.sum("rows").alias("rows")), "line-leaves")
    several = leaves.where("k > 1").select("leaf")
    # Few leaves hold more than one node: while they are 64 MB at most they go to the lines, else both are shuffled.
    few = several.count() * 16 <= 64 << 20
    split = lines.where("n >= 5")
    inside = split.join(F.broadcast(several), "leaf", "left_semi") if few else join_heavy(split, several, ["leaf"], leaves, limit)
    one = [F.min("o").alias("first"), F.max("o").alias("last"), F.any_value("n").alias("n"), *(F.any_value(p).alias(p) for p in _HASHES)]
    parts = F.slice(F.array(*_HASHES), 1, F.least(F.lit(PARTS), F.col("n") - LEAD)).alias("parts")
    open_ = inside.groupBy(*same).agg(*one).select(*same, "first", "last", "n", parts)
    forms = materialize(open_.select(*same, "first", "last", F.explode(_forms()).alias("form")), "line-forms")
    tops = forms.groupBy("form").agg(F.min("first").alias("head"), F.max("last").alias("end"), F.count("*").alias("rows"))
    tops = materialize(tops.where("rows > 1 AND head < end"), "line-tops")
    general = join_heavy(forms.select(*same, "form", "last"), tops.select("form", "head"), ["form"], tops.select("form", "rows"), limit)
    found = nodes.where("first < last").select(*same, F.col("first").alias("head"), "last").unionByName(general.select(*same, "head", "last"))
    least = found.groupBy(*same).agg(F.min("head").alias("head"), F.max("last").alias("last")).where("head < last")
    heads = materialize(least.select(*same, "head"), "line-heads")
    discard(forms, tops, leaves)
    return heads, nodes.select(*same, "rows")


def _copies(lines: DataFrame, lost: DataFrame) -> DataFrame:
    """o, h, head: documents that are copies, and of which earlier document. Sizes are numbers of tokens."""
    same = ["o", "h"]
    every = lines.groupBy(*same).agg(F.sum("n").alias("all"))
    by = lost.groupBy(*same, "head").agg(F.sum("n").alias("by"))
    best = by.groupBy(*same).agg(F.sum("by").alias("gone"), F.max(F.struct("by", F.negative("head").alias("m"))).alias("b"))
    kept = every.join(best, same, "left").select(*same, (F.col("all") - F.coalesce("gone", F.lit(0))).alias("kept"), F.col("b.by").alias("by"), F.negative("b.m").alias("head"))
    kept = materialize(kept, "line-kept")
    able = kept.where(F.col("by") >= COPY * (F.col("by") + F.col("kept")))
    many = materialize(able.groupBy("head").agg(F.count("*").alias("rows")), "line-partners")
    partner = kept.groupBy(F.col("o").alias("head")).agg(F.max("kept").alias("theirs"))
    found = join_heavy(able, partner.join(many.select("head"), "head"), ["head"], many, heavy_limit(lines.sparkSession, kept.count()))
    return found.where(F.col("by") >= COPY * F.col("theirs")).select(*same, "head")


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leave_copies: bool = False) -> DataFrame:
    """o, h, places: by order and text hash of a document, the sorted numbers (from 0) of the lines that it loses."""
    slim = docs.select(_order(id_col, text_col).alias("_o"), F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("_t"))
    lines = materialize(map_batches(slim, _LINES, _parse), "lines")
    limit = heavy_limit(docs.sparkSession, lines.count())
    heads, counts = _heads(lines, limit)
    lost = join_heavy(lines.select("leaf", "node", "n", "o", "h", "place"), heads, ["leaf", "node"], counts, limit).where("o > head").select("o", "h", "place", "n", "head")
    if leave_copies:
        lost = materialize(lost, "line-lost")
        spared = _copies(lines, lost).withColumnRenamed("head", "partner")
        lost = lost.join(spared, ["o", "h"], "left").where("partner IS NULL OR head <> partner")
    return lost.groupBy("o", "h").agg(F.array_sort(F.collect_set("place")).alias("places"))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leave_copies: bool = False) -> tuple[DataFrame, str]:
    """docs with recurring lines taken out of the texts and a column of the numbers of these lines, whose name is the second value."""
    name = fresh(docs.columns, "dropped_lines")
    lost = recurring_lines(docs, id_col, text_col, leave_copies)
    o, h, places = (fresh([*docs.columns, name], c) for c in ("_o", "_h", "_places"))
    lost = lost.select(F.col("o").alias(o), F.col("h").alias(h), F.col("places").alias(places))
    keyed = docs.withColumns({o: _order(id_col, text_col), h: F.xxhash64(text_col)})
    joined = keyed.join(lost, [o, h], "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n", -1), lambda x, i: ~F.array_contains(places, i)), "\n")
    out = [F.when(F.col(places).isNull(), F.col(f"`{c}`")).otherwise(kept).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*out, F.coalesce(places, F.array().cast("array<int>")).alias(name)), name


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_dropped, dropped_lines (numbers from 0, comma-joined), n_kept_chars, kept_sha256 of all documents."""
    out, name = drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    numbers = F.array_join(F.col(name).cast("array<string>"), ",").alias("dropped_lines")
    return out.select("doc_id", F.size(name).cast("long").alias("n_dropped"), numbers, F.length("text").cast("long").alias("n_kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE_OP4 = r"""
WITH l AS (SELECT doc_id, k - 1 AS place, string_split(text, chr(10))[k] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k FROM documents)),
t AS (SELECT doc_id, place, list_transform(list_filter(string_split_regex(line, '[ \t\r\x0b\x0c]+'), lambda x: x <> ''), lambda x: CASE WHEN regexp_matches(x, '[0-9@]|://') THEN '<*>' ELSE x END) AS w FROM l),
w AS (SELECT doc_id, place, w, len(w) AS n, least(10, greatest(len(w) - 3, 0)) AS k, len(w) || ' ' || array_to_string(w[1 : 3], ' ') AS leaf FROM t WHERE len(list_filter(w, lambda x: x <> '<*>')) > 0),
nodes AS (SELECT leaf, w, n, k, min(doc_id) AS first, max(doc_id) AS last FROM w GROUP BY ALL),
leaves AS (SELECT leaf FROM nodes GROUP BY leaf HAVING count(*) > 1),
parts AS (SELECT leaf, w, n, k, first, last, list_transform(range(0, k), lambda j: array_to_string(w[4 + j * (n - 3) // k : 3 + (j + 1) * (n - 3) // k], ' ')) AS p FROM nodes JOIN leaves USING (leaf) WHERE n >= 5),
one AS (SELECT *, unnest(range(0, k)) AS i FROM parts),
free AS (SELECT *, i AS j FROM one WHERE n < 10 UNION ALL SELECT * FROM (SELECT *, unnest(range(i + 1, k)) AS j FROM one WHERE n >= 10)),
forms AS (SELECT leaf, w, first, last, leaf || '|' || i || '|' || j || '|' || array_to_string(list_transform(range(0, k), lambda x: CASE WHEN x = i OR x = j THEN '*' ELSE p[x + 1] END), '|') AS form FROM free),
tops AS (SELECT form, min(first) AS head FROM forms GROUP BY form HAVING min(first) < max(last)),
heads AS (SELECT leaf, w, min(head) AS head FROM (SELECT leaf, w, head FROM forms JOIN tops USING (form) UNION ALL SELECT leaf, w, first FROM nodes WHERE first < last) GROUP BY ALL),
x AS (SELECT DISTINCT doc_id, place FROM w JOIN heads USING (leaf, w) WHERE doc_id > head),
g AS (SELECT doc_id, count(*) AS n, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS places FROM x GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS kept FROM l WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.doc_id = l.doc_id AND x.place = l.place) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_dropped, coalesce(places, '') AS dropped_lines, length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END) AS n_kept_chars,
  sha256(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""
