"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

The base kinds are `assign` (a name, a separator and a value), `access` (AKIA keys) and `hex` (long hex runs). The method adds the kind
`owner`: long bare strings that look random (24 characters or more, with lower case, upper case and digits) and that nobody names as a
secret. The corpus decides about them: the hash of each candidate, of base kinds too, is counted by distinct owners and distinct repositories.
A value that COPIED owners or SPREAD repositories hold, or more, is a widely copied example; any other is owner-specific and looks live.
Candidates of the kind `owner` become spans only if they look live; base spans stay whatever their frequency is. Each span carries both
counts and the decision.

Matches are placed by running sums over the lengths of what stands between them and of themselves, one row a match, so a text of very many
matches costs no more than their number. Values of many rows meet their counts by a broadcast.

Spans are in code points, ends exclusive. An `owner` span never overlaps a base span. Null texts are empty texts. A null owner is an owner of
its own, and so is a null repository. Repeated rows each have a result; they are one repository and one owner. An empty table has an empty
result. Further columns do no harm: only the named ones are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import heavy_limit, join_heavy, materialize, table

KINDS = ("assign", "access", "hex", "owner")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Equal to the longest runs of at least 20 and 24 characters, as a failing shorter run holds no longer one.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BARE = r"[A-Za-z0-9+/_-]{24,}={0,2}"
#: So many owners, or so many repositories, make a value an example.
COPIED, SPREAD = 3, 10


_STEP = "struct<kind:int,skip:int,len:int,ok:boolean,hash:string>"


def _steps(text: Column, pattern: str, kind: int, ok, value) -> Column:
    """Of the pattern's leftmost matches that do not overlap, in order: characters since the last match, length, whether it counts, its hash."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(m: Column, gap: Column) -> Column:
        good = ok(m)
        return F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("skip"), F.length(m).alias("len"), good.alias("ok"), F.when(good, F.sha2(value(m), 256)).alias("hash"))

    steps = F.zip_with(found, F.slice(gaps, 1, F.size(found)), one)
    return F.when(text.rlike(pattern), steps).otherwise(F.array()).cast(f"array<{_STEP}>")


def _spans(found: DataFrame) -> DataFrame:
    """row, repo, owner, kind, start, end, hash of the matches that count and, of the kind `owner`, overlap no other."""
    steps = found.where(F.size("steps") > 0).select("row", "repo", "owner", F.posexplode("steps").alias("at", "x")).select("row", "repo", "owner", "at", "x.*")
    upto = F.sum(F.col("skip") + F.col("len")).over(Window.partitionBy("row", "kind").orderBy("at")).cast("int")
    placed = steps.withColumns({"end": upto, "start": upto - F.col("len")}).where("ok")
    base = F.col("kind") < 3
    sooner = F.max(F.when(base, F.col("end"))).over(Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    later = F.min(F.when(base, F.col("start"))).over(Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1))
    free = (F.coalesce(sooner, F.lit(0)) <= F.col("start")) & (F.coalesce(later, F.col("end")) >= F.col("end"))
    return placed.withColumn("free", free).where(base | F.col("free")).select("row", "repo", "owner", "kind", "start", "end", "hash")


def scan(docs: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", copied: int = COPIED, spread: int = SPREAD) -> DataFrame:
    """repo_col and spans of each row: an array of (start, kind, end, owners, repos, live, example), by start."""
    text, always = F.coalesce(F.col(text_col), F.lit("")), lambda m: F.lit(True)
    value = lambda m: F.regexp_extract(m, ASSIGN, 1)
    whole = lambda m: m
    random = lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
    t = F.col("t")
    kinds = [_steps(t, ASSIGN, 0, lambda m: F.length(value(m)) >= 6, value), _steps(t, ACCESS, 1, always, whole), _steps(t, HEX, 2, always, whole), _steps(t, BARE, 3, random, whole)]
    slim = docs.select(F.col(repo_col).alias("repo"), F.col(owner_col).alias("owner"), F.monotonically_increasing_id().alias("row"), text.alias("t"))
    # The texts are read once: what follows works on the matches alone.
    found = materialize(slim.select("repo", "owner", "row", F.concat(*kinds).alias("steps")), "secrets")
    one = materialize(_spans(found), "secret-spans")
    repo, owner = F.xxhash64("repo", F.col("repo").isNull()).alias("r"), F.xxhash64("owner", F.col("owner").isNull()).alias("w")
    # Distinct first, so that a value of a third of all rows is a row for each repository, then partial counts.
    owners = one.select("hash", owner).distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    repos = one.select("hash", repo).distinct().groupBy("hash").agg(F.count("*").alias("repos"))
    rows = one.groupBy("hash").agg(F.count("*").alias("rows"))
    counts = materialize(rows.join(owners, "hash").join(repos, "hash"), "secret-counts")
    counted = join_heavy(one.select("row", "kind", "start", "end", "hash"), counts.drop("rows"), ["hash"], counts.select("hash", "rows"), heavy_limit(docs.sparkSession, one.count()))
    example = (F.col("owners") >= copied) | (F.col("repos") >= spread)
    span = F.struct("start", "kind", "end", "owners", "repos", (~example).alias("live"), example.alias("example"))
    spans = counted.where((F.col("kind") < 3) | ~example).groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("all"))
    none = F.array().cast(spans.schema["all"].dataType)
    return found.select("row", F.col("repo").alias(repo_col)).join(spans, "row", "left").select(repo_col, F.coalesce("all", none).alias("spans"))


def _text(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, frequencies (owners/repositories of each span) of all documents.

    A document is a repository, its source the owner.
    """
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    base = F.filter("spans", lambda x: x["kind"] < 3)

    def count(which, name: str) -> Column:
        return F.size(F.filter("spans", which)).cast("long").alias(name)

    n = [count(lambda x: x["kind"] == 0, "n_assign"), count(lambda x: x["kind"] == 1, "n_access"), count(lambda x: x["kind"] == 2, "n_hex")]
    more = [count(lambda x: x["live"], "n_live"), count(lambda x: x["example"], "n_example")]
    often = F.array_join(F.transform("spans", lambda x: F.concat_ws("/", x["owners"].cast("string"), x["repos"].cast("string"))), ",")
    return found.select("doc_id", *n, F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"), *more, often.alias("frequencies"))


_PLACED = """
SELECT rid, {kind} AS kind, len(array_to_string(gaps[1 : k], '')) + coalesce(len(array_to_string(found[1 : k - 1], '')), 0) AS s, found[k] AS m
FROM (SELECT rid, string_split_regex(t, {pat}) AS gaps, regexp_extract_all(t, {pat}) AS found, unnest(range(1, len(regexp_extract_all(t, {pat})) + 1)) AS k FROM d)
""".strip()


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


ORACLE_OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
b0 AS ({_PLACED.format(kind=0, pat=_sql(ASSIGN))} UNION ALL {_PLACED.format(kind=1, pat=_sql(ACCESS))} UNION ALL {_PLACED.format(kind=2, pat=_sql(HEX))}),
base AS (SELECT rid, kind, s, s + len(m) AS e, CASE WHEN kind = 0 THEN regexp_extract(m, {_sql(ASSIGN)}, 1) ELSE m END AS v FROM b0 WHERE kind > 0 OR len(regexp_extract(m, {_sql(ASSIGN)}, 1)) >= 6),
c0 AS ({_PLACED.format(kind=3, pat=_sql(BARE))}),
cand AS (SELECT rid, kind, s, s + len(m) AS e, m AS v FROM c0 WHERE regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')
  AND NOT EXISTS (SELECT 1 FROM base WHERE base.rid = c0.rid AND base.s < c0.s + len(c0.m) AND c0.s < base.e)),
one AS (SELECT * FROM base UNION ALL SELECT * FROM cand),
own AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT coalesce(doc_id, -1)) AS repos FROM one JOIN d USING (rid) GROUP BY v),
sp AS (SELECT rid, kind, s, e, owners, repos, owners >= {COPIED} OR repos >= {SPREAD} AS example FROM one JOIN own USING (v) WHERE kind < 3 OR NOT (owners >= {COPIED} OR repos >= {SPREAD})),
tx AS (SELECT rid, kind, s, example, owners || '/' || repos AS f, (['assign', 'access', 'hex', 'owner'])[kind + 1] || ':' || s || ':' || e AS x FROM sp),
g AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS c, count(*) FILTER (kind = 2) AS h, string_agg(x, ',' ORDER BY s, kind) FILTER (kind < 3) AS b,
  string_agg(x, ',' ORDER BY s, kind) AS spans, string_agg(f, ',' ORDER BY s, kind) AS often, count(*) FILTER (NOT example) AS live, count(*) FILTER (example) AS ex FROM tx GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live, 0) AS n_live, coalesce(ex, 0) AS n_example, coalesce(often, '') AS frequencies
FROM d LEFT JOIN g USING (rid)
"""
