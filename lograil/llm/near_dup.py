"""Near duplicates: one-permutation MinHash, optimal densification, banded buckets, star-shaped candidate edges.

A document's set is its distinct word shingles, as 64-bit hashes. One hash orders them: the range is cut into bins and the least
hash of each bin is the signature; an empty bin copies a full one that a fixed sequence of random draws names (the same draws
for every document, so equal sets agree and similar sets agree as often as they are similar). Bands of the signature are bucket
keys. Documents with equal sets are one node from the start.

In each bucket the node that shares most buckets with others is the hub, and edges go from it to the other members: a star, so a
bucket of n nodes has n - 1 edges. Every edge is confirmed on the full sets, and linked nodes join into components (large-star and
small-star rounds). What a hub refused may still belong to something that the hub accepted. So, in buckets that then still hold
several components, the members outside the largest one meet those of the other components, as far as bounds allow a link:
the sizes of the two sets and of what each has that no other set among these members has, the metric (Jaccard distance is one:
|d(hub, x) - d(hub, y)| <= 1 - threshold), and sketches at seven standard deviations. The bounds are part of the join, so what they rule out is
no row; members meet by classes of size, in blocks of BLOCK members, so that no task has a whole bucket. These pairs are confirmed as
well, so that no two members of a bucket that are similar enough end in different components. No candidate is capped.

Null and empty texts have the empty set: n_shingles 0, linked with nothing. Repeated rows each have a result row. The component is
named by its smallest id. Rows without an id link like others; a component in which no row has an id has a null name and a null
`kept`. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from .common import append_columns, discard, fresh, heavy_limit, join_heavy, map_batches, materialize, table
from .components import connected_components

WORDS, ROWS, BANDS = 5, 6, 32
BINS = ROWS * BANDS
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD1342543DE82EF95)
#: Members outside a bucket's largest component that one task compares with others.
BLOCK = 256
#: Bytes of sets that a Python function sends at a time.
SENT_BYTES = 4 << 20
#: Members of a star that one task confirms against one copy of the hub's set.
SALT_ROWS = 256


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse, as far as the longest text so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * self.up[-1] * _BASE])
            self.down = np.concatenate([self.down, self.down * self.down[-1] * _INVERSE])
            assert len(self.up) == 2 * k
        return self.up, self.down


_powers = _Powers()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of lower-cased UTF-8, in order."""
    raw = np.frombuffer(text, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    up, down = _powers.upto(len(raw) + 1)
    edge = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles; of the whole sequence where it is shorter; empty without words."""
    if not text:
        return np.zeros(0, np.uint64)
    w = word_hashes(text.encode("utf-8", "surrogatepass").translate(_LOWER))
    n = len(w)
    if not n:
        return w
    m = min(words, n)
    h = w[: n - m + 1].copy()
    for k in range(1, m):
        h = h * _STEP + w[k : n - m + 1 + k]
    return np.unique(_mix(h + np.uint64(m)))


_EDGES = np.array([((k << 64) + BINS - 1) // BINS for k in range(BINS)], dtype=object).astype(np.uint64)
_draws = np.random.default_rng(20_170_611)
#: The draws of each bin: where an empty one looks for a full one, in this order.
_LOOK = _draws.integers(0, BINS, (BINS, 4096)).astype(np.int16)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin; densified where a bin is empty. hashes: sorted, at least one."""
    at = np.searchsorted(hashes, _EDGES)
    full = at < np.append(at[1:], len(hashes))
    source = np.arange(BINS)
    empty = np.flatnonzero(~full)
    t, width = 0, 4
    while len(empty):
        if t >= _LOOK.shape[1]:  # practically never: the first full bin
            source[empty] = np.flatnonzero(full)[0]
            break
        look = _LOOK[empty, t : t + width]
        good = full[look]
        done = good.any(axis=1)
        source[empty[done]] = look[done, good[done].argmax(axis=1)]
        empty, t, width = empty[~done], t + width, min(256, width * 4)
    return hashes[at[source]]


_BAND_SEED = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS)
    h = _BAND_SEED.copy()
    for k in range(ROWS):
        h = _mix(h * _STEP + rows[:, k])
    return h


def sketch(sig: np.ndarray) -> np.ndarray:
    """One bit of each bin, in `BINS` / 64 longs."""
    return np.packbits((_mix(sig) & np.uint64(1)).astype(np.uint8)).view(np.int64)


#: Bits of the fine sketch, for the few nodes that the first links leave open.
FINE = 2048
_FINE = _draws.integers(0, 1 << 63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fine_sketch(hashes: np.ndarray) -> np.ndarray:
    """One bit of each of `FINE` independent minima of a set."""
    least = np.full(FINE, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), 256):
        h = hashes[lo : lo + 256, None] * _FINE[None, :]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, h.min(axis=0), out=least)
    return np.packbits(((least >> np.uint64(7)) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def _sets(words: int):
    def make():
        def fn(texts):
            n, keys, bands, bits = [], [], [], []
            for i in range(len(texts)):
                s = shingle_set(texts[i].as_py(), words)
                sig = signature(s) if len(s) else None
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(sig).view(np.int64).tolist() if len(s) else None)
                bits.append(sketch(sig).tolist() if len(s) else None)
            return [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))]

        return fn

    return make


def _look(id_col: str, text: Column) -> Column:
    """What a row is found again by: its id and the hash of its text as one number, nulls apart from empty texts."""
    return F.xxhash64(id_col, F.col(id_col).isNull(), text)


def _with_texts(wanted: DataFrame, docs: DataFrame, each: int) -> DataFrame:
    """wanted (of, key, look, roles) with the texts of the rows that `look` names; each: bytes of one entry of roles.

    The wanted rows go to all scans while they are small (64 MB at most); beyond that Spark shuffles both sides by `look`.
    """
    small = wanted.agg(F.count("*").alias("n"), F.sum(F.size("roles")).alias("k")).first()
    ids = F.broadcast(wanted) if small["n"] * 48 + (small["k"] or 0) * each <= 64 << 20 else wanted
    return docs.select("_text", _look("_id", F.xxhash64("_text")).alias("look")).join(ids, "look").select("_text", "key", "of", "roles")


class _Once:
    """The sets of wanted nodes, each once in a task however many rows are copies of it."""

    def __init__(self, words: int):
        self.words, self.seen = words, set()

    def of(self, text: str | None, key: bytes, node: int) -> np.ndarray | None:
        if node in self.seen:
            return None
        s = shingle_set(text, self.words)
        if hashlib.blake2b(s.tobytes(), digest_size=16).digest() != key:
            return None  # another row whose number is the same by chance
        self.seen.add(node)
        return s


def _alone(chosen: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """nid, u, fine, bands: how many shingles of a chosen node no other chosen node has, its fine sketch, its buckets in order."""
    wanted = materialize(chosen.join(nodes.select("nid", "key", "look"), "nid").select(F.col("nid").alias("of"), "key", "look", F.array().cast("array<int>").alias("roles")), "near-wanted")

    def emit():
        once = _Once(words)

        def fn(b):
            for text, key, of in zip(b.column("_text"), b.column("key").to_pylist(), b.column("of").to_pylist(), strict=True):
                s = once.of(text.as_py(), key, of)
                if s is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([of]), pa.array([s.view(np.int64)], pa.list_(pa.int64())), pa.array([fine_sketch(s)], pa.list_(pa.int64())), pa.array([band_keys(signature(s)).view(np.int64)], pa.list_(pa.int64()))], names=["nid", "h", "fine", "bands"])

        return fn

    sets = materialize(map_batches(_with_texts(wanted, docs, 0), "nid long, h array<long>, fine array<long>, bands array<long>", emit).dropDuplicates(["nid"]), "near-sets")
    each = sets.select("nid", F.explode("h").alias("h"))
    once = each.groupBy("h").agg(F.min("nid").alias("nid"), F.max("nid").alias("last")).where("nid = last").groupBy("nid").agg(F.count("*").alias("u"))
    lonely = materialize(sets.select("nid", "fine", "bands").join(once, "nid", "left").select("nid", "fine", "bands", F.coalesce("u", F.lit(0)).alias("u")), "near-alone")
    discard(wanted, sets)
    return lonely


def _confirm(edges: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """hub, nid, common, n_hub, n_nid of the edges (hub, nid), counted on full sets taken from the texts once more.

    docs: _id, _text. One shuffle brings each hub's set once for each `SALT_ROWS` members, and each member once for each of its
    edges, together. A hot hub is many groups.
    """
    spark = edges.sparkSession
    hot = materialize(edges.groupBy("hub").agg(F.count("*").alias("rows"), F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")), "near-hot")
    salted = join_heavy(edges, hot.select("hub", "salts"), ["hub"], hot, heavy_limit(spark, edges.count())).select("hub", "nid", F.pmod(F.xxhash64("nid"), F.col("salts")).cast("int").alias("salt"))
    roles = salted.select(F.col("nid").alias("of"), "hub", "salt", F.lit(1).alias("role")).unionByName(hot.select(F.col("hub").alias("of"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role")))
    wanted = roles.groupBy("of").agg(F.collect_list(F.struct("hub", "salt", "role")).alias("roles")).join(nodes.select(F.col("nid").alias("of"), "key", "look"), "of")
    wanted = materialize(wanted, "near-wanted")
    with_text = _with_texts(wanted, docs, 24)

    def emit():
        once = _Once(words)

        def fn(b):
            hub, salt, role, nid, sets, size = [], [], [], [], [], 0
            for text, key, of, roles_ in zip(b.column("_text"), b.column("key").to_pylist(), b.column("of").to_pylist(), b.column("roles").to_pylist(), strict=True):
                s = once.of(text.as_py(), key, of)
                if s is None:
                    continue
                raw = s.tobytes()
                for r in roles_:
                    hub.append(r["hub"])
                    salt.append(r["salt"])
                    role.append(r["role"])
                    nid.append(of)
                    sets.append(raw)
                    size += len(raw)
                    if size >= SENT_BYTES:
                        yield batch(hub, salt, role, nid, sets)
                        hub, salt, role, nid, sets, size = [], [], [], [], [], 0
            if sets:
                yield batch(hub, salt, role, nid, sets)

        def batch(hub, salt, role, nid, sets):
            return pa.RecordBatch.from_arrays([pa.array(hub, pa.int64()), pa.array(salt, pa.int32()), pa.array(role, pa.int32()), pa.array(nid, pa.int64()), pa.array(sets, pa.binary())], names=["hub", "salt", "role", "nid", "set"])

        return fn

    sets = map_batches(with_text, "hub long, salt int, role int, nid long, set binary", emit)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = sets.repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", "role")

    def compare():
        state = {"hub": None, "set": None}

        def fn(b):
            hubs, nids, common, n_hub, n_nid = [], [], [], [], []
            for hub, role, nid, raw in zip(b.column("hub").to_pylist(), b.column("role").to_pylist(), b.column("nid").to_pylist(), b.column("set").to_pylist(), strict=True):
                s = np.frombuffer(raw, dtype=np.uint64)
                if role == 0:
                    state["hub"], state["set"] = hub, s
                    continue
                own = state["set"]
                at = np.searchsorted(own, s)
                at[at == len(own)] = 0
                hubs.append(hub)
                nids.append(nid)
                common.append(int((own[at] == s).sum()))
                n_hub.append(len(own))
                n_nid.append(len(s))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (hubs, nids, common, n_hub, n_nid)], names=["hub", "nid", "common", "n_hub", "n_nid"])

        return fn

    tested = materialize(map_batches(dealt, "hub long, nid long, common long, n_hub long, n_nid long", compare).dropDuplicates(["hub", "nid"]), "near-tested")
    discard(wanted, hot)
    return tested


def _allowed(n1: Column, s1: Column, n2: Column, s2: Column, percent: int) -> Column:
    """Whether the sizes and sketches of two nodes allow the similarity."""
    t = percent / 100
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    apart = sum((F.bit_count(s1[k].bitwiseXOR(s2[k])) for k in range(BINS // 64)), F.lit(0))
    mean = (1 - t) / 2
    # Copied bins count for less: half of the full ones are taken as independent.
    independent = (1 - F.exp(-small / float(BINS))) * (BINS / 2)
    return (100 * small >= percent * large) & (apart / float(BINS) <= mean + 7 * F.sqrt(mean * (1 - mean) / independent))


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """id, n_shingles, component_id, kept and text_hash of each row; rows link at 100 * |A n B| >= percent * |A u B|."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    fields = [StructField("n", LongType()), StructField("key", BinaryType()), StructField("bands", ArrayType(LongType())), StructField("s", ArrayType(LongType()))]
    rows = materialize(append_columns(slim, ["_text"], fields, _sets(words)).withColumn("text_hash", F.xxhash64("_text")).drop("_text"), "near-rows")
    limit = heavy_limit(docs.sparkSession, rows.count())
    # The row of the smallest id stands for its copies; without any id, that of the smallest text hash.
    head = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "text_hash"))
    nodes = rows.where(F.col("n") > 0).groupBy("key").agg(head.alias("r"), F.count("*").alias("rows"), F.first(F.struct("n", "bands", "s")).alias("f"))
    look = F.xxhash64("r._id", F.col("r._id").isNull(), "r.text_hash").alias("look")
    nodes = materialize(nodes.select("key", F.col("r._id").alias("doc"), look, "rows", "f.*", F.monotonically_increasing_id().alias("nid")), "near-nodes")
    slots = nodes.select("nid", F.explode("bands").alias("bucket"))
    sizes = materialize(slots.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1"), "near-sizes")
    shared = materialize(join_heavy(slots, sizes, ["bucket"], sizes, limit), "near-slots")
    # A node's weight: how many others it meets. The hub of a bucket is the one that meets most.
    weight = shared.groupBy("nid").agg(F.sum(F.col("rows") - 1).alias("weight")).join(nodes.select("nid", "n", "s"), "nid")
    members = materialize(shared.select("bucket", "nid").join(weight, "nid"), "near-members")
    top = F.max(F.struct("weight", F.negative("nid").alias("m"), "n", "s"))
    hubs = materialize(members.groupBy("bucket").agg(top.alias("top")).select("bucket", F.negative("top.m").alias("hub"), F.col("top.n").alias("hub_n"), F.col("top.s").alias("hub_s")), "near-hubs")
    star = join_heavy(members, hubs, ["bucket"], sizes, limit).where((F.col("nid") != F.col("hub")) & _allowed(F.col("n"), F.col("s"), F.col("hub_n"), F.col("hub_s"), percent))
    edges = materialize(star.select("hub", "nid").distinct(), "near-edges")
    tested = _confirm(edges, nodes, slim, words)
    discard(shared, edges)
    passes = 100 * F.col("common") >= percent * (F.col("n_hub") + F.col("n_nid") - F.col("common"))
    links = tested.where(passes).select(F.col("hub").alias("a"), F.col("nid").alias("b"))
    labels = connected_components(links)
    open_ = _unresolved(members, hubs.select("bucket", "hub"), tested, labels, percent, sizes, limit, lambda chosen: _alone(chosen, nodes, slim, words))
    discard(members, hubs, sizes)
    if not open_.isEmpty():
        more = _confirm(open_, nodes, slim, words)
        labels = connected_components(links.unionByName(more.where(passes).select(F.col("hub").alias("a"), F.col("nid").alias("b"))))
        discard(more)
    discard(open_, tested)
    named = nodes.join(labels, nodes["nid"] == labels["node"], "left").select("key", "doc", "rows", F.coalesce("component", "nid").alias("c"))
    names = named.groupBy("c").agg(F.min("doc").alias("name"), F.count("*").alias("k")).where("k > 1").select("c", "name")
    of = materialize(named.join(names, "c", "left").select("key", "rows", F.coalesce("name", "doc").alias("component")), "near-names")
    full = join_heavy(rows.where("n > 0").select("key", "_id", "n", "text_hash"), of.select("key", "component"), ["key"], of.select("key", "rows"), limit)
    none = rows.where("n = 0").select("key", "_id", "n", "text_hash", F.col("_id").alias("component"))
    out = full.unionByName(none)
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("_id") == F.col("component")).alias("kept"), "text_hash")


def _unresolved(members: DataFrame, hubs: DataFrame, tested: DataFrame, labels: DataFrame, percent: int, sizes: DataFrame, limit: int, alone) -> DataFrame:
    """Untested pairs (hub, nid) of a bucket's members in different components that the bounds allow to be linked.

    Of a pair's common shingles neither set can count those that it has alone, and both kinds count in the union: most copies that were
    edited too much for a link are out by this bound without meeting any other.
    """
    t = percent / 100
    far = F.lit(1.0) - F.col("common") / (F.col("n_hub") + F.col("n_nid") - F.col("common"))
    met = tested.select("hub", "nid", far.alias("d"))
    all_ = members.join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("c", F.coalesce("component", "nid")).drop("component")
    by_c = all_.groupBy("bucket", "c").agg(F.count("*").alias("k"))
    several = by_c.groupBy("bucket").agg(F.max(F.struct("k", "c")).alias("top"), F.count("*").alias("cs")).where("cs > 1").select("bucket", F.col("top.c").alias("main"))
    all_ = join_heavy(all_, several.join(hubs, "bucket"), ["bucket"], sizes, limit).join(met, ["hub", "nid"], "left").withColumn("d", F.when(F.col("hub") == F.col("nid"), 0.0).otherwise(F.col("d")))
    # Who is more than a step of the threshold larger can't be linked: partners are in neighbouring classes of size.
    k = F.floor(F.log("n") / -F.log(F.lit(t)) + 1e-9).cast("int") if percent < 100 else F.col("n").cast("int")
    seen = materialize(all_.select("bucket", "main", "nid", "c", "n", "s", "d", k.alias("k")), "near-all")
    lonely = alone(seen.select("nid").distinct())
    # Without these: with nobody could one be linked, not even with a set that has all the rest of it and nothing else.
    all_ = materialize(seen.join(lonely, "nid").where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n")), "near-able")
    minor = all_.where(F.col("c") != F.col("main"))
    blocks = minor.groupBy("bucket", "k").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    one = minor.join(blocks, ["bucket", "k"]).withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int")).drop("blocks")
    other = all_.withColumn("k", F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1))).join(blocks, ["bucket", "k"])
    other = other.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    near = F.coalesce(F.abs(x("d") - y("d")) <= F.lit(1 - t + 1e-9), F.lit(True))
    twice = (y("c") == y("main")) | (x("nid") < y("nid"))
    common = F.least(x("n") - x("u"), y("n") - y("u"))
    union = F.greatest(x("n") + y("u"), y("n") + x("u"))
    apart = F.aggregate(F.zip_with(x("fine"), y("fine"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    mean = (1 - t) / 2
    fine = apart <= FINE * (mean + 7 * (mean * (1 - mean) / FINE) ** 0.5)
    # A pair is made in the first bucket that it shares.
    place = F.array_position(x("bands"), x("bucket")).cast("int")
    sooner = F.exists(F.zip_with(F.slice(x("bands"), 1, place - 1), F.slice(y("bands"), 1, place - 1), lambda a, b: a == b), lambda e: e)
    same = (x("bucket") == y("bucket")) & (x("k") == y("k")) & (x("block") == y("block"))
    able = (x("c") != y("c")) & twice & near & (100 * common >= percent * union) & _allowed(x("n"), x("s"), y("n"), y("s"), percent) & fine & ~sooner
    pairs = one.alias("x").join(other.alias("y"), same & able).select(F.least("x.nid", "y.nid").alias("hub"), F.greatest("x.nid", "y.nid").alias("nid")).distinct()
    done = tested.select(F.least("hub", "nid").alias("hub"), F.greatest("hub", "nid").alias("nid"))
    open_ = materialize(pairs.join(done, ["hub", "nid"], "left_anti"), "near-open")
    discard(seen, all_, lonely)
    return open_


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near duplicates: that with the component's smallest id.

    Rows with an empty set all stay, and so do components in which no row has an id. Of rows that repeat id and text one stays, by a hash of
    all its columns (two columns of such rows that hash alike are alike).
    """
    i, h = fresh(docs.columns, "_i"), fresh(docs.columns, "_h")
    number = lambda c: F.xxhash64(c, F.col(c).isNull())
    found = near_duplicates(docs, percent, id_col, text_col).where("n_shingles > 0")
    lost = found.where(~F.col("kept") | (F.col(id_col).isNull() & F.col("component_id").isNotNull())).select(number(id_col).alias(i), F.col("text_hash").alias(h)).distinct()
    left = docs.withColumns({i: number(id_col), h: F.xxhash64(text_col)}).join(lost, [i, h], "left_anti")
    again = found.where("kept").groupBy(number(id_col).alias(i), F.col("text_hash").alias(h)).count().where("count > 1").select(i, h)
    if again.isEmpty():
        return left.select(*docs.columns)
    # Aggregated before it moves: a row of many copies is one row for each partition.
    row = fresh(docs.columns, "_row")
    one = left.join(again, [i, h], "left_semi").groupBy(i, h).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))).alias(row))
    return left.join(again, [i, h], "left_anti").select(*docs.columns).unionByName(one.select(f"{row}.*"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of all documents; links at a similarity of 0.85 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, 85).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_OP8 = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM t WHERE len(w) > 0))),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
ln AS (SELECT x, y FROM pr JOIN sz p ON p.doc_id = x JOIN sz q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
sym AS (SELECT x, y FROM ln UNION SELECT y, x FROM ln),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, sym.y FROM reach JOIN sym ON reach.b = sym.x),
comp AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(sz.n, 0) AS BIGINT) AS n_shingles, m AS component_id, doc_id = m AS kept
FROM documents LEFT JOIN sz USING (doc_id) JOIN comp ON comp.a = doc_id
"""
