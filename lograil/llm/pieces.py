"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch fall into chunks (a run of word marks and what follows up to the next one; no piece crosses from one chunk into the
next). What is indexed is the batch's distinct chunks that this worker has not met before, as one concatenated text; the ids of those that it
has met come from a memo of about CHUNKS_KEPT chunks. The index is a suffix array, sorted on as many characters as the longest piece has.
Each piece of the vocabulary is found in it by binary search: the occurrences are a range of the array. Each occurrence is an edge over
the text; the edges are sorted by position and relaxed. The model is byte-pair: the relaxation applies in every chunk the best-scored edge
that spans exactly two symbols, the leftmost of equals, until none is left, which is how such a model defines its encoding. All chunks take
one such step side by side; a chunk of more than LONG_CHUNK characters, of which each step would look at the whole, takes the same steps over
the same edges from a heap. What no piece covers becomes bytes.

The ids equal the sentencepiece library's, which only reads the model file here and normalises texts. A null text has null ids and a
null decoded text; an empty one has none and decodes to itself. Texts of any length are encoded whole. A literal word mark (U+2581) decodes to a
space, as in the library. An empty table has an empty result; further columns stay.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from .common import append_columns, fresh, table

MARK = "▁"
CHUNKS_KEPT = 300_000
#: Characters of texts that are encoded at a time.
BATCH_CHARS = 4_000_000
#: Characters of new chunks that are indexed at a time, and the longest chunk that is relaxed with others.
INDEX_CHARS, LONG_CHUNK = 250_000, 200
_NONE = np.int64((1 << 62) - 1)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """The starts of all suffixes of codes (small ints, 0 the separator), in the order of their first `depth` codes or more."""
    n = len(codes)
    per = 8 if codes.max(initial=0) < 256 else 4
    bits = 64 // per
    padded = np.concatenate([codes, np.zeros(per, codes.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(per):
        key = (key << np.uint64(bits)) | padded[k : n + k]
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
    while per < depth:
        after = np.concatenate([rank[per:], np.zeros(min(per, n), np.int64)])[:n]
        rank = np.unique((rank << 32) | after, return_inverse=True)[1].astype(np.int64) + 1
        per *= 2
    return np.argsort(rank, kind="stable")


def occurrence_ranges(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each piece (rows of codes, padded with -1) the range of the suffix array whose suffixes begin with it, by binary search."""
    depth, n = pieces.shape[1], len(codes)
    padded = np.concatenate([codes.astype(np.int32), np.zeros(depth, np.int32)])
    pieces, span = pieces.astype(np.int32), np.arange(depth, dtype=np.int32)
    inside = span[None, :] < lengths[:, None]
    # All suffixes that begin with a piece's first character are neighbours: the search starts from their range.
    first_code = padded[order]
    begin, end = np.searchsorted(first_code, pieces[:, 0], "left"), np.searchsorted(first_code, pieces[:, 0], "right")

    def bound(which: np.ndarray, upper: bool) -> np.ndarray:
        lo, hi = begin[which].copy(), end[which].copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            w = which[open_]
            differs = (padded[order[mid][:, None] + span] - pieces[w]) * inside[w]
            sign = differs[np.arange(len(open_)), (differs != 0).argmax(axis=1)]
            right = sign <= 0 if upper else sign < 0
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    every = np.arange(len(pieces))
    lo = bound(every, False)
    hi = lo.copy()
    # Only pieces that occur at all have an upper bound to look for.
    there = every[lo < n]
    there = there[((padded[order[lo[there]][:, None] + span] == pieces[there]) | ~inside[there]).all(axis=1)]
    hi[there] = bound(there, True)
    return lo, hi


def _joined(keys: list, of) -> bytes:
    """The values of some keys in one."""
    return b"".join(itemgetter(*keys)(of)) if len(keys) > 1 else b"".join(of[k] for k in keys)


class PieceModel:
    def __init__(self, path: str, chunks_kept: int = CHUNKS_KEPT, index_chars: int = INDEX_CHARS):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in plain}
        self.ids = {t: i for i, t in self.text.items()}
        self.byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        by_score = sorted((i for i in plain if len(self.text[i]) > 1), key=lambda i: (-sp.get_score(i), i))
        #: Rank of each piece of two characters or more: equal scores have equal ranks, the smaller the better.
        self.ranked: list[tuple[str, int]] = []
        rank, last = -1, None
        for i in by_score:
            if (s := sp.get_score(i)) != last:
                rank, last = rank + 1, s
            self.ranked.append((self.text[i], rank))
        self.rank = dict(self.ranked)
        self.depth = max((len(t) for t, _ in self.ranked), default=2)
        self.piece_length = np.array([len(t) for t, _ in self.ranked])
        self.piece_rank = np.array([r for _, r in self.ranked])
        self.piece_code = np.full((len(self.ranked), self.depth), -1, np.int64)
        for k, (t, _) in enumerate(self.ranked):
            self.piece_code[k, : len(t)] = [ord(c) for c in t]
        crossing = any(re.search(f"[^{MARK}]{MARK}", t) for t in self.text.values())
        self.chunk = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+") if not crossing else re.compile(r"[\s\S]+")
        table_ = [b""] * size
        for i, t in self.text.items():
            table_[i] = t.encode()
        for b, i in self.byte.items():
            table_[i] = bytes([b])
        table_[self.unknown] = " ⁇ ".encode()
        self.bytes = table_
        #: Ids of chunks: those met lately, and those of the time before. When the first are half of chunks_kept they become the second.
        self.chunks_kept, self.index_chars = chunks_kept, index_chars
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _finish(self, symbols: list[str]) -> bytes:
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in s.encode("utf-8")]
            else:
                out.append(self.unknown)
        return array('i', out).tobytes()

    def _long(self, chunk: str, spans: dict[int, int]) -> list[str]:
        """The symbols of one long chunk. spans: rank of each edge of it, by start * depth + length."""
        n, d = len(chunk), self.depth + 1
        end, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def look(a: int) -> None:
            b = end[a]
            if b < n and (r := spans.get(a * d + end[b] - a)) is not None and end[b] - a <= self.depth:
                heapq.heappush(heap, (r, a, b, end[b]))

        for a in range(n - 1):
            look(a)
        while heap:
            _, a, b, e = heapq.heappop(heap)
            if end[a] != b or end[b] != e:
                continue
            end[a], end[b] = e, -1
            if e < n:
                before[e] = a
                look(a)
            if before[a] >= 0:
                look(before[a])
        out, a = [], 0
        while a < n:
            out.append(chunk[a : end[a]])
            a = end[a]
        return out

    def _index(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of some distinct chunks, by one suffix array over all of them."""
        joined = "\0".join(chunks) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        starts = np.cumsum([0] + [len(c) + 1 for c in chunks])
        edge = np.zeros(len(points), bool)
        edge[starts[1:] - 1] = True
        points[edge] = -2
        alphabet = np.unique(points)
        codes = np.searchsorted(alphabet, points).astype(np.uint16 if len(alphabet) < 65_536 else np.uint32)
        at = np.searchsorted(alphabet, self.piece_code)
        at[at == len(alphabet)] = 0
        pad = np.arange(self.depth)[None, :] >= self.piece_length[:, None]
        possible = np.flatnonzero(((alphabet[at] == self.piece_code) | pad).all(axis=1))
        pieces = np.where(pad[possible], -1, at[possible])
        order = suffix_array(codes, self.depth)
        lo, hi = occurrence_ranges(codes, order, pieces, self.piece_length[possible])
        counts = hi - lo
        # An edge is one number, of its start, length and rank in this order; no two have the same start and length.
        d, bits = self.depth + 1, int(self.piece_rank.max(initial=0)).bit_length()
        place = np.repeat(lo - np.cumsum(counts) + counts, counts)
        place += np.arange(len(place))
        edges = order[place]
        del place
        edges *= d << bits
        edges += np.repeat((self.piece_length[possible] << bits) | self.piece_rank[possible], counts)
        edges.sort()
        keys, ranks = edges >> bits, edges & ((1 << bits) - 1)
        del edges
        keys = np.append(keys, _NONE)
        ranks = np.append(ranks, 0)

        def rank_of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
            """rank << 32 | start of the edge from start to end; _NONE where there is none."""
            k = np.where(end - start < d, start * d + end - start, -1)
            i = np.searchsorted(keys, k)
            return np.where(keys[i] == k, (ranks[i] << 32) | start, _NONE)

        n = len(points)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        owner = np.cumsum(edge) - edge
        limit = starts[1:] - 1  # where each chunk ends
        lengths = np.diff(starts) - 1
        best = np.full(n + 1, _NONE)
        i = np.flatnonzero(~edge[:-1] & ~edge[1:]) if n > 1 else np.zeros(0, np.int64)
        best[i] = rank_of(i, i + 2)
        whole = np.zeros(n, bool)  # a symbol starts here
        whole[~edge] = True
        small = lengths <= LONG_CHUNK
        active = np.flatnonzero(whole & small[owner])
        while len(active):
            own = owner[active]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            top = np.minimum.reduceat(best[active], first)
            go = top < _NONE
            if not go.any():
                break
            a = top[go] & 0xFFFFFFFF
            b = after[a]
            e = after[b]
            after[a] = e
            whole[b] = False
            best[b] = _NONE
            last = limit[owner[a]]
            inside = e < last
            before[e[inside]] = a[inside]
            best[a] = _NONE
            best[a[inside]] = rank_of(a[inside], after[e[inside]])
            p = before[a]
            has = (p >= 0) & (owner[np.maximum(p, 0)] == owner[a]) & ~edge[np.maximum(p, 0)]
            best[p[has]] = rank_of(p[has], e[has])
            moved = np.zeros(len(chunks), bool)
            moved[owner[a]] = True
            active = active[whole[active] & moved[own]]
        out: dict[str, bytes] = {}
        begin = np.flatnonzero(whole)
        per_chunk = np.searchsorted(begin, starts)
        begin_l, after_l = begin.tolist(), after[begin].tolist()
        for c, chunk in enumerate(chunks):
            if small[c]:
                out[chunk] = self._finish([joined[begin_l[k] : after_l[k]] for k in range(per_chunk[c], per_chunk[c + 1])])
            else:
                s, t = np.searchsorted(keys, [starts[c] * d, limit[c] * d])
                out[chunk] = self._finish(self._long(chunk, dict(zip((keys[s:t] - starts[c] * d).tolist(), ranks[s:t].tolist(), strict=True))))
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The ids of each text (int32)."""
        split: list[list[str] | None] = []
        one: dict[str, str] = {}  # of equal chunks only one stays in memory
        for t in texts:
            found = self.chunk.findall(self.sp.normalize(t)) if t else []
            split.append(None if t is None else list(map(one.setdefault, found, found)))
        known, older, new = self.known, self.older, []
        for c in one:
            if c not in known:
                if c in older:
                    known[c] = older[c]
                else:
                    new.append(c)
        part, size = [], 0
        for c in sorted(new):
            if part and size + len(c) > self.index_chars:
                known.update(self._index(part))
                part, size = [], 0
            part.append(c)
            size += len(c) + 1
        if part:
            known.update(self._index(part))
        out = [None if s is None else np.frombuffer(_joined(s, known), dtype=np.int32) for s in split]
        if len(known) > self.chunks_kept // 2:
            self.known, self.older = {}, known
        return out

    def decode(self, ids: np.ndarray) -> str:
        raw = _joined(ids.tolist(), self.bytes).decode("utf-8", "replace").replace(MARK, " ")
        return raw[1:] if raw[:1] == " " else raw


@lru_cache(maxsize=1)
def piece_model(path: str, chunks_kept: int = CHUNKS_KEPT, index_chars: int = INDEX_CHARS) -> PieceModel:
    """One for each worker process and file."""
    return PieceModel(path, chunks_kept, index_chars)


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def encode(
    docs: DataFrame, model: str, text_col: str = "text", batch_chars: int = BATCH_CHARS, round_trip: str | None = None, chunks_kept: int = CHUNKS_KEPT, index_chars: int = INDEX_CHARS
) -> tuple[DataFrame, str]:
    """docs with a column of piece ids, and that column's name.

    round_trip: the name of one more column, whether the ids decode to the text; the same worker decodes, so a task needs one.
    batch_chars, chunks_kept, index_chars: smaller ones take less memory and more time; the ids are the same.
    """
    name = fresh(docs.columns, "piece_ids")

    def make():
        m = piece_model(model, chunks_kept, index_chars)

        def fn(texts):
            arrays = [arrow(m.encode(held)) for held in _by_size(texts, batch_chars)]
            ids = pa.concat_arrays(arrays)
            if round_trip is None:
                return [ids]
            same = [not t.is_valid if not x.is_valid else m.decode(x.values.to_numpy()) == t.as_py() for t, x in zip(texts, ids, strict=True)]
            return [ids, pa.array(same, pa.bool_())]

        def arrow(ids):
            ends = np.concatenate([[0], np.cumsum([0 if i is None else len(i) for i in ids])])
            flat = np.concatenate([i for i in ids if i is not None] or [np.zeros(0, np.int32)])
            none = pa.array([i is None for i in ids])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()), mask=none)

        return fn

    fields = [StructField(name, ArrayType(IntegerType()))] + ([StructField(round_trip, BooleanType())] if round_trip else [])
    return append_columns(docs, [text_col], fields, make), name


def decode(rows: DataFrame, model: str, ids_col: str) -> tuple[DataFrame, str]:
    """rows with a column of texts decoded from ids, and that column's name."""
    name = fresh(rows.columns, "decoded")

    def make():
        m = piece_model(model)

        def fn(lists):
            return [pa.array([m.decode(x.values.to_numpy()) if x.is_valid else None for x in lists], pa.string())]

        return fn

    return append_columns(rows, [ids_col], [StructField(name, StringType())], make), name


def _by_size(texts: pa.Array, most: int) -> Iterator[list[str | None]]:
    """Lists of texts with about `most` characters each."""
    held, size = [], 0
    for t in texts:
        held.append(t.as_py())
        size += len(held[-1] or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers) and whether the ids decode to the text.

    The worker that encodes a text decodes its ids, so these never leave it.
    """
    slim = docs.select(id_col, text_col)
    names = [fresh(slim.columns, c) for c in ("n_tokens", "ids_crc32", "round_trip")]

    def make():
        m = piece_model(model)

        def fn(texts):
            n, crc, same = [], [], []
            for rows in _by_size(texts, BATCH_CHARS):
                for t, ids in zip(rows, m.encode(rows), strict=True):
                    n.append(0 if ids is None else len(ids))
                    crc.append(None if ids is None else zlib.crc32(ids.astype("<i4", copy=False).tobytes()))
                    same.append(t is None if ids is None else m.decode(ids) == t)
            return [pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]

        return fn

    out = append_columns(slim, [text_col], [StructField(names[0], LongType()), StructField(names[1], LongType()), StructField(names[2], BooleanType())], make)
    return out.select(id_col, *(F.col(c).alias(k) for c, k in zip(names, ("n_tokens", "ids_crc32", "round_trip"), strict=True)))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, round_trip of all documents."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), default_model())
