"""Edit-aware token counts: a segment tree over pre-token runs for each document.

A text is cut into leaves of LEAF characters or somewhat more, always between a character that is no white space and one that is: there
every pre-token ends, whatever stands around, so the leaves' token counts add up to the text's. The tree's nodes hold the sums of
characters and of tokens below them: a place is found, and a count of any prefix read, in the depth of the tree.

An edit replaces `n` characters at `at` by a text. Only the leaves that it touches are encoded again, and their neighbours while a cut beside
them is no longer a pre-token's end; the leaves' new numbers are added up along the paths to the root. A leaf that has grown to SPLIT leaves
is cut anew, which rebuilds the tree from the leaves' numbers without encoding any other leaf.

Edits apply in their order to what the ones before them left; places beyond the text's end mean its end, negative ones its start, null
edits nothing, a null replacement an empty text. A null text is an empty one with a tree of one empty leaf. Repeated rows are handled row by
row. An empty table has an empty result.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from .common import append_columns, fresh, table

LEAF, SPLIT = 256, 8
_CUT = re.compile(r"(?<=\S)[ \n\t]")


@lru_cache(maxsize=1)
def counter(path: str, pattern: str):
    """Counts the tokens of a text; one for each worker process and vocabulary file."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: len(encode(text))


def leaves_of(text: str) -> list[str]:
    """The text in runs that end where a pre-token ends."""
    out, at, n = [], 0, len(text)
    while n - at > LEAF:
        cut = _CUT.search(text, at + LEAF)
        if not cut:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


class Tree:
    """chars and tokens: sums of a complete binary tree, node k above 2k and 2k + 1, leaves from `size` on."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.leaves = len(chars)
        self.size = 1 << max(0, (self.leaves - 1).bit_length())
        self.chars, self.tokens = (np.concatenate([np.zeros(self.size, np.int64), x, np.zeros(self.size - self.leaves, np.int64)]) for x in (chars, tokens))
        for sums in (self.chars, self.tokens):
            lo = self.size // 2
            while lo:
                sums[lo : 2 * lo] = sums[2 * lo : 4 * lo : 2] + sums[2 * lo + 1 : 4 * lo : 2]
                lo //= 2

    @classmethod
    def of(cls, text: str, count) -> Tree:
        runs = leaves_of(text)
        return cls([len(r) for r in runs], [count(r) if r else 0 for r in runs])

    @classmethod
    def stored(cls, chars: list[int], tokens: list[int], leaves: int) -> Tree:
        """From the arrays as they are, without adding anything up."""
        tree = cls.__new__(cls)
        tree.chars, tree.tokens, tree.size, tree.leaves = np.array(chars, np.int64), np.array(tokens, np.int64), len(chars) // 2, leaves
        return tree

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character at `at` (the last leaf that has any, for the end) and where that leaf starts."""
        k, start = 1, 0
        at = min(at, self.n_chars - 1)
        while k < self.size:
            left = int(self.chars[2 * k])
            if at - start < left or not self.chars[2 * k + 1]:
                k = 2 * k
            else:
                start += left
                k = 2 * k + 1
        return k - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        k = leaf + self.size
        dc, dt = chars - self.chars[k], tokens - self.tokens[k]
        while k:
            self.chars[k] += dc
            self.tokens[k] += dt
            k //= 2

    def _leaf_chars(self, leaf: int) -> int:
        return int(self.chars[leaf + self.size])

    def edit(self, text: str, at: int, n: int, new: str, count) -> tuple[str, int, Tree]:
        """The edited text, how many characters were encoded again, and the tree (this one, or a new one where it had to grow)."""
        at = min(max(at, 0), len(text))
        n = min(max(n, 0), len(text) - at)
        out = text[:at] + new + text[at + n :]
        if not text:
            tree = Tree.of(out, count)
            return out, len(out), tree
        a, lo = self.find(max(at - 1, 0))
        b, start = self.find(min(at + n, len(text) - 1))
        hi = start + self._leaf_chars(b)
        grown = len(out) - len(text)
        # Cuts beside the region must still be ends of pre-tokens in the edited text.
        while lo > 0 and not _CUT.match(out, lo):
            a, lo = self.find(lo - 1)
        while hi < len(text) and not (hi + grown > 0 and _CUT.match(out, hi + grown)):
            b, start = self.find(hi)
            hi = start + self._leaf_chars(b)
        region = out[lo : hi + grown]
        if len(region) <= SPLIT * LEAF:
            self.put(a, len(region), count(region) if region else 0)
            for leaf in range(a + 1, b + 1):
                self.put(leaf, 0, 0)
            return out, len(region), self
        runs = leaves_of(region)
        base = self.size
        chars = [*self.chars[base : base + a].tolist(), *(len(r) for r in runs), *self.chars[base + b + 1 : base + self.leaves].tolist()]
        tokens = [*self.tokens[base : base + a].tolist(), *(count(r) for r in runs), *self.tokens[base + b + 1 : base + self.leaves].tolist()]
        return out, len(region), Tree(chars, tokens)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


_TREE = ("tree_chars", "tree_tokens", "tree_leaves")


def build_trees(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """docs with each text's tree, and the names of its three columns: node sums of characters, of tokens, and the number of leaves."""
    names = [fresh(docs.columns, c) for c in _TREE]

    def make():
        count = counter(path, pattern)

        def fn(texts):
            trees = [Tree.of(t.as_py() or "", count) for t in texts]
            return [pa.array([t.chars for t in trees], pa.list_(pa.int64())), pa.array([t.tokens for t in trees], pa.list_(pa.int64())), pa.array([t.leaves for t in trees], pa.int32())]

        return fn

    kinds = [ArrayType(LongType()), ArrayType(LongType()), IntegerType()]
    return append_columns(docs, [text_col], [StructField(c, k) for c, k in zip(names, kinds, strict=True)], make), names


def apply_edits(state: DataFrame, tree: list[str], edits_col: str, path: str, pattern: str, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """state with text and tree after the edits (array of struct<at, n, text>), and two more columns: the text before, and how many characters
    were encoded again. The second value names these two."""
    rest = [c for c in state.columns if c not in (text_col, *tree)]
    names = [fresh(state.columns, "text_before"), fresh(state.columns, "encoded_again")]
    moved = {c: fresh([*state.columns, *names], "_old_" + c) for c in (text_col, *tree)}
    old = state.select(*rest, *(F.col(c).alias(moved[c]) for c in (text_col, *tree)))

    def make():
        count = counter(path, pattern)

        def fn(texts, chars, tokens, leaves, edits):
            cols: list[list] = [[] for _ in range(5)]
            for t, c, k, n, e in zip(texts, chars, tokens, leaves, edits, strict=True):
                text, one, again = t.as_py() or "", Tree.stored(c.values.to_numpy(), k.values.to_numpy(), n.as_py()), 0
                for x in e.as_py() or ():
                    if x is not None and x["at"] is not None:
                        text, more, one = one.edit(text, x["at"], x["n"] or 0, x["text"] or "", count)
                        again += more
                for col, v in zip(cols, (text, one.chars, one.tokens, one.leaves, again), strict=True):
                    col.append(v)
            kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int64()]
            return [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]

        return fn

    kinds = [StringType(), ArrayType(LongType()), ArrayType(LongType()), IntegerType(), LongType()]
    fields = [StructField(c, k) for c, k in zip((text_col, *tree, names[1]), kinds, strict=True)]
    out = append_columns(old, [moved[c] for c in (text_col, *tree)] + [edits_col], fields, make)
    return out.withColumnRenamed(moved[text_col], names[0]).drop(*(moved[c] for c in tree)), names


def marking_edits(text: Column) -> Column:
    """The edits of the query: five characters at a third of the text are redacted, and a note goes in at two thirds of what results."""
    n = F.coalesce(F.length(text), F.lit(0))
    first = F.struct(F.floor(n / 3).cast("int").alias("at"), F.lit(5).alias("n"), F.lit("[redacted]").alias("text"))
    second = F.struct(F.floor((n + 5) * 2 / 3).cast("int").alias("at"), F.lit(0).alias("n"), F.lit(" (see note 12) ").alias("text"))
    return F.array(first, second)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, n_tokens_edited, n_chars_edited, n_encoded_again of all documents: counts by tree before and after two edits."""
    path, pattern = default_vocabulary()
    state, tree = build_trees(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    state = state.withColumn("n_tokens", F.element_at(tree[1], 2)).withColumn("edits", marking_edits(F.col("text")))
    edited, names = apply_edits(state, tree, "edits", path, pattern)
    return edited.select("doc_id", "n_tokens", F.element_at(tree[1], 2).alias("n_tokens_edited"), F.element_at(tree[0], 2).alias("n_chars_edited"), F.col(names[1]).alias("n_encoded_again"))
