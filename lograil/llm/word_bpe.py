"""Encoding of whole batches with the tokenizers library, words that were met before from memory.

For texts of plain Latin characters the tokenizer's splitting rule is known exactly, so its words can be found here. Bytes are enough to cut
texts at white space, around digits and between letters and marks, where words always end; Arrow numbers the distinct chunks, each of them is
looked up once in a batch, and the texts' ids are gathered by number. A chunk of several words (apostrophes, marks beyond ASCII) is split by
the rule itself. Only words that are new are given to the library, joined by spaces and without the steps that they have behind them; the ids
of one word end with an end-of-word id. Any other text, and any that holds a special token's name, goes to the library whole. Both ways give
the same ids.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa

_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ſ–—‘’“”…€]*")
_LETTER, _NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
#: What the splitting rule above stands for; any other tokenizer file gets all texts whole.
_RULE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: And what has to follow it: bytes in place of characters, nothing else.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
#: Words held in memory: those met lately, and as many of the time before.
WORDS_KEPT = 1_000_000


_SPACE, _SMALL, _DIGIT, _MARK = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[list(b"\t\n\r ")] = _SPACE
_KIND[list(b"abcdefghijklmnopqrstuvwxyz")] = _SMALL
_KIND[list(b"0123456789")] = _DIGIT
_KIND[list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = _MARK
_KINDS = _KIND.tobytes()
#: Whether a byte of the second kind starts a chunk after one of the first, by 5 x first + second. 0 is any other byte.
_STARTS = bytes(b != _SPACE and (_SPACE in (a, b) or _DIGIT in (a, b) or {a, b} == {_SMALL, _MARK}) for a in range(5) for b in range(5)).ljust(256, b"\0")


def _chunks(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The chunks of all texts (plain characters, small letters), which are one word or more each, and the number of them before each text and the end."""
    raw = [t.encode() for t in texts]
    joined = b"\n" + b"\n".join(raw)
    data, kind = np.frombuffer(joined, dtype=np.uint8), np.frombuffer(bytearray(joined.translate(_KINDS)), dtype=np.uint8)
    wide = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))  # letters of two bytes, but for the signs of product and quotient
    wide = wide[(data[wide] != 0xC3) | ((data[wide + 1] != 0x97) & (data[wide + 1] != 0xB7))]
    kind[wide] = kind[wide + 1] = _SMALL
    start = np.frombuffer(b"\0" + (5 * kind[:-1] + kind[1:]).tobytes().translate(_STARTS), dtype=bool)
    kept = kind != _SPACE
    dense = data[kept]
    offsets = np.append(np.flatnonzero(start[kept]), len(dense)).astype(np.int32)
    before = np.searchsorted(np.flatnonzero(start), np.cumsum([0, *(len(r) + 1 for r in raw)]))
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(dense)), before


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        suffix = spec["model"].get("end_of_word_suffix")
        self.known = steps == ["NFC", "Replace", "Lowercase"] and len(cuts) == 2 and cuts[0].get("pattern", {}).get("Regex") == _RULE and _BYTES.items() <= cuts[1].items() and bool(suffix)
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        if self.known:
            for t, i in spec["model"]["vocab"].items():
                self.last[i] = t.endswith(suffix)
            # The same model for words that are in small letters and apart already.
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Puts new words' ids into the memory."""
        words = self.words
        for lo in range(0, len(new), 2000):
            part = new[lo : lo + 2000]
            ids = np.array(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            cut = np.flatnonzero(self.last[ids]) + 1
            if len(cut) == len(part):
                raw, at = ids.tobytes(), 0
                for w, end in zip(part, (4 * cut).tolist(), strict=True):
                    words[w] = raw[at:end]
                    at = end
            else:  # a word of which the model lacks a part
                words.update((w, e.tobytes()) for w, e in zip(part, self._whole(part), strict=True))

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        """The ids of each distinct chunk."""
        words, older = self.words, self.older
        out, split, new = list(map(words.get, chunks)), [], []
        for k, known in enumerate(out):
            if known is None:
                chunk = chunks[k]
                if chunk in older:
                    out[k] = words[chunk] = older[chunk]
                elif chunk.isalpha():
                    new.append(k)
                else:
                    split.append((k, _WORD.findall(chunk)))
        self._learn([chunks[k] for k in new])
        for k in new:
            out[k] = words[chunks[k]]
        rest = {w for _, parts in split for w in parts if w not in words}
        words.update((w, older[w]) for w in rest if w in older)
        self._learn([w for w in rest if w not in words])
        for k, parts in split:
            out[k] = b"".join([words[w] for w in parts])
        if len(words) > WORDS_KEPT // 2:
            self.words, self.older = {}, words
        return out

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts of plain characters in small letters."""
        chunks, before = _chunks(texts)
        coded = chunks.dictionary_encode()
        found = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # 32 bits do: no text has more ids than bytes.
        sizes, codes = np.fromiter(map(len, found), np.int32, len(found)) // 4, coded.indices.to_numpy()
        starts, n = np.cumsum(sizes, dtype=np.int32) - sizes, sizes[codes]
        ends = np.cumsum(n, dtype=np.int32)
        at = np.repeat(starts[codes] - ends + n, n)
        at += np.arange(len(at), dtype=np.int32)
        ids = np.frombuffer(b"".join(found), dtype=np.uint32)[at]
        cuts = np.concatenate([[0], ends])[before].tolist()
        return [ids[lo:hi] for lo, hi in pairwise(cuts)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain = [bool(self.known and _PLAIN.fullmatch(t)) and not any(s in t for s in self.special) for t in texts]
        whole = iter(self._whole([t for t, p in zip(texts, plain, strict=True) if not p]))
        words = iter(self._plain([t.lower() for t, p in zip(texts, plain, strict=True) if p]))
        return [next(words if p else whole) for p in plain]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)
