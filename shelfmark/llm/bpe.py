"""Byte-pair encoding and decoding over a contiguous rank array.

A word is a row of parts beside a row of the ranks of adjacent parts. The least rank is found by a
scan, the boundary behind it deleted, and the two neighbouring ranks looked up anew, until no pair
has a rank. Short words of a batch that have the same length are rows of one pair of arrays, so a
scan is one pass over contiguous memory; very long words keep their boundaries in a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_RANK = np.int32(2**31 - 1)
#: Bytes of a word up to which its ranks are scanned; longer ones use a heap.
SHORT = 96
#: Words whose ids a Python worker keeps.
CACHED = 200_000
# The letters and numbers of the first 256 code points, after lower-casing.
_LATIN_CLASSES = {r"\p{L}": "a-zªµºß-öø-ÿ", r"\p{N}": "0-9²³¹¼-¾"}

# Fixed value: white space of the first 256 code points; the module re would add U+001C to U+001F.
_LATIN_SPACE = r"\x09-\x0d\x20\x85\xa0"


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordBpe:
    """The encoder of one vocabulary file (JSON of the ``tokenizers`` library: BPE with an end-of-word suffix)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = dict(zip(vocab.values(), vocab.keys(), strict=True)) | {i: t for t, i in self.special.items()}
        self._split_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        for name, members in _LATIN_CLASSES.items():
            pattern = pattern.replace(name, members)
        self._latin = re.compile(pattern.replace(r"[^\s", f"[^{_LATIN_SPACE}"))
        letters = byte_letters()
        self._inner = np.array([vocab[c] for c in letters], dtype=np.int32)
        self._last = np.array([vocab[c + end] for c in letters], dtype=np.int32)
        left, right, made = [], [], []
        for rank, (a, b) in enumerate(model["merges"]):
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        self._base = 1 << 17
        keys = np.array(left, dtype=np.int64) * self._base + np.array(right, dtype=np.int64)
        # An open-addressing table of pair keys: a lookup is a few gathers for a whole array.
        self._bits = 20
        self._keys = np.full(1 << self._bits, -1, dtype=np.int64)
        self._ranks = np.full(1 << self._bits, NO_RANK, dtype=np.int32)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), strict=True)):
            while self._keys[slot] != -1 and self._keys[slot] != key:
                slot = (slot + 1) & ((1 << self._bits) - 1)
            if self._keys[slot] == -1:
                self._keys[slot], self._ranks[slot] = key, rank
        self._made = np.array([*made, -1], dtype=np.int32)
        self._packed_special = {t: np.int32(i).tobytes() for t, i in self.special.items()}
        self.cache = dict(self._packed_special)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NO_RANK`` where a part is absent (-1) or no merge joins them."""
        keys = left.astype(np.int64) * self._base + right
        slots = self._slot(keys)
        there = self._keys[slots]
        ranks = np.where(there == keys, self._ranks[slots], NO_RANK)
        todo = np.flatnonzero((there != keys) & (there != -1))
        while todo.size:
            slots[todo] = (slots[todo] + 1) & ((1 << self._bits) - 1)
            there = self._keys[slots[todo]]
            hit = there == keys[todo]
            ranks[todo[hit]] = self._ranks[slots[todo[hit]]]
            todo = todo[~hit & (there != -1)]
        return np.where((left < 0) | (right < 0), NO_RANK, ranks)

    def _encode_rows(self, parts: np.ndarray) -> list[bytes]:
        """Words of one length as rows of parts."""
        n, width = parts.shape
        out = [b""] * n

        def finish(rows: np.ndarray, parts: np.ndarray) -> None:
            packed, step = parts.tobytes(), parts.shape[1] * parts.itemsize
            for i, r in enumerate(rows.tolist()):
                out[r] = packed[i * step : (i + 1) * step]

        rows = np.arange(n)
        ranks = self._rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(n, width - 1)
        while width > 1:
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            done = least == NO_RANK
            if done.any():
                finish(rows[done], parts[done])
                keep = ~done
                rows, parts, ranks, at, least = rows[keep], parts[keep], ranks[keep], at[keep], least[keep]
            if not len(rows):
                return out
            line = np.arange(len(rows))
            parts[line, at] = self._made[least]
            width -= 1
            # Delete boundary at + 1: later parts move up by one; so do the ranks behind the merged pair.
            behind = np.arange(width)[None, :] > at[:, None]
            parts = np.where(behind, parts[:, 1:], parts[:, :-1])
            if width == 1:
                break
            gone = np.arange(width - 1)[None, :] >= at[:, None]
            ranks = np.where(gone, ranks[:, 1:], ranks[:, :-1])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self._rank(parts[before, at[before] - 1], parts[before, at[before]])
            after = np.flatnonzero(at < width - 1)
            ranks[after, at[after]] = self._rank(parts[after, at[after]], parts[after, at[after] + 1])
        finish(rows, parts)
        return out

    def _encode_long(self, parts: list[int]) -> list[int]:
        """One very long word: the same merges, boundaries in a linked list, ranks in a heap."""
        n = len(parts)
        nxt, prv, live = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        first = self._rank(np.array(parts[:-1]), np.array(parts[1:])).tolist()
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(i: int) -> None:
            j = nxt[i]
            if i >= 0 and j >= 0:
                pair = (parts[i], parts[j])
                if pair not in known:
                    known[pair] = int(self._rank(np.array([pair[0]]), np.array([pair[1]]))[0])
                if known[pair] != NO_RANK:
                    heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not live[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], live[j] = int(self._made[rank]), False
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prv[nxt[i]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return [p for p, a in zip(parts, live, strict=True) if a]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, packed as 32-bit integers."""
        coded = [w.encode() for w in words]
        out: dict[str, bytes] = {}
        by_length: dict[int, list[int]] = {}
        for i, c in enumerate(coded):
            by_length.setdefault(len(c), []).append(i)
        for length, which in by_length.items():
            flat = np.frombuffer(b"".join(coded[i] for i in which), dtype=np.uint8).reshape(len(which), length)
            parts = self._inner[flat]
            parts[:, -1] = self._last[flat[:, -1]]
            if length <= SHORT:
                rows = self._encode_rows(parts)
            else:
                rows = [np.array(self._encode_long(p), dtype=np.int32).tobytes() for p in parts.tolist()]
            out.update(zip((words[i] for i in which), rows, strict=True))
        return out

    def _pieces(self, text: str) -> list[str]:
        """Words in order, and special tokens of the raw text (no word of the pattern equals one)."""
        out: list[str] = []
        at = 0
        for m in self._split_special.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._plain(text[at:]) if at else self._plain(text)

    def _plain(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        # Each letter is lower-cased by itself, so a sigma at a word's end is as any other. White
        # space needs no folding: it parts words however much of it there is.
        lowered = text.replace("Σ", "σ").lower()
        return (self._latin if _is_latin(lowered) else self._words).findall(lowered)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; words met before come from the worker's bounded cache."""
        split = [self._pieces(t) for t in texts]
        words = set(chain.from_iterable(split))
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHED:
            self.cache = dict(self._packed_special)
            new = [w for w in words if w not in self.cache]
        self.cache.update(self.encode_words(new))
        find = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(find, pieces)), dtype=np.int32) for pieces in split]

    def decode(self, ids: list[int]) -> str:
        """The tokens as the vocabulary writes them, with single spaces between them."""
        return " ".join(map(self.tokens.__getitem__, ids))


_loaded: dict[str, WordBpe] = {}
_names: dict[str, pa.Array] = {}


def encoder(path: str) -> WordBpe:
    """The encoder of a file, once for each Python process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def token_names(path: str) -> pa.Array:
    """The tokens of a file by their ids, once for each Python process; all that decoding needs."""
    if path not in _names:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        _names[path] = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], type=pa.string())
    return _names[path]


#: Rows decoded at once.
DECODED_ROWS = 256
#: Characters encoded at once at most, but for a single longer text; bounds a task's memory.
BATCH_CHARS = 1_000_000


def encode_texts(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)`` for every row: the ids of its whole text as ``array<int>``.

    NULL and empty texts, and texts of white space only, have no ids. NULL keys and repeated rows are
    kept, other columns are not read; an empty table gives no rows. ``path`` is the vocabulary file,
    which every executor can read.
    """
    source = documents.select(F.col(key), F.col(text).alias("__text"))
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            start = 0
            while start < len(lengths):
                stop, chars = start, 0
                while stop < len(lengths) and (stop == start or chars + lengths[stop] <= BATCH_CHARS):
                    chars += lengths[stop]
                    stop += 1
                ids = bpe.encode([t or "" for t in texts.slice(start, stop - start).to_pylist()])
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids), type=pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([keys.slice(start, stop - start), lists], names=[key, "ids"])
                start = stop

    return source.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode_ids(ids: str | Column, path: str) -> Column:
    """The text of a column of ids; NULL for NULL."""

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        names = token_names(path)
        out = []
        for start in range(0, len(column), DECODED_ROWS):  # a few at a time, so that their tokens take little room
            some = column.slice(start, DECODED_ROWS)
            offsets = np.cumsum([0, *pc.fill_null(pc.list_value_length(some), 0).to_pylist()]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), names.take(some.flatten()), mask=some.is_null())
            out.append(pc.binary_join(tokens, " "))
        return pa.concat_arrays(out) if out else pa.array([], type=pa.string())

    return decoded(ids)


def ids_digest(ids: str | Column) -> Column:
    """SHA-256 of ids as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("string")
    def digest(column: pd.Series) -> pd.Series:
        return column.map(lambda x: hashlib.sha256(np.asarray(x, dtype="<u4").tobytes()).hexdigest())

    return digest(ids)
