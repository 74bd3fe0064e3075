"""Readers of public tokenizer files that more than one operator uses."""

from __future__ import annotations

import json
import re

import numpy as np
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from shelfmark.llm.bpe import byte_letters

#: Runs of white space from this length on go to the ``tokenizers`` library: the pattern of the other needs
#: stack in proportion to the run.
LONG_SPACE = re.compile(r"\s{20000}")


class ByteBpe:
    """Ids of a byte-level BPE file (JSON of the ``tokenizers`` library), by the faster of two libraries.

    Where every merge makes the id that follows its rank, ``tiktoken`` gives the same ids for the same
    pattern; files of another form and texts with extremely long white space go to ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *special.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            if token not in special:
                self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self._plain, self._marked = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self._plain.encode_special_tokens = True
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        in_order = all(vocab[a + b] == 256 + rank for rank, (a, b) in enumerate(pairs))
        self._fast = None
        if in_order and spec["normalizer"] is None and not spec["pre_tokenizer"]["add_prefix_space"]:
            ranks = {self.bytes_of[i]: i for token, i in vocab.items() if token not in special}
            self._fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._special = set(special)

    def encode(self, text: str, marks: bool) -> np.ndarray:
        """Ids of ``text``; the strings of special tokens stand for these if ``marks``, else for themselves."""
        if self._fast is None or LONG_SPACE.search(text):
            return np.array((self._marked if marks else self._plain).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        allowed = self._special if marks else set()
        return self._fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())


#: Fixed value: how byte-level BPE cuts a text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SPACE_MARK = "▁"


class PieceBpe:
    """Ids of a SentencePiece file, and the bytes of its pieces (byte pieces are that byte)."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        self.bytes_of = [
            bytes([int(p[1:-1], 16)]) if self._model.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(self._model.id_to_piece(list(range(self.size))))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)
