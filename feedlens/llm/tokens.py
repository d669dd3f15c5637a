"""Document encoding with a tokenizer file, at the speed of a word cache.

A byte-level tokenizer cuts a text into words by a fixed pattern and encodes
each word by itself, so a worker gives each new word once to the tokenizers
library's BPE model and joins the stored ids. Tokenizer files of any other
kind, and texts that hold an added token's content, go through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

#: Fixed value: the word pattern of byte-level BPE tokenizers.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters below U+0250; a text that has no other character above U+007F can be cut by ``re``.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NARROW = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_PLAIN = re.compile(rf"[\x00-\x1b\x20-\x7f{_LETTERS}]*")
_WIDE = regex.compile(WORDS)
#: Words a worker remembers and their characters in all; the older half goes when there are more of either.
CACHE_WORDS, CACHE_CHARS = 1_000_000, 32_000_000
#: Words longer than this are not remembered.
LONG_WORD = 128


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def split_words(text: str) -> list[str]:
    """The words of a text under ``WORDS``."""
    return (_NARROW if _PLAIN.fullmatch(text) else _WIDE).findall(text)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def is_byte_level(spec: dict) -> bool:
    """True if the file encodes each word of ``WORDS`` by itself."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None and model.get("type") == "BPE" and not model.get("dropout"))


class DocumentEncoder:
    """ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.by_word = is_byte_level(spec)
        self.model = self.full.model
        self.symbols = str.maketrans({b: s for s, b in byte_symbols().items()})
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the words known before the last time there were too many
        self.chars = 0  # of the words known

    def whole(self, text: str) -> bytes:
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        """One word by the library's BPE model, which knows bytes by their printable symbols."""
        if (ids := self.older.get(word)) is not None:
            return ids
        plain = word.isascii() and word.isprintable()
        shown = word.replace(" ", "Ġ") if plain else word.encode().decode("latin-1").translate(self.symbols)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self.whole(t) for t in texts]
        if len(self.known) > CACHE_WORDS // 2 or self.chars > CACHE_CHARS // 2:
            self.older, self.known, self.chars = self.known, {}, 0
        known, word = self.known, self.word
        out = []
        for text in texts:
            if any(a in text for a in self.added):
                out.append(self.whole(text))
                continue
            words = split_words(text)
            ids, at = list(map(known.get, words)), -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                if (new := known.get(w := words[at])) is None:
                    new = word(w)
                    if len(w) <= LONG_WORD:
                        known[w] = new
                        self.chars += len(w)
                ids[at] = new
            out.append(b"".join(ids))
        return out


_ENCODERS: dict[str, DocumentEncoder] = {}


def encoder(path: str) -> DocumentEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = DocumentEncoder(path)
    return _ENCODERS[path]
