"""Exact byte-level BPE by speculation: propose, verify, and merge only what fails.

For each new word a greedy longest match proposes tokens. A proposal is the
true encoding if every token is the encoding of its own bytes and no merge
crosses a border between neighbours. Whether a merge crosses the border of a
pair of tokens is decided from the merge ranks alone, for all pairs of a batch
at once: both tokens are undone merge by merge, the younger first, and at each
step a merge of the two parts that touch the border must not come before the
merges that absorb them. Words that fail are merged exactly.

Defined cases: null and empty texts have no ids and decode to the empty text;
a null doc_id stays null; repeated rows are kept; an empty table gives no rows;
other columns are ignored. Texts that hold an added token's content are cut
there, as the tokenizers library does. A text may be one word of any length:
merging takes time in proportion to n log n, and long words are not kept in the
worker's cache, which is bounded by words and characters.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import id_text, ready, slices
from feedlens.llm.tokens import CACHE_CHARS, CACHE_WORDS, LONG_WORD, byte_symbols, default_tokenizer, is_byte_level, split_words

_BITS = 24  # of an id
_ID = (1 << _BITS) - 1
_NONE = 1 << 60  # no merge
_NEVER = np.int64(_NONE)
#: Words of up to so many bytes are merged by scanning their pairs, longer ones by a heap.
SCANNED = 48


class Codec:
    """Encoding and decoding with one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not is_byte_level(spec):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        symbols = byte_symbols()
        as_bytes = lambda s: bytes(symbols[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        # the leftmost added token is cut out, of several the longest
        self.cut = (re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")
                    if self.added else None)
        self.tokens: list[bytes] = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        self.by_bytes: dict[bytes, int] = {}
        for s, i in vocab.items():
            if s not in self.added:
                self.tokens[i] = as_bytes(s)
                self.by_bytes[self.tokens[i]] = i
        for s, i in self.added.items():
            self.tokens[i] = s.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.byte_ids = [self.by_bytes.get(bytes([b]), 0) for b in range(256)]
        self.rank: dict[int, int] = {}  # by a pair of ids: rank of its merge and the id it makes
        size = len(self.tokens)
        self.born = np.full(size, -1, np.int64)  # rank of the merge that makes a token; -1 for a byte
        self.left, self.right = np.arange(size), np.arange(size)
        self.single = True  # each token has one merge that makes it
        for r, (x, y) in enumerate(merges):
            a, b, made = vocab[x], vocab[y], vocab[x + y]
            self.rank.setdefault(a << _BITS | b, r << _BITS | made)
            self.single &= self.born[made] < 0
            self.born[made], self.left[made], self.right[made] = r, a, b
        keys = np.array(list(self.rank), np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array(list(self.rank.values()), np.int64)[order] >> _BITS
        self.longest: dict[bytes, int] = {}  # of the tokens that begin with these two bytes
        for t in self.by_bytes:
            self.longest[t[:2]] = max(self.longest.get(t[:2], 0), len(t))
        self.own = np.full(size, -1, np.int8)  # 1: the token is the encoding of its bytes; -1: not known yet
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the words known before the last time there were too many
        self.chars = 0  # of the words known
        self.decimal = [b"%d" % i for i in range(size)]
        self.failed = self.seen = 0

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: again and again the pair of lowest rank, leftmost first."""
        if len(word) > SCANNED:
            return self.merge_long(word)
        ids, get = [self.byte_ids[b] for b in word], self.rank.get
        found = [get(a << _BITS | b, _NONE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != _NONE:
            i, made = found.index(best), best & _ID
            ids[i:i + 2] = [made]
            del found[i]
            if i < len(found):
                found[i] = get(made << _BITS | ids[i + 1], _NONE)
            if i:
                found[i - 1] = get(ids[i - 1] << _BITS | made, _NONE)
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """``merge`` with a heap of (rank, place) over a linked list: n log n for any word.

        Entries whose left part is gone or has another neighbour by now no longer
        have the rank they were pushed with and are passed over.
        """
        ids, get = [self.byte_ids[b] for b in word], self.rank.get
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places = n.bit_length()
        mask = (1 << places) - 1
        heap = [found << places | i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (found := get(a << _BITS | b)) is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, found = entry & mask, entry >> places
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << _BITS | ids[j]) != found:
                continue
            ids[i], ids[j] = made, _ = found & _ID, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := get(made << _BITS | ids[k])) is not None:
                    heappush(heap, new << places | i)
            h = before[i]
            if h >= 0 and (new := get(ids[h] << _BITS | made)) is not None:
                heappush(heap, new << places | h)
        return [i for i in ids if i >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        ids, at, n, get, longest = [], 0, len(word), self.by_bytes.get, self.longest.get
        while at < n:
            end = min(n, at + longest(word[at:at + 2], 1))
            while (i := get(word[at:end])) is None:
                end -= 1
            ids.append(i)
            at = end
        return ids

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether their border survives merging."""
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        absorbed_x = np.full(len(a), _NEVER)  # rank of the merge that takes the part up
        absorbed_y = np.full(len(a), _NEVER)
        while live.size:
            at = np.searchsorted(self.pair_keys, key := x << _BITS | y)
            at[at == self.pair_keys.size] = 0
            rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)
            # at equal rank the leftmost pair goes first
            crosses = (rank < absorbed_x) & (rank <= absorbed_y) & (rank < _NEVER)
            out[live[crosses]] = False
            undo_x = self.born[x] > self.born[y]
            goes_on = ~crosses & ((self.born[x] >= 0) | (self.born[y] >= 0))
            # two equal tokens: the left one is made first, so the right one is undone first
            absorbed_x = np.where(undo_x, self.born[x], absorbed_x)
            absorbed_y = np.where(undo_x, absorbed_y, self.born[y])
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            live, x, y, absorbed_x, absorbed_y = (v[goes_on] for v in (live, x, y, absorbed_x, absorbed_y))
        return out

    def self_encoded(self, ids: np.ndarray) -> np.ndarray:
        for i in np.unique(ids[self.own[ids] < 0]):
            self.own[i] = self.merge(self.tokens[i]) == [i]
        return self.own[ids] == 1

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, by proposing, checking and merging what fails."""
        raw = [w.encode() for w in words]
        if not self.single:
            return {w: array("I", self.merge(r)).tobytes() for w, r in zip(words, raw)}
        proposals = [self.propose(r) for r in raw]
        sizes = np.array([len(p) for p in proposals])
        flat = np.fromiter((i for p in proposals for i in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        wrong = np.zeros(len(words), bool)
        wrong[owner[~self.self_encoded(flat)]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[inner] << _BITS | flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs >> _BITS, pairs & _ID)[back]
        wrong[owner[inner[~good]]] = True
        self.seen += len(words)
        self.failed += int(wrong.sum())
        return {w: array("I", self.merge(r) if bad else p).tobytes()
                for w, r, p, bad in zip(words, raw, proposals, wrong.tolist())}

    def pieces(self, text: str) -> list[str | int]:
        """Words of the text, and ids of the added tokens in it."""
        if self.cut is None:
            return split_words(text)
        parts = self.cut.split(text)  # between two added tokens what stands between them
        out: list[str | int] = split_words(parts[0])
        for s, after in zip(parts[1::2], parts[2::2]):
            out.append(self.added[s])
            if after:
                out += split_words(after)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.known) > CACHE_WORDS // 2 or self.chars > CACHE_CHARS // 2:
            self.older, self.known, self.chars = self.known, {}, 0
        known, found, new, long = self.known, [], set(), set()
        for text in texts:
            words = self.pieces(text)
            ids, places, at = list(map(known.get, words)), [], -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                places.append((at, words[at]))
            for at, w in places:
                if w.__class__ is int:
                    ids[at] = w.to_bytes(4, "little")
                elif (old := self.older.get(w)) is not None:
                    ids[at] = known[w] = old
                    self.chars += len(w)
                else:
                    (long if len(w) > LONG_WORD else new).add(w)
            found.append((ids, places))
        if new := [w for w in new if w not in known]:
            known |= self.learn(new)
            self.chars += sum(map(len, new))
        once = self.learn(list(long)) if long else {}  # long words are not kept
        for ids, places in found:
            for at, w in places:
                if ids[at] is None:
                    ids[at] = known[w] if len(w) <= LONG_WORD else once[w]
        return [b"".join(ids) for ids, _ in found]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", errors="replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each document."""
    path = tokenizer or default_tokenizer()
    ready(docs.sparkSession)

    def run(batches):
        for part in slices(batches):
            ids = codec(path).encode(part["text"].to_pylist())
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.ListArray.from_arrays(pa.array(ends), values)],
                                             names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of rows of ids; a null array decodes to the empty text."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [codec(path).decode(x or []) for x in part["ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, "doc_id bigint, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document, encoded and decoded in one task."""
    path = tokenizer or default_tokenizer()
    ready(docs.sparkSession)

    def run(batches):
        for part in slices(batches):
            own = codec(path)
            counts, of_ids, of_text = [], [], []
            for raw in own.encode(part["text"].to_pylist()):
                ids = np.frombuffer(raw, "<u4").tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(b",".join(map(own.decimal.__getitem__, ids))).hexdigest())
                of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
