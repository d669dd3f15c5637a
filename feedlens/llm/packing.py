"""Packing of documents into fixed windows by minimum bin slack.

Each task encodes its documents and packs them in groups of bounded size, so
nothing is shuffled. Whole windows of a long document are cut off first. What
is left of each document is one length in a multiset; a window takes the
largest length left and the subset of the others that comes closest to its
capacity, found by a subset-sum dynamic program on a bitset whose stages are
walked back into counts per length. The same counts fill further windows while
they last. If no subset reaches the capacity, a document is cut to close the
gap; the last window of a group is cut into powers of two, which need no padding.

Defined cases: a null or empty text is its end id alone; a null doc_id stays
null; repeated rows are packed as often as they occur; an empty table gives no
rows; other columns are ignored. The input must be readable again with the same
partitions (a table or files), since sequence ids are numbered by partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from feedlens.llm.common import id_text, ready, slices
from feedlens.llm.tokens import default_tokenizer, encoder

#: Tokens that are packed together; a task holds the ids of one group.
GROUP_TOKENS = 3_000_000
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
_FIELDS = [c.split() for c in SCHEMA.split(", ")]


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts per length whose sum is the largest that ``counts`` can reach within ``capacity``."""
    whole = (1 << (capacity + 1)) - 1
    reach, stages = 1, []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], capacity // length), 1
        while left > 0 and not reach >> capacity & 1:
            k = min(step, left)
            stages.append((length, k, reach))
            reach |= reach << length * k & whole
            left -= k
            step *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, k, before in reversed(stages):
        if not before >> total & 1:
            total -= length * k
            used[length] = used.get(length, 0) + k
    return used


class Group:
    """Documents packed together: pieces left over, by length."""

    def __init__(self, window: int, numbers: Iterator[int]):
        self.window, self.numbers = window, numbers
        self.docs: list[tuple[int | None, bytes]] = []
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n, at = len(ids) // 4, len(self.docs)
        self.docs.append((doc_id, ids))
        self.tokens += n
        whole = n - n % self.window
        for start in range(0, whole, self.window):
            self.place([(at, start, self.window)])
        if whole < n:
            self.left.setdefault(n - whole, []).append((at, whole))

    def place(self, pieces: list[tuple[int, int, int]]) -> None:
        sequence, offset = next(self.numbers), 0
        for at, start, length in pieces:
            doc_id, ids = self.docs[at]
            crc = zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])
            self.rows.append((doc_id, start, length, crc, len(ids) // 4, sequence, offset))
            offset += length

    def take(self, length: int) -> tuple[int, int, int]:
        pieces = self.left[length]
        at, start = pieces.pop()
        if not pieces:
            del self.left[length]
        return at, start, length

    def pack(self) -> list[tuple]:
        """Place everything left; the rows of all pieces."""
        while self.left:
            first = max(self.left)
            others = {n: len(p) for n, p in self.left.items()}
            others[first] -= 1
            if not others[first]:
                del others[first]
            used = best_fill(others, self.window - first)
            gap = self.window - first - sum(n * k for n, k in used.items())
            used[first] = used.get(first, 0) + 1
            times = min(len(self.left[n]) // k for n, k in used.items()) if not gap else 1
            for _ in range(times):
                pieces = [self.take(n) for n in sorted(used, reverse=True) for _ in range(used[n])]
                if gap and self.left:  # every other length is over the gap, or it would be in the window
                    at, start, n = self.take(max(self.left))
                    pieces.append((at, start, gap))
                    self.left.setdefault(n - gap, []).append((at, start + gap))
                    gap = 0
                if gap:
                    self.powers(pieces)
                else:
                    self.place(pieces)
        return self.rows

    def powers(self, pieces: list[tuple[int, int, int]]) -> None:
        """The last pieces, in sequences whose lengths are powers of two."""
        total = sum(n for _, _, n in pieces)
        pieces = pieces[::-1]
        for bit in reversed(range(total.bit_length())):
            room, taken = total & 1 << bit, []
            while room:
                at, start, n = pieces.pop()
                taken.append((at, start, min(n, room)))
                if n > room:
                    pieces.append((at, start + room, n - room))
                room -= taken[-1][2]
            if taken:
                self.place(taken)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=[n for n, _ in _FIELDS])


def pack(docs: DataFrame, window: int = 1024, tokenizer: str | None = None, end_id: int = 0,
         group_tokens: int = GROUP_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: document, place in it, sequence and offset there."""
    path = tokenizer or default_tokenizer()
    ready(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(batches):
        import itertools

        numbers = itertools.count(TaskContext.get().partitionId() << 40)
        group = Group(window, numbers)
        for part in slices(batches):
            for doc_id, ids in zip(part["doc_id"].to_pylist(), encoder(path).encode(part["text"].to_pylist())):
                group.add(doc_id, ids + end)
                if group.tokens >= group_tokens:
                    yield _table(group.pack())
                    group = Group(window, numbers)
        if group.docs:
            yield _table(group.pack())

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
