"""Exact de-duplication by compressed radix tries over whole normalised texts.

Every task first gathers its own documents in a trie of bounded size, so that a
text repeated by a third of all rows leaves each task once. These texts go, by
length and content hash, to owner tasks, which insert the full byte strings
into a trie of their own; a terminal node keeps the row that stays and the size
of the group. An owner over its byte bound moves its largest subtree to a file
of the task and ends it in a trie of its own afterwards. A text that very many
tasks send on is first merged by owners of a share of its copies each, as many as
the square root of their number, so that no owner meets them all. Member rows then look
up their group by the number their first task gave it.

Defined cases: a null text counts as empty, and empty texts are equal; of equal
texts the longest original, then the smallest doc_id (null last), then the
first row read stays; of rows repeated with the same doc_id one is kept; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import (BROADCAST_ROWS, SEED, id_text, intermediate_tables, ready, signed, slices, without,
                                 work_dir, written)

#: Fixed value: the characters left out before texts are compared.
SPACE = b" \t\n\x0b\x0c\r"
#: Bytes of text in a task's trie before it sends them on (first tasks) or spills a subtree (owners).
TRIE_BYTES = 24 << 20
#: Copies of a text from which on they are merged in two steps.
HOT_COPIES = 64

_LOCAL = ("group_no bigint, row_no bigint, doc_id bigint, n_chars bigint, is_text boolean, n_rows bigint, "
          "text_hash bigint, length bigint, content_hash bigint, body binary")
_OWNED = "group_no bigint, keep_row bigint, keep_id bigint, group_size bigint, text_sha256 string"


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value = label, {}, value


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Byte strings to values; bounded by ``most`` bytes of labels if a spill file may be used."""

    def __init__(self, most: int | None = None):
        self.root, self.bytes, self.most, self.depth = Node(b""), 0, most, 0
        self.spilled: dict[int, tempfile._TemporaryFileWrapper] = {}

    def insert(self, key: bytes, value, merge: Callable):
        """Store ``value`` at ``key``, or ``merge(old, value)`` if there is one; returns what the node holds."""
        node, at = self.root, 0
        if self.spilled and len(key) > self.depth and (f := self.spilled.get(key[self.depth])):
            pickle.dump((key, value), f)
            return None
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                self.grow(len(key) - at)
                return value
            if not key.startswith(child.label, at):
                k = common_prefix(child.label, key[at:])
                upper = Node(child.label[:k])
                child.label = child.label[k:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = child = upper
            node = child
            at += len(child.label)
        node.value = value if node.value is None else merge(node.value, value)
        return node.value

    def grow(self, n: int) -> None:
        self.bytes += n + 200
        if self.most and self.bytes > self.most and self.root.children:
            self.spill()

    def subtree(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        todo = [(node, prefix)]
        while todo:
            node, prefix = todo.pop()
            key = prefix + node.label
            if node.value is not None:
                yield key, node.value
            todo += [(c, key) for c in node.children.values()]

    def shared(self) -> int:
        """Length of what all strings of the trie begin with."""
        node, n = self.root, 0
        while len(node.children) == 1 and node.value is None:
            (node,) = node.children.values()
            n += len(node.label)
        return n

    def spill(self) -> None:
        """Move the heaviest branch at the first fork to a file; later strings of that branch follow it."""
        if not self.spilled:
            self.depth = self.shared()
        weights: dict[int, int] = {}
        for key, _ in self.subtree(self.root, b""):
            if len(key) > self.depth:
                weights[key[self.depth]] = weights.get(key[self.depth], 0) + len(key)
        if not weights:
            return
        worst, rest = max(weights, key=weights.get), RadixTrie()
        f = self.spilled[worst] = tempfile.TemporaryFile()
        for key, value in self.subtree(self.root, b""):
            if len(key) > self.depth and key[self.depth] == worst:
                pickle.dump((key, value), f)
            else:
                rest.insert(key, value, _later)
        self.root, self.bytes = rest.root, rest.bytes

    def items(self, merge: Callable) -> Iterator[tuple[bytes, object]]:
        """All strings and values, one spilled subtree after the other."""
        yield from self.subtree(self.root, b"")
        self.root = Node(b"")
        for f in self.spilled.values():
            below = RadixTrie(self.most)
            f.seek(0)
            while True:
                try:
                    key, value = pickle.load(f)
                except EOFError:
                    break
                below.insert(key, value, merge)
            f.close()
            yield from below.items(merge)


def _later(old, new):
    return new


def _rank(n_chars: int, doc_id: int | None, row_no: int) -> tuple:
    return -n_chars, doc_id is None, doc_id or 0, row_no


def _gather(trie_bytes: int):
    """First pass: member rows, and each distinct text of the task with its best row and count."""

    def texts(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for body, (group_no, best, n) in trie.subtree(trie.root, b""):
            neg, _, _, row_no = best[0]
            rows.append((group_no, row_no, best[1], -neg, True, n, None, len(body), xxhash.xxh3_64_intdigest(body) - 2**63, body))
            held += len(body)
            if held > 4 << 20:
                yield _batch(rows, _LOCAL)
                rows, held = [], 0
        if rows:
            yield _batch(rows, _LOCAL)

    def run(batches):
        base = TaskContext.get().partitionId() << 36
        group_no = row_no = base
        trie = RadixTrie()
        for part in slices(batches):
            members = []
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                raw = text.encode()
                body = raw.translate(None, SPACE)
                value = (group_no, (_rank(len(text), doc_id, row_no), doc_id), 1)
                number = trie.insert(body, value, _merge_local)[0]  # the first of a text has given it
                group_no += number == group_no
                members.append((number, row_no, doc_id, len(text), False, 1, signed(xxhash.xxh64_intdigest(raw, SEED)),
                                None, None, None))
                row_no += 1
            yield _batch(members, _LOCAL)
            if trie.bytes > trie_bytes:
                yield from texts(trie)
                trie = RadixTrie()
        yield from texts(trie)

    return run


def _merge_local(old: tuple, new: tuple) -> tuple:
    return old[0], min(old[1], new[1], key=lambda b: b[0]), old[2] + new[2]


def _merge_owned(old: tuple, new: tuple) -> tuple:
    old[2].extend(new[2])
    return min(old[0], new[0], key=lambda b: b[0]), old[1] + new[1], old[2]


def _merged(batches, trie_bytes: int) -> Iterator[tuple[bytes, tuple]]:
    """Each distinct text of text rows with its best row, number of rows and the numbers of its groups."""
    trie = RadixTrie(trie_bytes)
    for part in slices(batches, "body"):
        for group_no, row_no, doc_id, n_chars, n, body in zip(*(part[c].to_pylist() for c in (
                "group_no", "row_no", "doc_id", "n_chars", "n_rows", "body"))):
            trie.insert(body, ((_rank(n_chars, doc_id, row_no), doc_id), n, [group_no]), _merge_owned)
    yield from trie.items(_merge_owned)


def _batches(rows: Iterator[tuple], schema: str, most: int) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, most)):
        yield _batch(part, schema)


def _own(trie_bytes: int):
    """Last pass: one trie for the texts of a length-and-hash partition."""

    def run(batches):
        def rows():
            for body, (best, n, numbers) in _merged(batches, trie_bytes):
                sha = hashlib.sha256(body).hexdigest()
                yield from ((g, best[0][3], best[1], n, sha) for g in numbers)
        yield from _batches(rows(), _OWNED, 5000)

    return run


def _own_share(trie_bytes: int):
    """For a share of the copies of hot texts: a text row of each, and for each of its groups (group_no) the one it became (row_no)."""

    def run(batches):
        for body, (best, n, numbers) in _merged(batches, trie_bytes):
            neg, _, _, row_no = best[0]
            yield _batch([(numbers[0], row_no, best[1], -neg, True, n, None, len(body),
                           xxhash.xxh3_64_intdigest(body) - 2**63, body)], _LOCAL)
            yield from _batches(((g, numbers[0], None, None, False, None, None, None, None, None) for g in numbers), _LOCAL, 5000)

    return run


_TYPES = {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*rows), fields)],
                                      names=[n for n, _ in fields])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                trie_bytes: int = TRIE_BYTES, hot_copies: int = HOT_COPIES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chars, text_hash (XXH64 of the text)."""
    spark = docs.sparkSession
    ready(spark)
    local = written(id_text(docs, id_col, text_col).mapInArrow(_gather(trie_bytes), _LOCAL), work_dir(spark, "dedup"))
    columns = ["group_no", "row_no", "doc_id", "n_chars", "n_rows", "length", "content_hash", "body"]
    key = ["length", "content_hash"]
    texts = local.where("is_text").select(columns)
    hot = written(texts.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > hot_copies),
                  work_dir(spark, "dedup-hot"))
    n_hot, parts = hot.count(), None
    if n_hot:
        told = texts.join(F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot, key, "left")
        share = F.pmod(F.xxhash64("group_no"), F.ceil(F.sqrt("copies")))
        parts = written(told.where("copies is not null").withColumn("share", share).repartition(*key, "share")
                        .select(columns).mapInArrow(_own_share(trie_bytes), _LOCAL), work_dir(spark, "dedup-shares"))
        texts = told.where("copies is null").select(columns).unionByName(parts.where("is_text").select(columns))
    owned = texts.repartition(*key).mapInArrow(_own(trie_bytes), _OWNED)
    if parts is not None:
        owned = written(owned, work_dir(spark, "dedup-owned"))
        became = parts.where("not is_text").select(F.col("group_no").alias("own_no"), F.col("row_no").alias("group_no"))
        # a group that a share kept is among the groups that became it
        joined = became.join(owned, "group_no").drop("group_no").withColumnRenamed("own_no", "group_no")
        owned = owned.join(became.select("group_no").distinct(), "group_no", "left_anti").unionByName(joined)
    members = local.where("not is_text").select("group_no", "row_no", "doc_id", "n_chars", "text_hash")
    return members.join(owned, "group_no").select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), "text_sha256", "n_chars",
        "text_hash")


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``exact_dedup`` keeps; columns as before."""
    folder = work_dir(docs.sparkSession, "dedup-dropped")
    with intermediate_tables(docs.sparkSession):
        decided = written(exact_dedup(docs, id_col, text_col).where("not kept").select(
            "doc_id", "text_hash", (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("repeated")), folder)
    return without(docs, decided, id_col, text_col)
