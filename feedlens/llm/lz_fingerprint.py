"""Lempel-Ziv phrase fingerprints: how much of one text's dictionary another one shares.

A text's UTF-8 bytes are cut into phrases, each the longest phrase seen before
plus one byte. The hashed set of phrases has a minimum-hash signature; the share
of equal places estimates the overlap of two dictionaries. The edited text of a
document shares the document's beginning, so the two are parsed together up to
the cut.

For the comparison with the next document, rows are dealt into ranges of doc_id
(those without id into ranges of their texts' first bytes) and sorted there;
each range also gets the first document of the range that follows it, one row
per range.

Defined cases: a null text counts as empty; an empty text's signature is its own
and resembles only empty texts; documents without doc_id come last, in the order
of their texts, like rows of equal doc_id; texts of any length are parsed
whole; a single document is its own next one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import id_text, ready, shuffle_partitions, slices, with_id_range

#: Places of a signature; each is kept as 16 bits.
PLACES = 128
_RNG = np.random.default_rng(78)
_FACTORS = _RNG.integers(0, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, PLACES, dtype=np.uint64)
_FULL = np.uint64(2**64 - 1)


def parse(data: bytes, at: int, limit: int, phrases: set[bytes], new: list[bytes]) -> int:
    """Add the phrases that end by ``limit`` to ``phrases`` and ``new``; returns where the next one begins.

    Every phrase's beginning is a phrase, so the longest known one is found by
    growing or shrinking the length that the last phrase had.
    """
    length = 4
    while at < limit:
        end = at + length
        if end <= limit and data[at:end] in phrases:
            end += 1
            while end <= limit and data[at:end] in phrases:
                end += 1
        else:
            if end > limit + 1:
                end = limit + 1
            while end > at + 1 and data[at:end - 1] not in phrases:
                end -= 1
        if end > limit:
            return at
        phrase = data[at:end]
        phrases.add(phrase)
        new.append(phrase)
        length = end - at
        at = end
    return at


def minima(phrases: list[bytes]) -> np.ndarray:
    """Minimum of each hash function over the phrases."""
    out = np.full(PLACES, _FULL)
    for i in range(0, len(phrases), 4096):
        part = phrases[i:i + 4096]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part), np.uint64, len(part))
        np.minimum(out, (h[:, None] * _FACTORS + _SHIFTS).min(axis=0), out=out)
    return out


def signature(least: np.ndarray) -> np.ndarray:
    return (least >> np.uint64(16)).astype(np.uint16)


def text_signature(text: str) -> np.ndarray:
    new: list[bytes] = []
    data = text.encode()
    parse(data, 0, len(data), set(), new)
    return signature(minima(new))


def both_signatures(text: str, edited: str, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of two texts whose first ``shared`` code points are the same."""
    a, b, cut = text.encode(), edited.encode(), len(text[:shared].encode())
    phrases: set[bytes] = set()
    head, tail, other = [], [], []
    at = parse(a, 0, cut, phrases, head)
    least = minima(head)
    parse(a, at, len(a), phrases, tail)
    if a == b:
        own = signature(np.minimum(least, minima(tail)))
        return own, own
    phrases.difference_update(tail)
    parse(b, at, len(b), phrases, other)
    return signature(np.minimum(least, minima(tail))), signature(np.minimum(least, minima(other)))


def hexadecimal(places: np.ndarray) -> str:
    return places.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edit(text: str, following: str) -> tuple[str, int]:
    """The text whose last third is replaced by the beginning of ``following``; how much it keeps."""
    third = len(text) // 3
    keep = len(text) - third
    return text[:keep] + following[:third], keep


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of each document, without a shuffle."""
    ready(docs.sparkSession)

    def run(batches):
        for part in slices(batches):
            made = [hexadecimal(text_signature(t)) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fingerprint string")


def _followers(ranged: DataFrame) -> DataFrame:
    """For each range the first document of the one after it (ids descending, then rows without id; after the last the first)."""
    spark = ranged.sparkSession
    heads = (ranged.groupBy("range_no").agg(F.max("doc_id").alias("head"), F.min("first_bytes").alias("first"))
             .collect())  # one row per range
    heads.sort(key=lambda r: (r["head"] is None, -(r["head"] or 0), r["range_no"]))
    pairs = [(a["range_no"], b["range_no"], b["head"], b["first"]) for a, b in zip(heads, [*heads[1:], *heads[:1]])]
    to = F.broadcast(spark.createDataFrame(pairs, "before int, after int, head bigint, first bigint"))  # one row per range
    wanted = ranged.join(to, (F.col("range_no") == F.col("after")) & F.col("doc_id").eqNullSafe(F.col("head"))
                         & F.col("first_bytes").eqNullSafe(F.col("first")))
    return wanted.groupBy("before").agg(F.min("text").alias("text")).select(
        F.lit(None).cast("long").alias("doc_id"), "text", F.col("before").alias("range_no"), F.lit(1).alias("extra"))


_SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_TYPES = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _rows(batches):
    fields = [f.split() for f in _SCHEMA.split(", ")]
    held = None  # (range, doc_id, text) that waits for its next document
    done = None  # its predecessor's row, which waits for this document's signature
    out = []
    for part in slices(batches):
        for range_no, extra, doc_id, text in zip(*(part[c].to_pylist() for c in ("range_no", "extra", "doc_id", "text"))):
            if held and held[0] == range_no:
                own_text = held[2]
                edited, keep = edit(own_text, text)
                own, changed = both_signatures(own_text, edited, keep)
                if done:
                    out.append((*done[0], likeness(done[1], own)))
                done = ((held[1], len(own_text), hashlib.sha256(edited.encode()).hexdigest(), hexadecimal(own),
                         hexadecimal(changed), likeness(own, changed)), own)
            if extra:
                out.append((*done[0], likeness(done[1], text_signature(text))))
                held = done = None
            else:
                held = (range_no, doc_id, text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*out), fields)],
                                             names=[n for n, _ in fields])
            out = []


def compare_edits(docs: DataFrame, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness to it and to the next one."""
    spark = docs.sparkSession
    ready(spark)
    table = id_text(docs, id_col, text_col)
    ranged, n = with_id_range(table, parts or shuffle_partitions(spark))
    rows = ranged.select("doc_id", "text", "range_no", F.lit(0).alias("extra"))
    return (rows.unionByName(_followers(ranged))
            .repartitionById(n, F.col("range_no"))
            .sortWithinPartitions("range_no", "extra", F.col("doc_id").desc_nulls_last(), "text")
            .mapInArrow(_rows, _SCHEMA))
