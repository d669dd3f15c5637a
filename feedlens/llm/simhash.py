"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints are linked at up to two differing bits. Equal fingerprints are
gathered first. Each distinct one is cut into three segments. With two errors
over three segments, one segment has none, and its neighbour has at most two:
then some word within one bit of both neighbours exists, and the codeword of the
(23, 12) Golay code nearest to it is shared. So the keys are, for each segment,
its exact value and the codeword indices of all words within one bit of the
next segment (one to six of them). Members of a key are verified in one small
group by their exact distance. A key with more members than that takes an exact
way without pairs: all words within one bit of each whole fingerprint, where two
fingerprints meet if and only if they differ in at most two bits.

Defined cases: null and empty texts, and texts of white space, have fingerprint
zero and are linked like any other; a text of fewer words than a shingle is one
shingle; of a text of any length all shingles count; a null doc_id is never a
component's smallest id unless it stands alone with others of that kind;
repeated rows are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import (BROADCAST_ROWS, SEED, id_text, intermediate_tables, ready, signed, slices, without,
                                 work_dir, written)
from feedlens.llm.components import connected_components

#: Fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the (23, 12) Golay code.
GENERATOR = 0b101011100011
#: Bits of the three segments (first bit, bits); each fits the code's 23.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a key that are compared with each other; larger keys take the way over middle words.
SMALL_KEY = 64


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bit majority of the XXH64 of all word shingles; zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (as a signed long) and text_hash (XXH64 of the text) of every document."""
    ready(docs.sparkSession)

    def run(batches):
        for part in slices(batches):
            texts = part["text"].to_pylist()
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            of_text = [signed(xxhash.xxh64_intdigest(t.encode(), SEED)) for t in texts]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(values.view(np.int64)), pa.array(of_text, pa.int64())],
                                             names=["doc_id", "fp", "text_hash"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint, text_hash bigint")


def golay_index() -> np.ndarray:
    """Index (0 to 4095) of the codeword nearest to each 23-bit word; the code is perfect."""
    words = np.arange(1 << 23, dtype=np.uint32)
    syndrome = words.copy()
    for bit in range(22, 10, -1):
        syndrome ^= np.where(syndrome >> bit & 1, np.uint32(GENERATOR << bit - 11), np.uint32(0))
    error = np.zeros(1 << 11, np.uint32)
    ones = [0, *(1 << i for i in range(23))]
    patterns = np.array(sorted({a | b | c for a in ones for b in ones for c in ones}, key=int.bit_count), np.uint32)
    error[syndrome[patterns]] = patterns
    return ((words ^ error[syndrome]) >> 11).astype(np.int16)


_INDEX: list[np.ndarray] = []


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) pairs of distinct keys: exact segment and codeword indices around the next one."""
    if not _INDEX:
        _INDEX.append(golay_index())
    parts = [(fps >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    where, keys = [], []
    for i in range(len(SEGMENTS)):
        j = (i + 1) % len(SEGMENTS)
        near = parts[j][:, None] ^ np.array([0, *(1 << b for b in range(SEGMENTS[j][1]))])
        index = np.sort(_INDEX[0][near].astype(np.int64), axis=1)
        new = np.ones(index.shape, bool)
        new[:, 1:] = index[:, 1:] != index[:, :-1]
        row, col = np.nonzero(new)
        where.append(row)
        keys.append(i << 40 | parts[i][row] << 12 | index[row, col])
    return np.concatenate(where), np.concatenate(keys)


def _key_rows(batches):
    for batch in batches:
        fps = batch["fp"].to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4096):
            part = fps[at:at + 4096]
            where, keys = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[where])], names=["key", "fp"])


def _verify(bits: int):
    """Links inside small groups, compared pair by pair; a spanning forest of them is enough."""

    def run(batches):
        for batch in batches:
            a, b = [], []
            for group in batch["fps"].to_pylist():
                x = np.unique(np.array(group, np.int64)).view(np.uint64)
                near = np.bitwise_count(x[:, None] ^ x[None, :]) <= bits
                todo = set(range(len(x)))
                while todo:
                    front = [todo.pop()]
                    while front:
                        i = front.pop()
                        for j in [j for j in np.flatnonzero(near[i]).tolist() if j in todo]:
                            todo.discard(j)
                            front.append(j)
                            a.append(int(x[i].view(np.int64)))
                            b.append(int(x[j].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def links(distinct: DataFrame, small_key: int = SMALL_KEY) -> DataFrame:
    """Links (a, b) that connect all fingerprints within two bits; ``distinct`` holds each once."""
    spark = distinct.sparkSession
    folder = work_dir(spark, "simhash-keys")
    keys = written(distinct.select("fp").mapInArrow(_key_rows, "key bigint, fp bigint"), f"{folder}/all")
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keys.join(counts, "key"), f"{folder}/shared")
    small = (shared.where(F.col("n") <= small_key).groupBy("key").agg(F.collect_list("fp").alias("fps"))
             .mapInArrow(_verify(2), "a bigint, b bigint"))
    flips = [F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64))]
    middle = (shared.where(F.col("n") > small_key).select("fp").distinct()
              .select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(m) for m in flips])).alias("middle")))
    stars = middle.groupBy("middle").agg(F.min("fp").alias("centre"), F.count("*").alias("n")).where("n > 1")
    large = middle.join(stars, "middle").where("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    return small.unionByName(large)


def classes(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
            small_key: int = SMALL_KEY) -> DataFrame:
    """doc_id, fp, text_hash, component_id and root (a fingerprint of the component) of every document."""
    spark = docs.sparkSession
    folder = work_dir(spark, "simhash")
    table = written(fingerprints(docs, shingle, id_col, text_col), f"{folder}/fingerprints")
    distinct = written(table.groupBy("fp").agg(F.min("doc_id").alias("least_id")), f"{folder}/distinct")
    with intermediate_tables(spark):
        found = written(connected_components(links(distinct, small_key)), f"{folder}/roots")
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return table.join(rooted.join(least, "root").select("fp", "component_id", "root"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                    small_key: int = SMALL_KEY) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    return classes(docs, shingle, id_col, text_col, small_key).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the smallest doc_id (then text hash; null ids last); columns as before."""
    spark = docs.sparkSession
    folder = work_dir(spark, "simhash-dropped")
    with intermediate_tables(spark):
        dropped = written(_others(docs, shingle, id_col, text_col), folder)
    return without(docs, dropped, id_col, text_col)


def _others(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, repeated) of the rows that do not stay; ``repeated`` ones equal a row that does."""
    spark = docs.sparkSession
    found = written(classes(docs, shingle, id_col, text_col), work_dir(spark, "simhash-classes"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = written(found.groupBy("root").agg(F.min(place).alias("best"), F.count("*").alias("n")).where("n > 1"),
                   work_dir(spark, "simhash-best"))
    same = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    others = found.join(F.broadcast(best) if best.count() <= BROADCAST_ROWS else best, "root").select("doc_id", "text_hash", same.alias("repeated"))
    kept_once = others.where("repeated").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    return others.where("not repeated").unionByName(
        kept_once.select("doc_id", "text_hash", F.lit(True).alias("repeated")))
