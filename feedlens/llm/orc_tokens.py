"""Token files in ORC: stripes of run-length encoded ids with row indexes and Bloom filters.

Documents are dealt into ranges of doc_id, so that file after file, and row
after row in a file, they stand in ascending order. A row holds the document's
ids and the number of ids before it in its file; the files' totals, one row
each, give the offsets. Readers split files at stripes; a filter on doc_id is
pushed to the stripe and row-group statistics and the Bloom filter.

Defined cases: a null or empty text is its end id alone; documents without
doc_id stand last; rows with equal doc_id follow each other in the order of
their texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.llm.common import id_text, ready, shuffle_partitions, slices, with_id_range
from feedlens.llm.tokens import default_tokenizer, encoder

FILE_SCHEMA = "doc_id bigint, part int, row_start bigint, n_tokens int, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0,
                 parts: int | None = None, stripe_bytes: int = 64 << 20, index_rows: int = 1000,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode documents, whole texts of any length, and write them to ORC files in ascending doc_id order."""
    spark = docs.sparkSession
    ready(spark)
    file, end = tokenizer or default_tokenizer(), end_id.to_bytes(4, "little")
    table = id_text(docs, id_col, text_col)
    ranged, n = with_id_range(table, parts or shuffle_partitions(spark))

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids = [x + end for x in encoder(file).encode(batch["text"].to_pylist())]
            sizes = [len(x) // 4 for x in ids]
            starts, ends = [], [0]
            for k in sizes:
                starts.append(before)
                before += k
                ends.append(ends[-1] + k)
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([part] * len(sizes), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                names=["doc_id", "part", "row_start", "n_tokens", "ids"])

    (ranged.repartitionById(n, F.col("range_no"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
     .select("doc_id", "text").mapInArrow(run, FILE_SCHEMA)
     .write.option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", index_rows).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before it), n_tokens, ids."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    # One row per file: the only unpartitioned window, over as many rows as there are files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("part_start") + F.col("row_start")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            ends = ids.offsets.to_pylist()
            data = memoryview(ids.values.buffers()[1] or b"").cast("B")
            skip = ids.values.offset
            crc = [zlib.crc32(data[4 * (skip + a):4 * (skip + b)]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
