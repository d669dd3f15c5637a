"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from feedlens.session import ensure_checkpoint_dir

#: The seed of Spark's xxhash64, which makes hashes on both sides agree.
SEED = 42
#: A table of so many (doc_id, text_hash) rows at most may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of the documents; a null text counts as empty, other columns are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def ready(spark: SparkSession) -> None:
    """What tasks with Python code need: this package on the workers' path, and batches of bounded size.

    On a cluster the package is shipped with the job; the path added here serves
    sessions that imported it from a source folder. Batch bounds that the session
    has chosen itself are left alone.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "", "-1", str(2**63 - 1), str(2**31 - 1)):
        spark.conf.set(key, str(16 << 20))
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


#: The folder of the innermost ``intermediate_tables``.
_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run of an operator, below the shared checkpoint folder."""
    return f"{_SCOPE.get() or ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that operators write in this scope are removed at its end, also after an error.

    Results are computed when they are read, from those tables: write a result
    that is to outlive the scope to a folder made outside it. Scopes may be
    nested; another thread's operators are not affected.
    """
    folder = work_dir(spark, "intermediate")
    outer = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(outer)
        removed(spark, folder)


def removed(spark: SparkSession, path: str) -> bool:
    """Remove a folder of shared storage that is no longer read; whether there was one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table to shared storage and read it back: later steps start from the files."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = [n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()]
        begin, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def hash_mod(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null for null."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def range_cuts(df: DataFrame, column: str, parts: int) -> list[float]:
    """Inner borders that deal the column's values into at most ``parts`` ranges.

    Only this column is read; the result holds ``parts`` numbers at most.
    """
    if parts < 2:
        return []
    probs = [i / parts for i in range(1, parts)]
    cuts = df.select(F.col(column).cast("double").alias("v")).approxQuantile("v", probs, 0.25 / parts)
    return sorted(set(cuts))


def with_range(df: DataFrame, column: str, cuts: list[float], out: str) -> DataFrame:
    """Add the range number of ``column`` (nulls: the last one)."""
    wide, number = f"{out}_value", f"{out}_no"
    df = df.withColumn(wide, F.col(column).cast("double"))
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        df = Bucketizer(splits=splits, inputCol=wide, outputCol=number, handleInvalid="keep").transform(df)
    else:
        df = df.withColumn(number, F.lit(0.0))
    last = F.lit(len(cuts) + 1)
    return df.withColumn(out, F.when(F.col(wide).isNull(), last).otherwise(F.col(number).cast("int"))).drop(wide, number)


def with_id_range(table: DataFrame, parts: int, out: str = "range_no") -> tuple[DataFrame, int]:
    """Deal (doc_id, text) into about ``parts`` ranges of doc_id; also the number of ranges.

    Rows without id come last, in as many ranges of their texts' first bytes as
    their share of the rows asks for, whose borders are in the column
    ``first_bytes`` (null for rows with an id).
    """
    cuts = range_cuts(table, "doc_id", parts)
    rows = table.agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    if not rows["nulls"]:
        return with_range(table, "doc_id", cuts, out).withColumn("first_bytes", F.lit(None).cast("long")), len(cuts) + 2
    first = F.conv(F.rpad(F.hex(F.substring(F.encode("text", "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("long")
    table = table.withColumn("first_bytes", F.when(F.col("doc_id").isNull(), first))
    null_cuts = range_cuts(table.where("doc_id is null"), "first_bytes", rows["nulls"] * parts // rows["n"])
    table = with_range(with_range(table, "doc_id", cuts, out), "first_bytes", null_cuts, "null_no")
    number = F.when(F.col("doc_id").isNull(), F.col(out) + F.col("null_no")).otherwise(F.col(out))
    return table.withColumn(out, number).drop("null_no"), len(cuts) + 2 + len(null_cuts)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until no column of the table has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def with_text_scores(df: DataFrame, compute: Callable[[list[str | None]], dict[str, list]], fields: dict[str, str],
                     text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """Append columns that depend on the text alone, in one pass without a shuffle.

    ``compute`` gets the texts of a slice (nulls stay) and returns the new columns; ``fields``
    has their types. Also returns the names they were given, which clash with no column.
    """
    names = {}
    for f in fields:
        names[f] = free_name(df, f)
    ready(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *(T.StructField(names[f], T._parse_datatype_string(t))
                                                for f, t in fields.items())])
    types = {f: to_arrow_type(schema[names[f]].dataType) for f in fields}

    def run(batches):
        for part in slices(batches, text_col):
            made = compute(part[text_col].to_pylist())
            for f in fields:
                part = part.append_column(names[f], pa.array(made[f], types[f]))
            yield part

    return df.mapInArrow(run, schema), names


def signed(unsigned: int) -> int:
    """A 64-bit number as Spark's long."""
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows named by (doc_id, text_hash, repeated), a table on shared storage.

    Rows marked ``repeated`` share doc_id and meaning with a row that stays: of
    each set of those the longest text stays, once.
    """
    counts = {r["repeated"]: r["n"] for r in dropped.groupBy("repeated").agg(F.count("*").alias("n")).collect()}
    key, order = free_name(docs, "text_hash"), free_name(docs, "place")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))

    def joined(left: DataFrame, repeated: bool, how: str) -> DataFrame:
        names = dropped.where(F.col("repeated") == repeated).select(
            F.col("doc_id").alias("_dropped_id"), F.col("text_hash").alias("_dropped_hash"))
        if counts.get(repeated, 0) <= BROADCAST_ROWS:
            names = F.broadcast(names)
        return left.join(names, left[id_col].cast("long").eqNullSafe(names["_dropped_id"])
                         & (left[key] == names["_dropped_hash"]), how)

    # a repeated row may have the very text of the row that stays
    out = joined(keyed, False, "left_anti")
    if counts.get(True):
        ids = dropped.where("repeated").select(F.col("doc_id").alias("_dropped_id")).distinct()
        several = out.join(ids, out[id_col].cast("long").eqNullSafe(ids["_dropped_id"]), "left_semi")
        plain = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[ \t\n\x0B\f\r]", "")
        best = Window.partitionBy(id_col, F.sha2(plain, 256)).orderBy(F.length(text_col).desc_nulls_last(), key)
        once = several.withColumn(order, F.row_number().over(best)).where(F.col(order) == 1).drop(order)
        out = out.join(ids, out[id_col].cast("long").eqNullSafe(ids["_dropped_id"]), "left_anti").unionByName(once)
    return out.select(*docs.columns)
