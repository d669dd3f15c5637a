"""Rows that every operator has to stand: nulls, empty and long texts, ties, repeats, clashing column names."""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF0001, SF001 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

LONG = "A sentence that goes on and on, for ever. " * 6000
EDGE = [(1, "The cat sat on the mat."), (2, None), (3, ""), (4, " \n\t "), (5, "The cat  sat on\nthe mat."), (6, LONG),
        (7, LONG + "x"), (8, "héé ñ 日本 <|endoftext|> \x00 \U0001f600"), (9, "The cat sat on the mat."),
        (9, "The cat sat on the mat."), (None, "no id"), (None, None), (10, "12345 !!"), (11, "a")]

#: Names that operators use for their own columns.
CLASHING = ("n_tokens bigint, ids bigint, fp bigint, fingerprint string, kept boolean, score string, lang string, "
            "lang_pred bigint, range_no string, text_hash string, held_out string, start string, extra string")


def edge_table(spark, rows=EDGE):
    """doc_id, text and columns whose names operators use themselves."""
    names = [c.split()[0] for c in CLASHING.split(", ")]
    full = [(i, t, *(None if n != "lang" else "en" for n in names)) for i, t in rows]
    return spark.createDataFrame(full, f"doc_id bigint, text string, {CLASHING}")


def empty_table(spark):
    return edge_table(spark, [])


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def common_rows(spark, sf_dir):
    """(doc_id, text) of a folder's documents."""
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
