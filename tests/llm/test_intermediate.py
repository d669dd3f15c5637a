"""Intermediate tables are removed with their scope, and results that were written outlive it."""

import os

import pytest
from cases import documents

from feedlens.llm import common, exact_dedup, simhash, spelling
from feedlens.session import ensure_checkpoint_dir


def _files(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(at, f) for at, _, files in os.walk(root) for f in files}


def test_scope_removes_what_operators_wrote(spark):
    docs = documents(spark, [(i, f"some word number {i % 7} of a text") for i in range(60)])
    out = common.work_dir(spark, "outside")
    before = _files(spark)
    with common.intermediate_tables(spark):
        found = common.written(exact_dedup.exact_dedup(docs), out)
        with common.intermediate_tables(spark):
            spelling.spelling_variants(docs).count()
        near = common.written(simhash.near_duplicates(docs), f"{out}-near")
    assert found.count() == 60 and found.select("keep_id").distinct().count() == 7
    assert near.count() == 60
    assert {f.split("/outside-")[0] for f in _files(spark) - before} == {ensure_checkpoint_dir(spark).removeprefix("file:")}


def test_scope_ends_after_an_error(spark):
    before = _files(spark)
    with pytest.raises(KeyError), common.intermediate_tables(spark):
        common.written(documents(spark, [(1, "a")]), common.work_dir(spark, "lost"))
        raise KeyError("x")
    assert _files(spark) == before
    assert common.work_dir(spark, "next").rsplit("/", 1)[0] == ensure_checkpoint_dir(spark)


def test_filters_keep_only_the_names_of_dropped_rows(spark):
    docs = documents(spark, [(i, f"a text of several words, {i // 3}") for i in range(30)])
    before = _files(spark)
    assert exact_dedup.keep_distinct(docs).count() == 10
    assert simhash.keep_one_of_each(docs).count() <= 10
    left = {os.path.basename(os.path.dirname(f)).split("-")[:2] == ["dedup", "dropped"] or "simhash-dropped-" in f
            for f in _files(spark) - before}
    assert left == {True}
