"""The pipeline against a plain version, stage by stage, and the entry module without the subpackage."""

import os
import shutil
import subprocess
import sys

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from cases import ROOT, SF001, edge_table, empty_table
from feedlens.llm import common, language, packing, quality, queries
from test_simhash import _fingerprint, _roots
from test_tokens import _check_packing


def test_stages_against_plain_versions(spark):
    from tokenizers import Tokenizer

    from feedlens.llm.tokens import default_tokenizer

    docs = common.documents(spark, SF001)
    columns, labels = docs.columns, spark.read.parquet(f"{SF001}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "quality classifier", "exact dedup", "SimHash near-dedup", "packing"]
    kept = {}
    for name in list(stages)[:-1]:
        before = docs
        docs = common.written(stages[name](spark, docs, SF001), common.work_dir(spark, "stage"))
        assert docs.columns == columns
        kept[name] = (sorted(tuple(r) for r in before.collect()), sorted(tuple(r) for r in docs.collect()))
    # language: the rows with a letter and a score
    model = language.train(common.documents(spark, SF001), teach=common.hash_mod(_col("doc_id"), 3) != 1)
    rows, left = kept["language ID"]
    names, scores = model.decide([r[1] for r in rows])
    assert left == [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= language.MIN_SCORE]
    # quality: the rows at or over the threshold
    rows, left = kept["quality classifier"]
    own = quality.train(spark.createDataFrame(rows, common.documents(spark, SF001).schema), labels)
    share = own.score(np.array([quality.statistics(r[1]) for r in rows]))
    assert left == [r for r, s in zip(rows, share) if s >= quality.KEEP]
    # exact copies: of each text the longest original, then the smallest id
    rows, left = kept["exact dedup"]
    groups = {}
    for r in rows:
        groups.setdefault("".join(c for c in r[1] if c not in " \t\n\x0b\x0c\r"), []).append((-len(r[1]), r[0], r))
    assert left == sorted(min(g)[2] for g in groups.values())
    # near copies: of each component the smallest id
    rows, left = kept["SimHash near-dedup"]
    root = _roots([_fingerprint(r[1]) for r in rows])
    assert left == sorted(rows[i] for i in sorted({min(np.flatnonzero(root == x), key=lambda i: rows[i][0]) for x in set(root)}))
    texts = [(r[0], r[1]) for r in left]
    pieces = stages["packing"](spark, docs, SF001).collect()
    assert _check_packing(pieces, texts, Tokenizer.from_file(default_tokenizer())) == 0


def _col(name):
    from pyspark.sql import functions as F
    return F.col(name)


def test_run_is_the_stages_in_order(spark):
    got = {r.doc_id for r in corpus_pipeline.run(spark, SF001).select("doc_id").distinct().collect()}
    docs = common.documents(spark, SF001)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SF001), common.work_dir(spark, "stage"))
    assert got == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_stand_the_edge_cases(spark):
    for table in (edge_table(spark), empty_table(spark)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.written(stage(spark, docs, SF001), common.work_dir(spark, "stage"))
            assert docs.columns == table.columns
        assert packing.pack(docs).count() >= docs.count()


def test_registered_queries():
    own = entry.queries()
    assert {n for n in own if n.startswith("op")} == set(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert own["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_without_the_subpackage(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                          env=os.environ | {"PYTHONPATH": copy})
    assert done.returncode == 0, done.stderr
    n, pipeline, statements = done.stdout.split()
    assert int(n) > 50 and pipeline == "False" and int(statements) == int(n) - 1
