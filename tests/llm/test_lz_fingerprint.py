import hashlib

import numpy as np
from pyspark.sql import functions as F

from cases import EDGE, SF0001, documents, edge_table, empty_table
from feedlens.llm import common, queries
from feedlens.llm import lz_fingerprint as lz


def _phrases(data):
    found, at = set(), 0
    for end in range(1, len(data) + 1):
        if data[at:end] not in found:
            found.add(data[at:end])
            at = end
    return found


def _signature(text):
    return lz.signature(lz.minima(sorted(_phrases(text.encode()))))


def test_parse_is_the_plain_one():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 300, 3000):
        data = bytes(rng.integers(97, 100, n).tolist())
        own, new = set(), []
        lz.parse(data, 0, n, own, new)
        assert own == _phrases(data) and len(new) == len(own)


def test_likeness_estimates_the_overlap():
    rng = np.random.default_rng(2)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(400)]
    a, b = " ".join(words), " ".join(words[:300] + words[:100])
    p, q = _phrases(a.encode()), _phrases(b.encode())
    assert abs(lz.likeness(_signature(a), _signature(b)) - len(p & q) / len(p | q)) < 0.15
    assert lz.likeness(_signature(a), _signature(a)) == 1.0
    assert lz.likeness(_signature(a), _signature("")) < 0.02


def _check(got, rows):
    order = sorted(rows, key=lambda r: r[1] or "")
    order = sorted(order, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (i, t), (_, nxt) in zip(order, [*order[1:], *order[:1]]):
        t, nxt = t or "", nxt or ""
        third = len(t) // 3
        edited = t[:len(t) - third] + nxt[:third]
        own, other, following = map(_signature, (t, edited, nxt))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), lz.hexadecimal(own), lz.hexadecimal(other),
                     lz.likeness(own, other), lz.likeness(own, following)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_defined_cases(spark):
    short = [(i, t[:3000] if t else t) for i, t in EDGE]
    for parts in (1, 2, 30):
        _check(lz.compare_edits(edge_table(spark, short).repartition(3), parts=parts).collect(), short)
    _check(lz.compare_edits(documents(spark, [(4, "only one document")])).collect(), [(4, "only one document")])
    assert lz.compare_edits(empty_table(spark)).count() == 0
    assert lz.fingerprints(edge_table(spark)).count() == len(EDGE)


def test_documents_without_id_are_spread(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(97, 123, 12))) + " some words" for _ in range(300)]
    rows = [(i if i % 3 == 0 else None, t) for i, t in enumerate(texts)] + [(None, None), (None, ""), (None, texts[1])]
    got = lz.compare_edits(documents(spark, rows).repartition(4), parts=9)
    _check(got.collect(), rows)
    sizes = [r["count"] for r in got.where("doc_id is null").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 60
    nobody = [(None, t) for t in texts[:50]]
    for parts in (1, 7):
        _check(lz.compare_edits(documents(spark, nobody), parts=parts).collect(), nobody)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SF0001).collect()]
    rows.sort()
    got = queries.QUERIES["op6_lz_fingerprint"](spark, SF0001).collect()
    _check(got, rows)
    assert sum(r.near_edited > r.near_next for r in got) > 0.97 * len(got)
