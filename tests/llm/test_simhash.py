import random
import re

import numpy as np
import xxhash

from cases import EDGE, SF001, documents, edge_table, empty_table
from feedlens.llm import common, queries, simhash
from feedlens.llm.components import connected_components


def _fingerprint(text, n=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(fps):
    """Smallest member of each component of fingerprints within two bits."""
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 2
    root = np.arange(len(fps))
    while True:
        new = np.array([root[near[i]].min() for i in range(len(fps))])
        if (new == root).all():
            return root
        root = new


def test_golay_code_is_perfect():
    index = simhash.golay_index()
    assert len(np.unique(index)) == 4096
    assert (np.bincount(index) == 2048).all()  # every word is within three bits of one codeword


def test_fingerprints_within_two_bits_share_a_key():
    rng = random.Random(1)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 2)):
            y ^= 1 << b
        where, keys = simhash.keys_of(np.array([x, y], np.uint64))
        assert set(keys[where == 0].tolist()) & set(keys[where == 1].tolist())
        assert len(keys) < 2 * 20


def test_fingerprint_definition():
    for text in ("", "One", "one two", "One TWO three", "É one two three four " * 50, " \t a\x0bb  c\x0cd\r\n", "日本 a b c"):
        assert simhash.fingerprint(text) == _fingerprint(text)


def _linked(spark, fps, small_key):
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in set(fps)]
    table = spark.createDataFrame(signed, "fp bigint")
    roots = {r.node & (1 << 64) - 1: r.root for r in connected_components(simhash.links(table, small_key)).collect()}
    return [roots.get(f, f if f < 1 << 63 else f - (1 << 64)) for f in fps]


def test_links_find_every_component(spark):
    """Chains, balls around a centre and strangers; both ways of comparing a key's members."""
    rng = random.Random(7)
    fps = [0, (1 << 64) - 1]
    for _ in range(12):
        centre = rng.getrandbits(64)
        fps += [centre] + [centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(25)]
    step = rng.getrandbits(64)
    for b in range(0, 60, 2):  # a chain whose ends are far apart
        step ^= (1 << b) | (1 << b + 1)
        fps.append(step)
    fps += [rng.getrandbits(64) for _ in range(200)]
    want = _roots(fps)
    for small_key in (64, 3):
        got = _linked(spark, fps, small_key)
        assert len(set(got)) == len(set(want.tolist()))
        assert len(set(zip(got, want.tolist()))) == len(set(got))


def _check(got, rows):
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in got)
    fps = [_fingerprint(t) for _, t in rows]
    root = _roots(fps)
    least = {}
    for r, (i, _) in zip(root, rows):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted(((i is None, i or 0), f"{f:016x}", least.get(r)) for r, f, (i, _) in zip(root, fps, rows))
    assert got == want


def test_defined_cases(spark):
    _check(simhash.near_duplicates(edge_table(spark)).collect(), EDGE)
    assert simhash.near_duplicates(empty_table(spark)).count() == 0
    nobody = documents(spark, [(None, "a b c d"), (None, "a b c d")])
    assert [r.component_id for r in simhash.near_duplicates(nobody).collect()] == [None, None]


def test_planted_near_copies(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for n in range(20):
        text = [rng.choice(words) for _ in range(1500)]
        rows.append((10 * n, " ".join(text)))
        for k in range(3):
            text[rng.randrange(1500)] = "changed"
            rows.append((10 * n + 1 + k, " ".join(text)))
    _check(simhash.near_duplicates(documents(spark, rows), small_key=2).collect(), rows)
    kept = simhash.keep_one_of_each(documents(spark, rows)).collect()
    components = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert sorted(r.doc_id for r in kept) == sorted(set(components.values())) and len(kept) < len(rows)


def test_kept_rows(spark):
    table = edge_table(spark)
    kept = simhash.keep_one_of_each(table)
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.collect()]
    root = _roots([_fingerprint(t) for _, t in EDGE])
    assert len(ids) == len(set(root.tolist())) and sorted(i for i in ids if i == 9) == []
    repeated = documents(spark, [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (None, "x y z w"), (None, "x y z w")])
    assert sorted(map(str, simhash.keep_one_of_each(repeated).collect())) == sorted(
        ["Row(doc_id=1, text='a b c d e')", "Row(doc_id=None, text='x y z w')"])


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SF001).collect()]
    _check(queries.QUERIES["op8_golay_simhash"](spark, SF001).collect(), rows)
