"""Periodic runs against a search of every period in turn."""

import hashlib
import random
import re
import zlib

import pytest
from cases import LONG, SF001, common_rows, documents, edge_table, empty_table

from feedlens.llm import periodic, queries


def brute_runs(words, min_words=12):
    """For each period in ascending order the maximal stretches of words equal at that distance."""
    n, found, seen = len(words), [], set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= 2 * q:
                if (i, length) not in seen:  # a smaller period has the same stretch otherwise
                    seen.add((i, length))
                    if length >= min_words:
                        found.append((i, length, q))
            i = j + 1
    return sorted(found)


def brute_row(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4))
    return (doc_id, *head, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 5])
def test_random_sequences(alphabet):
    rnd = random.Random(alphabet)
    for _ in range(250):
        words = [rnd.randrange(alphabet) for _ in range(rnd.randrange(90))]
        for _ in range(rnd.randrange(4)):  # some copies of a stretch behind it
            at, size = rnd.randrange(len(words) + 1), rnd.randrange(12)
            words[at:at] = words[at:at + size] * rnd.randrange(4)
        for least in (2, 12):
            assert periodic.runs_of(words, least) == brute_runs(words, least)
        text = " ".join(map(str, words)).encode()
        (n, runs, rest), = periodic.runs_and_rest([text])
        assert n == len(words) and runs == brute_runs(words)
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        assert rest.decode().split() == [str(w) for i, w in enumerate(words) if i not in dropped]


def test_fibonacci_word_has_runs_within_runs():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert periodic.runs_of(b, 2) == brute_runs(b, 2)


def test_query_matches_brute_force(spark):
    got = {tuple(r) for r in queries.op12_periodic_runs(spark, SF001).select(COLUMNS).collect()}
    want = {brute_row(*r) for r in common_rows(spark, SF001)}
    assert got == want
    assert sum(1 for r in want if r[1]) > 50


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 12), (5, "a " * 11), (6, "x y z " * 4 + "x q"), (None, "b c " * 6),
            (None, None), (6, "x y z " * 4 + "x q"), (7, "a b " * 6 + "a b " * 6), (8, LONG[:4000]), (9, "é " * 30)]
    found = periodic.periodic_runs(edge_table(spark, rows))
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(map(str, (tuple(r) for r in periodic.run_digests(found).select(COLUMNS).collect())))
    assert got == sorted(map(str, (brute_row(i, t, plant=False) for i, t in rows)))
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[4].collapsed == "a" and by_id[6].collapsed == "x y z q" and by_id[8].n_words == len(LONG[:4000].split())
    assert periodic.run_digests(periodic.periodic_runs(empty_table(spark))).count() == 0


def test_planted_documents(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(i % 40))) for i in range(200)] + [(None, "a b c"), (10, None)]
    got = sorted(map(str, (tuple(r) for r in periodic.run_digests(
        periodic.periodic_runs(periodic.with_planted_runs(documents(spark, rows)))).select(COLUMNS).collect())))
    assert got == sorted(map(str, (brute_row(i, t) for i, t in rows)))


def test_long_repetitive_text_in_time():
    words = [i % 7 for i in range(60_000)] + [i % 1000 for i in range(60_000)]
    runs = periodic.runs_of(words)
    assert (0, 60_007, 7) in runs or (0, 60_000, 7) in runs
    assert any(q == 1000 and m >= 60_000 for _, m, q in runs)
