"""Spelling variants against a plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from cases import SF001, documents, edge_table, empty_table

from feedlens.llm import common, queries, spelling


def one_error(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_counts(rows, typo_every=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute(counts, words=None):
    """{word: (form, root, n, n_near, form_n)} of ``words``, or of all."""
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)

    def judged(w):
        near = [x for size in (-1, 0, 1) for x in by_size.get(len(w) + size, ()) if one_error(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        return (best if best and counts[best] >= 5 * counts[w] else None), len(near)

    out = {}
    for w in counts if words is None else words:
        form, n_near = judged(w)
        root = w
        while (ahead := judged(root)[0]):
            root = ahead
        out[w] = (form, root, counts[w], n_near, counts[form] if form else None)
    return out


def rows_of(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def test_query_matches_brute_force(spark):
    got = rows_of(queries.op11_spelling_variants(spark, "/root/testdata/sf0.001"))
    docs = [tuple(r) for r in common.documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect()]
    assert got == brute(brute_counts(docs))
    assert any(r[0] for r in got.values()) and any(r[3] > 1 for r in got.values())


def test_larger_vocabulary_on_words_drawn_at_random(spark):
    got = rows_of(queries.op11_spelling_variants(spark, SF001))
    docs = [tuple(r) for r in common.documents(spark, SF001).select("doc_id", "text").collect()]
    counts = brute_counts(docs)
    assert {w: r[2] for w, r in got.items()} == counts
    drawn = random.Random(5).sample(sorted(counts), 150)
    assert {w: got[w] for w in drawn} == brute(counts, drawn)


def test_chains_ties_and_every_kind_of_error(spark):
    texts = ("letters " * 125 + "lettersx " * 25 + "letersx " * 5  # a chain of two forms
             + "banane " * 5 + "banana " * 25 + "bananx " * 25  # equal counts: the first in order
             + "Straße " * 30 + "STRAße " * 2 + "straÃe " * 6 + "straaße " * 6 + "strasse " * 9
             + "aaaaaa " * 50 + "aaaaaaa " * 10 + "aaaaaaaa " * 5  # a letter within a run of the same
             + "abcdef " * 4)  # too rare
    got = rows_of(spelling.spelling_variants(documents(spark, [(1, texts)]), typo_every=0))
    assert got == brute(brute_counts([(1, texts)], 0))
    assert got["letersx"][:2] == ("lettersx", "letters") and got["letters"][:2] == (None, "letters")
    assert got["banane"][0] == "banana" and "abcdef" not in got and got["aaaaaa"][3] == 1


@pytest.mark.parametrize("block", [3, 40])
def test_large_blocks_are_cut_without_loss(spark, block):
    rnd = random.Random(7)
    words = {"".join(rnd.choice("abc") for _ in range(rnd.choice((6, 6, 7, 8)))) for _ in range(260)}
    text = " ".join(w for w in sorted(words) for _ in range(5 + rnd.choice((0, 0, 30))))
    got = rows_of(spelling.spelling_variants(documents(spark, [(1, text)]), typo_every=0, block=block))
    assert got == brute(brute_counts([(1, text)], 0))


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "naïve " * 9), (None, "houses " * 3), (None, "houses " * 3), (4, "houses " * 3),
            (4, "houses " * 3), (5, "long word " * 50_000 + "housee " * 600)]
    got = rows_of(spelling.spelling_variants(edge_table(spark, rows), typo_every=0))
    assert got == {"houses": ("housee", "housee", 12, 1, 600), "housee": (None, "housee", 600, 1, None)}
    planted = rows_of(spelling.spelling_variants(edge_table(spark, rows)))
    assert planted == brute(brute_counts([("" if i is None else i, t) for i, t in rows]))
    assert rows_of(spelling.spelling_variants(empty_table(spark))) == {}
