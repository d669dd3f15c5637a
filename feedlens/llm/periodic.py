"""Periodic runs: stretches of a text whose words repeat with some period, and the text without the repeats.

A run is a stretch of consecutive words that its smallest period ``q`` covers
at least twice, with at least ``MIN_WORDS`` words, and that no neighbouring word
extends keeping that period.

The stretch's *suffix automaton* says which suffixes of every prefix have
occurred before: those of the states on the way from the prefix's state along
the suffix links. Each state keeps, as its colour, the last end of its strings.
Appending a word gives its whole way to the root a new colour, which is the
*access* of a link-cut tree: the way consists of a few preferred paths, one
colour each, so a step reads, for every such segment, the deepest length L and
the previous end p, and joins the segments into one. The suffix of length L ends
both here and at p; if the distance q = i - p is at most L, a square of period q
ends here, and the words from i - L - q + 1 to i have that period. Being the last
occurrence makes q the smallest period, being the deepest state makes the
stretch's left end final; its right end grows with every appended word.

Most words of a text lie in no run and need no automaton. A run of period q
with n words has n - q >= 6 pairs of equal words at distance q, so six
consecutive words occur twice, and such six-word strings cover the whole run.
Words that no repeated six-word string covers cut the text into stretches that
are searched on their own (equal hashes of different strings can only make a
stretch larger).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.llm.common import id_text, ready, slices

#: A run has at least so many words, and at least two periods.
MIN_WORDS = 12
#: Words without white space, as Java and Python see them alike.
WORD = r"[^\x20\x09-\x0D]+"

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length of the longest string, suffix link) of each state, and the state of every prefix; state 0 is the root."""
    longest, link, follow, ends = [0], [-1], [{}], []
    last = 0
    for word in words:
        new = len(longest)
        longest.append(longest[last] + 1)
        follow.append({})
        link.append(0)
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if at >= 0:
            ahead = follow[at][word]
            if longest[at] + 1 == longest[ahead]:
                link[new] = ahead
            else:
                copy = len(longest)
                longest.append(longest[at] + 1)
                follow.append(dict(follow[ahead]))
                link.append(link[ahead])
                while at >= 0 and follow[at].get(word) == ahead:
                    follow[at][word] = copy
                    at = link[at]
                link[ahead] = link[new] = copy
        ends.append(new)
        last = new
    return longest, link, ends


class LastOccurrences:
    """The tree of suffix links under link-cut access; every preferred path has one colour, the last end seen on it.

    Preferred paths are splay trees ordered by depth; ``up`` of a splay root is
    the tree node above its path. The root state is left out: the empty string
    ends everywhere. Node numbers start at 1, so 0 means none.
    """

    def __init__(self, longest: list[int], link: list[int]):
        n = len(longest)
        self.longest, self.up = longest, [max(v, 0) for v in link]
        self.left, self.right, self.colour = [0] * n, [0] * n, [-1] * n

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            left[y] = b = right[x]
            right[x] = y
        else:
            right[y] = b = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def _splay(self, x: int) -> None:
        """Make x the root of its path's splay tree; the colour moves to it."""
        up, left, right = self.up, self.left, self.right
        top = x
        while (y := up[top]) and (left[y] == top or right[y] == top):
            top = y
        if top == x:
            return
        self.colour[x] = self.colour[top]
        while (y := up[x]) and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            self._rotate(x)

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """(previous end, deepest length) of the segments between the root and ``state``, which all get the colour ``end``."""
        up, right, colour, longest = self.up, self.right, self.colour, self.longest
        below, at, seen = 0, state, []
        while at:
            self._splay(at)
            if colour[at] >= 0:
                seen.append((colour[at], longest[at]))
            if right[at]:
                colour[right[at]] = colour[at]  # what lies deeper keeps its colour, on a path of its own
            right[at] = below
            below, at = at, up[at]
        colour[below] = end
        return seen


def runs_of(words: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence, by start and period."""
    longest, link, ends = suffix_automaton(words)
    tree = LastOccurrences(longest, link)
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(ends):
        for previous, length in tree.access(state, i):
            period = i - previous
            if period <= length:
                found[i - length - period + 1, period] = i
    return sorted((start, end - start + 1, period) for (start, period), end in found.items()
                  if end - start + 1 >= min_words)


def repeated_stretches(texts: list[list[bytes]], gram: int) -> list[list[tuple[int, int]]]:
    """For each text the stretches (from, to) of words that some repeated string of ``gram`` words covers.

    All texts are looked at together: their words' hashes are summed up to hashes
    of strings, and equal ones of the same text found by one sort.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if total < gram:
        return out
    hashes = np.fromiter((hash(w) for t in texts for w in t), np.int64, total).view(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    strings = np.zeros(total - gram + 1, np.uint64)
    for k in range(gram):
        strings *= np.uint64(0x9E3779B97F4A7C15)
        strings += hashes[k:k + len(strings)] ^ (hashes[k:k + len(strings)] >> np.uint64(29))
    strings += owner[:len(strings)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    inside = np.flatnonzero(owner[:len(strings)] == owner[gram - 1:])
    order = inside[np.argsort(strings[inside], kind="stable")]
    ordered = strings[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    places = np.sort(order[twice])
    if not len(places):
        return out
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + gram, -1)
    covered = np.cumsum(edges[:-1]) > 0
    # a stretch ends where its text does
    first = covered & np.r_[True, ~covered[:-1] | (owner[1:] != owner[:-1])]
    last = covered & np.r_[~covered[1:] | (owner[1:] != owner[:-1]), True]
    begins = np.r_[0, np.cumsum(sizes)]
    for a, b in zip(np.flatnonzero(first).tolist(), np.flatnonzero(last).tolist()):
        n = int(owner[a])
        out[n].append((a - int(begins[n]), b + 1 - int(begins[n])))
    return out


def runs_and_rest(texts: list[bytes], min_words: int = MIN_WORDS) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs, text without repeats) of each text."""
    split = [t.split() for t in texts]  # bytes are split at exactly the six white-space characters of WORD
    for words, stretches in zip(split, repeated_stretches(split, max(1, min_words // 2))):
        runs: list[tuple[int, int, int]] = []
        for a, b in stretches:
            if b - a >= min_words:
                number: dict[bytes, int] = {}
                part = [number.setdefault(w, len(number)) for w in words[a:b]]
                runs += [(a + start, length, period) for start, length, period in runs_of(part, min_words)]
        if runs:
            kept, done = [], 0
            for a, b in sorted((start + period, start + length) for start, length, period in runs):
                kept += words[done:a]
                done = max(done, b)
            rest = b" ".join(kept + words[done:])
        else:
            rest = b" ".join(words)
        yield len(words), runs, rest


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document.

    ``runs`` are (start, length, period) in words, numbered from 0, by start and
    then period. ``collapsed`` are the words that are left, joined by one space,
    when every run is cut down to its first period: a word goes if any run has it
    after that run's first ``period`` words.

    Null and empty texts have no words, no runs and an empty rest; every row has
    one row in the result, also those with a null or repeated id. A very long
    text is searched stretch by stretch in its task, with memory in proportion to
    its longest repetitive stretch. An empty table gives an empty result; other
    columns are left out, whatever their names.
    """
    ready(docs.sparkSession)
    schema = T._parse_datatype_string(f"doc_id long, n_words long, runs {RUNS}, collapsed string")
    run_type = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n, runs, rest = zip(*runs_and_rest(part["text"].cast(pa.binary()).to_pylist(), min_words))
            named = [[{"start": s, "length": m, "period": q} for s, m, q in r] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(n, pa.int64()), pa.array(named, run_type), pa.array(rest, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text), where a tenth of the documents repeat some of their words from a certain one on: runs to be found.

    With h the checksum of the id as text and g = h / 10, a text of n words with h
    divisible by 10 goes on, from word a = g mod n, with words a to a + p - 1 over
    and over, p = 1 + (n - a) / (3 + g mod 8), as long as it was (whole divisions).
    Texts without words, or of documents without id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = id_text(docs, id_col, text_col).select(
        "doc_id", "text", F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    placed = planted.withColumn("n", F.size("words").cast("long"))
    placed = placed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, p, n = F.col("a").cast("int"), F.col("p"), F.col("n").cast("int")
    cycle = F.slice("words", a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    edited = F.slice(F.concat(F.slice("words", F.lit(1), a), F.flatten(F.array_repeat(cycle, times))), F.lit(1), n)
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """One row per document: its number of runs, the longest one, and digests of all runs and of the collapsed text.

    Of equally long runs the first by start, then period, counts; documents without a run have nulls there.
    """
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * -best.shorter) div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words")
