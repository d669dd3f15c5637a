"""License scans: winnowed fingerprints find candidates, banded alignment confirms them.

Texts are folded to their ASCII letters and digits in lower case. Hashes of all
runs of ``RUN`` such characters are winnowed with windows of ``WINDOW``: of each
window the smallest stays, so a passage of RUN + WINDOW - 1 characters that is
in both a text and a template has a fingerprint in common. Of short templates
all runs are kept and looked up at all places of a text, so there a passage of
RUN characters is enough. The templates'
fingerprints form an inverted index, small enough to go to every task (its size
is checked). Hits on one diagonal are a candidate; the template's words are
then aligned with the words around it inside a band, and the result is the span
in the text and the share of the template's words that match. Of a long template
the hits are first extended to runs of equal words and chained; only the gaps
between chained runs, and what stands before and after them, are aligned, so a whole
licence costs little more than comparing it word by word.

Defined cases: null and empty texts match nothing; a null doc_id stays null;
repeated rows repeat their matches; of overlapping matches the one with the
higher alignment score stays, then the one earlier in the list of templates; an
empty table gives no rows; other columns are ignored. A notice is named only if
its numbers and marks (version, SA, NC, ND, Lesser, Affero, the licence's short name)
are those of the text.
A text of any length with any number of licences is searched whole, in time that
grows with its hits.
"""

from __future__ import annotations

import pkgutil
import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedlens.llm.common import id_text, ready, slices

#: Folded characters of a hashed run, and runs of a winnowing window.
RUN, WINDOW = 12, 8
#: Of templates of fewer folded characters every run is looked up at every place.
SHORT = 60
#: Words by which an alignment may leave its diagonal, at least and as a share of the template.
BAND, BAND_SHARE = 6, 0.1
#: Wider bands are aligned with numpy.
WIDE_BAND = 16
#: Templates of at least so many words are aligned between chained runs of equal words.
CHAINED_WORDS = 90
#: An alignment beyond the last run goes on until its score has fallen by so much.
FALL = 40
MIN_COVERAGE = 0.8
#: Bound of the templates' text, which is sent to every task.
TEMPLATE_BYTES = 64 << 20

#: Short notices of common licences, public texts.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under Creative Commons CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_GNU = (("GPL", "General", ("1", "2")), ("LGPL", "Library General", ("2",)), ("LGPL", "Lesser General", ("2.1", "3")),
        ("AGPL", "Affero General", ("3",)))
_CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
       ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))


def _variants():
    """Other notices and versions of the same families."""
    for short, name, versions in _GNU:
        for v in versions:
            full = f"{short}-{v}" if "." in v else f"{short}-{v}.0"
            if (short, v) not in (("LGPL", "3"), ("AGPL", "3")):  # among NOTICES
                yield full, f"This work is licensed under the GNU {name} Public License, version {v}."
            for what in ("program", "library"):
                yield f"{full}-notice", (
                    f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
                    f"Public License as published by the Free Software Foundation; either version {v} of the License, or "
                    "(at your option) any later version.")
    for short, name in _CC:
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            full = f"CC-{short}-{v}"
            if v != "4.0" or short in ("BY", "BY-NC-SA", "BY-NC-ND"):  # the others are among NOTICES
                yield full, f"Licensed under CC {short} {v}."
            scope = "International" if v == "4.0" else "Unported" if v == "3.0" else "Generic"
            yield full, f"This work is licensed under a Creative Commons {name} {v} {scope} License."
            yield full, f"This work is licensed under the Creative Commons {name} {v} License."
    for n in (2, 3):
        yield f"BSD-{n}-Clause", f"Released under the BSD {n}-Clause License."
    yield "MIT", "This project is MIT licensed."
    yield "Apache-2.0", "Licensed under the Apache License 2.0."
    for name in (*WHOLE, "AGPL-3.0", *(f"CC-{short}-4.0" for short, _ in _CC)):
        yield name, f"SPDX-License-Identifier: {name}"
    yield "MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"


#: Whole licences, files of the folder ``licenses``, by the names that are reported.
WHOLE = {"MIT": "MIT", "BSD-2-Clause": "BSD-2", "BSD-3-Clause": "BSD-3", "ISC": "ISC", "0BSD": "0BSD",
         "Unlicense": "Unlicense", "Apache-2.0": "Apache-2.0", "Artistic-1.0-Perl": "Artistic", "CC0-1.0": "CC0-1.0",
         "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3",
         "LGPL-2.0": "LGPL-2", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
#: Templates of fewer words are notices: their numbers and these words must be those of the text.
NOTICE_WORDS = 90
MARKS = frozenset(b"sa nc nd sharealike noncommercial noderivatives noderivs lesser affero "
                  b"mit bsd apache gpl lgpl agpl gfdl mpl isc cc0 artistic unlicense".split())


def production_templates() -> list[tuple[str, str]]:
    """Notices, whole licences and the disclaimers of the short ones."""
    whole = {name: pkgutil.get_data("feedlens.llm", f"licenses/{file}.txt").decode() for name, file in WHOLE.items()}
    parts = [(f"{name}-warranty", text[text.index("THE SOFTWARE IS" if "THE SOFTWARE IS" in text else "THIS SOFTWARE IS"):])
             for name, text in whole.items() if name in ("MIT", "BSD-3-Clause", "ISC")]
    return [*NOTICES, *_variants(), *whole.items(), *parts]


_FOLD = bytes(b if 97 <= b <= 122 or 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else 0 for b in range(256))
_BREAK = 1  # stands between texts
_NONE = np.uint64(2**64 - 1)
_WORD = re.compile(rb"[0-9A-Za-z]+")
_BASE = 0x9E3779B97F4A7C15


def run_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the run of ``RUN`` codes at each place; none where a break is in the run."""
    c = codes.astype(np.uint64)
    n = len(c) - RUN + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = lambda k: np.uint64(pow(_BASE, k, 2**64))
    h, size, parts = c, 1, {1: c}
    while size * 2 <= RUN:
        h = h[:-size] * power(size) + h[size:]
        size *= 2
        parts[size] = h
    out, at = np.zeros(n, np.uint64), 0
    for size in sorted(parts, reverse=True):
        while at + size <= RUN:
            out = out * power(size) + parts[size][at:at + n]
            at += size
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    broken = np.concatenate([[0], np.cumsum(codes == _BREAK)])
    out[broken[RUN:] != broken[:n]] = _NONE
    return out


def rolling(h: np.ndarray, size: int, least: np.ufunc) -> np.ndarray:
    """``least`` of each ``size`` neighbours."""
    done = 1
    while done < size:
        step = min(done, size - done)
        h = least(h[:-step], h[step:])
        done += step
    return h


def winnow(h: np.ndarray) -> np.ndarray:
    """Places whose hash is the smallest of some window."""
    if len(h) < WINDOW:
        return np.flatnonzero((h == h.min()) & (h != _NONE)) if len(h) else np.zeros(0, np.int64)
    smallest = rolling(h, WINDOW, np.minimum)
    pad = np.zeros(WINDOW - 1, np.uint64)
    best = rolling(np.concatenate([pad, smallest, pad]), WINDOW, np.maximum)
    return np.flatnonzero((best == h) & (h != _NONE))


class Index:
    """Inverted index of (hash, template, word of the template)."""

    def __init__(self, entries: list[tuple[int, int, int]]):
        hashes, owner, place = (list(c) for c in zip(*entries)) if entries else ([], [], [])
        order = np.argsort(np.array(hashes, np.uint64), kind="stable")
        self.hashes = np.array(hashes, np.uint64)[order]
        self.owner, self.place = np.array(owner, np.int64)[order], np.array(place, np.int64)[order]
        # one bit per hash, by its low bits: nearly all places of a text end here
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, h: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int]]:
        values = h[places]
        near = self.filter[(values & np.uint64((1 << 20) - 1)).astype(np.int64)]
        places, values = places[near], values[near]
        a, b = np.searchsorted(self.hashes, values), np.searchsorted(self.hashes, values, "right")
        size = b - a
        entry = np.repeat(a - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        return list(zip(np.repeat(places, size).tolist(), self.owner[entry].tolist(), self.place[entry].tolist()))


class Templates:
    """Words of the templates and the inverted index of their fingerprints."""

    def __init__(self, templates):
        if sum(len(t.encode()) for _, t in templates) > TEMPLATE_BYTES:
            raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes in all")
        self.names = [name for name, _ in templates]
        self.words = [[w.group().lower() for w in _WORD.finditer(t.encode())] for _, t in templates]
        self.bags = [Counter(words) for words in self.words]
        self.number = {w: k for k, w in enumerate(dict.fromkeys(w for words in self.words for w in words))}
        self.codes = [np.array([self.number[w] for w in words], np.int32) for words in self.words]
        self.code_bags = [np.unique(c, return_counts=True) for c in self.codes]
        self.named = [Counter({w: n for w, n in bag.items() if w.isdigit() or w in MARKS})
                      if sum(bag.values()) < NOTICE_WORDS else None for bag in self.bags]
        entries: tuple[list, list] = [], []  # of long and of short templates: hash, template, word
        for i, (name, text) in enumerate(templates):
            codes = np.frombuffer(text.encode().translate(_FOLD), np.uint8)
            folded = codes[codes > 0]
            if len(folded) < RUN:
                raise ValueError(f"template {name!r} has fewer than {RUN} letters and digits")
            word_of = np.repeat(np.arange(len(self.words[i])), [len(w) for w in self.words[i]])
            h = run_hashes(folded)
            short = len(folded) < SHORT
            for at in (range(len(h)) if short else winnow(h).tolist()):
                entries[short].append((int(h[at]), i, int(word_of[at])))
        self.long, self.short = map(Index, entries)

    def possible(self, t: int, window: list[bytes], least: float) -> bool:
        """Whether the words of the window can match as many of the template's."""
        if len(window) < least:
            return False
        own = self.bags[t]
        return sum(min(n, own[w]) for w, n in Counter(window).items() if w in own) >= least

    def possible_codes(self, t: int, window: np.ndarray, least: float) -> bool:
        """``possible`` for words by their numbers (-1: in no template)."""
        if len(window) < least:
            return False
        own, n = self.code_bags[t]
        here = np.bincount(window[window >= 0], minlength=len(self.number))
        return bool(np.minimum(here[own], n).sum() >= least)

    def right_name(self, t: int, span: list[bytes]) -> bool:
        """Whether the words that tell a notice from others are in the span, and no other such mark is."""
        if self.named[t] is None:
            return True
        here = Counter(span)
        return all(here[w] >= n for w, n in self.named[t].items()) and all(w in self.named[t] for w in MARKS & here.keys())

    def hits(self, h: np.ndarray) -> list[tuple[int, int, int]]:
        """(place in the text, template, word of the template) of common fingerprints."""
        return self.long.hits(h, winnow(h)) + self.short.hits(h, np.flatnonzero(h != _NONE))


def align(template: list[bytes], words: list[bytes], diagonal: int, band: int, begin: int = 0,
          end: int | None = None) -> tuple[int, int, int, int]:
    """Best local alignment with word j of the text, from ``begin`` to ``end``, near word j - diagonal of the template.

    Returns its score (2 a match, -1 a mismatch or gap), matched words, and the
    first and last matched word of the text.
    """
    end = len(words) if end is None else end
    if band > WIDE_BAND:
        return _align_wide(template, words, diagonal, band, begin, end)
    best = (0, 0, -1, -1)
    previous: dict[int, tuple[int, int, int]] = {}  # offset in the band: score, matches, first word
    for i, word in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        for k in range(-band, band + 1):
            j = i + diagonal + k
            if not begin <= j < end:
                continue
            same = words[j] == word
            s, m, first = previous.get(k, (0, 0, -1))
            cell = (s + 2, m + 1, first if m else j) if same else (s - 1, m, first)
            for gap in (previous.get(k + 1), row.get(k - 1)):
                if gap and gap[0] - 1 > cell[0]:
                    cell = (gap[0] - 1, gap[1], gap[2])
            if cell[0] > 0:
                row[k] = cell
                if same and cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], j)
        previous = row
    return best


def _align_wide(template: list[bytes], words: list[bytes], diagonal: int, band: int, begin: int,
                end: int) -> tuple[int, int, int, int]:
    """``align`` with one row of the band at a time."""
    number = {w: k for k, w in enumerate(dict.fromkeys(template))}
    size, low = 2 * band + 1, diagonal - band
    codes = np.full(len(template) + size, -1)  # of the words from ``low`` on
    inside = np.zeros(len(codes), bool)
    for j in range(max(begin, low), min(end, low + len(codes))):
        codes[j - low], inside[j - low] = number.get(words[j], -1), True
    k, never = np.arange(size), -(1 << 40)
    s, m, first = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1)
    best = (0, 0, -1, -1)
    for i, word in enumerate(template):
        same = codes[i:i + size] == number[word]
        first = np.where(same & (m == 0), low + i + k, first)
        now, count = np.where(same, s + 2, s - 1), m + same
        # gaps: from the row before, then along this row
        up = np.flatnonzero(s[1:] - 1 > now[:-1])
        new_first = first.copy()
        now[up], count[up], new_first[up] = s[up + 1] - 1, m[up + 1], old_first[up + 1] if i else -1
        now[~inside[i:i + size]] = never
        along = now + k
        top = np.maximum.accumulate(along)
        source = np.maximum.accumulate(np.where(along == top, k, 0))
        now, count, new_first = top - k, count[source], new_first[source]
        gone = (now <= 0) | ~inside[i:i + size]
        now[gone], count[gone], new_first[gone] = 0, 0, -1
        s, m, first = now, count, new_first
        old_first = first
        at = int(np.argmax(np.where(same, s, 0)))
        if same[at] and s[at] > best[0]:
            best = (int(s[at]), int(m[at]), int(first[at]), low + i + at)
    return best


def _grid(a: np.ndarray, b: np.ndarray, whole: bool) -> tuple[int, int, int]:
    """Alignment of two word sequences from their beginnings on: score, matched words and words of ``b`` up to the last match.

    ``whole`` takes both to their ends; else the best beginnings count, and rows end
    when the score has fallen by ``FALL``. One row of the grid at a time; gaps along a
    row come from a running maximum.
    """
    k = np.arange(len(b) + 1)
    s, m, best = -k, np.zeros(len(b) + 1, np.int64), (0, 0, 0)
    for i, word in enumerate(a):
        same = b == word
        now, count = s - 1, m.copy()  # a word of a is left out
        step = s[:-1] + np.where(same, 2, -1)
        better = step >= now[1:]
        now[1:][better], count[1:][better] = step[better], (m[:-1] + same)[better]
        along = now + k
        top = np.maximum.accumulate(along)
        source = np.maximum.accumulate(np.where(along == top, k, 0))
        s, m = top - k, count[source]
        if not whole:
            at = int(np.argmax(s))
            if s[at] > best[0]:
                best = (int(s[at]), int(m[at]), at)
            elif s[at] < best[0] - FALL:
                break
    return (int(s[-1]), int(m[-1]), len(b)) if whole else best


def _equal_runs(template: np.ndarray, words: np.ndarray, hits: list[tuple[int, int]], begin: int,
                stop: int) -> list[tuple[int, int, int]]:
    """(word of the text, word of the template, length) of the runs of equal words that the hits lie in, by place."""
    runs: list[tuple[int, int, int]] = []
    pairs = np.array(hits, np.int64)
    pairs = pairs[np.argsort(pairs[:, 0] - pairs[:, 1], kind="stable")]
    diagonals, starts = np.unique(pairs[:, 0] - pairs[:, 1], return_index=True)
    for d, places in zip(diagonals.tolist(), np.split(pairs[:, 1], starts[1:])):
        low, high = max(0, begin - d), min(len(template), stop - d)
        if high <= low:
            continue
        unequal = np.flatnonzero(template[low:high] != words[low + d:high + d]) + low
        ends = np.concatenate([[low - 1], unequal, [high]])
        at = np.concatenate([places, places + 1, places + 2])  # a hit may begin inside a word
        at = at[(low <= at) & (at < high)]
        own = np.searchsorted(ends, at, "right") - 1
        own = np.unique(own[ends[own] < at])  # not an unequal word itself
        first, after = ends[own] + 1, ends[own + 1]
        runs += [(f + d, f, e - f) for f, e in zip(first.tolist(), after.tolist()) if f < e]
    return sorted(runs)


def align_chained(template: np.ndarray, words: np.ndarray, hits: list[tuple[int, int]], begin: int, stop: int,
                  band: int) -> tuple[int, int, int, int]:
    """``align`` by way of the hits (word of the text, word of the template) between ``begin`` and ``stop``.

    The runs of equal words in order in both make the chain with the largest score,
    a gap costing its words; the gaps are then aligned, and the ends as far as they add to it.
    """
    runs = _equal_runs(template, words, hits, begin, stop)
    if not runs:
        return 0, 0, -1, -1
    j, i, n = (np.array(c) for c in zip(*runs))
    total, before, cut = 2 * n, np.full(len(runs), -1), np.zeros(len(runs), np.int64)
    for r in range(1, len(runs)):
        over = np.maximum(0, np.maximum(j[:r] + n[:r] - j[r], i[:r] + n[:r] - i[r]))  # words that both runs would take
        apart = np.maximum(j[r] + over - j[:r] - n[:r], i[r] + over - i[:r] - n[:r])
        value = np.where(over < n[r], total[:r] + 2 * (n[r] - over) - apart, -1)
        best = int(np.argmax(value))
        if value[best] > total[r]:
            total[r], before[r], cut[r] = value[best], best, over[best]
    chain = []
    at = int(np.argmax(total))
    while at >= 0:
        chain.append((int(j[at] + cut[at]), int(i[at] + cut[at]), int(n[at] - cut[at])))
        at = int(before[at])
    chain.reverse()
    matched = sum(c[2] for c in chain)
    score = 2 * matched
    for (j0, i0, n0), (j1, i1, _) in zip(chain, chain[1:]):
        s, m, _ = _grid(template[i0 + n0:i1], words[j0 + n0:j1], True)
        score, matched = score + s, matched + m
    first, start = chain[0][:2]
    s, m, back = _grid(template[:start][::-1], words[max(begin, first - start - band):first][::-1], False)
    score, matched, first = score + s, matched + m, first - back
    last, end = chain[-1][0] + chain[-1][2], chain[-1][1] + chain[-1][2]
    s, m, on = _grid(template[end:], words[last:min(stop, last + len(template) - end + band)], False)
    return score + s, matched + m, first, last + on - 1


def _inside(spans: list[tuple[int, int]], word: int) -> bool:
    """Whether a word lies in one of the spans (first and last word), which are in order and do not overlap."""
    at = bisect_right(spans, (word, 1 << 60)) - 1
    return at >= 0 and word <= spans[at][1]


def matches(raw: bytes, hits: list[tuple[int, int, int]], templates: Templates,
            min_coverage: float) -> list[tuple[str, int, int, int, float]]:
    """(template, begin and end byte, matched words, coverage) of one text's hits (byte, template, word)."""
    found = list(_WORD.finditer(raw))
    begins = np.array([w.start() for w in found])
    words = [w.group().lower() for w in found]
    codes = np.fromiter((templates.number.get(w, -1) for w in words), np.int32, len(words))
    tries = defaultdict(set)
    at = np.searchsorted(begins, [hit[0] for hit in hits], "right") - 1
    for word, (_, t, place) in zip(at.tolist(), hits):
        tries[t].add((word - place, word))
    out = []
    # long templates first, by their hits; a whole licence found word for word leaves nothing
    # in its span that could score more
    solid: list[tuple[int, int]] = []
    order = sorted(tries, key=lambda t: (len(templates.words[t]) < CHAINED_WORDS, -len(tries[t]), t))
    for t in order:
        template = templates.words[t]
        places = sorted(p for p in tries[t] if not _inside(solid, p[1]))
        band = max(BAND, int(len(template) * BAND_SHARE))
        diagonals = [d for d, _ in places]
        least = min_coverage * len(template)
        chained = len(template) >= CHAINED_WORDS
        bands: list[tuple[int, list[tuple[int, int]]]] = []
        last = None
        for d in diagonals:
            if last is None or d - last > band:  # else the same band is aligned
                bands.append((d, places[bisect_left(diagonals, d - band):bisect_right(diagonals, d + band)]))
                last = d
        taken: list[tuple[int, int]] = []
        if chained:  # true copies first; hits inside them are none of others
            bands.sort(key=lambda b: -len(b[1]))
        for d, here in bands:
            here = [p for p in here if not _inside(taken, p[1])]
            near = sorted(w for _, w in here)
            # a band may hold several copies: again before and after each, while hits are left there
            todo = [(0, len(words))]
            while todo:
                begin, stop = todo.pop()
                if bisect_left(near, begin) == bisect_left(near, stop):
                    continue
                low, high = max(begin, d - band), max(0, min(stop, d + len(template) + band))
                if chained:
                    if not templates.possible_codes(t, codes[low:high], least):
                        continue
                    inside = [(w, w - e) for e, w in here if low <= w < high]
                    score, n, first, end = align_chained(templates.codes[t], codes, inside, low, high, band)
                else:
                    if not templates.possible(t, words[low:high], least):
                        continue
                    score, n, first, end = align(template, words, d, band, begin, stop)
                if n and n >= least:
                    if templates.right_name(t, words[first:end + 1]):
                        out.append((-score, t, found[first].start(), found[end].end(), n, n / len(template)))
                        if chained and n == len(template) == end - first + 1:
                            insort(solid, (first, end))
                    if chained:
                        insort(taken, (first, end))
                    todo += [(begin, first), (end + 1, stop)]
    kept: list[tuple[int, int, str, int, float]] = []  # by place, without overlaps
    for _, t, a, b, n, coverage in sorted(out):
        at = bisect_left(kept, (a,))
        if (at == 0 or kept[at - 1][1] <= a) and (at == len(kept) or b <= kept[at][0]):
            kept.insert(at, (a, b, templates.names[t], n, coverage))
    return [(name, a, b, n, coverage) for a, b, name, n, coverage in kept]


SCHEMA = ("doc_id bigint, license string, coverage double, matched_words bigint, "
          "span_start bigint, span_end bigint, matched_text string")


def scan(docs: DataFrame, templates=None, min_coverage: float = MIN_COVERAGE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per licence passage: template, share of its words, and the span in code points.

    Without ``templates``, those of ``production_templates`` count.
    """
    templates = production_templates() if templates is None else templates
    ready(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(Templates(list(templates)))
    gap = bytes([_BREAK]) * WINDOW

    def run(batches):
        own = index.value
        for part in slices(batches):
            raw = [t.encode() for t in part["text"].to_pylist()]
            folded = gap.join(r.translate(_FOLD) for r in raw)
            begins = np.concatenate([[0], np.cumsum([len(r) + WINDOW for r in raw])])
            codes = np.frombuffer(folded, np.uint8)
            at = np.flatnonzero(codes)
            h = run_hashes(codes[at])
            per_doc = defaultdict(list)
            for place, t, word in own.hits(h):
                doc = int(np.searchsorted(begins, at[place], "right")) - 1
                per_doc[doc].append((int(at[place] - begins[doc]), t, word))
            rows = []
            for doc in sorted(per_doc):
                doc_id = part["doc_id"][doc].as_py()
                for name, a, b, n, coverage in matches(raw[doc], per_doc[doc], own, min_coverage):
                    text = raw[doc][a:b].decode()
                    first = len(raw[doc][:a].decode())
                    rows.append((doc_id, name, coverage, n, first, first + len(text), text))
            if rows:
                columns = list(zip(*rows))
                types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 names=[f.split()[0] for f in SCHEMA.split(", ")])

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
