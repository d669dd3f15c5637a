import random
import re
import time

import numpy as np
import pytest

from cases import LONG, SF001, documents, edge_table, empty_table
from feedlens.llm import common, queries
from feedlens.llm import license_scan as scan


def test_winnowing_guarantee():
    """A shared run of RUN + WINDOW - 1 characters always has a common fingerprint."""
    rng = random.Random(2)
    for _ in range(60):
        shared = "".join(rng.choices("abcdef0123", k=scan.RUN + scan.WINDOW - 1))
        sides = []
        for _ in range(2):
            text = ("".join(rng.choices("ghij", k=rng.randint(20, 60))) + shared + "".join(rng.choices("klmn", k=rng.randint(20, 60))))
            h = scan.run_hashes(np.frombuffer(text.encode(), np.uint8))
            sides.append({int(v) for v in h[scan.winnow(h)]})
        assert sides[0] & sides[1]


def test_run_hashes_depend_on_the_run_alone():
    a = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    h = scan.run_hashes(a)
    assert len(h) == len(a) - scan.RUN + 1 and len(set(h.tolist())) == len(h)
    assert h[5] == scan.run_hashes(a[5:5 + scan.RUN])[0]
    broken = a.copy()
    broken[7] = 1
    assert (scan.run_hashes(broken)[:8] == scan._NONE).all() and scan.run_hashes(broken)[8] == h[8]


def _edit_distance_matches(template, words):
    """Longest common subsequence, the most words any alignment can match."""
    table = np.zeros((len(template) + 1, len(words) + 1), int)
    for i, a in enumerate(template):
        for j, b in enumerate(words):
            table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


def test_alignment_matches_edited_templates():
    rng = random.Random(3)
    words = [f"w{i}".encode() for i in range(60)]
    for _ in range(40):
        edited = list(words)
        for _ in range(3):
            k = rng.randrange(len(edited))
            edited[k:k + 1] = rng.choice([[], [b"new"], [edited[k], b"new"]])
        text = [b"noise"] * 10 + edited + [b"noise"] * 10
        score, n, first, last = scan.align(words, text, 10, 6)
        assert n == _edit_distance_matches(words, text) and first >= 10 and last < 10 + len(edited) and score > 0


def test_spans_and_coverage(spark):
    apache = dict(scan.NOTICES)["Apache-2.0"]
    rows = [(1, f"Some text. {apache} More text.\nReleased under the  MIT\nlicense!"),
            (2, "Licensed under CC BY-NC 4.0, as agreed."),
            (3, "This work is licensed under the GNU General Public Licence, version 3."),  # one word differs
            (4, "Licensed by nobody, under no version of any license at all."),
            (5, "日本 é " * 50 + apache)]
    got = scan.scan(documents(spark, rows)).collect()
    found = {(r.doc_id, r.license): r for r in got}
    assert set(found) == {(1, "Apache-2.0"), (1, "MIT"), (2, "CC-BY-NC-4.0"), (3, "GPL-3.0"), (5, "Apache-2.0")}
    for r in got:
        assert dict(rows)[r.doc_id][r.span_start:r.span_end] == r.matched_text
    assert found[(1, "MIT")].matched_text == "Released under the  MIT\nlicense" and found[(1, "MIT")].coverage == 1
    assert found[(3, "GPL-3.0")].coverage == pytest.approx(11 / 12) and found[(3, "GPL-3.0")].matched_words == 11


def test_long_templates_and_repeats(spark):
    grant = dict(scan.NOTICES)["MIT-grant"]
    words = grant.split()
    damaged = " ".join(w for n, w in enumerate(words) if n % 12 != 5)
    rows = [(1, LONG + grant + " " + LONG + damaged + " " + grant), (2, " ".join(words[:30]))]
    got = sorted(scan.scan(documents(spark, rows)).collect(), key=lambda r: (r.doc_id, r.span_start))
    assert [(r.doc_id, r.license) for r in got] == [(1, "MIT-grant")] * 3
    assert got[0].coverage == got[2].coverage == 1 and 0.8 < got[1].coverage < 1
    part = scan.scan(documents(spark, rows), min_coverage=0.4).where("doc_id = 2").first()
    assert part.coverage == pytest.approx(30 / len(re.findall(r"[0-9A-Za-z]+", grant)), abs=0.02)


def test_copies_side_by_side(spark):
    line = "Released under the MIT License.\n"
    rows = [(n, line * n) for n in (2, 3, 10, 50)]
    got = scan.scan(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.span_start) for r in got) == [(n, k * len(line)) for n in (2, 3, 10, 50) for k in range(n)]
    assert all(r.coverage == 1 for r in got)
    # two damaged copies whose diagonals are four words apart, and a template of six words
    own = [("own", "alphabet bravissimo charlatan deltas echoes foxtrots")]
    copies = "alphabet bravissimo charlatan deltas echoes " * 2 + "alphabet bravissimo charlatan deltas echoes foxtrots"
    assert scan.scan(documents(spark, [(1, copies)]), templates=own).count() == 3


def test_wide_alignment_equals_the_plain_one(monkeypatch):
    rng = random.Random(5)
    for _ in range(60):
        template = [rng.choice([b"a", b"b", b"c", b"d", b"e%d" % n]) for n in range(rng.randint(3, 40))]
        text = [rng.choice([b"a", b"b", b"x"]) for _ in range(9)] + [w for w in template if rng.random() < 0.9] + [b"a", b"c"] * 5
        args = (template, text, rng.randint(-4, 14), rng.randint(1, 16), rng.randint(0, 4), len(text) - rng.randint(0, 4))
        monkeypatch.setattr(scan, "WIDE_BAND", 16)
        plain = scan.align(*args)
        monkeypatch.setattr(scan, "WIDE_BAND", 0)
        assert scan.align(*args) == plain


def test_whole_licences(spark):
    own = scan.production_templates()
    texts = {name: next(t for n, t in own if n == name and len(t) == max(len(t) for n, t in own if n == name)) for name in scan.WHOLE}
    rows = [(k, f"Some words before. {t}\nAnd some after.") for k, t in enumerate(texts.values())]
    got = {}
    for r in scan.scan(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, name in enumerate(texts):
        assert [r.license for r in got[k]] == [name] and got[k][0].coverage == 1, name
    warranty = texts["MIT"][texts["MIT"].index("THE SOFTWARE IS"):]
    assert [r.license for r in scan.scan(documents(spark, [(1, warranty)])).collect()] == ["MIT-warranty"]


def test_notices_are_named_by_version_and_marks(spark):
    want = {"Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
            "Licensed under CC BY-SA 3.0.": "CC-BY-SA-3.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
            "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
            "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
            "This work is licensed under the GNU General Public License, version 9.": None,
            "Licensed under the Apache License, Version 1.1.": None}
    got = {r.doc_id: r.license for r in scan.scan(documents(spark, list(enumerate(want)))).collect()}
    assert [got.get(k) for k in range(len(want))] == list(want.values())


def test_short_notices_with_one_word_changed(spark):
    rows = [(1, "It is available under the MIT License"), (2, "Released under an MIT License"), (3, "Licensed under a CC BY-SA 4.0 ")]
    padded = [(i + 10 * k, "qzx jvk " * k + t + " wvu" * k) for i, t in rows for k in range(12)]
    got = {(r.doc_id, r.license, r.matched_words) for r in scan.scan(documents(spark, padded)).collect()}
    names = {1: "MIT", 2: "MIT", 3: "CC-BY-SA-4.0"}
    assert got >= {(i + 10 * k, names[i], 4) for i in (1, 2) for k in range(12)}
    assert {(i, name) for i, name, _ in got} == {(i + 10 * k, names[i]) for i in names for k in range(12)}


def test_short_forms(spark):
    want = {"This project is MIT licensed": "MIT", "SPDX-License-Identifier: GPL-3.0": "GPL-3.0",
            "SPDX-License-Identifier: LGPL-2.1": "LGPL-2.1", "// SPDX-License-Identifier: MIT": "MIT",
            "Licensed under Apache License 2.0": "Apache-2.0", "Released under the BSD 3-Clause License": "BSD-3-Clause",
            "Released under the BSD 2-Clause License": "BSD-2-Clause", "This project is fully licensed": None,
            "Released under the Foo License.": None, "SPDX-License-Identifier: WTFPL": None}
    got = {r.doc_id: r.license for r in scan.scan(documents(spark, list(enumerate(want)))).collect()}
    assert [got.get(k) for k in range(len(want))] == list(want.values())


def _full_local_alignment(template, words):
    """Best local alignment by the whole table, without band or index: score, and all (matches, first, last) that reach it."""
    rows, columns = len(template) + 1, len(words) + 1
    best, found = 0, set()
    s = [[(0, 0, -1)] * columns for _ in range(rows)]
    for i in range(1, rows):
        for j in range(1, columns):
            same = template[i - 1] == words[j - 1]
            d, m, f = s[i - 1][j - 1]
            cell = (d + 2, m + 1, f if m else j - 1) if same else (d - 1, m, f)
            for x, m2, f2 in (s[i - 1][j], s[i][j - 1]):
                if x - 1 > cell[0]:
                    cell = (x - 1, m2, f2)
            s[i][j] = cell if cell[0] > 0 else (0, 0, -1)
            if same and cell[0] >= best:
                found = (found if cell[0] == best else set()) | {(cell[1], cell[2], j - 1)}
                best = cell[0]
    return best, found


def test_chained_alignment_equals_the_whole_table():
    """Edited long templates in a text of other words: the same score as by a full dynamic program, hence the same coverage."""
    rng = random.Random(12)
    template = [f"w{rng.randrange(60)}" for _ in range(160)]
    number = {w: k for k, w in enumerate(dict.fromkeys(template))}
    codes = np.array([number[w] for w in template], np.int32)
    for trial in range(25):
        edited = list(template)
        for _ in range(rng.randrange(0, 16)):
            k = rng.randrange(len(edited))
            edited[k:k + rng.choice([1, 1, 2])] = rng.choice([[], ["new"], [edited[k], "new", "words"]])
        if trial % 5 == 0:
            edited = edited[:70] + ["lost"] * 6 + edited[76:]
        text = ["noise"] * 15 + edited + ["noise"] * 15
        words = np.array([number.get(w, -1) for w in text], np.int32)
        hits = [(j, i) for i in range(len(template) - 2) for j in range(len(text) - 2) if template[i:i + 3] == text[j:j + 3]]
        best, found = _full_local_alignment(template, text)
        score, n, first, last = scan.align_chained(codes, words, hits, 0, len(text), 40)
        assert score == best and any(abs(n - m) <= 1 for m, _, _ in found)
        assert 15 <= first <= last < len(text) - 15


def test_edited_licences_and_many_of_them_in_time(spark):
    texts = dict(sorted(scan.production_templates(), key=lambda t: len(t[1])))
    rng = random.Random(4)
    rows = []
    for k, name in enumerate(("GPL-3.0", "LGPL-2.1", "Apache-2.0", "MPL-2.0")):
        words = texts[name].split(" ")
        for _ in range(len(words) // 40):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], ["changed"], [words[at], "added"]])
        rows.append((k, " ".join(words)))
    rows.append((9, "\n\nnext copy\n\n".join([texts["GPL-3.0"]] * 5)))
    rows.append((10, "Released under the MIT License.\n" * 8000))
    began = time.perf_counter()
    got = {}
    for r in scan.scan(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert time.perf_counter() - began < 60
    for k, name in enumerate(("GPL-3.0", "LGPL-2.1", "Apache-2.0", "MPL-2.0")):
        assert [r.license for r in got[k]] == [name] and 0.9 < got[k][0].coverage < 1
    assert [r.license for r in got[9]] == ["GPL-3.0"] * 5 and all(r.coverage == 1 for r in got[9])
    assert len(got[10]) == 8000


def test_defined_cases(spark):
    assert scan.scan(edge_table(spark)).count() == 0
    assert scan.scan(empty_table(spark)).count() == 0
    twice = documents(spark, [(1, "Released under the MIT License."), (1, "Released under the MIT License."),
                              (None, "Released under the MIT License.")])
    assert sorted(map(str, (r.doc_id for r in scan.scan(twice).collect()))) == ["1", "1", "None"]
    with pytest.raises(ValueError, match="fewer than"):
        scan.scan(twice, templates=[("short", "MIT")])


def test_query_against_plain_search(spark):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SF001).collect()]
    plain = {(name, i, m.start(), m.end()) for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0") for i, t in rows
             for m in re.finditer(re.escape(dict(scan.NOTICES)[name].rstrip(".")), t or "")}
    got = {(r.license, r.doc_id, r.span_start, r.span_end) for r in queries.QUERIES["op1_license_scan"](spark, SF001).collect()}
    assert got == plain and len(plain) > 20
