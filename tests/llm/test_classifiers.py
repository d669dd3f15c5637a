"""Language ID and quality scores: held-out accuracy and defined cases."""

import zlib

import numpy as np
import pytest

from cases import EDGE, SF0001, SF001, edge_table, empty_table
from feedlens.llm import common, language, quality, queries
from feedlens.llm.svm import fit_linear_svm, fit_sigmoid


def _held_out(doc_id, modulus, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == value


def test_svm_separates_and_weighs_classes_alike():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(-1, 0.4, (400, 3)), rng.normal(1, 0.4, (20, 3))])
    positive = np.arange(420) >= 400
    w, b = fit_linear_svm(x, positive)
    assert (((x @ w + b) > 0) == positive).mean() > 0.99
    slope, offset = fit_sigmoid(x @ w + b, positive)
    assert slope > 0 and 1 / (1 + np.exp(-(slope * (x @ w + b)[-1] + offset))) > 0.5


def test_language_query(spark):
    truth = {r.doc_id: r for r in common.documents(spark, SF001).collect()}
    got = queries.QUERIES["op7_language_id"](spark, SF001).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == _held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.97


def test_language_never_sees_held_out_labels(spark):
    """Wrong labels on held-out rows change no prediction."""
    from pyspark.sql import functions as F
    docs = common.documents(spark, SF0001)
    wrong = docs.withColumn("lang", F.when(common.hash_mod(F.col("doc_id"), 3) == 1, "xx").otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, language.identify(d).collect())) for d in (docs, wrong))
    assert a == b


def test_language_families():
    rng = np.random.default_rng(1)
    texts, names = [], []
    for name, letters in (("de", "abc"), ("en", "abd"), ("fr", "xyz"), ("xx", "mno")):
        for _ in range(30):
            texts.append(" ".join("".join(rng.choice(list(letters), 4)) for _ in range(30)))
            names.append(name)
    model = language.fit(language.vectors(texts), names)
    assert model.families == {"germanic": ["de", "en"], "romance": ["fr"], "xx": ["xx"]}
    assert len(model.between) == 3 and len(model.within["germanic"]) == 1
    got, scores = model.decide(texts + [None, "", "12 !!", "½ ² _ 日"[:5]])
    assert got == names + ["und"] * 4 and scores[-4:] == [0.0] * 4 and all(0 <= s <= 1 for s in scores)
    assert language.has_letter("日") and language.has_letter("1 é")


def test_language_defined_cases(spark):
    got = language.identify(edge_table(spark)).collect()
    assert len(got) == len(EDGE)
    by_text = {(r.doc_id): r for r in got}
    assert by_text[2].lang_pred == by_text[3].lang_pred == by_text[10].lang_pred == "und" and by_text[2].score == 0
    assert by_text[1].lang_pred == by_text[6].lang_pred == "en"  # one learned language
    assert language.identify(empty_table(spark)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in language.identify(unlabelled).collect()] == [(1, _held_out(1, 3, 1), "und", 0.0)]
    kept = language.keep_identified(edge_table(spark))
    assert kept.columns == edge_table(spark).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 5, 6, 7, 8, 9, 9, 11]


def test_whole_texts_count(spark):
    """The language of a text's end counts as much as that of its beginning."""
    x = language.vectors(["aaa " * 10 + "bbb " * 5000, "bbb " * 5000])
    assert x[0] @ x[1] / np.sqrt((x[0] @ x[0]) * (x[1] @ x[1])) > 0.99


def _auc(scores, labels):
    p, q = scores[labels == 1], scores[labels == 0]
    return ((p[:, None] > q).mean() + 0.5 * (p[:, None] == q).mean())


def test_quality_query(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    got = queries.QUERIES["op9_quality_score"](spark, SF001).collect()
    assert len(got) == common.documents(spark, SF001).count()
    assert all(r.held_out == _held_out(r.doc_id, 5, 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert _auc(np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])) > 0.95


def test_quality_never_sees_held_out_labels(spark):
    from pyspark.sql import functions as F
    docs, labels = common.documents(spark, SF0001), spark.read.parquet(f"{SF0001}/labels.parquet")
    wrong = labels.withColumn("quality", F.when(common.hash_mod(F.col("doc_id"), 5) == 0, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.score) for r in quality.score_documents(docs, x).collect()) for x in (labels, wrong))
    assert [i for i, _ in a] == [i for i, _ in b]
    assert np.allclose([s for _, s in a], [s for _, s in b], atol=1e-9)


def test_quality_defined_cases(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality.score_documents(edge_table(spark), labels).collect()
    assert len(got) == len(EDGE) and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    one = spark.createDataFrame([(i, 0) for i in range(12)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    assert {r.score for r in quality.score_documents(edge_table(spark), one).collect()} == {0.0}
    assert quality.score_documents(empty_table(spark), one).count() == 0
    kept = quality.keep_good(edge_table(spark), labels)
    assert kept.columns == edge_table(spark).columns and kept.count() == len(EDGE)
    assert quality.keep_good(edge_table(spark), one).count() == 0


def test_statistics_cover_the_whole_text():
    a, b = quality.statistics("good words here. " * 500), quality.statistics("good words here. " * 500 + "### " * 500)
    assert len(a) == len(quality.STATISTICS) and np.isfinite(b).all()
    assert b[quality.STATISTICS.index("symbols")] > a[quality.STATISTICS.index("symbols")]
    assert len(quality.statistics("")) == len(quality.statistics(" \n")) == len(quality.STATISTICS)


def test_isotonic_pools_violators():
    scores, shares = quality.isotonic([(0.1, 0, 2), (0.2, 2, 2), (0.3, 1, 2), (0.4, 2, 2)])
    assert shares.tolist() == [0.0, 0.75, 1.0] and scores.tolist() == pytest.approx([0.1, 0.25, 0.4])


def _plain_language(model, text):
    """The prediction by dictionaries: trigram counts, one duel after the other."""
    words = " ".join("".join(c if c.isalpha() and c.isascii() or ord(c) > 127 else " " for c in text.lower()).split())
    if not language.has_letter(text):
        return "und", 0.0
    vector = language.vectors([text])[0].astype(float)
    assert words
    weights = {k: v for k, v in enumerate(vector.tolist()) if v}

    def contest(names, duels):
        if len(names) == 1:
            return names[0], 1.0
        wins, shares = {n: 0 for n in names}, {n: 0.0 for n in names}
        for d in duels:
            m = sum(v * float(model.weights[k, d.column]) for k, v in weights.items()) + d.bias
            p = 1 / (1 + np.exp(-(d.slope * m + d.offset)))
            wins[d.first if m > 0 else d.second] += 1
            shares[d.first] += p
            shares[d.second] += 1 - p
        best = max(names, key=lambda n: (wins[n], shares[n], n))
        return best, shares[best] / (len(names) - 1)

    family, p = contest(sorted(model.families), model.between)
    name, q = contest(model.families[family], model.within[family])
    return name, p * q


def test_language_query_against_plain_duels(spark):
    from pyspark.sql import functions as F
    docs = common.documents(spark, SF001)
    model = language.train(docs, teach=common.hash_mod(F.col("doc_id"), 3) != 1)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op7_language_id"](spark, SF001).collect()}
    for doc_id in sorted(texts)[::7]:
        name, score = _plain_language(model, texts[doc_id] or "")
        assert got[doc_id].lang_pred == name and got[doc_id].score == pytest.approx(score, abs=1e-4)


def test_language_sample_is_bounded(spark, monkeypatch):
    """Many languages, and one row repeated very often: the driver's share keeps its bound."""
    monkeypatch.setattr(language, "SAMPLES", 60)
    monkeypatch.setattr(language, "LANGUAGES", 20)
    rows = [(i, f"{'abcdefghijklmnopqrstuvwxy'[i % 25] * 4} word {i}", f"l{i % 25:02d}") for i in range(2000)]
    rows += [(5, "the very same text", "l05")] * 3000
    seen = []
    fit = language.fit
    monkeypatch.setattr(language, "fit", lambda x, labels: seen.append((len(x), len(set(labels)))) or fit(x, labels))
    language.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert seen[0][0] < 200 and 5 <= seen[0][1] <= 20


def test_quality_query_against_least_squares(spark):
    """The normal equations by plain least squares over all rows, and a naive isotonic fit: the same scores."""
    docs = {r.doc_id: r.text or "" for r in common.documents(spark, SF001).collect()}
    labels = {r.doc_id: float(r.quality) for r in spark.read.parquet(f"{SF001}/labels.parquet").collect() if r.quality is not None}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in docs}
    x = {i: np.array(quality.statistics(t), np.float32).astype(float) for i, t in docs.items()}
    teach = [i for i in docs if i in labels and fold[i] != 0]
    known = np.array([x[i] for i in teach])
    spread = known.std(axis=0)
    model = quality.Model(known.mean(axis=0), np.where(spread > 1e-9, spread, 1.0))
    fits = [i for i in teach if fold[i] != 1]
    z = model.cosines(np.array([x[i] for i in fits]))
    strength = np.sqrt(quality.RIDGE * len(fits) / quality.COSINES)
    model.weights = np.linalg.lstsq(np.vstack([z, strength * np.eye(z.shape[1])]),
                                    np.r_[[labels[i] for i in fits], np.zeros(z.shape[1])], rcond=None)[0]
    held = [i for i in teach if fold[i] == 1]
    raw = np.round(model.ridge(np.array([x[i] for i in held])) / quality.BIN).clip(-2000, 2000) * quality.BIN
    bins = sorted(set(raw))
    ones = np.array([sum(labels[i] for i, r in zip(held, raw) if r == b) for b in bins])
    n = np.array([sum(1 for r in raw if r == b) for b in bins])
    # naive isotonic regression: the largest of the smallest means around each bin
    share = [max(min(ones[a:b + 1].sum() / n[a:b + 1].sum() for b in range(k, len(bins))) for a in range(k + 1)) for k in range(len(bins))]
    blocks = {}
    for k, s in enumerate(share):
        blocks.setdefault(round(s, 12), []).append(k)
    at = [np.average([bins[k] for k in ks], weights=n[ks]) for ks in blocks.values()]
    want = dict(zip(docs, np.interp(model.ridge(np.array([x[i] for i in docs])), at, list(blocks))))
    got = {r.doc_id: r.score for r in queries.QUERIES["op9_quality_score"](spark, SF001).collect()}
    assert set(got) == set(want) and max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_sums_need_few_vectors_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(quality, "VECTORS", 2)
    rows = spark.range(1000, numPartitions=40).selectExpr("cast(id as double) AS v")
    total = quality.summed(rows, lambda b: np.array([b.num_rows, sum(b["v"].to_pylist())]), 2)
    assert total.tolist() == [1000.0, 499500.0]
