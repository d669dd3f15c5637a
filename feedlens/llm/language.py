"""Language identification in two levels: the family first, then the language within it.

A document is the average of hashed byte trigrams of its lower-cased words, so
every linear machine's margin is the mean of its trigram weights over the whole
text. One-versus-one support vector machines separate the families, and the
languages of each family; a logistic curve on each margin gives its share of
the score. The fit reads a bounded sample of labelled rows, about
``sample`` of each language, chosen by a hash of document id and text over all rows;
feature vectors are made on the executors from whole texts, of any length.

Defined cases: ``und`` and score 0 if the text is null or has no letter, or if
there is nothing to learn from; with one learned language that language; rows
with null language teach nothing; repeated rows are kept; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import hash_mod, ready, slices, with_text_scores
from feedlens.llm.svm import fit_linear_svm, fit_sigmoid

#: Families of language codes (ISO 639-1); a code that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "semitic": ("ar", "he", "mt", "am"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
}
#: Hash buckets of the trigrams.
BUCKETS = 4096
#: About so many labelled documents of each language are read for the fit.
SAMPLE = 400
#: Most labelled documents in all (16 kB each on the driver), and most languages that are learned.
SAMPLES, LANGUAGES = 8000, 200
#: A document without a letter, or with less than this score, is rejected by ``keep_identified``.
MIN_SCORE = 0.2
# ASCII characters other than letters count as space
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all trigrams around a non-space byte, and where each text's begin."""
    raw = [b" " + t.lower().encode().translate(_FOLD) + b" " for t in texts]
    a = np.frombuffer(b" ".join(raw) + b"  ", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    code = a[:-2].astype(np.uint32) << 16 | a[1:-1].astype(np.uint32) << 8 | a[2:]
    at = np.flatnonzero(a[1:-1] != 32)
    bucket = (code[at] * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return bucket, np.searchsorted(at, np.concatenate([[0], ends[:-1]]))


def vectors(texts: list[str]) -> np.ndarray:
    """Average of the trigram buckets of each text."""
    bucket, starts = trigrams(texts)
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(bucket)])):
        out[i] = np.bincount(bucket[a:b], minlength=BUCKETS) / max(b - a, 1)
    return out


@dataclass
class Duel:
    """One of two: which, by the sign of a margin; the logistic curve gives the first's share."""

    first: str
    second: str
    column: int
    bias: float
    slope: float
    offset: float


@dataclass
class Model:
    families: dict[str, list[str]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    between: list[Duel] = field(default_factory=list)
    within: dict[str, list[Duel]] = field(default_factory=dict)

    def margins(self, texts: list[str]) -> np.ndarray:
        bucket, starts = trigrams(texts)
        sums = np.zeros((len(texts), self.weights.shape[1]))
        sizes = np.diff([*starts, len(bucket)])
        full = np.flatnonzero(sizes)
        for c in range(self.weights.shape[1] if len(full) else 0):
            sums[full, c] = np.add.reduceat(self.weights[:, c][bucket], starts[full])
        return sums / np.maximum(sizes, 1)[:, None]

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        if not self.families:
            return ["und"] * len(texts), [0.0] * len(texts)
        margins = self.margins([t or "" for t in texts])
        names, scores = [], []
        for text, m in zip(texts, margins):
            if not has_letter(text):
                names.append("und")
                scores.append(0.0)
                continue
            family, p = _winner(sorted(self.families), self.between, m)
            name, q = _winner(self.families[family], self.within.get(family, []), m)
            names.append(name)
            scores.append(p * q)
        return names, scores


def _winner(names: list[str], duels: list[Duel], margins: np.ndarray) -> tuple[str, float]:
    """Most duels won, then the larger sum of shares; its mean share of its duels is the score."""
    if len(names) == 1:
        return names[0], 1.0
    wins, shares = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
    for d in duels:
        m = margins[d.column] + d.bias
        p = 1 / (1 + np.exp(-np.clip(d.slope * m + d.offset, -30, 30)))
        wins[d.first if m > 0 else d.second] += 1
        shares[d.first] += p
        shares[d.second] += 1 - p
    best = max(names, key=lambda n: (wins[n], shares[n], n))
    return best, float(shares[best] / (len(names) - 1))


def fit(x: np.ndarray, labels: list[str], families: dict[str, tuple[str, ...]] | None = None) -> Model:
    """Machines for families and languages from rows of ``vectors`` and their languages."""
    model = Model()
    family_of = {code: f for f, codes in (families or FAMILIES).items() for code in codes}
    labels = np.array(labels, dtype=object)
    for name in sorted(set(labels)):
        model.families.setdefault(family_of.get(name, name), []).append(name)
    groups = np.array([family_of.get(n, n) for n in labels], dtype=object)
    columns = []
    scale = 1 / max(float(np.sqrt((x * x).sum(axis=1)).mean()), 1e-9) if len(x) else 1.0

    def duel(own: np.ndarray, first: str, second: str) -> Duel:
        rows = (own == first) | (own == second)
        part, positive = x[rows] * scale, own[rows] == first
        w, bias = fit_linear_svm(part, positive, cost=10.0)
        slope, offset = fit_sigmoid(part @ w + bias, positive)
        columns.append(w * scale)
        return Duel(first, second, len(columns) - 1, bias, slope, offset)

    for a, b in combinations(sorted(model.families), 2):
        model.between.append(duel(groups, a, b))
    for family, names in model.families.items():
        model.within[family] = [duel(labels, a, b) for a, b in combinations(names, 2)]
    if columns:
        model.weights = np.stack(columns, axis=1).astype(np.float32)
    return model


def train(docs: DataFrame, teach: Column | None = None, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on about ``sample`` labelled rows of each language among the rows where ``teach`` holds.

    What the driver holds is bounded: the ``LANGUAGES`` most frequent languages are
    learned, on fewer rows of each if they would be over ``SAMPLES`` in all. Equal
    rows (id and text) are one row of the sample.
    """
    ready(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if teach is not None:
        rows = rows.where(teach)
    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGUAGES)
    counts = {r["lang"]: r["n"] for r in found.collect()}
    each = max(1, min(sample, SAMPLES // max(len(counts), 1)))
    key = F.xxhash64("doc_id", "text")
    limit = F.lit(-1).cast("bigint")
    for name, n in counts.items():
        limit = F.when(F.col("lang") == name, F.lit(min(2**63 - 1, each * 2**63 // n)).cast("bigint")).otherwise(limit)
    chosen = (rows.where(F.shiftrightunsigned(key, 1) <= limit).groupBy("lang", key.alias("key"))  # draws from 0 to 2^63 - 1
              .agg(F.first("text").alias("text")))

    def run(batches):
        for part in slices(batches):
            told = [(t, n) for t, n in zip(part["text"].to_pylist(), part["lang"].to_pylist()) if has_letter(t)]
            for at in range(0, len(told), 200):
                texts, names = zip(*told[at:at + 200])
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in vectors(list(texts))], pa.binary()),
                                                  pa.array(names, pa.string())], names=["x", "lang"])

    got = chosen.select("text", "lang").mapInArrow(run, "x binary, lang string").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, BUCKETS)
    order = np.lexsort((x @ np.arange(1, BUCKETS + 1, dtype=np.float32), np.array(got["lang"].to_pylist(), dtype="U16")))
    return fit(x[order], [got["lang"][i].as_py() for i in order.tolist()])


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` with lang_pred and score; also the names these two were given."""
    def compute(texts: list[str | None]) -> dict[str, list]:
        names, scores = model.decide(texts)
        return {"lang_pred": names, "score": scores}

    return with_text_scores(docs, compute, {"lang_pred": "string", "score": "double"}, text_col)


def identify(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows whose id hash modulo 3 is not 1."""
    key = hash_mod(F.col(id_col), 3)
    model = train(docs, teach=key != 1, id_col=id_col)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(key == 1, F.lit(False)).alias("held_out"),
                         F.col("text").cast("string").alias("text"))
    return predict(narrow, model)[0].select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id") -> DataFrame:
    """The documents whose language is predicted with at least ``min_score``; columns as before."""
    model = train(docs, teach=hash_mod(F.col(id_col), 3) != 1, id_col=id_col)
    scored, names = predict(docs, model)
    return scored.where((F.col(names["lang_pred"]) != "und") & (F.col(names["score"]) >= min_score)).select(*docs.columns)
