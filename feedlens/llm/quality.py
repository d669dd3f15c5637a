"""Quality scores: random Fourier features, ridge by partition-summed normal equations, isotonic calibration.

A document is some twenty statistics of its whole text. Random cosines of the
standardised statistics approximate a Gaussian kernel; every task adds up its
rows' normal equations, and the sums, whose size depends on the number of
features alone, are added in levels, so that the driver gets a few. The ridge scores of rows set aside are
binned over all partitions, and an isotonic curve over the bins turns scores
into shares of label 1. All labelled rows take part.

Defined cases: null and empty texts are scored like any text, from zero
statistics; texts of any length count whole; a document's repeated labels count as their mean, null labels not
at all; without labels every score is 0.5, and with labels of one kind it is
that label; repeated rows are kept; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import hash_mod, id_text, intermediate_tables, ready, slices, with_text_scores, work_dir, written

#: Random cosines, and the width of the kernel in standard deviations of one statistic.
COSINES = 384
WIDTH = 4.0
RIDGE = 1e-3
#: Bins of ridge scores for the isotonic curve.
BIN = 1 / 200
KEEP = 0.3

_DIGITS, _UPPER, _LOWER = (x.encode() for x in (string.digits, string.ascii_uppercase, string.ascii_lowercase))
_ENDS, _SPACE = b".,;:?'\"-()", b" \t\n\r\x0b\x0c"
_SYMBOLS = bytes(set(string.punctuation.encode()) - set(_ENDS))
_MARKS = b".!?"
STATISTICS = ("log_chars", "log_words", "word_length", "digits", "upper", "lower", "wide", "ends", "symbols", "marks",
              "space", "distinct_words", "top_word", "distinct_lines", "words_per_line", "repeated_lines", "long_words",
              "short_words", "loud_words", "bare_words", "exclamations", "bars", "distinct_pairs")


def statistics(text: str) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``; zeros for an empty one."""
    b = text.encode()
    n, words = len(b), b.split()
    if not words:
        return [math.log1p(n)] + [0.0] * (len(STATISTICS) - 1)
    share = lambda chars: (n - len(b.translate(None, chars))) / n
    k, lengths = len(words), np.fromiter(map(len, words), np.int64, len(words))
    counts, lines = Counter(words), [x for x in b.split(b"\n") if x]
    line_counts = Counter(lines)
    digits, upper, lower, ends, symbols, space = map(share, (_DIGITS, _UPPER, _LOWER, _ENDS, _SYMBOLS, _SPACE))
    distinct = list(counts)
    loud = sum(counts[w] for w in distinct if len(w) > 2 and w.isupper())
    bare = sum(counts[w] for w in distinct if not w.translate(None, _SYMBOLS + _ENDS + _DIGITS))
    return [math.log1p(n), math.log1p(k), float(lengths.mean()), digits, upper, lower,
            1 - digits - upper - lower - ends - symbols - space, ends, symbols, share(_MARKS), space,
            len(counts) / k, max(counts.values()) / k, len(line_counts) / max(len(lines), 1),
            math.log1p(k / max(len(lines), 1)),
            sum(len(x) * (c - 1) for x, c in line_counts.items()) / n, float((lengths > 12).mean()),
            float((lengths < 4).mean()), loud / k, bare / k, b.count(b"!") / k, b.count(b"|") / k,
            len(set(zip(words, words[1:]))) / max(k - 1, 1)]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x (array of the statistics)."""
    ready(docs.sparkSession)

    def run(batches):
        for part in slices(batches):
            x = np.array([statistics(t) for t in part["text"].to_pylist()], np.float32)
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part["doc_id"], values], names=["doc_id", "x"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, x array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), len(STATISTICS))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None = None
    scores: np.ndarray | None = None  # of the isotonic curve's blocks
    shares: np.ndarray | None = None
    constant: float = 0.5

    def cosines(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(20)
        directions = rng.normal(0, 1 / WIDTH, (len(STATISTICS), COSINES))
        phases = rng.uniform(0, 2 * np.pi, COSINES)
        z = np.sqrt(2 / COSINES) * np.cos(np.clip((x - self.mean) / self.spread, -6, 6) @ directions + phases)
        return np.hstack([z, np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.cosines(x[i:i + 2000]) @ self.weights for i in range(0, len(x), 2000)] or [np.zeros(0)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        raw = self.ridge(x)
        if self.scores is None:
            return np.clip(raw, 0, 1)
        return np.clip(np.interp(raw, self.scores, self.shares), 0, 1)


#: Vectors that the driver adds up itself.
VECTORS = 8


def summed(rows: DataFrame, compute, size: int) -> np.ndarray:
    """Sum of ``compute(batch)`` (``size`` numbers) over all rows: a vector per task, added up by fewer and
    fewer tasks until at most ``VECTORS`` are left for the driver."""
    def first(batches):
        total = np.zeros(size)
        for batch in batches:
            total += compute(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def second(batches):
        total = np.zeros(size)
        for batch in batches:
            for s in batch["s"].to_pylist():
                total += np.frombuffer(s)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    sums, groups = rows.mapInArrow(first, "s binary"), rows.rdd.getNumPartitions()
    while groups > VECTORS:
        groups = math.isqrt(groups)
        sums = sums.repartition(groups).mapInArrow(second, "s binary")
    return sum((np.frombuffer(r["s"]) for r in sums.collect()), np.zeros(size))


def isotonic(bins: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing shares of (score, sum of labels, rows) bins by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for score, ones, n in sorted(bins):
        blocks.append([score * n, ones, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(rows: DataFrame) -> Model:
    """Model of (x, y, calibrate) rows: y in 0 to 1; rows with ``calibrate`` are for the isotonic curve."""
    with intermediate_tables(rows.sparkSession):
        return _fit(written(rows.select("x", F.col("y").cast("double").alias("y"), "calibrate"),
                            work_dir(rows.sparkSession, "quality")))


def _fit(rows: DataFrame) -> Model:
    d, m = len(STATISTICS), COSINES + 1

    def moments(batch):
        x = _matrix(batch["x"])
        return np.concatenate([[len(x), np.sum(batch["y"].to_numpy(zero_copy_only=False))], x.sum(0), (x * x).sum(0)])

    s = summed(rows, moments, 2 + 2 * d)
    n, ones = s[0], s[1]
    mean = s[2:2 + d] / max(n, 1)
    spread = np.sqrt(np.maximum(s[2 + d:] / max(n, 1) - mean**2, 0))
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0))
    if n == 0 or ones in (0, n):
        model.constant = 0.5 if n == 0 else float(ones > 0)
        return model

    def equations(batch):
        fits = ~batch["calibrate"].to_numpy(zero_copy_only=False)
        total = np.zeros((m, m + 1))
        x, y = _matrix(batch["x"])[fits], batch["y"].to_numpy(zero_copy_only=False)[fits]
        for i in range(0, len(x), 2000):
            z = model.cosines(x[i:i + 2000])
            total[:, :m] += z.T @ z
            total[:, m] += z.T @ y[i:i + 2000]
        return total.ravel()

    e = summed(rows, equations, m * (m + 1)).reshape(m, m + 1)
    # the last cosine is the constant, which counts the rows
    model.weights = np.linalg.solve(e[:, :m] + RIDGE * max(e[m - 1, m - 1], 1) / COSINES * np.eye(m), e[:, m])

    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.round(model.ridge(_matrix(batch["x"])) / BIN).clip(-2000, 2000)),
                                              batch["y"]], names=["bin", "y"])

    bins = (rows.where("calibrate").mapInArrow(scored, "bin double, y double").groupBy("bin")
            .agg(F.sum("y").alias("ones"), F.count("*").alias("n")).collect())
    if bins:
        model.scores, model.shares = isotonic([(b["bin"] * BIN, b["ones"], b["n"]) for b in bins])
    return model


def labelled(stats: DataFrame, labels: DataFrame, teach: Column, calibrate: Column) -> DataFrame:
    """Rows to learn from: statistics joined with the mean label of each document."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.avg(F.col("quality").cast("double")).alias("y")))
    return stats.where(teach).join(marks, "doc_id").select("x", "y", calibrate.alias("calibrate"))


def _folds() -> tuple[Column, Column, Column]:
    key = hash_mod(F.col("doc_id"), 5)
    return key == 0, key != 0, key == 1


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the labelled documents whose id hash modulo 5 is not 0."""
    _, teach, calibrate = _folds()
    return fit(labelled(with_statistics(docs, id_col, text_col), labels, teach, calibrate))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = KEEP) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    stats = written(with_statistics(docs, id_col, text_col), work_dir(docs.sparkSession, "quality-statistics"))
    held_out, teach, calibrate = _folds()
    model = fit(labelled(stats, labels, teach, calibrate))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(_matrix(batch["x"])), pa.float64())],
                                             names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = KEEP, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The documents with a score of at least ``threshold``; columns as before."""
    model = train(docs, labels, id_col, text_col)

    def compute(texts: list[str | None]) -> dict[str, list]:
        x = np.array([statistics(t or "") for t in texts], np.float32).reshape(len(texts), len(STATISTICS))
        return {"score": model.score(x.astype(np.float64)).tolist()}

    scored, names = with_text_scores(docs, compute, {"score": "double"}, text_col)
    return scored.where(F.col(names["score"]) >= threshold).select(*docs.columns)
