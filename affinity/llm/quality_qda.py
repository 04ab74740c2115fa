"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a short vector of transformed statistics (``FEATURES``). The
labelled rows of the training fold give, per class, counts, means and
covariances as sums of a fixed number of moments (one aggregate; no sample is
collected). Every class covariance is shrunk towards the pooled one and that
towards its diagonal, factored once (Cholesky), and the factors travel with
the scoring task. The score is the logistic of the difference of the two
Gaussian log densities plus the log prior odds.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import stored

FEATURES = ("log_words", "word_len", "symbols", "bangs", "upper", "digits", "distinct", "repeated_lines",
            "line_words", "stops", "longest_word", "repeated_triples", "other_punct")
#: share of the pooled covariance in a class covariance, and of the diagonal in the pooled one
SHRINK, RIDGE = 0.2, 0.1
#: pseudo-counts of characters, lines and triples that keep a ratio of a very short text near zero
CHARS, LINES, TRIPLES = 60, 6, 40
#: added to every variance, so that a constant feature can't dominate
FLOOR = 1e-3
_DROP_LOWER = re.compile(r"[^A-ZÀ-ÖØ-Þ]+")
_SYMBOLS = "#*$%&|<>"
_DIGITS = "0123456789"
_OTHER = ";:()[]{}=/\\_@^~+\"'"


def _count(text: str, chars: str) -> int:
    return sum(map(text.count, chars))


def statistics(text: str | None) -> list[float]:
    """The feature vector of one text; null counts as empty."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text) + CHARS
    lines = [x for x in text.split("\n") if x.strip()]
    triples = list(zip(words, words[1:], words[2:]))
    root = math.sqrt
    return [
        math.log1p(n),
        math.log1p(sum(map(len, words)) / n) if n else 0.0,
        root(_count(text, _SYMBOLS) / chars),
        root(text.count("!") / chars),
        root(len(_DROP_LOWER.sub("", text)) / chars),
        root(_count(text, _DIGITS) / chars),
        math.log1p(len(set(words))) / math.log1p(n) if n else 1.0,
        root((len(lines) - len(set(lines))) / (len(lines) + LINES)),
        math.log1p(n / len(lines)) / 5 if lines else 0.0,
        root(_count(text, ".") / (n + 10)),
        math.log1p(max(map(len, words))) / 5 if n else 0.0,
        root((len(triples) - len(set(triples))) / (len(triples) + TRIPLES)),
        root(_count(text, _OTHER) / chars),
    ]


@dataclass
class Discriminant:
    """Per class (0, 1): log prior, mean, inverse Cholesky factor and log determinant."""

    prior: list[float]
    mean: list[np.ndarray] = field(default_factory=list)
    whiten: list[np.ndarray] = field(default_factory=list)
    log_det: list[float] = field(default_factory=list)

    @classmethod
    def from_moments(cls, n: list[float], total: list[np.ndarray], square: list[np.ndarray],
                     shrink: float = SHRINK, ridge: float = RIDGE, floor: float = FLOOR) -> "Discriminant":
        """From counts, sums and sums of outer products of both classes.

        With a class absent the discriminant falls back to the (smoothed) prior.
        """
        rows = sum(n)
        self = cls([math.log((n[c] + 1) / (rows + 2)) for c in (0, 1)])
        if min(n) < 1:
            return self
        mean = [total[c] / n[c] for c in (0, 1)]
        cov = [square[c] / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)]
        pooled = sum(n[c] * cov[c] for c in (0, 1)) / rows
        pooled = (1 - ridge) * pooled + ridge * np.diag(np.diag(pooled))
        for c in (0, 1):
            factor = np.linalg.cholesky((1 - shrink) * cov[c] + shrink * pooled + floor * np.eye(len(pooled)))
            self.mean.append(mean[c])
            self.whiten.append(np.linalg.inv(factor))
            self.log_det.append(2 * float(np.log(np.diag(factor)).sum()))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for the rows of ``x``."""
        odds = np.full(len(x), self.prior[1] - self.prior[0])
        for c, sign in zip(range(len(self.mean)), (-1, 1)):
            apart = ((x - self.mean[c]) @ self.whiten[c].T) ** 2
            odds += sign * -0.5 * (apart.sum(axis=1) + self.log_det[c])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, x): the feature vector of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x], ["doc_id", "x"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


def held_out(doc_id) -> F.Column:
    """True where crc32 of the id as text leaves the remainder 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> Discriminant:
    """Fit on every labelled row outside the held-out fold; rows with a null label or id don't count."""
    train = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = train.select("doc_id", F.col(label_col).cast("int").alias("y")).join(
        stats.where("doc_id is not null"), "doc_id").select("y", "x")
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = np.asarray(b.column(0))
            x = np.asarray(b.column(1).flatten()).reshape(-1, d)
            for c in (0, 1):
                own = x[y == c]
                flat = np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * len(flat), pa.int32()), pa.array(range(len(flat)), pa.int32()),
                     pa.array(flat, pa.float64())], ["y", "k", "v"])

    sums = rows.mapInArrow(moments, "y int, k int, v double").groupBy("y", "k").agg(F.sum("v").alias("v"))
    flat = np.zeros((2, 1 + d + d * d))  # the result has at most this many cells, whatever the input
    for r in sums.collect():
        flat[r["y"], r["k"]] = r["v"]
    return Discriminant.from_moments([flat[c, 0] for c in (0, 1)], [flat[c, 1:1 + d] for c in (0, 1)],
                                     [flat[c, 1 + d:].reshape(d, d) for c in (0, 1)])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words. Repeated ids are
    separate rows. Labels, language, source and id are no inputs of a score.
    Without labels of both classes every score is the prior (0.5 with none).
    An empty table gives an empty result.
    """
    stats = stored(document_statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, labels)
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(1).flatten()).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, all columns unchanged (one pass to fit, one to filter)."""
    model = fit(stored(document_statistics(docs, id_col, text_col), "statistics"), labels)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([statistics(t.as_py()) for t in b.column(at)])
                yield b.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
