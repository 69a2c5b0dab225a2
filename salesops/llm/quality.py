"""Document quality by a regularised quadratic discriminant.

A document becomes a vector of transformed statistics (shares of capitals,
digits, symbols, repeated words, bigrams and lines, lengths). Each class gets a
mean and a covariance, shrunk towards the covariance of all classes and towards
a sphere. The score is the probability that follows from the difference of the
two log-densities, each a Mahalanobis distance and a determinant from a
Cholesky factor that is computed once and sent with the tasks.

The statistics of all documents are computed in one pass and stored (some 150
bytes a document); sums and products over all labelled rows are added up by
Spark, so that only two small matrices reach the driver.

Defined cases: a null text is an empty one and has a score like any other;
labels that are null, or not 0 or 1, are not used; several labels of a document
all count; documents without doc_id are scored, never learned from; repeated
rows are scored each; without labels of both classes every score is 0.5; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.llm.filters import keep_rows
from salesops.llm.textarrays import Piece, pieces, prefix_sums, run_hashes, words
from salesops.session import materialize

# Weight of the common covariance in a class's own, and of a sphere in both.
TOWARDS_POOLED = 0.25
TOWARDS_SPHERE = 0.02
# Added to every total, so that the shares of short texts stay near zero.
_PSEUDO_COUNT = 20.0

STATISTICS = [
    "words", "word_bytes", "capitals", "digits", "symbols", "marks", "exclamations", "bars",
    "symbol_ends", "repeats", "repeated_bigrams", "repeated_words", "repeated_lines", "sentence_words", "other_bytes",
]


def _members(text: str) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(text.encode())] = True
    return found


_CAPITALS = _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTERS = _CAPITALS | _members("abcdefghijklmnopqrstuvwxyz")
_DIGITS = _members("0123456789")
_SYMBOLS = _members("#$%&*@^~_=+{}[]\\/<>`|")
_MARKS = _members(".,;:?'\"()-")
_OTHER = np.arange(256) >= 128


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _copies(values: np.ndarray) -> int:
    """How many values equal an earlier one."""
    return len(values) - len(np.unique(values))


def statistics(piece: Piece) -> np.ndarray:
    """One row per text, one column per name in STATISTICS."""
    found = words(piece)
    raw, bounds = piece.data, piece.bounds
    size = np.diff(bounds).astype(float)
    count = np.diff(found.of_text).astype(float)
    letters = _per_text(_LETTERS[raw] | _OTHER[raw], bounds)
    sums = prefix_sums(found.data)
    hashes = run_hashes(sums, found.starts, found.ends)
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) > 1 else hashes[:0]
    same = np.concatenate([hashes[1:] == hashes[:-1], [False]]) if len(hashes) else np.zeros(0, bool)
    last = raw[found.ends - 1] if len(hashes) else raw[:0]
    breaks = np.flatnonzero(raw == 10)
    repeats, bigrams, repeated, lines = (np.zeros(len(piece)) for _ in range(4))
    line_total = np.zeros(len(piece))
    for k in range(len(piece)):
        a, b = int(found.of_text[k]), int(found.of_text[k + 1])
        if b - a > 1:
            repeats[k] = np.count_nonzero(same[a : b - 1])
            bigrams[k] = _copies(pairs[a : b - 1])
            repeated[k] = _copies(hashes[a:b])
        first, end = bounds[k], bounds[k + 1]
        inside = breaks[np.searchsorted(breaks, first) : np.searchsorted(breaks, end)]
        if len(inside):
            starts = np.concatenate([[first], inside + 1])
            ends = np.concatenate([inside, [end]])
            long = ends - starts > 3
            lines[k] = _copies(run_hashes(sums, starts[long], ends[long]))
            line_total[k] = np.count_nonzero(long)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.arcsin(np.sqrt(np.clip(part / (whole + _PSEUDO_COUNT), 0, 1)))

    return np.column_stack(
        [
            np.log1p(count),
            np.log1p((size - count) / (count + 1)),
            share(_per_text(_CAPITALS[raw], bounds), letters),
            share(_per_text(_DIGITS[raw], bounds), size),
            share(_per_text(_SYMBOLS[raw], bounds), size),
            share(_per_text(_MARKS[raw], bounds), size),
            share(_per_text(raw == ord("!"), bounds), size),
            share(_per_text(raw == ord("|"), bounds), size),
            share(_per_text(_SYMBOLS[last], found.of_text), count),
            share(repeats, count),
            share(bigrams, count),
            share(repeated, count),
            share(lines, line_total),
            np.log1p(count / (_per_text(raw == ord("."), bounds) + 1)),
            share(_per_text(_OTHER[raw], bounds), size),
        ]
    )


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(1)):
            rows = statistics(piece)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(piece.first, len(piece)), pa.array(list(rows), pa.list_(pa.float64()))],
                names=["key", "statistics"],
            )


def describe(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and its ``statistics``. One pass, no shuffle."""
    kind = rows.schema[key].dataType.simpleString()
    return (
        rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(_describe, f"key {kind}, statistics array<double>")
        .withColumnRenamed("key", key)
    )


class Discriminant(NamedTuple):
    """Per class: mean, inverse Cholesky factor, constant of the log-density. ``None`` without both classes."""

    scale: tuple[np.ndarray, np.ndarray]
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        rows = (rows - self.scale[0]) / self.scale[1]
        density = [
            constant - 0.5 * np.square((rows - mean) @ factor.T).sum(axis=1)
            for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class and task: count, sums and products, as (class, place, value)."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        rows = np.array(batch.column(1).to_pylist()).reshape(len(labels), -1)
        for label in (0, 1):
            own = rows[labels == label]
            if len(own):
                with_one = np.column_stack([np.ones(len(own)), own])
                totals[label] = totals.get(label, 0) + with_one.T @ with_one
    for label, total in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * total.size), pa.array(np.arange(total.size)), pa.array(total.ravel())],
            names=["label", "place", "value"],
        )


def fit(labelled: DataFrame) -> Discriminant | None:
    """From rows (``label``, ``statistics``): all of them count, none is collected."""
    sums = (
        labelled.where("label in (0, 1)")
        .select(F.col("label").cast("long").alias("label"), "statistics")
        .mapInArrow(_sums, "label long, place long, value double")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
        .collect()  # two classes times (statistics + 1) squared
    )
    side = len(STATISTICS) + 1
    totals = np.zeros((2, side * side))
    for row in sums:
        totals[row["label"], row["place"]] = row["value"]
    totals = totals.reshape(2, side, side)
    counts = totals[:, 0, 0]
    if counts.min() < 2:
        return None
    whole = totals.sum(axis=0)
    centre = whole[0, 1:] / whole[0, 0]
    spread = np.sqrt(np.maximum(np.diag(whole)[1:] / whole[0, 0] - centre**2, 1e-12))
    spread[spread < 1e-5] = 1.0
    means, covariances = [], []
    for total in totals:
        mean = total[0, 1:] / total[0, 0]
        covariance = (total[1:, 1:] / total[0, 0] - np.outer(mean, mean)) / np.outer(spread, spread)
        means.append((mean - centre) / spread)
        covariances.append(covariance)
    pooled = sum(n * c for n, c in zip(counts, covariances, strict=True)) / counts.sum()
    factors, constants = [], []
    for n, covariance in zip(counts, covariances, strict=True):
        shrunk = (1 - TOWARDS_POOLED) * covariance + TOWARDS_POOLED * pooled
        sphere = np.trace(shrunk) / len(shrunk) * np.eye(len(shrunk))
        shrunk = (1 - TOWARDS_SPHERE) * shrunk + TOWARDS_SPHERE * sphere
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(n / counts.sum()) - np.log(np.diag(lower)).sum()))
    return Discriminant((centre, spread), means, factors, constants)


def _score(model: Discriminant | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column(1).to_pylist()).reshape(batch.num_rows, -1)
            scores = model.score(rows) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["key", "score"])

    return run


def held_out(key: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether labels of this key are kept out of learning."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % folds == fold, F.lit(False))


def _learned(described: DataFrame, labels: DataFrame, label: str, key: str) -> Discriminant | None:
    known = labels.select(F.col(f"`{key}`").alias(key), F.col(f"`{label}`").alias("label")).where(~held_out(key))
    return fit(described.join(known, key).select("label", "statistics"))


def classify(
    rows: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: the key, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from 0.5 on).

    Learns from the labels of all keys that are not held out.
    """
    kind = rows.schema[key].dataType.simpleString()
    described = materialize(describe(rows, key, text))
    model = _learned(described, labels, label, key)
    scored = described.select(F.col(f"`{key}`").alias("key"), "statistics").mapInArrow(
        _score(model), f"key {kind}, score double"
    )
    return scored.withColumnRenamed("key", key).select(
        key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_poor(
    rows: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows, with all columns, that are predicted to be of class 1.

    Statistics are computed again for the decision: that is cheaper than a join of whole rows.
    """
    model = _learned(materialize(describe(rows, key, text)), labels, label, key)
    return rows if model is None else keep_rows(rows, text, lambda: lambda piece: model.score(statistics(piece)) >= 0.5)
