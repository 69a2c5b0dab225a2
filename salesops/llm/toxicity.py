"""Toxicity by a classifier chain.

The categories are predicted one after the other. Each has a logistic model over
the words of a document and over the probabilities of the categories before it.
While learning, those probabilities come from models that did not see the
document (out-of-fold predictions), so a later model does not trust an earlier
one more than it may; while scoring, from the models of all learning rows.

Features are words and word beginnings, as 64-bit hashes. The sample to learn
from is bounded (``MAX_SAMPLE`` rows of either class, drawn by a hash of the
key); all documents are scored, in one pass over whole texts without a shuffle.
The models are a table of at most ``MAX_FEATURES`` weights per category, sent
with the tasks.

Defined cases: a null text is an empty one; labels that are null or not 0 or 1
are not used, of several labels of one key the largest counts; repeated rows are
scored each; rows without key are scored, never learned from; without labels of
both classes all probabilities are 0; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.llm.filters import keep_rows
from salesops.llm.textarrays import LETTERS, Piece, mix, pieces, prefix_sums, run_hashes, words
from salesops.session import materialize

MAX_SAMPLE = 8_000
MAX_FEATURES = 8_192
FOLDS = 3
BEGINNING_BYTES = 5
# A feature is used from this many standard errors between the classes.
LEAST_DEVIATION = 4.0
_BEGINNING = np.uint64(0x5851F42D4C957F2D)
_FILTER_BITS = 20


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def features(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature of each word and each word beginning of the piece."""
    found = words(piece, lower=False, solid_bytes=LETTERS)
    sums = prefix_sums(found.data)
    whole = run_hashes(sums, found.starts, found.ends)
    begun = mix(run_hashes(sums, found.starts, np.minimum(found.starts + BEGINNING_BYTES, found.ends)) ^ _BEGINNING)
    of = np.repeat(np.arange(len(piece)), np.diff(found.of_text))
    return np.concatenate([of, of]), np.concatenate([whole, begun])


def counted(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, feature) with their counts, in order."""
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    at = np.flatnonzero(new)
    return text[at], feature[at], np.diff(np.append(at, len(text)))


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature: texts of each class that hold it, added up within a piece."""
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        for piece in pieces(_lowered(batch.column(1))):
            own = labels[piece.first : piece.first + len(piece)]
            text, feature, _ = counted(*features(piece))
            distinct, back = np.unique(feature, return_inverse=True)
            with_ = np.bincount(back, weights=own[text], minlength=len(distinct)).astype(np.int64)
            all_ = np.bincount(back, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(with_), pa.array(all_ - with_)],
                names=["feature", "with_label", "without"],
            )


class Chain(NamedTuple):
    """Sorted feature hashes; per category weights, weights of earlier categories and the intercept."""

    hashes: np.ndarray
    weights: list[np.ndarray]
    earlier: list[np.ndarray]
    intercepts: list[float]

    def known(self, text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known features of the texts: text, place in the chain's list, count."""
        low = np.zeros(1 << _FILTER_BITS, dtype=bool)
        mask = np.uint64((1 << _FILTER_BITS) - 1)
        low[self.hashes & mask] = True
        likely = low[feature & mask]
        text, feature = text[likely], feature[likely]
        place = np.minimum(np.searchsorted(self.hashes, feature), max(len(self.hashes) - 1, 0))
        hit = self.hashes[place] == feature if len(self.hashes) else np.zeros(len(feature), bool)
        return counted(text[hit], place[hit])

    def lookup(self, text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known features of the texts: text, place in the chain's list, value."""
        text, place, count = self.known(text, feature)
        return text, place, 1 + np.log(count)

    def predict(self, rows: int, text: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Probabilities, one column per category."""
        found = np.zeros((rows, len(self.weights)))
        for k, weights in enumerate(self.weights):
            linear = np.bincount(text, weights=weights[place] * value, minlength=rows) + self.intercepts[k]
            found[:, k] = _sigmoid(linear + found[:, :k] @ self.earlier[k])
        return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logistic(
    rows: int, text: np.ndarray, place: np.ndarray, value: np.ndarray, dense: np.ndarray, label: np.ndarray,
    width: int, rounds: int = 150, penalty: float = 0.05,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the sparse features, of the dense ones, and the intercept, by AdaGrad over all rows."""
    size = width + dense.shape[1] + 1
    weights, moved = np.zeros(size), np.full(size, 1e-8)
    for _ in range(rounds):
        linear = np.bincount(text, weights=weights[place] * value, minlength=rows)
        error = _sigmoid(linear + dense @ weights[width:-1] + weights[-1]) - label
        slope = np.concatenate(
            [np.bincount(place, weights=error[text] * value, minlength=width), dense.T @ error, [error.sum()]]
        )
        slope[:-1] += penalty * weights[:-1]
        moved += slope**2
        weights -= 0.5 * slope / np.sqrt(moved)
    return weights[:width], weights[width:-1], float(weights[-1])


def fit_chain(
    hashes: np.ndarray, text: np.ndarray, place: np.ndarray, value: np.ndarray, labels: np.ndarray, folds: np.ndarray
) -> Chain:
    """From the sample's features and labels (a column per category); ``folds`` numbers the rows' folds."""
    rows, width = len(labels), len(hashes)
    earlier = np.zeros((rows, 0))
    chain = Chain(hashes, [], [], [])
    for k in range(labels.shape[1]):
        unseen = np.zeros(rows)
        for fold in range(FOLDS):
            inside = folds != fold
            new = np.cumsum(inside) - 1
            own = inside[text]
            weights, more, intercept = _logistic(
                int(inside.sum()), new[text[own]], place[own], value[own], earlier[inside], labels[inside, k], width
            )
            linear = np.bincount(text, weights=weights[place] * value, minlength=rows) + earlier @ more + intercept
            unseen[~inside] = _sigmoid(linear[~inside])
        weights, more, intercept = _logistic(rows, text, place, value, earlier, labels[:, k], width)
        chain.weights.append(weights)
        chain.earlier.append(more)
        chain.intercepts.append(intercept)
        earlier = np.column_stack([earlier, unseen])
    return chain


def _features_of(hashes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Chain(hashes, [], [], [])
        for batch in batches:
            for piece in pieces(_lowered(batch.column(2))):
                text, place, count = finder.known(*features(piece))
                bounds = np.searchsorted(text, np.arange(len(piece) + 1))
                lists = [place[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                counts = [count[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, len(piece)),
                        batch.column(1).slice(piece.first, len(piece)),
                        pa.array(lists, pa.list_(pa.int32())),
                        pa.array(counts, pa.list_(pa.int32())),
                    ],
                    names=["label", "drawn", "places", "counts"],
                )

    return run


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of a column of lists, and all their numbers in a row, as longs."""
    lengths = pc.list_value_length(column).to_numpy().astype(np.int64)
    return lengths, pc.list_flatten(column).to_numpy().astype(np.int64)


def _sample(rows: DataFrame, labels: DataFrame, label: str, key: str, text: str) -> DataFrame:
    """At most MAX_SAMPLE labelled rows of either class, stored: label, drawn, text."""
    known = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"))
        .where("key is not null and label in (0, 1)")
        .groupBy("key")
        .agg(F.max("label").cast("long").alias("label"))
        .withColumn("drawn", F.xxhash64(F.col("key").cast("string")))
    )
    chosen = [known.where(F.col("label") == k).orderBy("drawn", "key").limit(MAX_SAMPLE) for k in (0, 1)]
    # Repeated rows of a key count once: any of their texts, the same in every run.
    drawn = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * MAX_SAMPLE rows of 24 bytes
    texts = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return materialize(texts.join(drawn, "key").groupBy("key", "label", "drawn").agg(F.min("text").alias("text")))


def fit(
    rows: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
    severity: tuple[int, ...] = (4, 2),
) -> Chain | None:
    """A chain whose categories are degrees of the label, the label itself last.

    A degree holds for a labelled text with at least so many different features
    that mark the label. None without labels of both classes.
    """
    sample = _sample(rows, labels, label, key, text)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    with_, without = F.col("with_label") / sizes[1], F.col("without") / sizes[0]
    share = (F.col("with_label") + F.col("without") + 1) / (sizes[0] + sizes[1] + 2)
    error = F.sqrt(share * (1 - share) * (1 / sizes[0] + 1 / sizes[1]))
    chosen = (
        sample.select("label", "text")
        .mapInArrow(_class_counts, "feature long, with_label long, without long")
        .groupBy("feature")
        .agg(F.sum("with_label").alias("with_label"), F.sum("without").alias("without"))
        .select("feature", ((with_ - without) / error).alias("deviation"))
        .where(F.col("deviation") >= LEAST_DEVIATION)
        .orderBy(F.desc("deviation"), "feature")
        .limit(MAX_FEATURES)
        .collect()
    )
    hashes = np.sort(np.array([r["feature"] for r in chosen], dtype=np.int64).view(np.uint64))
    # At most 2 * MAX_SAMPLE rows of chosen features; as Arrow columns, not as Python lists of numbers.
    found = (
        sample.select("label", "drawn", "text")
        .mapInArrow(_features_of(hashes), "label long, drawn long, places array<int>, counts array<int>")
        .orderBy("drawn")
        .select("label", "places", "counts")
        .toArrow()
        .combine_chunks()
    )
    given = found.column("label").to_numpy().astype(float)
    lengths, place = _lists(found.column("places"))
    value = 1 + np.log(_lists(found.column("counts"))[1])
    text_of = np.repeat(np.arange(len(found)), lengths)
    marks = [given * (lengths >= degree) for degree in severity]
    folds = np.arange(len(found)) % FOLDS
    return fit_chain(hashes, text_of, place, value, np.column_stack([*marks, given]), folds)


def _score(chain: Chain | None, categories: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(_lowered(batch.column(1))):
                scores = np.zeros((len(piece), categories))
                if chain is not None:
                    scores = chain.predict(len(piece), *chain.lookup(*features(piece)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, len(piece)),
                        *[pa.array(np.ascontiguousarray(scores[:, k])) for k in range(categories)],
                    ],
                    names=["key", *[f"p{k}" for k in range(categories)]],
                )

    return run


def score(rows: DataFrame, chain: Chain | None, names: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and a probability per category, under the given names."""
    kind = rows.schema[key].dataType.simpleString()
    columns = [f"p{k}" for k in range(len(names))]
    scored = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        _score(chain, len(names)), ", ".join([f"key {kind}", *[f"{c} double" for c in columns]])
    )
    return scored.select(F.col("key").alias(key), *[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])


def is_toxic(probability: Column) -> Column:
    return probability >= 0.5


def classify(rows: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``p_frequent``, ``p_repeated``, ``p_toxic`` and ``toxic`` (1 from 0.5 on)."""
    chain = fit(rows, labels, key=key, text=text)
    scored = score(rows, chain, ["p_frequent", "p_repeated", "p_toxic"], key, text)
    return scored.withColumn("toxic", is_toxic(F.col("p_toxic")).cast("int"))


def without_toxic(rows: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all columns, that the chain does not call toxic."""
    chain = fit(rows, labels, key=key, text=text)
    if chain is None:
        return rows
    return keep_rows(
        rows, text,
        lambda: lambda piece: chain.predict(len(piece), *chain.lookup(*features(piece)))[:, -1] < 0.5,
        prepare=_lowered,
    )
