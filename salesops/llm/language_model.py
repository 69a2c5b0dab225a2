"""Scores of documents by a hierarchical Pitman-Yor language model.

Three levels of restaurants. Every training word, and the end of a text, has a
context restaurant of its own, whose dishes are the words that follow it. Its
base is a coarser model: each of the ``CLASSES`` - 1 most frequent words and the
end is a class, all other words are one class, RARE; every class has a
restaurant over classes, whose customers are the tables of its words'
restaurants, and all of them share one parent, whose customers are their tables.
A word within RARE comes from a further restaurant over all occurrences of all
other training words, whose base gives half its mass to the one unknown word.

Seating is sampled by Gibbs, a dish at a time with all its customers. Given
x ~ Gamma(strength / discount + tables) of a restaurant, its dishes are
independent, with weight ``discount * base * x`` of a new table, so that a
restaurant of many dishes may lie in several tasks. What counts of a seating is
the number of its tables: for up to ``EXACT`` customers it is drawn from its exact
distribution, which does not ask for the seating before. Larger dishes keep the
places of the customers that opened tables; a new seating is drawn for a whole
dish from front to back, waiting times at once, and taken by Metropolis-Hastings
(``reseated``), which costs as many steps as it has tables, for any number of
customers. A parent keeps its seating: customers come and go at its end.
Restaurants of words are sampled against the parent of the sweep before.
Predictive probabilities are averaged over the sweeps after burn-in. In the
restaurant of rare words, the words of equal count share the mean of their
seatings, each drawn by itself or as numbers of words per number of tables.

Counts of words and pairs cover all training texts and stay distributed. A pair
that is learned once always has one table of its own, so it needs no sampling and
is not stored, unless a held-out text has it: a pair of a learned text that no
stored row holds was learned once. Pairs of two words that the list lacks are
always stored. Numbers travel in parcels, a row per bucket, as binary values.
Scoring takes the ``FREQUENT`` most frequent words and ``FREQUENT_PAIRS`` pairs
from broadcast lists of these fixed lengths,
looks all other pairs and words up in the bucket of their hash.

Defined cases: a null text is an empty one (its end is its one token); a null key
counts as an empty text when keys are drawn, which holds it out; repeated rows
are scored each and learned from each; without training texts all words are
unknown; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.llm.textarrays import pieces, word_hashes, words
from salesops.session import TASK_ROWS, materialize, small_side, written

CLASSES = 256
# Bytes of texts handled at once: their hashes stay in a core's cache.
PIECE = 1 << 18
FREQUENT = 1 << 17
FREQUENT_PAIRS = 1 << 20
# Words or pairs counted by a task before it passes them on; tokens learned per bucket of words or pairs that go to one task.
HELD_PAIRS = 1 << 21
BUCKET_TOKENS = 1 << 20
# Unlisted pairs that a task holds before it passes them on, and parts of the texts that are scored one after the other,
# to hold less on disk at once.
HELD_ASKED = 1 << 19
PARTS = 2
# Added to the count of a pair that an asked text has.
ASKED = 1 << 40
# Dishes of a listed word's restaurant in one row; a larger restaurant has several rows.
DISHES = 4096
BURN_IN, SWEEPS = 3, 6
# Counts up to here have their numbers of tables drawn from the exact distribution.
EXACT = 64
# Counts up to here have them drawn without logarithms.
FEW = 8
# Dishes that a sweep takes together: the steps that large dishes need are taken once for all of them.
TOGETHER = 400_000
STRENGTH = 1.0
UNKNOWN_SHARE = 0.5
_END = np.uint64(0xE0D0F0A7E0D0F0A7)
_SEED = 20_240_601


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) % 10 == 0


def tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, token hashes (each text's words and its end), and the bounds of the texts, a piece at a time."""
    for piece in pieces(texts, PIECE):
        found = words(piece)
        rows = len(piece)
        bounds = found.of_text + np.arange(rows + 1)
        stream = np.full(len(found.starts) + rows, _END, dtype=np.uint64)
        inside = np.ones(len(stream), dtype=bool)
        inside[bounds[1:] - 1] = False
        stream[inside] = word_hashes(found)
        yield piece.first, stream, bounds


class Finder:
    """Where 64-bit keys stand among sorted distinct ones, by a table of slots; keys that share one have a table of their own."""

    def __init__(self, keys: np.ndarray, odd: int = 0x9E3779B97F4A7C15, depth: int = 0) -> None:
        bits = max(len(keys).bit_length() + 2, 8)
        self.keys, self.odd, self.shift = keys, np.uint64(odd), np.uint64(64 - bits)
        self.table = np.full(1 << bits, -1, dtype=np.int32)
        slots, at = self._slots(keys), np.arange(len(keys), dtype=np.int32)
        self.table[slots] = at
        self.table[slots[self.table[slots] != at]] = -2
        self.shared = np.flatnonzero(self.table[slots] == -2)
        self.others = Finder(keys[self.shared], odd * odd + 2 & (1 << 64) - 1, depth + 1) if len(self.shared) and depth < 4 else None

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.odd) >> self.shift).astype(np.int64)

    def place(self, asked: np.ndarray) -> np.ndarray:
        """-1 where a key is not among them."""
        if not len(self.keys):
            return np.full(len(asked), -1)
        at = self.table[self._slots(asked)]
        found = np.where(self.keys[np.maximum(at, 0)] == asked, at, -1).astype(np.int64)
        open_ = np.flatnonzero(at == -2)
        if len(open_) and self.others:
            there = self.others.place(asked[open_])
            found[open_] = np.where(there >= 0, self.shared[there], -1)
        elif len(open_):
            there = np.minimum(np.searchsorted(self.keys, asked[open_]), len(self.keys) - 1)
            found[open_] = np.where(self.keys[there] == asked[open_], there, -1)
        return found


def _spread(keys: np.ndarray, buckets: int) -> np.ndarray:
    """One of so many buckets for each 64-bit key."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def _blobs(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """Consecutive runs of numbers (or rows of as many numbers), each as one binary value."""
    values = np.ascontiguousarray(values)
    width = values.itemsize * math.prod(values.shape[1:])
    bounds = (np.concatenate([[0], np.cumsum(lengths)]) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(values)])


def _runs(column: pa.Array | pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all binary values in a row, and how many each has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not len(column) or column.null_count == len(column):
        return np.zeros(0, kind), np.zeros(len(column), dtype=np.int64)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return data.view(kind), np.diff(bounds) // np.dtype(kind).itemsize


def _flat(column: pa.Array | pa.ChunkedArray, kind) -> np.ndarray:
    return _runs(column, kind)[0]


def _parcels(buckets: np.ndarray, **columns: np.ndarray) -> dict[str, pa.Array]:
    """Per bucket one row, which holds its part of each column as a binary value: Spark then moves few rows."""
    small = buckets.astype(np.uint16) if len(buckets) and buckets.max() < 1 << 16 else buckets
    order = np.argsort(small, kind="stable")
    sorted_ = buckets[order]
    at = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])[: len(order)])
    lengths = np.diff(np.append(at, len(order)))
    return {"bucket": pa.array(sorted_[at].astype(np.int32)), **{name: _blobs(lengths, values[order]) for name, values in columns.items()}}


def _rows_of(names: list[str], kind: int, parcels: dict[str, pa.Array]) -> pa.RecordBatch:
    """Parcels of a kind; columns they lack are null."""
    rows = len(parcels["bucket"])
    given = {"kind": pa.array(np.full(rows, kind, dtype=np.int8)), **parcels}
    return pa.RecordBatch.from_arrays([given[n] if n in given else pa.nulls(rows, pa.binary()) for n in names], names=names)


def _few(batch: pa.RecordBatch, rows: int = 16) -> Iterator[pa.RecordBatch]:
    """Parcels a few at a time: the JVM holds them several times over."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[at], *(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values)


class Lexicon(NamedTuple):
    """Frequent words: sorted hashes with their counts and classes; words of no class of their own are RARE."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    rare: int

    def place(self, stream: np.ndarray) -> np.ndarray:
        """Where each token is in the list; -1 where it is not."""
        if not len(self.words):
            return np.full(len(stream), -1)
        place = np.minimum(np.searchsorted(self.words, stream), len(self.words) - 1)
        return np.where(self.words[place] == stream, place, -1)

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and count of places; -1 where there is no count."""
        if not len(self.words):
            return np.full(len(place), self.rare), np.full(len(place), -1)
        return np.where(place >= 0, self.classes[place], self.rare), np.where(place >= 0, self.counts[place], -1)

    def find(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and count of each token; -1 where the count is not in the list."""
        return self.at(self.place(stream))

    def own(self) -> Lexicon:
        """The words with a class of their own."""
        own = self.classes != self.rare
        return Lexicon(self.words[own], self.counts[own], self.classes[own], self.rare)


def _lexicon(counted: DataFrame) -> Lexicon:
    end = F.col("word") == int(_END.view(np.int64))
    rows = counted.orderBy(F.desc(end), F.desc("count"), "word").limit(FREQUENT).collect()
    found = np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)
    counts = np.array([r["count"] for r in rows], dtype=np.int64)
    classes = np.full(len(found), CLASSES, dtype=np.int64)
    own = [k for k in range(len(found)) if found[k] != _END][: CLASSES - 1]
    classes[own] = np.arange(1, len(own) + 1)
    classes[found == _END] = 0
    order = np.argsort(found)
    return Lexicon(found[order], counts[order], classes[order], CLASSES)


def _before(values: np.ndarray, bounds: np.ndarray, end) -> np.ndarray:
    """What stands before each token; a text begins after an end."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[bounds[:-1]] = end
    return before


def _joined(contexts: np.ndarray, words_: np.ndarray) -> np.ndarray:
    """One hash for two."""
    mixed = (contexts ^ (contexts >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words_
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


_WORDS = "bucket int, word binary, count binary"


def _count_words(buckets: int):
    """Words and their counts, in parcels by the hash of the word."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        parcels = _parcels(_spread(found, buckets), word=found, count=counts)
        return pa.RecordBatch.from_arrays(list(parcels.values()), names=list(parcels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, stream, _ in tokens(batch.column(0)):
                held.append(stream)
                size += len(stream)
                if size > HELD_PAIRS:
                    yield from _few(counted(held))
                    held, size = [], 0
        if held:
            yield from _few(counted(held))

    return run


def _word_counts(parcels: pa.Table) -> pa.Table:
    found, counts = _sums(_flat(parcels.column("word"), np.uint64), _flat(parcels.column("count"), np.int64))
    return pa.Table.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["word", "count"])


_PAIRS = "bucket int, context binary, word binary, count binary"


def _count_pairs(lexicon: Lexicon, buckets: int):
    """Of texts (``text``, ``learned``, ``asked``) the pairs with the times they are learned, plus ``ASKED`` where an asked
    text has them, in parcels by the hash of the pair. The last bucket has the pairs of classes, as ``word``.
    """
    own, side = lexicon.own(), lexicon.rare + 1
    names = ["bucket", "context", "word", "count"]

    def counted(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        contexts, found, marks = (np.concatenate(x) for x in zip(*held, strict=True))
        joined = _joined(contexts, found)
        order = np.argsort(joined)
        joined, marks = joined[order], marks[order]
        at = np.flatnonzero(np.append(True, joined[1:] != joined[:-1])[: len(joined)])
        counts = np.add.reduceat((marks & 1).astype(np.int64), at) + ASKED * (np.bitwise_or.reduceat(marks, at) >> 1).astype(np.int64)
        first = order[at]
        parcels = _parcels(_spread(joined[at], buckets), context=contexts[first], word=found[first], count=counts)
        return pa.RecordBatch.from_arrays(list(parcels.values()), names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        classed, size, finder = np.zeros(side * side, dtype=np.int64), 0, Finder(own.words)
        for batch in batches:
            learned, asked = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.uint8) for k in (1, 2))
            for first, stream, bounds in tokens(batch.column(0)):
                rows = slice(first, first + len(bounds) - 1)
                marks = np.repeat(learned[rows] + 2 * asked[rows], np.diff(bounds))
                classes, _ = own.at(finder.place(stream))
                at = _before(classes, bounds, 0) * side + classes
                classed += np.bincount(at[marks & 1 > 0], minlength=side * side)
                held.append((_before(stream, bounds, _END), stream, marks))
                size += len(stream)
                if size > HELD_PAIRS:
                    yield from _few(counted(held))
                    held, size = [], 0
        if held:
            yield from _few(counted(held))
        met = np.flatnonzero(classed)
        parcels = _parcels(np.full(len(met), buckets), context=met, word=met, count=classed[met])
        yield pa.RecordBatch.from_arrays(list(parcels.values()), names=names)

    return run


def _wanted_pairs(lexicon: Lexicon, buckets: int):
    """Of the parcels of a bucket the pairs to store: learned repeatedly, or once and asked for, or of two words that the
    lexicon lacks. Pairs of classes have no context.
    """
    names = ["context", "word", "count"]

    def run(parcels: pa.Table) -> pa.Table:
        contexts, found = (_flat(parcels.column(c), np.uint64) for c in ("context", "word"))
        counts = _flat(parcels.column("count"), np.int64)
        if parcels.num_rows and parcels.column("bucket")[0].as_py() == buckets:
            word, count = _sums(found, counts)
            return pa.Table.from_arrays([pa.nulls(len(word), pa.int64()), pa.array(word.view(np.int64)), pa.array(count)], names=names)
        joined = _joined(contexts, found)
        order = np.argsort(joined)
        joined = joined[order]
        at = np.flatnonzero(np.append(True, joined[1:] != joined[:-1])[: len(joined)])
        counts = np.add.reduceat(counts[order], at) if len(at) else counts
        first = order[at]
        learned = counts % ASKED
        wanted = (learned > 1) | (learned == 1) & (counts > ASKED)
        other, finder = np.flatnonzero(~wanted), Finder(lexicon.words)
        other = other[finder.place(found[first[other]]) < 0]
        wanted[other[finder.place(contexts[first[other]]) < 0]] = True
        first, learned = first[wanted], learned[wanted]
        return pa.Table.from_arrays([pa.array(contexts[first].view(np.int64)), pa.array(found[first].view(np.int64)), pa.array(learned)], names=names)

    return run


def discount(counts: np.ndarray) -> float:
    """From how many counts are one and two."""
    ones, twos = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
    return min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.9)


# The next three seat one customer at a time; tests compare ``reseated`` with the same distribution.
def seat(customers: int, pull: float, discount_: float, rng: np.random.Generator) -> list[int]:
    """A first seating of a dish's customers: when tables open is drawn, and they grow in proportion.

    ``pull`` is the weight of a new table, (strength + discount * tables) * parent's probability.
    """
    opened, now = [1.0], 1.0
    while len(opened) < customers:
        begun = now - discount_ * len(opened)
        growth = math.exp(min(-math.log(1 - rng.random()) / max(pull, 1e-12), 700.0))
        now = max(discount_ * len(opened) + begun * growth, now + 1)
        if not now < customers:
            break
        opened.append(now)
    sizes = [max(1, int(customers * (1 - discount_) / t**0.5 / len(opened))) for t in opened]
    sizes[0] += customers - sum(sizes)
    while sizes[0] < 1:  # rounding gave the later tables too much
        largest = max(range(len(sizes)), key=sizes.__getitem__)
        sizes[largest] -= 1
        sizes[0] += 1
    return sizes


def reseat(sizes: list[int], times: int, weight: float, strength: float, discount_: float, others: int, rng) -> None:
    """Some customers of a dish leave their tables and sit down again.

    ``weight`` is the parent's probability of the dish, ``others`` the tables of the restaurant's other dishes.
    """
    customers = sum(sizes)
    for leave, sit, where in rng.random((times, 3)).tolist():
        at = _table(sizes, leave * customers, 0.0)
        sizes[at] -= 1
        if not sizes[at]:
            sizes.pop(at)
        new = (strength + discount_ * (others + len(sizes))) * weight
        old = customers - 1 - discount_ * len(sizes)
        if not sizes or sit * (new + old) < new:
            sizes.append(1)
        else:
            sizes[_table(sizes, where * old, discount_)] += 1


def _table(sizes: list[int], point: float, discount_: float) -> int:
    for k, size in enumerate(sizes):
        point -= size - discount_
        if point < 0:
            return k
    return len(sizes) - 1


def gammaln(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function above 0."""
    x = np.asarray(x, dtype=float)
    small = x < 10
    up = np.where(small, x + 10, x)
    rows = np.where(small, x, 1.0)
    shift = rows.copy()
    for k in range(1, 10):
        shift = shift * (rows + k)
    square = up**-2.0
    tail = (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680))) / up
    return (up - 0.5) * np.log(up) - up + 0.5 * math.log(2 * math.pi) + tail - np.where(small, np.log(shift), 0.0)


class Seating(NamedTuple):
    """Of several dishes: customers, tables, and the places of the customers that opened these, from 1."""

    customers: np.ndarray
    tables: np.ndarray
    opened: np.ndarray

    def fit(self, counts: np.ndarray) -> Seating:
        """Without the tables of customers that have gone."""
        of = np.repeat(np.arange(len(counts)), self.tables)
        kept = self.opened <= counts[of]
        customers = np.minimum(self.customers, counts)
        return Seating(customers, np.bincount(of[kept], minlength=len(counts)), self.opened[kept])


def _blocks(now: np.ndarray, counts: np.ndarray, pulls: np.ndarray, discount_: float) -> tuple[np.ndarray, np.ndarray]:
    """Where the block of places ends that ``now`` customers stand in, and the weight of a new table there.

    A table makes all later customers less likely by about (place / counts) ** discount, which the proposal foresees.
    """
    ends = np.minimum(np.exp2(np.floor(np.log2(now)) + 1), counts)
    return ends, np.maximum(pulls * (np.sqrt(now * ends) / counts) ** discount_, 1e-12)


def forward(counts: np.ndarray, pulls: np.ndarray, discount_: float, rng: np.random.Generator, old: Seating | None = None) -> Seating:
    """Customers sit down from front to back, after those of an old seating.

    Between two openings the chance of a new table is that of a beta-geometric waiting time.
    """
    customers, counts = counts, counts.astype(float)
    if old is None:
        now, tables = np.minimum(counts, 1.0), np.minimum(counts, 1.0)
        places, dishes = [np.ones(int(tables.sum()))], [np.flatnonzero(tables)]
    else:
        tables = old.tables.astype(float)
        dishes, places = [np.repeat(np.arange(len(counts)), old.tables)], [old.opened.astype(float)]
        now = old.customers.astype(float)
    active = np.flatnonzero(now < counts)
    while len(active):
        at, n = now[active], counts[active]
        fresh = at < 1
        ends, pull = _blocks(np.maximum(at, 1.0), n, pulls[active], discount_)
        chance = rng.beta(pull, np.where(fresh, 1.0, at - discount_ * tables[active]))
        with np.errstate(divide="ignore", over="ignore"):
            wait = np.maximum(np.ceil(np.log(1 - rng.random(len(active))) / np.log1p(-chance)), 1.0)
        then = np.where(fresh, 1.0, at + np.where(chance > 0, wait, np.inf))
        opens = fresh | (then <= ends)
        now[active] = np.where(opens, then, ends)
        tables[active[opens]] += 1
        dishes.append(active[opens])
        places.append(then[opens])
        active = active[now[active] < counts[active]]
    dish, place = np.concatenate(dishes), np.concatenate(places)
    order = np.lexsort((place, dish))
    return Seating(customers, np.bincount(dish, minlength=len(counts)), place[order].astype(np.int64))


def _weights(seating: Seating, counts: np.ndarray, pulls: np.ndarray, discount_: float) -> np.ndarray:
    """Logarithm of how much likelier each dish's seating is than ``forward`` draws it, up to a constant."""
    counts = counts.astype(float)
    total = np.zeros(len(counts))
    of = np.repeat(np.arange(len(counts)), seating.tables)
    rank = np.arange(len(of)) - np.repeat(np.cumsum(seating.tables) - seating.tables, seating.tables) + 1.0
    now = seating.opened.astype(float)
    last = np.append(of[1:] != of[:-1], True)[: len(of)]
    until = np.where(last, counts[of], np.append(now[1:], 0.0)[: len(of)])
    while len(of):
        ends, pull = _blocks(now, counts[of], pulls[of], discount_)
        ends = np.where(now < until, np.minimum(ends, until), now)
        seated = gammaln(ends - discount_ * rank + pull) - gammaln(now - discount_ * rank + pull)
        opened = (ends == until) & ~last & (now < until)
        total += np.bincount(of, weights=seated + np.where(opened, np.log(pulls[of] / pull), 0.0), minlength=len(counts))
        more = ends < until
        of, rank, now, until, last = of[more], rank[more], ends[more], until[more], last[more]
    return total


def reseated(old: Seating | None, counts: np.ndarray, pulls: np.ndarray, discount_: float, rng) -> Seating:
    """All customers of every dish sit down anew; ``pulls`` are the weights of new tables.

    The counts may have changed: customers leave from the end, new ones sit down after the others.
    """
    pulls = np.maximum(pulls, 1e-12)
    new = forward(counts, pulls, discount_, rng)
    if old is None:
        return new
    old = forward(counts, pulls, discount_, rng, old.fit(counts))
    gain = _weights(new, counts, pulls, discount_) - _weights(old, counts, pulls, discount_)
    taken = np.log(1 - rng.random(len(counts))) < gain
    of_new, of_old = (np.repeat(np.arange(len(counts)), x.tables) for x in (new, old))
    in_new, in_old = taken[of_new], ~taken[of_old]
    dish = np.concatenate([of_new[in_new], of_old[in_old]])
    opened = np.concatenate([new.opened[in_new], old.opened[in_old]])
    return Seating(counts, np.where(taken, new.tables, old.tables), opened[np.argsort(dish, kind="stable")])


def _crowd(tables: float, strength: float, discount_: float, rng) -> float:
    """The x of a restaurant, given which its dishes are independent."""
    return discount_ * rng.gamma(strength / discount_ + tables)


def _uniform(keys: np.ndarray, draw: int) -> np.ndarray:
    """A number between 0 and 1 for each key and draw, the same wherever it is drawn."""
    mixed = keys + np.uint64((draw + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53 + 2.0**-54


# Draws of a sweep: one for the dishes of each restaurant, and those of its crowd.
_DRAWS = 1024


def crowds(tables: np.ndarray, strength: float, discount_: float, keys: np.ndarray, sweep: int) -> np.ndarray:
    """The x of restaurants by their keys, as ``_crowd``: gamma numbers by squeezed normal ones."""
    shape = strength / discount_ + tables - 1 / 3
    width, found = 1 / np.sqrt(9 * shape), np.ones(len(shape))
    left = np.arange(len(shape))
    for draw in range(_DRAWS * sweep + 1, _DRAWS * (sweep + 1) - 3, 3):
        first, second, third = (_uniform(keys[left], draw + k) for k in range(3))
        normal = np.sqrt(-2 * np.log(first)) * np.cos(2 * np.pi * second)
        cube = (1 + width[left] * normal) ** 3
        with np.errstate(invalid="ignore", divide="ignore"):
            taken = np.log(third) < normal**2 / 2 + shape[left] * (1 - cube + np.log(cube))
        taken &= cube > 0
        found[left[taken]] = cube[taken]
        left = left[~taken]
        if not len(left):
            break
    return discount_ * shape * found


def table_weights(most: int, discount_: float) -> np.ndarray:
    """At [n, t] the logarithm of how many ways, weighted, n customers have t tables."""
    found = np.full((most + 1, most + 2), -np.inf)
    found[0, 0] = 0.0
    at = np.arange(most + 1)
    for n in range(most):
        with np.errstate(divide="ignore"):
            stay = found[n, :-1] + np.log(np.maximum(n - discount_ * at, 0.0))
        found[n + 1, :-1] = stay
        found[n + 1, 1:] = np.logaddexp(found[n + 1, 1:], found[n, :-1])
    return found[:, :-1]


def drawn_tables(counts: np.ndarray, pulls: np.ndarray, weights: np.ndarray, uniforms: np.ndarray) -> np.ndarray:
    """Numbers of tables of dishes from their exact distribution; ``weights`` are ``table_weights``."""
    found = np.ones(len(counts), dtype=np.int64)
    order = np.argsort(counts.astype(np.min_scalar_type(len(weights))), kind="stable")
    bounds = np.searchsorted(counts[order], np.arange(2, len(weights) + 1))
    for n, begin, end in zip(range(2, len(weights)), bounds, bounds[1:], strict=False):
        if begin == end:
            continue
        at = order[begin:end]
        if n <= FEW:  # powers of a pull are no risk yet, nor is their sum
            powers, share = [np.ones(len(at))], np.exp(weights[n, 2 : n + 1] - weights[n, 1])
            for _ in share:
                powers.append(powers[-1] * pulls[at])
            total = np.cumsum([powers[0], *(p * x for p, x in zip(powers[1:], share, strict=True))], axis=0)
            found[at] += (total[:-1] < uniforms[at] * total[-1]).sum(axis=0)
        else:
            chance = weights[n, 1 : n + 1] + np.log(np.maximum(pulls[at], 1e-300))[:, None] * np.arange(1, n + 1)
            total = np.cumsum(np.exp(chance - chance.max(axis=1, keepdims=True)), axis=1)
            found[at] += (total < uniforms[at, None] * total[:, -1:]).sum(axis=1)
    return found


def table_numbers(most: int, pull: float, discount_: float) -> np.ndarray:
    """Row n: probabilities of 0, 1, 2, ... tables of a dish of n customers."""
    found = np.zeros((most + 1, most + 1))
    found[0, 0] = 1.0
    if most:
        found[1, 1] = 1.0
    at = np.arange(most + 1)
    for n in range(1, most):
        row = found[n] * np.maximum(n - discount_ * at, 0.0)
        row[1:] += found[n, :-1] * pull
        found[n + 1] = row / row.sum()
    return found


def _predictive(
    counts: np.ndarray, tables: np.ndarray, parent: np.ndarray, discount_: float, strength: float = STRENGTH
) -> np.ndarray:
    """Probabilities of the dishes; contexts by row, if there are several."""
    customers, all_tables = counts.sum(axis=-1, keepdims=True), tables.sum(axis=-1, keepdims=True)
    return (counts - discount_ * tables + (strength + discount_ * all_tables) * parent) / (strength + customers)


class Rare(NamedTuple):
    """The restaurant of rare words: probability by count, and of the unknown word."""

    counts: np.ndarray
    probabilities: np.ndarray
    unknown: float

    def of(self, counts: np.ndarray) -> np.ndarray:
        """Probability within RARE of words with these counts (0: unknown)."""
        if not len(self.counts):
            return np.full(len(counts), self.unknown)
        place = np.minimum(np.searchsorted(self.counts, counts), len(self.counts) - 1)
        return np.where(counts > 0, self.probabilities[place], self.unknown)


def fit_rare(counts: np.ndarray, many: np.ndarray) -> Rare:
    """``many`` words have each of the sorted ``counts``."""
    if not len(counts):
        return Rare(counts, counts.astype(float), 1.0)
    rng = np.random.default_rng([_SEED, 1 << 20])
    ones, twos = (int(many[counts == k].sum()) for k in (1, 2))
    discount_ = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.9)
    vocabulary, customers = float(many.sum()), float((counts * many).sum())
    weight = (1 - UNKNOWN_SHARE) / vocabulary
    pull = (STRENGTH + discount_ * vocabulary) * weight
    few = counts <= EXACT
    each = np.repeat(np.flatnonzero(~few), many[~few])
    seating = forward(counts[each], np.full(len(each), pull), discount_, rng)
    tables = np.where(few, many, 0).astype(float) + np.bincount(each, weights=seating.tables, minlength=len(counts))
    kept, unknown, samples = np.zeros(len(counts)), 0.0, 0
    for sweep in range(BURN_IN + SWEEPS):
        pull = _crowd(tables.sum(), STRENGTH, discount_, rng) * weight
        seating = reseated(seating, counts[each], np.full(len(each), pull), discount_, rng)
        tables = np.bincount(each, weights=seating.tables, minlength=len(counts)).astype(float)
        numbers = table_numbers(int(counts[few].max(initial=0)), pull, discount_)
        drawn = rng.multinomial(many[few], numbers[counts[few]])
        tables[few] = drawn @ np.arange(len(numbers))
        if sweep >= BURN_IN:
            new = (STRENGTH + discount_ * float(tables.sum())) / (STRENGTH + customers)
            kept += (counts - discount_ * tables / many) / (STRENGTH + customers) + new * weight
            unknown += new * UNKNOWN_SHARE
            samples += 1
    return Rare(counts, kept / samples, unknown / samples)


class Classes:
    """The restaurants of the classes and their parent."""

    def __init__(self, side: int) -> None:
        self.side, self.rng = side, np.random.default_rng([_SEED, 1 << 21])
        self.lower: Seating | None = None
        self.upper: Seating | None = None
        self.base = np.full(side, 1 / side)
        self.parent = self.base
        self.probabilities = np.full((side, side), 1 / side)

    def sweep(self, counts: np.ndarray) -> None:
        """``counts`` are the tables of the restaurants of words, by class of the context and of the word."""
        discount_, flat = discount(counts[counts > 0]), counts.ravel()
        held = self.lower.tables.reshape(counts.shape) if self.lower else np.minimum(counts, 1)
        crowds = np.array([_crowd(t, STRENGTH, discount_, self.rng) for t in held.sum(axis=1).tolist()])
        self.lower = reseated(self.lower, flat, (crowds[:, None] * self.parent).ravel(), discount_, self.rng)
        tables = self.lower.tables.reshape(counts.shape)
        above = tables.sum(axis=0)
        held = self.upper.tables if self.upper else np.minimum(above, 1)
        self.upper = reseated(self.upper, above, _crowd(held.sum(), STRENGTH, 0.5, self.rng) * self.base, 0.5, self.rng)
        self.parent = _predictive(above, self.upper.tables, self.base, 0.5)
        self.probabilities = _predictive(counts, tables, self.parent[None, :], discount_)


# Numbers of a restaurant's dishes are binary values, which Spark passes on as they are: of repeated dishes, and of ``once``.
_CELLS = {"word": np.int64, "dish": np.int16, "count": np.int64, "inside": np.float64}
_ONCE = {f"once_{name}": kind for name, kind in _CELLS.items()}
_SEATED = {"tables": np.int32, "opened": np.int64, "seated": np.int32}
_KEPT = ["context", "chunk", "chunks", "class", "customers", "singles", *_CELLS, *_ONCE]
_STATE = (
    "context long, chunk int, chunks int, class int, customers long, singles long, "
    + ", ".join(f"{c} binary" for c in (*_CELLS, *_ONCE, *_SEATED))
    + ", totals array<long>"
)


def _release(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _lists(lengths: np.ndarray, values) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values))


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of restaurants, put together until they have many dishes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(_flat(batch.column(batch.schema.get_field_index("word")), np.int64))
        if size > TOGETHER:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _sweep(parent: np.ndarray, discount_: float, sweep: int):
    """Rows of restaurants with new seatings; ``whole`` are the tables of a restaurant, of which a row may be a part.

    Dishes of up to ``EXACT`` customers keep no seating: theirs is drawn from its exact distribution. Each draw
    depends on the restaurant, the word and the sweep alone; only larger dishes are drawn a batch at a time.
    """
    weights = table_weights(EXACT, discount_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            get = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            contexts = get["context"].to_numpy().view(np.uint64)
            chunks, classes, whole, singles = (get[c].to_numpy() for c in ("chunk", "class", "whole", "singles"))
            rows, dishes = batch.num_rows, _runs(get["word"], np.int64)[1]
            found, dish, counts, inside = (_flat(get[c], kind) for c, kind in _CELLS.items())
            of = np.repeat(np.arange(rows), dishes)
            crowd = crowds(whole + singles, STRENGTH, discount_, contexts, sweep)
            pulls = crowd[of] * parent[classes[of], dish] * inside
            keys = _joined(contexts[of], found.view(np.uint64))
            few = counts <= EXACT
            tables = np.ones(len(counts), dtype=np.int64)
            tables[few] = drawn_tables(counts[few], pulls[few], weights, _uniform(keys[few], _DRAWS * sweep))
            many, old = counts[~few], None
            if sweep:
                old = Seating(many, _flat(get["tables"], np.int32)[~few].astype(np.int64), _flat(get["opened"], np.int64))
            seed = [_SEED, sweep, int(contexts[0]) if rows else 0, int(chunks[0]) if rows else 0]
            seating = reseated(old, many, pulls[~few], discount_, np.random.default_rng(seed))
            tables[~few] = seating.tables
            own = np.bincount(of, weights=tables, minlength=rows).astype(np.int64)
            opened = np.bincount(of[~few], weights=seating.tables, minlength=rows).astype(np.int64)
            seated = _flat(get["seated"], np.int32) if sweep else np.zeros(len(counts), dtype=np.int32)
            before = get["totals"].flatten().to_numpy().reshape(rows, -1) if sweep else np.zeros((rows, 0), np.int64)
            totals = np.column_stack([before, own])
            found = pa.RecordBatch.from_arrays(
                [
                    *(get[c] for c in _KEPT), _blobs(dishes, tables.astype(np.int32)), _blobs(opened, seating.opened),
                    _blobs(dishes, (seated + tables * (sweep >= BURN_IN)).astype(np.int32)), _lists(np.full(rows, totals.shape[1]), totals.ravel()),
                ],
                names=[*_KEPT, *_SEATED, "totals"],
            )
            yield from _few(found, 10_000)

    return run


def _class_tables(side: int, kind):
    """By class of the context and of the dish: sums of what the third column has by dish, and how often that is two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, twos = np.zeros(side * side, dtype=np.int64), np.zeros(side * side, dtype=np.int64)
        for batch in batches:
            dish, dishes = _runs(batch.column(1), _CELLS["dish"])
            tables = _flat(batch.column(2), kind)
            at = np.repeat(batch.column(0).to_numpy(), dishes).astype(np.int64) * side + dish
            total += np.bincount(at, weights=tables, minlength=side * side).astype(np.int64)
            twos += np.bincount(at[tables == 2], minlength=side * side)
        met = np.flatnonzero(total)
        columns = [pa.array(x) for x in (met // side, met % side, total[met], twos[met])]
        yield pa.RecordBatch.from_arrays(columns, names=["class", "dish", "tables", "twos"])

    return run


def _dense(rows: DataFrame, side: int) -> np.ndarray:
    found = np.zeros((side, side), dtype=np.int64)
    for r in rows.groupBy("class", "dish").agg(F.sum("tables").alias("tables")).collect():  # at most side * side rows
        found[r["class"], r["dish"]] = r["tables"]
    return found


def _dense_tables(state: DataFrame, column: str, side: int) -> tuple[np.ndarray, np.ndarray]:
    """By class of the context and of the dish: sums of a column of the dishes, and how often it is two."""
    kind = {**_CELLS, **_SEATED}[column]
    found = state.select("class", "dish", column).mapInArrow(_class_tables(side, kind), "class long, dish long, tables long, twos long")
    sums, twos = (np.zeros((side, side), dtype=np.int64) for _ in range(2))
    for r in found.groupBy("class", "dish").agg(F.sum("tables").alias("tables"), F.sum("twos").alias("twos")).collect():  # at most side * side rows
        sums[r["class"], r["dish"]], twos[r["class"], r["dish"]] = r["tables"], r["twos"]
    return sums, twos


class Samples(NamedTuple):
    """What the sweeps after burn-in leave: probabilities of classes by sweep, and the discount of words' restaurants."""

    classes: np.ndarray
    discount: float

    def weights(self, customers: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """What each restaurant gives its base, by sweep; without customers it is its base alone."""
        share = (STRENGTH + self.discount * totals) / (STRENGTH + customers)[:, None]
        return np.where(customers[:, None] > 0, share, 1.0)

    def backed(self, weights: np.ndarray, classes: np.ndarray, dishes: np.ndarray) -> np.ndarray:
        """What a restaurant takes from its base: ``weights`` by dish and sweep."""
        total = np.zeros(len(classes))
        for k, base in enumerate(self.classes):
            total += weights[:, k] * base[classes, dishes]
        return total / len(self.classes)

    def single(self, customers: np.ndarray) -> np.ndarray:
        """What a word that stands once after a context has of its own."""
        return (1 - self.discount) / (STRENGTH + customers)


def _totals(lists: pa.Array, customers: np.ndarray) -> np.ndarray:
    """Tables by sweep; where there is no list all customers sit alone."""
    found = np.repeat(customers[:, None], SWEEPS, axis=1)
    given = lists.is_valid().to_numpy(zero_copy_only=False)
    found[given] = lists.drop_null().flatten().to_numpy().reshape(-1, SWEEPS)
    return found


def _inside(lexicon: Lexicon, rare: Rare, dishes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probability of words within their classes, by their counts."""
    return np.where(dishes == lexicon.rare, rare.of(counts), 1.0)


_FITTED = "pair long, context long, word long, count long, log double, seen float, unseen float"


def _finished(samples: Samples, lexicon: Lexicon):
    """Cells with the logarithm of their probability, and by how much it is above that of a pair seen once (``seen``) or never;
    above nothing if the lexicon has neither word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon.words)
        for batch in batches:
            get = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            all_contexts, all_customers, all_classes = (get[c].to_numpy() for c in ("context", "customers", "class"))
            all_weights = samples.weights(all_customers, _totals(get["kept"], all_customers))
            lacks = finder.place(all_contexts.view(np.uint64)) < 0
            for once, names in enumerate((_CELLS, _ONCE)):
                word, dish, counts, inside = (_flat(get[c], kind) for c, kind in names.items())
                seated = counts if once else _flat(get["seated"], _SEATED["seated"]) / SWEEPS
                of = np.repeat(np.arange(batch.num_rows), _runs(get[next(iter(names))], np.int64)[1])
                contexts, customers = all_contexts[of], all_customers[of]
                backed = samples.backed(all_weights[of], all_classes[of], dish) * inside
                logs = np.log10((counts - samples.discount * seated) / (STRENGTH + customers) + backed)
                lone = lacks[of]
                lone[lone] = finder.place(word[lone].view(np.uint64)) < 0
                seen, unseen = (np.where(lone, logs, logs - np.log10(x + backed)) for x in (samples.single(customers), 0.0))
                columns = [
                    _joined(contexts.view(np.uint64), word.view(np.uint64)).view(np.int64), contexts, word, counts, logs,
                    seen.astype(np.float32), unseen.astype(np.float32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["pair", "context", "word", "count", "log", "seen", "unseen"])

    return run


class Model(NamedTuple):
    lexicon: Lexicon
    classes: np.ndarray
    rare: Rare
    tokens: int
    distinct: int
    samples: Samples

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))

    def inside(self, dishes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _inside(self.lexicon, self.rare, dishes, counts)


def _counts_by_word(lexicon: Lexicon, buckets: int, names: list[str], kind: int, key: str, value: str):
    """Parcels of the words that the lexicon lacks, by their hash, and of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon.words)
        for batch in batches:
            words_, counts = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            lacks = finder.place(words_) < 0
            words_ = words_[lacks]
            yield _rows_of(names, kind, _parcels(_spread(words_, buckets), **{key: words_, value: counts[lacks]}))

    return run


_PLACED = ["bucket", "kind", "context", "word", "count", "inside"]
_PLACED_ROWS = "bucket int, kind byte, context binary, word binary, count binary, inside binary"
# Kinds of parcels: pairs, and counts of words.
_PAIRS_, _COUNTS = 0, 1


def _chunks(lexicon: Lexicon, place: np.ndarray) -> np.ndarray:
    """Rows of the restaurant of each context: a word that is learned n times has n / 2 repeated dishes at most."""
    if not len(lexicon.words):
        return np.ones(len(place), dtype=np.int64)
    return np.where(place >= 0, np.maximum(-(-lexicon.counts[place] // (2 * DISHES)), 1), 1)


def _chunk(chunks: np.ndarray, contexts: np.ndarray, words_: np.ndarray) -> np.ndarray:
    return np.where(chunks > 1, _joined(words_, contexts) % chunks.astype(np.uint64), 0).astype(np.int64)


def _by_context(lexicon: Lexicon, finder: Finder, buckets: int, contexts, words_, counts, inside) -> dict[str, pa.Array]:
    """Parcels of pairs by the row of a restaurant that has them."""
    chunks = _chunks(lexicon, finder.place(contexts))
    keys = np.where(chunks > 1, _joined(contexts, _chunk(chunks, contexts, words_).astype(np.uint64)), contexts)
    return _parcels(_spread(keys, buckets), context=contexts, word=words_, count=counts, inside=inside)


def _placed(lexicon: Lexicon, rare: Rare, buckets: int, lacking: bool):
    """Parcels of the pairs whose word the lexicon lacks, by that word; or of the others, by context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon.words)
        for batch in batches:
            contexts, found = (batch.column(k).to_numpy().view(np.uint64) for k in range(2))
            counts, place = batch.column(2).to_numpy(), finder.place(found)
            here = place < 0 if lacking else place >= 0
            contexts, found, counts = contexts[here], found[here], counts[here]
            if lacking:
                parcels = _parcels(_spread(found, buckets), context=contexts, word=found, count=counts)
            else:
                dish, of_word = lexicon.at(place[here])
                parcels = _by_context(lexicon, finder, buckets, contexts, found, counts, _inside(lexicon, rare, dish, of_word))
            yield _rows_of(_PLACED, _PAIRS_, parcels)

    return run


def _split(parcels: pa.Table, *kinds: int) -> list[pa.Table]:
    held = parcels.column("kind").to_numpy()
    return [parcels.filter(pa.array(held == kind)) for kind in kinds]


def _found_words(lexicon: Lexicon, rare: Rare, buckets: int):
    """Pairs of the words of a bucket with their probabilities within RARE, in parcels by context."""

    def run(parcels: pa.Table) -> pa.Table:
        pairs, counted = _split(parcels, _PAIRS_, _COUNTS)
        contexts, found = (_flat(pairs.column(c), np.uint64) for c in ("context", "word"))
        known, of_word = _sorted(_flat(counted.column("context"), np.uint64), _flat(counted.column("count"), np.int64))
        at = Finder(known).place(found)
        inside = rare.of(np.append(of_word, 0)[at])
        return pa.Table.from_batches([
            _rows_of(_PLACED, _PAIRS_, _by_context(lexicon, Finder(lexicon.words), buckets, contexts, found, _flat(pairs.column("count"), np.int64), inside))
        ])

    return run


def _sorted(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys)
    return keys[order], *(v[order] for v in values)


_OPENED = (
    "context long, chunk int, chunks int, class int, customers long, repeated long, dishes long, "
    + ", ".join(f"{c} binary" for c in (*_CELLS, *_ONCE))
)


def _restaurants(lexicon: Lexicon):
    """Of the parcels of a bucket the rows of restaurants: their repeated dishes, and apart (``once``) the others."""

    def run(parcels: pa.Table) -> pa.Table:
        pairs, counted = _split(parcels, _PAIRS_, _COUNTS)
        contexts, found = (_flat(pairs.column(c), np.uint64) for c in ("context", "word"))
        counts, inside = _flat(pairs.column("count"), np.int64), _flat(pairs.column("inside"), np.float64)
        known, of_context = _sorted(_flat(counted.column("context"), np.uint64), _flat(counted.column("count"), np.int64))
        finder = Finder(lexicon.words)
        place = finder.place(contexts)
        chunks = _chunks(lexicon, place)
        chunk = _chunk(chunks, contexts, found)
        order = np.lexsort((found.view(np.int64), chunk, contexts))
        contexts, found, counts, inside, place, chunks, chunk = (x[order] for x in (contexts, found, counts, inside, place, chunks, chunk))
        new = np.append(True, (contexts[1:] != contexts[:-1]) | (chunk[1:] != chunk[:-1]))[: len(order)]
        at, of = np.flatnonzero(new), np.cumsum(new) - 1
        classes, customers = lexicon.at(place[at])
        lacks = place[at] < 0
        # A context that only asked texts have has no customers.
        customers = np.where(lacks, np.append(of_context, 0)[Finder(known).place(contexts[at])], customers)
        dish, _ = lexicon.find(found)
        columns = {
            "context": contexts[at].view(np.int64), "chunk": chunk[at].astype(np.int32), "chunks": chunks[at].astype(np.int32),
            "class": classes.astype(np.int32), "customers": customers,
        }
        repeated = counts > 1
        columns["repeated"] = np.bincount(of, weights=np.where(repeated, counts, 0), minlength=len(at)).astype(np.int64)
        columns["dishes"] = np.bincount(of[repeated], minlength=len(at))
        arrays = {name: pa.array(values) for name, values in columns.items()}
        for names, here in ((_CELLS, repeated), (_ONCE, ~repeated)):
            lengths = np.bincount(of[here], minlength=len(at))
            for (name, kind), values in zip(names.items(), (found.view(np.int64), dish, counts, inside), strict=True):
                arrays[name] = _blobs(lengths, values[here].astype(kind))
        return pa.Table.from_pydict(arrays)

    return run


def _cells(texts: DataFrame, counted: DataFrame, lexicon: Lexicon, rare: Rare, buckets: int) -> tuple[DataFrame, str, np.ndarray, int]:
    """Parcels by context of the stored pairs (``_wanted_pairs``), with the probabilities of their words within RARE; the
    folder; pairs of classes; how many are stored. All pairs are counted; those learned once that are not stored are known by their absence.
    """
    spark, side = texts.sparkSession, lexicon.rare + 1
    pairs, of_pairs = written(
        texts.select("text", "learned", "asked")
        .mapInArrow(_count_pairs(lexicon, buckets), _PAIRS)
        .groupBy("bucket").applyInArrow(_wanted_pairs(lexicon, buckets), "context long, word long, count long")
    )
    most = pairs.count()
    classed = pairs.where("context is null").select(F.floor(F.col("word") / side).alias("class"), (F.col("word") % side).alias("dish"), F.col("count").alias("tables"))
    classed, pairs = _dense(classed, side), pairs.where("context is not null")
    lacking = (
        pairs.mapInArrow(_placed(lexicon, rare, buckets, lacking=True), _PLACED_ROWS)
        .unionByName(counted.select("word", "count").mapInArrow(_counts_by_word(lexicon, buckets, _PLACED, _COUNTS, "context", "count"), _PLACED_ROWS))
        .groupBy("bucket").applyInArrow(_found_words(lexicon, rare, buckets), _PLACED_ROWS)
    )
    cells, folder = written(pairs.mapInArrow(_placed(lexicon, rare, buckets, lacking=False), _PLACED_ROWS).unionByName(lacking), most_rows=most)
    _release(spark, of_pairs)
    return cells, folder, classed, most


def _seated(cells: DataFrame, counted: DataFrame, classed: np.ndarray, most: int, lexicon: Lexicon, buckets: int) -> tuple[Samples, DataFrame, str]:
    """The sweeps over the restaurants of ``most`` pairs. Samples; the stored last state of the restaurants, with ``kept``, their tables by sweep; its folder."""
    side = lexicon.rare + 1
    asked = counted.select("word", "count").mapInArrow(_counts_by_word(lexicon, buckets, _PLACED, _COUNTS, "context", "count"), _PLACED_ROWS)
    state, folder = written(cells.unionByName(asked).groupBy("bucket").applyInArrow(_restaurants(lexicon), _OPENED), most_rows=most)
    spark = cells.sparkSession
    # Each file of a state starts processes on its executor: one a core is enough.
    files = max(spark.sparkContext.defaultParallelism, -(-state.count() // TASK_ROWS))
    customers, twos = _dense_tables(state, "count", side)
    single = classed - customers
    ones, twos = int(single.sum()), int(twos.sum())
    discount_ = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.9)
    classes, kept = Classes(side), []
    several = state.where("chunks > 1").groupBy("context").agg(F.sum("dishes").alias("_whole"), F.sum("repeated").alias("_repeated"))
    empty = [F.lit(None).cast("binary").alias(c) for c in _SEATED]
    ready = (
        state.join(small_side(several), "context", "left")
        .withColumn("whole", F.coalesce("_whole", "dishes")).withColumn("singles", F.col("customers") - F.coalesce("_repeated", "repeated"))
        .select(*_KEPT, *empty, F.array().cast("array<long>").alias("totals"), "whole")
    )
    for sweep in range(BURN_IN + SWEEPS):
        before = folder
        state, folder = written(ready.coalesce(files).mapInArrow(_sweep(classes.probabilities, discount_, sweep), _STATE))
        _release(spark, before)
        classes.sweep(single + _dense_tables(state, "tables", side)[0])
        # A restaurant of several rows needs the tables of all of them.
        own = F.element_at("totals", -1)
        several = state.where("chunks > 1").groupBy("context").agg(F.sum(own).alias("_whole"))
        ready = state.join(small_side(several), "context", "left").withColumn("whole", F.coalesce("_whole", own)).drop("_whole")
        if sweep >= BURN_IN:
            kept.append(classes.probabilities)
    alone = F.transform(F.slice("totals", BURN_IN + 1, SWEEPS), lambda t: t + F.col("singles"))
    sums = [F.sum(F.element_at("totals", k + 1)) + F.first("singles") for k in range(BURN_IN, BURN_IN + SWEEPS)]
    several = state.where("chunks > 1").groupBy("context").agg(F.array(*sums).alias("_kept"))
    state = state.join(small_side(several), "context", "left").withColumn("kept", F.coalesce("_kept", alone)).drop("_kept")
    return Samples(np.stack(kept), discount_), state, folder


class Fit(NamedTuple):
    """A model; stored ``counted`` words; stored ``contexts`` (``context``, ``customers``, ``kept``: tables by sweep) of which
    pairs are stored, others have a table per customer; lazy ``pairs``; in how many buckets they go; what can go with them.
    """

    model: Model
    counted: DataFrame
    contexts: DataFrame
    pairs: DataFrame
    buckets: int
    folders: list[str]


def _fit(texts: DataFrame) -> Fit:
    """From texts (``text``, ``learned``, ``asked``) the model; ``pairs`` are those of ``_wanted_pairs``."""
    learned = texts.where("learned").select("text")
    cores = texts.sparkSession.sparkContext.defaultParallelism
    parcels = learned.mapInArrow(_count_words(2 * max(cores, learned.rdd.getNumPartitions())), _WORDS)
    counted = materialize(parcels.groupBy("bucket").applyInArrow(_word_counts, "word long, count long"))
    total, distinct = counted.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(2 * cores, -(-int(total) // BUCKET_TOKENS))
    lexicon = _lexicon(counted)
    own = lexicon.own().words.view(np.int64).tolist()
    by_count = (
        counted.where(~F.col("word").isin(own))
        .groupBy("count")
        .agg(F.count(F.lit(1)).alias("many"))
        .orderBy("count")
        .collect()  # distinct counts: at most the square root of twice the tokens
    )
    rare = fit_rare(*(np.array([r[c] for r in by_count], dtype=np.int64) for c in ("count", "many")))
    cells, of_cells, classed, most = _cells(texts, counted, lexicon, rare, buckets)
    samples, state, of_state = _seated(cells, counted, classed, most, lexicon, buckets)
    model = Model(lexicon, samples.classes.mean(axis=0), rare, int(total), int(distinct), samples)
    # Chunks of a restaurant have the same tables by sweep.
    contexts = state.where("customers > 0").select("context", "customers", "kept", "chunks")
    of_chunks = contexts.where("chunks > 1").groupBy("context").agg(F.first("customers").alias("customers"), F.first("kept").alias("kept"))
    contexts = materialize(contexts.where("chunks = 1").drop("chunks").unionByName(of_chunks), most_rows=int(distinct))
    rows = state.select("context", "class", "customers", "kept", *_CELLS, *_ONCE, "seated")
    return Fit(model, counted, contexts, rows.mapInArrow(_finished(samples, lexicon), _FITTED), buckets, [of_cells, of_state])


def fit(training: DataFrame) -> tuple[Model, DataFrame]:
    """From texts (``text``): the model, and the stored counts (``word``, ``count``) of all training words."""
    return fit_all(training)[:2]


def fit_all(training: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the counts of words, and rows of all pairs (``kind`` 0: ``context``, ``word``, ``count``, ``log``)
    and contexts (``kind`` 1, ``word`` null: ``context``, ``weights`` by sweep).
    """
    found = _fit(training.select("text", F.lit(True).alias("learned"), F.lit(True).alias("asked")))
    share = found.model.samples.discount
    tables = F.coalesce("kept", F.array_repeat("count", SWEEPS))
    weights = F.transform(tables, lambda t: (STRENGTH + share * t) / (STRENGTH + F.col("count")))
    contexts = found.counted.withColumnRenamed("word", "context").join(found.contexts.select("context", "kept"), "context", "left")
    contexts = contexts.select("context", weights.alias("weights"), F.lit(1).alias("kind"))
    pairs = found.pairs.select("context", "word", "count", "log", F.lit(0).alias("kind"))
    return found.model, found.counted.select("word", "count"), pairs.unionByName(contexts, allowMissingColumns=True)


class Listed(NamedTuple):
    """The most frequent pairs: sorted hashes, and the logarithms of their probabilities."""

    pairs: np.ndarray
    logs: np.ndarray


def _listed(pairs: DataFrame) -> Listed:
    """Only pairs of the least listed count are sorted: a sort of all would leave its shuffle on disk."""
    least, above = 0, 0
    for row in pairs.groupBy("count").agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("count")).collect():  # distinct counts
        least = row["count"]
        if above + row["many"] >= FREQUENT_PAIRS:
            break
        above += row["many"]
    more = pairs.where(F.col("count") > least).select("pair", "log").toArrow()
    ties = pairs.where(F.col("count") == least).orderBy("pair").limit(max(FREQUENT_PAIRS - more.num_rows, 0)).select("pair", "log").toArrow()
    rows = pa.concat_tables([more, ties.cast(more.schema)])
    hashes, logs = rows.column("pair").to_numpy().view(np.uint64), rows.column("log").to_numpy()
    order = np.argsort(hashes)
    return Listed(hashes[order], logs[order])


def _listed_weights(model: Model, contexts: DataFrame) -> np.ndarray:
    """What the restaurants of the lexicon's words give their base, by sweep."""
    lexicon = model.lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon.words)
        for batch in batches:
            yield batch.filter(pa.array(finder.place(batch.column(0).to_numpy().view(np.uint64)) >= 0))

    found = model.samples.weights(lexicon.counts, np.repeat(lexicon.counts[:, None], SWEEPS, axis=1))
    rows = contexts.mapInArrow(run, contexts.schema).toArrow().combine_chunks()  # at most as many as the lexicon has words
    if rows.num_rows:
        context, customers, kept = (rows.column(c).combine_chunks() for c in ("context", "customers", "kept"))
        customers = customers.to_numpy()
        found[lexicon.place(context.to_numpy().view(np.uint64))] = model.samples.weights(customers, _totals(kept, customers))
    return found


class Occurrences(NamedTuple):
    """Tokens of some texts: their text, the token before, their hashes, places in the lexicon, and the logarithm of a listed pair."""

    text: np.ndarray
    contexts: np.ndarray
    stream: np.ndarray
    pairs: np.ndarray
    place: np.ndarray
    before: np.ndarray
    logs: np.ndarray


class Lists:
    """The broadcast lists, as a task uses them."""

    def __init__(self, model: Model, shared) -> None:
        hashes, logs, self.weights = shared.value
        self.model, self.pairs, self.logs = model, Finder(hashes), np.append(logs, np.nan)
        self.words, self.base = Finder(model.lexicon.words), np.append(model.base(model.lexicon.counts), 0.0)

    def occurrences(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, Occurrences]]:
        """First row and bounds of some texts, and their tokens; the logarithm of a pair that is not listed is not a number."""
        end = int(self.words.place(np.array([_END]))[0])
        for first, stream, bounds in tokens(texts):
            text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            contexts, place = _before(stream, bounds, _END), self.words.place(stream)
            pairs = _joined(contexts, stream)
            logs = self.logs[self.pairs.place(pairs)]
            yield first, bounds, Occurrences(text, contexts, stream, pairs, place, _before(place, bounds, end), logs)

    def sums(self, own: Occurrences, learned: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text its tokens and, as far as the lexicon holds its words, those known and their base; and its score as far as
        the lists hold it, other pairs of listed words taken for seen once (in a learned text) or never.
        """
        rows, model = len(learned), self.model
        both = np.flatnonzero(np.isnan(own.logs) & (own.place >= 0) & (own.before >= 0))
        classes, customers = model.lexicon.at(own.before[both])
        dishes, counts = model.lexicon.at(own.place[both])
        backed = model.samples.backed(self.weights[own.before[both]], classes, dishes) * model.inside(dishes, counts)
        score = np.nan_to_num(own.logs, nan=0.0)
        score[both] = np.log10(backed + np.where(learned[own.text[both]], model.samples.single(customers), 0.0))
        known = np.bincount(own.text[own.place >= 0], minlength=rows)
        return np.bincount(own.text, minlength=rows), known, *(np.bincount(own.text, weights=x, minlength=rows) for x in (self.base[own.place], score))


def _asked(ids, keys, times, kinds, dishes, scales, own) -> pa.RecordBatch:
    """Rows of words to look up. Where ``_OF_WORD``, ``key`` follows a context that is known: ``scale`` is what its
    restaurant takes from its base and ``own`` what a pair has of its own, both 0 if the pair is listed or stored. Else ``key``
    is the context of a listed word of class ``dish``, whose probability within that is ``scale``; ``own`` is 1 if learned.
    """
    columns = [ids, keys, times.astype(np.int32), kinds.astype(np.int8), dishes.astype(np.int32), scales, own]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "key", "times", "kind", "dish", "scale", "own"])


_OF_CONTEXT, _OF_WORD = 0, 1


def _lone(own: Occurrences) -> tuple[np.ndarray, np.ndarray]:
    """Where the distinct pairs of each text stand that no list holds, if the lexicon lacks both words; how often they occur."""
    at = np.flatnonzero((own.place < 0) & (own.before < 0) & np.isnan(own.logs))
    order, begins, times = _distinct(own.text[at], own.pairs[at])
    return at[order[begins]], times


def _half_listed(lists: Lists, own: Occurrences, learned: np.ndarray) -> tuple[np.ndarray, ...]:
    """As ``_lone`` those pairs of which one word has to be looked up, with ``kind``, ``dish``, ``scale`` and ``own`` of ``_asked``."""
    model = lists.model
    rare, lone = own.place < 0, own.before < 0
    at = np.flatnonzero(rare | lone)
    open_ = np.isnan(own.logs[at])
    # A pair of two rare words is looked up here if a list holds it: for its word's count.
    wanted = np.where(rare[at], ~(lone[at] & open_), open_)
    at, open_ = at[wanted], open_[wanted]
    order, begins, times = _distinct(own.text[at], own.pairs[at])
    at, open_ = at[order[begins]], open_[order[begins]]
    of_word, of_learned = rare[at], learned[own.text[at]]
    scales, alone = np.zeros(len(at)), np.zeros(len(at))
    new = of_word & open_
    classes, customers = model.lexicon.at(own.before[at[new]])
    scales[new] = model.samples.backed(lists.weights[own.before[at[new]]], classes, np.full(int(new.sum()), model.lexicon.rare))
    alone[new] = np.where(of_learned[new], model.samples.single(customers), 0.0)
    dishes, counts = model.lexicon.at(own.place[at])
    scales[~of_word] = model.inside(dishes[~of_word], counts[~of_word])
    alone[~of_word] = of_learned[~of_word]
    return at, times, of_word * _OF_WORD, dishes, scales, alone


def _rare_pairs(model: Model, shared, both: bool):
    """A row per distinct pair of a text with a word that the lexicon lacks, if there is anything to look up.

    ``both``: pairs that no list holds and of which the lexicon has neither word (``id``, ``context``, ``word``, ``times``,
    ``learned``). Else those of which one word has to be looked up (``_asked``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(model, shared)
        for batch in batches:
            all_ids, held = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for first, bounds, own in lists.occurrences(batch.column(3)):
                rows = slice(first, first + len(bounds) - 1)
                ids, learned = all_ids[rows], ~held[rows]
                if both:
                    at, times = _lone(own)
                    columns = [ids[own.text[at]], own.contexts[at].view(np.int64), own.stream[at].view(np.int64), times.astype(np.int32), learned[own.text[at]]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "context", "word", "times", "learned"])
                else:
                    at, times, kinds, *others = _half_listed(lists, own, learned)
                    yield _asked(ids[own.text[at]], np.where(kinds == _OF_WORD, own.stream[at], own.contexts[at]).view(np.int64), times, kinds, *others)

    return run


def _distinct(texts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the rows, where in it each distinct row begins, and how often it occurs."""
    keys = _joined(pairs, texts.astype(np.uint64))
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return order, at, np.diff(np.append(at, len(order)))


# Parcels of the texts' sums, of unlisted pairs and words to look up, and of what is known of pairs, words and contexts.
_OF_TEXT, _ASKED_PAIR, _ASKED_WORD, _OF_PAIR, _WORD_COUNT, _CONTEXT_TABLES = range(6)
_LOOKED_UP = ["bucket", "kind", "key", "id", "flag", "times", "dish", "scale", "own", "known", "base", "value"]
_LOOKED_UP_ROWS = "bucket int, kind byte, " + ", ".join(f"{c} binary" for c in _LOOKED_UP[2:])


def _questions(model: Model, shared, buckets: int):
    """Of texts (``id``, ``key``, ``held_out``, ``text``) their sums, every occurrence of a pair that is not listed, and the
    words that the lexicon lacks: of a pair of two such words, which is always stored, only the second for its count.
    """

    def parcels(kind: int, at: str, held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        columns = {c: np.concatenate([x[c] for x in held]) for c in held[0]}
        return _rows_of(_LOOKED_UP, kind, _parcels(_spread(columns[at].view(np.uint64), buckets), **columns))

    def flushed(texts, pairs, words_) -> Iterator[pa.RecordBatch]:
        for kind, at, held in ((_OF_TEXT, "id", texts), (_ASKED_PAIR, "key", pairs), (_ASKED_WORD, "key", words_)):
            if held:
                yield from _few(parcels(kind, at, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, size = Lists(model, shared), 0
        held: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            all_ids, held_out_ = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for first, bounds, own in lists.occurrences(batch.column(3)):
                rows = slice(first, first + len(bounds) - 1)
                ids, learned = all_ids[rows], ~held_out_[rows]
                times, known, base, value = lists.sums(own, learned)
                held[0].append({"id": ids, "times": times, "known": known, "base": base, "value": value})
                other = np.flatnonzero(np.isnan(own.logs))
                text = own.text[other]
                held[1].append({"key": own.pairs[other], "id": ids[text], "flag": learned[text].astype(np.uint8)})
                at, times = _lone(own)
                none = np.zeros(len(at), dtype=np.float32)
                held[2].append({
                    "key": own.stream[at], "id": ids[own.text[at]], "times": times, "flag": np.full(len(at), _OF_WORD, dtype=np.uint8),
                    "dish": np.zeros(len(at), dtype=np.int16), "scale": none, "own": none,
                })
                at, times, kinds, dishes, scales, alone = _half_listed(lists, own, learned)
                held[2].append({
                    "key": np.where(kinds == _OF_WORD, own.stream[at], own.contexts[at]), "id": ids[own.text[at]], "times": times,
                    "flag": kinds.astype(np.uint8), "dish": dishes.astype(np.int16), "scale": scales.astype(np.float32), "own": alone.astype(np.float32),
                })
                size += len(other) + len(ids)
                if size > HELD_ASKED:
                    yield from flushed(*held)
                    held, size = ([], [], []), 0
        yield from flushed(*held)

    return run


def _pair_gains(buckets: int):
    """Parcels of stored pairs by their hash: ``scale`` is ``seen``, ``own`` is ``unseen``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, seen, unseen = (batch.column(k).to_numpy() for k in range(3))
            yield _rows_of(_LOOKED_UP, _OF_PAIR, _parcels(_spread(pairs.view(np.uint64), buckets), key=pairs, scale=seen, own=unseen))

    return run


def _context_tables(lexicon: Lexicon, buckets: int):
    """Parcels of the contexts that the lexicon lacks: ``times`` are their tables by sweep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon.words)
        for batch in batches:
            contexts = batch.column(0).to_numpy().view(np.uint64)
            at = np.flatnonzero(finder.place(contexts) < 0)
            tables = batch.column(1).flatten().to_numpy().reshape(-1, SWEEPS)[at]
            yield _rows_of(_LOOKED_UP, _CONTEXT_TABLES, _parcels(_spread(contexts[at], buckets), key=contexts[at], times=tables))

    return run


_ANSWERED = ["id", "copies", "times", "known", "base", "value"]
_ANSWERED_ROWS = "bucket int, " + ", ".join(f"{c} binary" for c in _ANSWERED)


def _answers(model: Model, buckets: int):
    """What a bucket knows of the texts' sums, in parcels by text."""
    samples, rare = model.samples, model.lexicon.rare

    def words_(asked: pa.Table, counted: pa.Table, contexts: pa.Table) -> tuple[np.ndarray, ...]:
        """Tokens known, their base, and the score, by row that asks for a word."""
        keys, times, kinds = (_flat(asked.column(c), kind) for c, kind in (("key", np.uint64), ("times", np.int64), ("flag", np.uint8)))
        dishes, scales, own = (_flat(asked.column(c), kind) for c, kind in (("dish", np.int16), ("scale", np.float32), ("own", np.float32)))
        known, of_word = _sorted(_flat(counted.column("key"), np.uint64), _flat(counted.column("times"), np.int64))
        counts = np.append(of_word, 0)[Finder(known).place(keys)]
        of_word, value = kinds == _OF_WORD, np.zeros(len(keys))
        new = of_word & (scales > 0)
        value[new] = np.log10(scales[new].astype(float) * model.rare.of(counts[new]) + own[new])
        others = np.flatnonzero(~of_word)
        customers = counts[others]
        known, tables = _sorted(_flat(contexts.column("key"), np.uint64), _flat(contexts.column("times"), np.int64).reshape(-1, SWEEPS))
        at = Finder(known).place(keys[others])
        totals = np.repeat(customers[:, None], SWEEPS, axis=1)
        totals[at >= 0] = tables[at[at >= 0]]
        backed = samples.backed(samples.weights(customers, totals), np.full(len(others), rare), dishes[others])
        value[others] = np.log10(backed * scales[others] + own[others] * samples.single(customers))
        return np.where(of_word & (counts > 0), times, 0), np.where(of_word, times * model.base(counts), 0.0), times * value

    def run(parcels: pa.Table) -> pa.Table:
        texts, pairs, asked, stored, counted, contexts = _split(parcels, *range(6))
        known, seen, unseen = _sorted(_flat(stored.column("key"), np.uint64), *(_flat(stored.column(c), np.float32) for c in ("scale", "own")))
        at = Finder(known).place(_flat(pairs.column("key"), np.uint64))
        hit = np.flatnonzero(at >= 0)
        at, learned = at[hit], _flat(pairs.column("flag"), np.uint8)[hit] > 0
        ids = [_flat(x.column("id"), np.int64) for x in (texts, pairs, asked)]
        ids[1] = ids[1][hit]
        none = [np.zeros(len(x)) for x in ids]
        times, known_, base = _flat(texts.column("times"), np.int64), _flat(texts.column("known"), np.int64), _flat(texts.column("base"), np.float64)
        of_words = words_(asked, counted, contexts)
        columns = (
            [np.ones(len(ids[0])), none[1], none[2]], [times, none[1], none[2]], [known_, none[1], of_words[0]], [base, none[1], of_words[1]],
            [_flat(texts.column("value"), np.float64), np.where(learned, seen[at], unseen[at]), of_words[2]],
        )
        found, *sums = _sums(np.concatenate(ids), *(np.concatenate(x).astype(float) for x in columns))
        parcels_ = _parcels(_spread(found.view(np.uint64), buckets), **dict(zip(_ANSWERED, (found, *sums), strict=True)))
        return pa.Table.from_pydict(parcels_)

    return run


def _text_sums(parcels: pa.Table) -> pa.Table:
    """The texts of a bucket; those equal in key and text share one id, their sums are divided by their number."""
    kinds = [np.int64, *[np.float64] * 5]
    found, copies, *sums = _sums(*(_flat(parcels.column(c), kind) for c, kind in zip(_ANSWERED, kinds, strict=True)))
    return pa.Table.from_arrays([pa.array(found), *(pa.array(x / copies) for x in sums)], names=["id", "n_tokens", "n_known", "base_score", "score"])


# Shuffles of this operator's own jobs are read by these alone; their files go when a job ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Whole texts and parcels go through the JVM and the workers in small batches, which each hold several times over.
_SETTINGS = {_CLEANUP: "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def score(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``perplexity`` (of the score, per token).

    Runs its jobs at once. Rows equal in key and text share one id; their sums are divided by their number.
    """
    spark = rows.sparkSession
    before = {name: spark.conf.get(name) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return _scored(rows, key, text)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _scored(rows: DataFrame, key: str, text: str) -> DataFrame:
    spark = rows.sparkSession
    given, content = F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")
    texts = rows.select(
        F.xxhash64(given.isNull(), given, content.isNull(), content).alias("id"), given.alias("key"), held_out(key).alias("held_out"), content.alias("text")
    )
    found = _fit(texts.select("text", (~F.col("held_out")).alias("learned"), F.col("held_out").alias("asked")))
    model, contexts, buckets = found.model, found.contexts, found.buckets
    pairs, of_pairs = written(found.pairs.select("pair", "count", "log", "seen", "unseen"))
    _release(spark, *found.folders)
    listed = _listed(pairs)
    shared = spark.sparkContext.broadcast((listed.pairs, listed.logs, _listed_weights(model, contexts)))
    counts = _counts_by_word(model.lexicon, buckets, _LOOKED_UP, _WORD_COUNT, "key", "times")
    known = (
        pairs.select("pair", "seen", "unseen").mapInArrow(_pair_gains(buckets), _LOOKED_UP_ROWS)
        .unionByName(found.counted.select("word", "count").mapInArrow(counts, _LOOKED_UP_ROWS))
        .unionByName(contexts.select("context", "kept").mapInArrow(_context_tables(model.lexicon, buckets), _LOOKED_UP_ROWS))
    )
    scores = [
        materialize(
            texts.where(F.pmod("id", F.lit(PARTS)) == part)
            .mapInArrow(_questions(model, shared, buckets), _LOOKED_UP_ROWS)
            .unionByName(known)
            .groupBy("bucket").applyInArrow(_answers(model, buckets), _ANSWERED_ROWS)
            .groupBy("bucket").applyInArrow(_text_sums, "id long, n_tokens double, n_known double, base_score double, score double")
        )
        for part in range(PARTS)
    ]
    _release(spark, of_pairs)
    scored = scores[0]
    for other in scores[1:]:
        scored = scored.unionByName(other)
    return materialize(
        texts.select("id", F.col("key").alias("_key"), "held_out").join(scored, "id")
        .select(
            F.col("_key").alias(key),
            "held_out",
            F.col("n_tokens").cast("long").alias("n_tokens"),
            F.col("n_known").cast("long").alias("n_known"),
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            "base_score",
            "score",
            F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
        )
    )
