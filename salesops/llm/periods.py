"""Periodic runs of words, found in compressed texts.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that no neighbouring word extends and that is at least
``EXPONENT`` periods and ``LEAST`` words long.

The texts of a piece become numbers of words. Re-Pair compresses them: a frequent
pair of neighbouring symbols becomes a new symbol, most frequent ones first, and
so on until no pair occurs twice. Here a round takes all pairs whose count is
within a factor ``BATCH`` of the highest; where two of them overlap, the more
frequent one wins. What is left of a text is then paired evenly up to one symbol.
So every symbol but the words has two parts, and every place at which it is
derived is written down when it is made.

A run of a text lies within the lowest symbol that holds all of it, across that
symbol's inner boundary. At least half of it lies on one side, which is two
periods or more. So the period is a distance at which the four words next to the
boundary (or fewer, for periods below four) occur again on the same side. These
distances are tried once per symbol, smallest first; two periods around a shorter
one are no period of their own and are passed over. What is found is moved to all
places at which the symbol is derived, and stretches of equal period that
overlap become one maximal interval.

Only whole texts are looked at, one piece of about a megabyte (or one longer
text) at a time; no text meets another in a shuffle.

Defined cases: a null or empty text has no words and no runs; a null key is kept
as it is; repeated rows each get their row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXPONENT = 4
LEAST = 6
# Pairs replaced in one round have at least this part of the highest count.
BATCH = 4
# Words next to a boundary that must occur again at the distance of a longer period.
GRAM = 4
# Words of a repeat that are compared before its whole stretch is.
LOOKED = 64
PIECE_BYTES = 1 << 20


class Symbols(NamedTuple):
    """Symbols with two parts: where they first stand in the words, and every place at which they are derived."""

    low: np.ndarray
    middle: np.ndarray
    high: np.ndarray
    # Sorted by symbol: the places' first words, and where each symbol's places begin (and one more).
    places: np.ndarray
    of_symbol: np.ndarray


def _frequent(now: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First symbols of the pairs that a round replaces, in order, and numbers that tell different pairs apart.

    Pairs that stand there once are no longer ``alive``: they stay single until one of their symbols changes.
    """
    at = np.flatnonzero(alive)
    keys = (now[at] << 32) | now[at + 1]
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(keys)))
    kind = np.empty(len(keys), dtype=np.int64)
    kind[order] = np.cumsum(new) - 1
    count = counts[kind]
    alive[at[count < 2]] = False
    if not len(counts) or counts.max() < 2:
        return at[:0], kind[:0]
    # More frequent pairs rank higher; ranks of equally frequent ones are scattered, so that no chain decides in order.
    scattered = (kind * 0x9E3779B1) & 0xFFFFFFFF
    rank = np.where(count >= max(2, int(counts.max()) // BATCH), (count << 32) | scattered, 0)
    # Neighbouring pairs of one kind are one stretch, a symbol repeated, which wins or loses as a whole.
    begins = np.ones(len(at), dtype=bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (rank[1:] != rank[:-1])
    first = np.flatnonzero(begins)
    ranks, last = rank[first], np.append(first[1:], len(at)) - 1
    wins = ranks > 0
    touching = at[first[1:]] == at[last[:-1]] + 1
    wins[1:] &= ~touching | (ranks[1:] > ranks[:-1])
    wins[:-1] &= ~touching | (ranks[:-1] > ranks[1:])
    stretch = np.cumsum(begins) - 1
    won = wins[stretch] & ((np.arange(len(at)) - first[stretch]) % 2 == 0)
    return at[won], kind[won]


def _evenly(paired: np.ndarray) -> np.ndarray:
    """The first symbol of a text with the second, the third with the fourth, and so on."""
    opens = np.ones(len(paired), dtype=bool)
    opens[1:] = ~paired[:-1]
    first = np.flatnonzero(opens)
    place = np.arange(len(paired)) - first[np.cumsum(opens) - 1]
    return np.flatnonzero(paired & (place % 2 == 0))


def compress(words: np.ndarray, bounds: np.ndarray) -> Symbols:
    """The grammar of texts (words ``bounds[k]`` to ``bounds[k + 1]``) as one numbering of symbols."""
    now, first = words.astype(np.int64), np.arange(len(words) + 1)
    paired = np.ones(len(words), dtype=bool)
    paired[bounds[1:][np.diff(bounds) > 0] - 1] = False
    alive = paired.copy()
    known, made = int(words.max(initial=-1)) + 1, 0
    lows, middles, highs, places, symbols = [], [], [], [], []
    repeats = True
    while True:
        at, kind = _frequent(now, alive) if repeats else (_evenly(paired), None)
        if not len(at):
            if not repeats:
                break
            repeats = False
            continue
        if kind is None:
            sample = number = np.arange(len(at))
        else:
            _, sample, number = np.unique(kind, return_index=True, return_inverse=True)
        lows.append(first[at[sample]])
        middles.append(first[at[sample] + 1])
        highs.append(first[at[sample] + 2])
        places.append(first[at])
        symbols.append(made + number)
        now[at] = known + made + number
        made += len(sample)
        # The new symbol is paired with what its second part was paired with.
        paired[at] = paired[at + 1]
        alive[at] = paired[at]
        before = at[at > 0] - 1
        alive[before] = paired[before]
        left = np.ones(len(first), dtype=bool)
        left[at + 1] = False
        first, left = first[left], left[:-1]
        now, paired, alive = now[left], paired[left], alive[left]
    if not made:
        none = np.zeros(0, dtype=np.int64)
        return Symbols(none, none, none, none, np.zeros(1, dtype=np.int64))
    symbol, place = np.concatenate(symbols), np.concatenate(places)
    order = np.argsort(symbol, kind="stable")
    counts = np.bincount(symbol, minlength=made)
    return Symbols(
        np.concatenate(lows), np.concatenate(middles), np.concatenate(highs),
        place[order], np.concatenate([[0], np.cumsum(counts)]),
    )


def _common(words: np.ndarray, one: np.ndarray, other: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words from two places on are equal, forward (``step`` 1) or backward (-1), up to ``most``."""
    found = np.zeros(len(one), dtype=np.int64)
    open_ = np.flatnonzero(most > 0)
    open_ = open_[words[one[open_]] == words[other[open_]]]
    width = 8
    while len(open_):
        ahead = np.arange(width)
        offset = found[open_, None] + ahead
        inside = offset < most[open_, None]
        offset = np.where(inside, offset, 0) * step
        equal = inside & (words[one[open_, None] + offset] == words[other[open_, None] + offset])
        unequal = ~equal
        length = np.where(unequal.any(axis=1), unequal.argmax(axis=1), width)
        found[open_] += length
        open_ = open_[length == width]
        width = min(2 * width, max(8, (1 << 20) // max(len(open_), 1)))
    return found


def _grams(words: np.ndarray) -> np.ndarray:
    """A number per place for the four words that begin there; equal if and only if the words are."""
    grams = words
    for reach in (1, 2):
        if len(grams) <= reach:
            return np.zeros(0, dtype=np.int64)
        _, grams = np.unique((grams[:-reach] << 32) | grams[reach:], return_inverse=True)
    return grams


def _expand(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which row each element belongs to, and the elements ``first``, ``first`` + 1 ... of each row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]


def _candidates(
    words: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Side (-1 left, 1 right), symbols and periods whose two repeats may stand on that side of the boundary."""
    grams = _grams(words)
    size = len(words)
    order = np.argsort(grams, kind="stable")
    keys = grams[order] * (size + 1) + order
    for side, room in ((-1, middle - low), (1, high - middle)):
        longest = np.minimum((high - low) // EXPONENT, room // 2)
        short = [np.flatnonzero(longest >= period) for period in range(1, GRAM)]
        rows = np.flatnonzero(longest >= GRAM)
        here = middle[rows] - GRAM if side < 0 else middle[rows]
        base = grams[here] * (size + 1)
        nearest, farthest = here + side * GRAM, here + side * longest[rows]
        least, most = np.minimum(nearest, farthest), np.maximum(nearest, farthest)
        first = np.searchsorted(keys, base + least)
        last = np.searchsorted(keys, base + most, side="right")
        row, element = _expand(first, np.maximum(last - first, 0))
        symbol = np.concatenate([*short, rows[row]])
        periods = [np.full(len(x), k, dtype=np.int64) for k, x in enumerate(short, start=1)]
        yield side, symbol, np.concatenate([*periods, np.abs(order[element] - here[row])])


def boundary_runs(words: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs within ``low`` to ``high`` that touch or cross the boundary: symbol, start, end, period."""
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none, none, none)]
    for side, symbol, period in _candidates(words, low, middle, high):
        # Two periods on one side: the words next to the boundary are those a period further out.
        near, looked = middle[symbol] - (side < 0), np.minimum(period, LOOKED)
        whole = _common(words, near, near + side * period, looked, side) == looked
        symbol, period = symbol[whole], period[whole]
        order = np.lexsort((period, symbol))
        symbol, period = symbol[order], period[order]
        while len(symbol):
            new = np.ones(len(symbol), dtype=bool)
            new[1:] = symbol[1:] != symbol[:-1]
            at = np.flatnonzero(new)
            s, q, m = symbol[at], period[at], middle[symbol[at]]
            # The boundary's words compared with those a period to the left, or to the right.
            one = m - q if side < 0 else m
            start = one - _common(words, one - 1, one - 1 + q, one - low[s], -1)
            end = one + q + _common(words, one, one + q, high[s] - one - q, 1)
            # Two periods must fit in whole on this side, beyond the words looked at: a shorter period that they
            # repeat was then tried before. Where fewer do, the other side holds two and tries them.
            reach = (m - start if side < 0 else end - m) // 2
            long = (end - start >= np.maximum(LEAST, EXPONENT * q)) & (reach >= q)
            found.append((s[long], start[long], end[long], q[long]))
            # Periods of which two fit into this stretch, on this side, are multiples of its period.
            passed = np.maximum(reach, q)
            group = np.cumsum(new) - 1
            kept = period > passed[group]
            symbol, period = symbol[kept], period[kept]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def find_runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of all texts: start, end (places in ``words``) and period; by text, start, period."""
    symbols = compress(words, bounds)
    long = np.flatnonzero(symbols.high - symbols.low >= LEAST)
    none = np.zeros(0, dtype=np.int64)
    if not len(long):
        return none, none, none
    of, start, end, period = boundary_runs(words, symbols.low[long], symbols.middle[long], symbols.high[long])
    if not len(of):
        return none, none, none
    # The places of each symbol that has runs.
    owner = long[of]
    row, place = _expand(symbols.of_symbol[owner], np.diff(symbols.of_symbol)[owner])
    shift = symbols.places[place] - symbols.low[owner][row]
    start, end, period = start[row] + shift, end[row] + shift, period[row]
    text = np.searchsorted(bounds, start, side="right")
    # Stretches of one text and period that overlap by a period or more are one.
    order = np.lexsort((end, start, period, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    kind = np.ones(len(order), dtype=bool)
    kind[1:] = (text[1:] != text[:-1]) | (period[1:] != period[:-1])
    group = np.cumsum(kind) - 1
    # The farthest end so far within a group: groups are moved apart, so that one running maximum serves all.
    apart = group * (len(words) + 1)
    farthest = np.maximum.accumulate(end + apart) - apart
    opens = kind.copy()
    opens[1:] |= start[1:] + period[1:] > farthest[:-1]
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(opens)) - 1
    start, end, period = start[first], farthest[last], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """First row and texts of about a megabyte at a time."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + PIECE_BYTES, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, end to end, and each text's first (and one more)."""
    found = pc.ascii_split_whitespace(texts)
    offsets = found.offsets.to_numpy()
    parts = found.values.slice(offsets[0], offsets[-1] - offsets[0])
    # White space at a text's ends leaves empty parts.
    solid = pc.binary_length(parts).to_numpy() > 0
    before = np.concatenate([[0], np.cumsum(solid)]).astype(np.int64)
    return parts.filter(pa.array(solid)), before[offsets - offsets[0]]


def _runs(kept: bool):
    names = ["key", "n_words", "starts", "lengths", "periods", *(["collapsed"] if kept else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _pieces(batch.column(1).cast(pa.large_string()).fill_null("")):
                words, bounds = _split(texts)
                start, end, period = find_runs(words.dictionary_encode().indices.to_numpy().astype(np.int64), bounds)
                of = np.searchsorted(start, bounds)
                base = np.repeat(bounds[:-1], np.diff(of))
                offsets = pa.array(of.astype(np.int32))
                columns = [batch.column(0).slice(first, len(texts)), pa.array(np.diff(bounds))]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (start - base, end - start, period)]
                if kept:
                    covers = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(covers, start + period, 1)
                    np.add.at(covers, end, -1)
                    stays = np.cumsum(covers)[:-1] == 0
                    left = np.concatenate([[0], np.cumsum(stays)]).astype(np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(left[bounds].astype(np.int32)), words.filter(pa.array(stays)))
                    columns.append(pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def periodic_runs(rows: DataFrame, key: str = "doc_id", text: str = "text", collapsed: bool = True) -> DataFrame:
    """Per row: the key, ``n_words``, ``runs`` and, if asked for, ``collapsed``.

    ``runs`` are structs of ``start`` (word number from 0), ``length`` and
    ``period``, by start, then period. ``collapsed`` is the text without the words
    that repeat within a run (all but each run's first period), joined by single
    spaces. One pass over the texts, no shuffle.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_words long, starts array<long>, lengths array<long>, periods array<long>"
    found = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        _runs(collapsed), schema + (", collapsed string" if collapsed else "")
    )
    zipped = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    more = ["collapsed"] if collapsed else []
    return found.select(F.col("key").alias(key), "n_words", zipped.alias("runs"), *more)
