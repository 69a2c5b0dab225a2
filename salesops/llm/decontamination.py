"""Benchmark passages in documents, found with a budget of edits.

Pigeonhole edit matching: an item of m characters may differ in up to
``m * ERROR_SHARE`` insertions, deletions and replacements. It is cut into one
piece more than that, so at least one piece stands unchanged in any occurrence.
An automaton over all pieces finds the unchanged ones in one pass over a text;
around each, Myers' bit-parallel algorithm verifies first the part of two pieces
that holds it, then of four, and so on up to the whole item. A part of j pieces
may have j - 1 edits: if both halves of a part had more than they may, so would
the part, so every occurrence has a hit that passes all the way up.

Texts are compared in lower case with single spaces. Items are searched in
blocks of at most some ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes (or one
longer item), each against all documents; documents are never shuffled.

The budget is the same share for items of any length. Where an item of fewer
than ``SHORT_CHARS`` characters occurs, no word may go on across its bounds, edits
included; scripts without spaces have a bound everywhere.

Defined cases: null and empty texts hold nothing; an item without text is not
searched; items with equal texts are all reported, one that is repeated with its
id is reported once; repeated documents are each reported; without items or
documents the result is empty; other columns are not read.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import defaultdict
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.llm.filters import keep_rows
from salesops.llm.textarrays import Piece
from salesops.session import materialize

ERROR_SHARE = 0.1
SHORT_CHARS = 24
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 * 1024 * 1024


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str, error_share: float = ERROR_SHARE) -> int:
    return int(len(item) * error_share)


# Scripts without spaces between words: from Thai to ideographs.
_UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x31FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x20000, 0x3FFFF),
)


def _of_spaced_word(character: str) -> bool:
    if not (character.isalnum() or unicodedata.category(character)[0] == "M"):
        return False
    return not any(first <= ord(character) <= last for first, last in _UNSPACED)


def word_bound(text: str, at: int) -> bool:
    """Whether no word goes on across this place."""
    return not (0 < at < len(text) and _of_spaced_word(text[at - 1]) and _of_spaced_word(text[at]))


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length with their places."""
    bounds = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.cache
def _parts(leaf: int, leaves: int) -> list[tuple[int, int]]:
    """The parts of a binary tree over the leaves that hold the leaf, small ones first, without leaf and root."""
    first, last, found = 0, leaves, []
    while last - first > 1:
        middle = (first + last) // 2
        first, last = (first, middle) if leaf < middle else (middle, last)
        found.append((first, last))
    return [x for x in reversed(found) if x[1] - x[0] > 1]


class Pattern:
    """An item prepared for Myers' algorithm."""

    def __init__(self, item: str) -> None:
        self.size = len(item)
        self.where: dict[str, int] = {}
        for k, c in enumerate(item):
            self.where[c] = self.where.get(c, 0) | (1 << k)

    def nearest(self, text: str, anchored: bool = False, ends: Container[int] | None = None) -> tuple[int, int]:
        """Least distance to a part of the text and where that part ends.

        The part may begin anywhere, or only at the text's beginning if anchored,
        and end anywhere, or only at the ends given.
        """
        mask, top = (1 << self.size) - 1, 1 << (self.size - 1)
        grown, shrunk, score = mask, 0, self.size
        best, end, first = self.size, 0, int(anchored)
        for j, c in enumerate(text, 1):
            same = self.where.get(c, 0)
            vertical = same | shrunk
            horizontal = (((same & grown) + grown) ^ grown) | same
            up = shrunk | (~(horizontal | grown) & mask)
            down = grown & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = (up << 1) | first
            grown = ((down << 1) | ~(vertical | up)) & mask
            shrunk = up & vertical & mask
            if score < best and (ends is None or j in ends):
                best, end = score, j
        return best, end


class Finder:
    """Searches texts for a block of items."""

    def __init__(self, items: list[tuple[object, str]], error_share: float) -> None:
        import ahocorasick

        self.ids: dict[str, list] = defaultdict(list)
        for item_id, text in items:
            if text:
                self.ids[text].append(item_id)
        self.items = list(self.ids)
        self.errors = [budget(x, error_share) for x in self.items]
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        self.parts: dict[tuple[int, int, int], Pattern] = {}
        self.cuts = [[at for at, _ in cut(x, e)] + [len(x)] for x, e in zip(self.items, self.errors, strict=True)]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, item in enumerate(self.items):
            for leaf, (_, piece) in enumerate(cut(item, self.errors[k])):
                places[piece].append((k, leaf))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def _pattern(self, k: int) -> tuple[Pattern, Pattern]:
        if k not in self.patterns:
            self.patterns[k] = Pattern(self.items[k]), Pattern(self.items[k][::-1])
        return self.patterns[k]

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """Item, distance, begin and end in the normalised text, of every occurrence."""
        text = normalised(text)
        if not self.items or not text:
            return
        lines: dict[int, set[int]] = defaultdict(set)
        for last, (length, found) in self.automaton.iter(text):
            for k, leaf in found:
                begin = last - length + 1 - self.cuts[k][leaf]
                if not self.errors[k] and not self._at_bounds(k, text, begin, last + 1):
                    continue
                if begin not in lines.get(k, ()) and self._climbs(k, leaf, begin, text):
                    lines[k].add(begin)
        for k, begins in lines.items():
            yield from self._verified(k, sorted(begins), text)

    def _at_bounds(self, k: int, text: str, begin: int, end: int) -> bool:
        return len(self.items[k]) >= SHORT_CHARS or (word_bound(text, begin) and word_bound(text, end))

    def _climbs(self, k: int, leaf: int, begin: int, text: str) -> bool:
        """Whether the parts around a hit, each at most half the item, have few enough edits."""
        cuts = self.cuts[k]
        for first, last in _parts(leaf, len(cuts) - 1):
            if last - first == 2 and not self._beside(k, leaf, first, begin, text):
                return False
            if (k, first, last) not in self.parts:
                self.parts[k, first, last] = Pattern(self.items[k][cuts[first] : cuts[last]])
            errors = last - first - 1
            window = text[max(begin + cuts[first] - errors, 0) : begin + cuts[last] + errors]
            if self.parts[k, first, last].nearest(window)[0] > errors:
                return False
        return True

    def _beside(self, k: int, leaf: int, first: int, begin: int, text: str) -> bool:
        """Whether the hit's sibling can be there with one edit: one half stands unchanged, if the far one by one off."""
        cuts, item = self.cuts[k], self.items[k]
        left, right = (cuts[leaf + 1], cuts[leaf + 2]) if leaf == first else (cuts[first], cuts[leaf])
        middle = (left + right) // 2
        near, far = (slice(left, middle), slice(middle, right))[:: 1 if leaf == first else -1]
        if text.startswith(item[near], max(begin + near.start, 0)):
            return True
        return text.find(item[far], max(begin + far.start - 1, 0), max(begin + far.stop + 1, 0)) >= 0

    def _verified(self, k: int, begins: list[int], text: str) -> Iterator[tuple[int, int, int, int]]:
        """Hits whose windows overlap closely are one window; the best place in it counts."""
        size, errors = len(self.items[k]), self.errors[k]
        forward, backward = self._pattern(k)
        first = 0
        for i in range(1, len(begins) + 1):
            if i < len(begins) and begins[i] - begins[i - 1] <= max(2 * errors, 1):
                continue
            left, right = max(begins[first] - errors, 0), begins[i - 1] + errors
            first = i
            if size < SHORT_CHARS:
                distance, begin, end = self._between_words(forward, errors, text, left, right)
                if distance <= errors:
                    yield k, distance, begin, end
                continue
            window = text[left : right + size]
            distance, end = forward.nearest(window)
            if distance <= errors:
                _, length = backward.nearest(window[:end][::-1], anchored=True)
                yield k, distance, left + end - length, left + end

    @staticmethod
    def _between_words(item: Pattern, errors: int, text: str, first: int, last: int) -> tuple[int, int, int]:
        """Distance, begin and end of the best place that begins in the range and has word bounds at both ends."""
        best = (item.size, first, first)
        for begin in range(first, min(last, len(text)) + 1):
            if word_bound(text, begin):
                window = text[begin : begin + item.size + errors]
                ends = {j for j in range(1, len(window) + 1) if word_bound(text, begin + j)}
                distance, length = item.nearest(window, anchored=True, ends=ends)
                best = min(best, (distance, begin, begin + length))
        return best


def _find(items: list[tuple[object, str]], error_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(items, error_share)
        for batch in batches:
            found: list[tuple[int, object, int, int, int]] = []
            for row in range(batch.num_rows):
                value = batch.column(1)[row].as_py()
                for k, distance, begin, end in finder.matches(value):
                    text = normalised(value)
                    words = text.count(" ", 0, begin), text.count(" ", 0, end - 1)
                    found += [(row, item_id, distance, *words) for item_id in finder.ids[finder.items[k]]]
            columns = list(zip(*found, strict=True)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(columns[0], pa.int64())),
                    *[pa.array(c, pa.int64()) for c in columns[1:]],
                ],
                names=["key", "item_id", "distance", "first_word", "last_word"],
            )

    return run


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[object, str]]]:
    """The items' ids and normalised texts, in as many blocks as their number and bytes ask for."""
    known = materialize(items.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).distinct())
    number, size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-number // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        yield [(r["id"], normalised(r["text"])) for r in rows]


def find_passages(
    rows: DataFrame, items: DataFrame, error_share: float = ERROR_SHARE,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per occurrence: the key, ``item_id``, ``distance``, ``first_word``, ``last_word``.

    The words count from 0 over the document's words between white space. Two
    occurrences of an item that lie within twice the budget are one.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = f"key {kind}, item_id long, distance long, first_word long, last_word long"
    texts = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    found = rows.sparkSession.createDataFrame([], schema)
    for k, block in enumerate(_blocks(items, item_key, item_text)):
        part = texts.mapInArrow(_find(block, error_share), schema)
        found = part if k == 0 else found.unionByName(part)
    return found.withColumnRenamed("key", key)


def without_passages(
    rows: DataFrame, items: DataFrame, error_share: float = ERROR_SHARE,
    text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows, with all columns, whose text holds none of the items."""
    for block in _blocks(items, item_key, item_text):

        def decider(block=block):
            finder = Finder(block, error_share)

            def decide(piece: Piece) -> np.ndarray:
                held = piece.data.tobytes()
                bounds = zip(piece.bounds[:-1].tolist(), piece.bounds[1:].tolist(), strict=True)
                texts = [held[a:b].decode("utf-8", "replace") for a, b in bounds]
                return np.array([next(finder.matches(t), None) is None for t in texts], dtype=bool)

            return decide

        rows = keep_rows(rows, text, decider)
    return rows
