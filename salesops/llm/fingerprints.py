"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes decides, from the content alone, where a text is
cut: a cut of level k follows every byte whose hash ends in k one-bits, some
2**k bytes apart. Each chunk becomes one character, so an edit changes the
characters around it and leaves the others. A fingerprint is
``k:signature:signature`` with cuts of level k (at most 64 characters) and k + 1
(at most 32); k follows from the text's length, is lowered while the signature
stays short and raised while it overflows. Where the next level has hardly any
cuts, as in repeated lines, neighbouring chunks are joined instead, equally many
for each character, so that the characters cover the whole text. A few chunks too
many at level k + 1 are in the last character. Fingerprints are compared at the levels they share, by
the edit distance (insertions and deletions) of their signatures.

Defined cases: a null text is an empty one; equal texts have equal fingerprints;
texts of fewer bytes than the window use a shorter one; two signatures without a
common run of RUN characters (or of the shorter one's length) are alike to
degree 0; repeated rows are fingerprinted each. In a chain (``with_neighbours``)
rows are ordered by key, then a hash of the text, a null key before all others,
and the row after the last is the first, which may be the row itself; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops.llm.textarrays import PIECE_BYTES, Piece, pieces, prefix_sums, run_hashes
from salesops.session import materialize

WINDOW = 7
LONGEST = 64
LEAST_LEVEL = 2
RUN = 4
# Fewer cuts are too few for a signature; so many times too many chunks of level k + 1 are joined.
FEWEST = 16
JOINED = 1.5
_SIGNS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)


def _signature(sums: np.ndarray, first: int, last: int, cuts: np.ndarray, longest: int) -> str:
    """One character per chunk, or per equally many if there are too many; the last one covers all that is left."""
    cuts = cuts[cuts < last]
    joined = -(-(len(cuts) + 1) // longest) if len(cuts) + 1 >= JOINED * longest or longest == LONGEST else 1
    cuts = cuts[joined - 1 :: joined][: longest - 1]
    starts, ends = np.append(first, cuts), np.append(cuts, last)
    return _SIGNS[(run_hashes(sums, starts, ends) >> np.uint64(40)) & np.uint64(63)].tobytes().decode()


def fingerprints(piece: Piece) -> list[str]:
    """The fingerprint of each text of a piece."""
    sums = prefix_sums(piece.data)
    at = np.arange(len(piece.data))
    begin = np.repeat(piece.bounds[:-1], np.diff(piece.bounds))
    rolling = run_hashes(sums, np.maximum(at - WINDOW + 1, begin), at + 1)
    # The level of a cut is the number of one-bits at the end of the hash.
    places = np.flatnonzero((rolling & np.uint64((1 << LEAST_LEVEL) - 1)) == np.uint64((1 << LEAST_LEVEL) - 1))
    zeros = ~rolling[places]
    lowest = zeros & (~zeros + np.uint64(1))
    levels = np.where(lowest > 0, np.log2(np.maximum(lowest, 1).astype(float)), 64).astype(int)
    places += 1
    found = []
    edges = np.searchsorted(places, piece.bounds, side="right").tolist()
    for k, (first, last) in enumerate(zip(piece.bounds[:-1].tolist(), piece.bounds[1:].tolist(), strict=True)):
        if last == first:
            found.append(f"{LEAST_LEVEL}::")
            continue
        own, own_levels = places[edges[k] : edges[k + 1]], levels[edges[k] : edges[k + 1]]
        level = max(LEAST_LEVEL, ((last - first) // LONGEST).bit_length())
        while level > LEAST_LEVEL and np.count_nonzero(own_levels >= level) < LONGEST // 2:
            level -= 1
        while np.count_nonzero(own_levels >= level) >= LONGEST and np.count_nonzero(own_levels > level) >= FEWEST:
            level += 1
        coarse = _signature(sums, first, last, own[own_levels > level], LONGEST // 2)
        found.append(f"{level}:{_signature(sums, first, last, own[own_levels >= level], LONGEST)}:{coarse}")
    return found


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest one, a row of the table per bit operation."""
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << k)
    mask = (1 << len(a)) - 1
    row = mask
    for c in b:
        step = row & where.get(c, 0)
        row = ((row + step) | (row - step)) & mask
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(RUN, len(a), len(b))
    if not run:
        return 0.0
    runs = {a[k : k + run] for k in range(len(a) - run + 1)}
    if not any(b[k : k + run] in runs for k in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common_subsequence(a, b) / (len(a) + len(b))


def likeness(one: str, other: str) -> float:
    """0 to 1: one less the share of characters to insert or delete, at the best shared level."""
    if one == other:
        return 1.0
    (level, fine, coarse), (other_level, other_fine, other_coarse) = one.split(":"), other.split(":")
    step = int(level) - int(other_level)
    if step == 0:
        return max(_alike(fine, other_fine), _alike(coarse, other_coarse))
    if step == 1:
        return _alike(fine, other_coarse)
    return _alike(coarse, other_fine) if step == -1 else 0.0


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(piece.first, len(piece)), pa.array(fingerprints(piece), pa.string())],
                names=["key", "fingerprint"],
            )


def fingerprint(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and its ``fingerprint``. One pass, no shuffle."""
    kind = rows.schema[key].dataType.simpleString()
    texts = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return texts.mapInArrow(_fingerprint, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part, in order; a guest, the next part's first row, closes each part."""
    held: list[tuple[int, bool, object, str]] = []
    size = 0
    for batch in batches:
        parts, guests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for row in range(batch.num_rows):
            text = batch.column(3)[row].as_py()
            held.append((parts[row], guests[row] == 1, batch.column(2)[row].as_py(), text))
            size += len(text)
            if size >= PIECE_BYTES and len(held) > 1:
                yield _described(held)
                held, size = held[-1:], len(text)
    if len(held) > 1:
        yield _described(held)


def _described(held: list[tuple[int, bool, object, str]]) -> pa.RecordBatch:
    texts = [x[3] for x in held]
    pairs = [
        k for k in range(len(held) - 1) if held[k][0] == held[k + 1][0] and not held[k][1]
    ]  # a guest has its own row in another part
    changed = [edited(texts[k], texts[k + 1]) for k in pairs]
    own = [f for piece in pieces(pa.array(texts, pa.large_string())) for f in fingerprints(piece)]
    new = [f for piece in pieces(pa.array(changed, pa.large_string())) for f in fingerprints(piece)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([held[k][2] for k in pairs], pa.int64()),
            pa.array([len(texts[k]) for k in pairs], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
            pa.array([own[k] for k in pairs], pa.string()),
            pa.array(new, pa.string()),
            pa.array([likeness(own[k], f) for k, f in zip(pairs, new, strict=True)], pa.float64()),
            pa.array([likeness(own[k], own[k + 1]) for k in pairs], pa.float64()),
        ],
        names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _part_of(firsts: list[tuple[int, int]]) -> Column:
    """The last part whose first (order, tie) is not after the row's."""
    orders, ties = (np.array(x, dtype=np.int64) for x in zip(*firsts, strict=True))

    @F.pandas_udf("long")
    def part(order: pd.Series, tie: pd.Series) -> pd.Series:
        order, tie = order.to_numpy(), tie.to_numpy()
        found = np.searchsorted(orders, order, side="left")
        last = np.searchsorted(orders, order, side="right")
        # Only an order that begins a part, or several, needs its ties.
        shared = np.flatnonzero(found < last)
        for value in np.unique(order[shared]):
            own = shared[order[shared] == value]
            first, end = found[own[0]], last[own[0]]
            found[own] = first + np.searchsorted(ties[first:end], tie[own], side="right")
        return pd.Series(np.maximum(found - 1, 0))

    return part("order", "tie")


def with_neighbours(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and its likeness to that and to the next row's.

    Rows meet their neighbour in ranges of (key, hash of the text), at most one per
    shuffle partition, so that the texts of one hot key spread over ranges; rows equal
    in both stay together. The ranges are cut on keys and hashes alone. The first row
    of each range is sent to the range before as well, so one shuffle of the texts is
    enough. The key must be an integer.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    keyed = rows.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(least)).alias("order"),
        F.col(f"`{key}`").cast("long").alias("key"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    ranged = keyed.select("order", "tie").repartitionByRange(ranges, "order", "tie")
    cut = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("order", "tie")).alias("first"))
    firsts = sorted((r["first"]["order"], r["first"]["tie"]) for r in cut.collect())  # one row per range
    if not firsts:
        return spark.createDataFrame([], _chain_schema(key))
    before = [(*first, (part - 1) % len(firsts)) for part, first in enumerate(firsts)]
    edges = F.broadcast(spark.createDataFrame(before, "order long, tie long, to long"))  # one row per range
    guests = materialize(
        keyed.join(edges, ["order", "tie"])
        .groupBy("order", "tie", "to")
        .agg(F.min("text").alias("text"))
        .select(F.col("to").alias("part"), F.lit(1).alias("guest"), F.lit(None).cast("long").alias("key"), "text", "order", "tie")
    )
    placed = keyed.select(_part_of(firsts).alias("part"), F.lit(0).alias("guest"), "key", "text", "order", "tie")
    chained = (
        placed.unionByName(guests)
        .repartitionById(ranges, F.col("part").cast("int"))
        .sortWithinPartitions("part", "guest", "order", "tie", "text")
        .select("part", "guest", "key", "text")
        .mapInArrow(_chain, _chain_schema("key"))
    )
    return chained.withColumnRenamed("key", key)


def _chain_schema(key: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("n_chars", T.LongType()),
            *[T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")],
            *[T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")],
        ]
    )
