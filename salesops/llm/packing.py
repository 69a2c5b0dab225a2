"""Packing of tokenized documents into fixed-length sequences.

A document's ids are cut at every multiple of the capacity: whole parts are a
sequence each, the rest is an item. Items are packed by first-fit decreasing:
longest first, each into the first open sequence with room. A tournament tree
over the room left in each sequence finds it in logarithmic time. Packing runs
independently in groups of documents that are drawn at random (by a hash of the
document and its place in its task), of bounded expected size, so that neither
a hot key nor the number of rows makes a group large.

Defined cases: a null text is an empty one and becomes its end id alone; repeated
rows are packed each on its own, also with equal or null keys; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops.llm.textarrays import mix, pieces
from salesops.llm.tokens import encoder, gather, read_definition

GROUP_DOCUMENTS = 8192
_GROUP_BITS = 31


class Tournament:
    """Room left in each bin; every inner node holds the most room below it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_with(self, size: int) -> int:
        node = 1
        while node < self.leaves:
            node = 2 * node if self.room[2 * node] >= size else 2 * node + 1
        return node - self.leaves

    def take(self, bin_: int, size: int) -> None:
        node = bin_ + self.leaves
        self.room[node] -= size
        node //= 2
        while node:
            self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])
            node //= 2


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; equal sizes keep their order."""
    tree = Tournament(len(sizes), capacity)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bins[k] = tree.first_with(sizes[k])
        offsets[k] = capacity - tree.room[bins[k] + tree.leaves]
        tree.take(bins[k], sizes[k])
    return bins, offsets


def _cut(definition: str, capacity: int, end_id: int, groups: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(definition)
        seen = 0
        for batch in batches:
            for piece in pieces(batch.column(1)):
                chunks, places = known.find(piece)
                lengths = known.id_count[places]
                flat = gather(known.ids.data, known.id_first[places], lengths).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(lengths)])[chunks.of_text].tolist()
                rows, starts, sizes, crcs, wholes, cut = [], [], [], [], [], []
                for k in range(len(piece)):
                    ids = np.append(flat[ends[k] : ends[k + 1]], np.array([end_id], dtype="<u4"))
                    for start in range(0, len(ids), capacity):
                        part = ids[start : start + capacity]
                        rows.append(piece.first + k)
                        starts.append(start)
                        sizes.append(len(part))
                        crcs.append(zlib.crc32(part.tobytes()))
                        wholes.append(len(ids))
                        if keep_ids:
                            cut.append(part.astype(np.int32))
                order = np.arange(seen, seen + len(rows), dtype=np.uint64)
                drawn = mix(np.array(crcs, dtype=np.uint64) * np.uint64(1 << 32) + order) % np.uint64(groups)
                seen += len(rows)
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array(wholes, pa.int64()),
                    pa.array(drawn.astype(np.int64)),
                ]
                names = ["key", "start", "length", "ids_crc32", "doc_tokens", "pack_group"]
                if keep_ids:
                    columns.append(pa.array(cut, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _pack(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "start", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].tolist(), capacity)
        base = group["pack_group"] * (1 << _GROUP_BITS)
        return group.drop(columns="pack_group").assign(sequence_id=base + np.array(bins), offset=np.array(offsets))

    return run


def pack(
    rows: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    group_documents: int = GROUP_DOCUMENTS,
    keep_ids: bool = False,
) -> DataFrame:
    """Per piece: the key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    With ``keep_ids`` also ``ids``, the piece's token ids; otherwise only their
    checksum travels. One pass over the texts, one shuffle of the pieces.
    """
    kind = rows.schema[key].dataType
    groups = max(1, -(-rows.count() // group_documents))
    fields = [("key", kind)] + [(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    ids = [("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []
    cut = T.StructType([T.StructField(n, t) for n, t in [*fields, ("pack_group", T.LongType()), *ids]])
    placed = [*fields, *ids, ("sequence_id", T.LongType()), ("offset", T.LongType())]
    packed = (
        rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(_cut(read_definition(tokenizer), capacity, end_id, groups, keep_ids), cut)
        .groupBy("pack_group")
        .applyInPandas(_pack(capacity), T.StructType([T.StructField(n, t) for n, t in placed]))
    )
    return packed.withColumnRenamed("key", key)
