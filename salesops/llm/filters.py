"""Rows kept or dropped by a decision on their text, in one pass and without a join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesops.llm.textarrays import Piece, pieces


def keep_rows(
    rows: DataFrame, text: str, decider: Callable[[], Callable[[Piece], np.ndarray]],
    prepare: Callable[[pa.Array], pa.Array] = lambda column: column,
) -> DataFrame:
    """The rows, with all columns, for whose text the decision is true.

    ``decider`` is called once in each task and returns the decision on a piece;
    ``prepare`` changes the text that it sees, not the one that is kept.
    """
    place = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = decider()
        for batch in batches:
            # A piece at a time: no second copy of all texts of a batch is held.
            for piece in pieces(prepare(batch.column(place))):
                yield batch.slice(piece.first, len(piece)).filter(pa.array(decide(piece)))
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, rows.schema)
