"""Exact token counts of whole texts and of all their prefixes.

Prefix dynamic programming: the count of a prefix is the count of the chunks that
lie wholly inside it plus the count of the part of a chunk at its end. The first
follows from the prefix one chunk shorter, the second from a table of the
chunk's own prefixes, made when asked for. Inside a long chunk the same holds of
the tokenizer's own runs, whatever their length. Budget
and truncation questions read these tables; no prefix is encoded as a whole.

Defined cases: a null text counts as an empty one (0 bytes, 0 tokens); rows
repeat in the result as in the input; an empty table gives no rows; only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.llm.textarrays import Piece, pieces
from salesops.llm.tokens import ChunkEncoder, Found, encoder, read_definition


class Prefixes(NamedTuple):
    """A piece's chunks with the tokens before each, over the whole piece, and one more entry for all."""

    known: ChunkEncoder
    found: Found
    before: np.ndarray

    def texts(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens before each text of the piece, and of the text."""
        bounds = self.before[self.found.chunks.of_text]
        return bounds[:-1], np.diff(bounds)

    def inside(self, chunk: int) -> np.ndarray:
        """Per byte of a chunk, the tokens of the piece up to there."""
        data, first, last = self.found.chunks.data, self.found.chunks.starts[chunk], self.found.chunks.ends[chunk]
        total = int(self.known.id_count[self.found.known[chunk]])
        return self.before[chunk] + self.known.prefixes(data[first:last].tobytes(), total)

    def longest(self, text: int, bounds: np.ndarray, limit: int) -> int:
        """Bytes of the longest prefix of a text, of whole code points, that has at most so many tokens.

        Counts at the ends of chunks never fall, so that the prefix ends in the
        first chunk that goes beyond the limit, or just before it.
        """
        chunks = self.found.chunks
        first, last = int(chunks.of_text[text]), int(chunks.of_text[text + 1])
        most = self.before[first] + limit
        beyond = int(np.searchsorted(self.before[first + 1 : last + 1], most, side="right")) + first
        if beyond == last:
            return int(bounds[text + 1] - bounds[text])
        begin, end = int(chunks.starts[beyond]), int(chunks.ends[beyond])
        whole = np.append((chunks.data[begin + 1 : end] & 0xC0) != 0x80, True)
        fits = np.flatnonzero((self.inside(beyond) <= most) & whole)
        return begin - int(bounds[text]) + (int(fits[-1]) + 1 if len(fits) else 0)


def prefixes_of(known: ChunkEncoder, piece: Piece) -> Prefixes:
    found = known.find(piece)
    return Prefixes(known, found, np.concatenate([[0], np.cumsum(known.id_count[found.known])]))


def _code_points(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte, and in all."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def _count(definition: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(definition)
        for batch in batches:
            for piece in pieces(batch.column(1)):
                prefixes = prefixes_of(known, piece)
                _, n_tokens = prefixes.texts()
                points = _code_points(piece.data)
                kept = points[piece.bounds[1:]] - points[piece.bounds[:-1]]
                for k in np.flatnonzero(n_tokens > limit).tolist():
                    first = piece.bounds[k]
                    kept[k] = points[first + prefixes.longest(k, piece.bounds, limit)] - points[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, len(piece)),
                        pa.array(np.diff(piece.bounds)),
                        pa.array(n_tokens),
                        pa.array(kept),
                    ],
                    names=["key", "n_bytes", "n_tokens", "kept_chars"],
                )

    return run


def token_counts(rows: DataFrame, tokenizer: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_bytes``, ``n_tokens``, ``over_limit``, and ``kept_chars``.

    ``kept_chars`` is the length in code points of the longest prefix of at most
    ``limit`` tokens. One pass over the texts, no shuffle.
    """
    kind = rows.schema[key].dataType.simpleString()
    counted = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        _count(read_definition(tokenizer), limit), f"key {kind}, n_bytes long, n_tokens long, kept_chars long"
    )
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "kept_chars"
    )


def _prefixes(definition: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(definition)
        for batch in batches:
            for piece in pieces(batch.column(1)):
                prefixes = prefixes_of(known, piece)
                chunks = prefixes.found.chunks
                # White space adds nothing: it keeps the count of the chunk before it.
                table = prefixes.before[np.searchsorted(chunks.ends, np.arange(len(piece.data)), side="right")]
                for k in range(len(chunks.starts)):
                    table[chunks.starts[k] : chunks.ends[k]] = prefixes.inside(k)
                counts = []
                for base, first, last in zip(prefixes.texts()[0], piece.bounds[:-1], piece.bounds[1:], strict=True):
                    ends = np.append((piece.data[first + 1 : last] & 0xC0) != 0x80, True)[: last - first]
                    counts.append(np.concatenate([[0], table[first:last][ends] - base]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), pa.array(counts, pa.list_(pa.int32()))],
                    names=["key", "counts"],
                )

    return run


def prefix_counts(rows: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and ``counts``, the token count of each prefix of 0, 1, 2, ... code points."""
    kind = rows.schema[key].dataType.simpleString()
    return (
        rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(_prefixes(read_definition(tokenizer)), f"key {kind}, counts array<int>")
        .withColumnRenamed("key", key)
    )
