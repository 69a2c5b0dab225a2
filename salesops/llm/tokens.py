"""Token ids of whole texts, one distinct chunk at a time.

The tokenizers handled here never merge across white space, which has no token,
nor between a letter or digit and a mark such as a comma, and they take capitals
as small letters. So a text's ids are those of its chunks in order, and a chunk
met before, in whatever case, need not be encoded again. A task therefore calls
the tokenizer once per distinct chunk and puts texts together by array
operations.

The counts of all prefixes of a long run follow from each other (``Runs``): a
sequence of tokens is a run's encoding if each two neighbours encode to
themselves, so that one token at most can end each prefix.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from typing import NamedTuple

import numpy as np

from salesops.llm.textarrays import Piece, Words, word_hashes, words

# Distinct chunks remembered by a Python worker; beyond them it starts afresh.
MAX_CHUNKS = 1_000_000
# The tokenizer counts each prefix of a chunk, or of a run within a longer chunk, of up to so many bytes.
COUNTED_SINGLY = 96

_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b",.;:!?")] = True


def chunks_of(piece: Piece) -> Words:
    """Runs without white space, cut between ASCII letters or digits and marks."""
    plain, mark = _PLAIN[piece.data], _MARKS[piece.data]
    cuts = np.zeros(len(piece.data), dtype=bool)
    cuts[1:] = (plain[:-1] & mark[1:]) | (mark[:-1] & plain[1:])
    # The names of special tokens are the one thing that depends on case.
    special = b"<|" in piece.data.tobytes()
    return words(piece, lower=not special, cuts=cuts)


class Pool:
    """Arrays of different lengths, end to end."""

    def __init__(self) -> None:
        self.data = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0

    def add(self, values: np.ndarray) -> int:
        """Where the values begin."""
        first, last = self.used, self.used + len(values)
        if last > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(last, len(self.data)), dtype=np.int32)])
        self.data[first:last] = values
        self.used = last
        return first


class Found(NamedTuple):
    """Chunks of a piece, and for each its place among the known chunks."""

    chunks: Words
    known: np.ndarray


def gather(pool: np.ndarray, firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pool's runs in the given order, end to end."""
    before = np.cumsum(lengths) - lengths
    return pool[np.repeat(firsts - before, lengths) + np.arange(int(lengths.sum()))]


class Runs:
    """Token counts of all prefixes of a run of byte symbols, by the merges of a byte pair encoding."""

    def __init__(self, model: dict) -> None:
        self.vocabulary = model["vocab"]
        merges = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: k for k, pair in enumerate(merges)}
        self.closing = model["end_of_word_suffix"] or ""
        self.longest = max(map(len, self.vocabulary))
        self.apart = functools.lru_cache(1 << 18)(self._apart)

    @staticmethod
    def of(definition: str) -> Runs | None:
        """None if the tokenizer is of another kind."""
        model = json.loads(definition)["model"]
        other = ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        return None if model["type"] != "BPE" or any(model.get(x) for x in other) else Runs(model)

    def _symbols(self, token: str, closed: bool) -> list[str]:
        return [*token[:-1], token[-1] + (self.closing if closed else "")]

    def _encoded(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            ranks = [self.ranks.get(pair, len(self.ranks)) for pair in zip(symbols[:-1], symbols[1:], strict=True)]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.ranks):
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _apart(self, before: str, token: str, closed: bool) -> bool:
        """Whether two neighbours (the first may be empty) encode to themselves."""
        symbols = [*before, *self._symbols(token, closed)]
        return self._encoded(symbols) == [*([before] if before else []), token + (self.closing if closed else "")]

    def _last(self, run: str, end: int, lasts: list[str], closed: bool) -> str | None:
        """The token that ends the encoding of a prefix."""
        for size in range(min(end, self.longest), 0, -1):
            token = run[end - size : end]
            if (token + self.closing if closed else token) in self.vocabulary and (
                self.apart("", token, closed) and self.apart(lasts[end - size], token, closed)
            ):
                return token
        return None

    def counts(self, run: str, ends: list[int]) -> list[int] | None:
        """Tokens of the prefixes that end there; None if a symbol is unknown."""
        lasts, numbers = [""], [0]
        for end in range(1, len(run)):
            token = self._last(run, end, lasts, closed=False)
            if token is None:
                return None
            lasts.append(token)
            numbers.append(numbers[end - len(token)] + 1)
        closing = [self._last(run, end, lasts, closed=True) for end in ends]
        return None if None in closing else [numbers[e - len(t)] + 1 for e, t in zip(ends, closing, strict=True)]


class ChunkEncoder:
    """Ids of chunks by a tokenizer of the ``tokenizers`` library, given as the text of its file."""

    def __init__(self, definition: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.runs = functools.cache(lambda: Runs.of(definition))
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or "(?!)")
        size = self.tokenizer.get_vocab_size()
        self.closing = np.array([(self.tokenizer.id_to_token(k) or "").endswith("</w>") for k in range(size)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = Pool()
        self.inner: dict[bytes, np.ndarray] = {}
        self.id_first = np.zeros(0, dtype=np.int64)
        self.id_count = np.zeros(0, dtype=np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words of letters alone, and how many each has, from one call for all.

        Each is one word to the tokenizer, whose last id closes it. None if that does not hold.
        """
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ids = np.array(self._encode([" ".join(texts)])[0], dtype=np.int32)
        ends = np.flatnonzero(self.closing[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(texts) else None

    def find(self, piece: Piece) -> Found:
        chunks = chunks_of(piece)
        hashes = word_hashes(chunks)
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > MAX_CHUNKS:
            self._forget()
        keys = distinct.tolist()
        new = [k for k, key in enumerate(keys) if key not in self.known]
        if new:
            held = chunks.data.tobytes()
            where = at[new]
            bounds = zip(chunks.starts[where].tolist(), chunks.ends[where].tolist(), strict=True)
            self._learn([keys[k] for k in new], [held[a:b] for a, b in bounds])
        places = np.fromiter((self.known[key] for key in keys), dtype=np.int64, count=len(keys))
        return Found(chunks, places[back])

    def _learn(self, keys: list[int], chunks: list[bytes]) -> None:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        # A capital I with dot is a letter that becomes a letter and a mark.
        alone = [t.isalpha() and "\u0130" not in t for t in texts]
        together = self._encode_words([t for t, a in zip(texts, alone, strict=True) if a])
        if together is None:
            alone, together = [False] * len(texts), self._encode_words([])
        others = self._encode([t for t, a in zip(texts, alone, strict=True) if not a])
        counts = np.concatenate([together[1], [len(x) for x in others]]).astype(np.int64)
        first = self.ids.add(np.concatenate([together[0], *[np.asarray(x, np.int32) for x in others]]))
        order = np.argsort(~np.array(alone, dtype=bool), kind="stable")
        place = len(self.known)
        self.known.update(zip([keys[k] for k in order.tolist()], range(place, place + len(keys)), strict=True))
        self.id_first = np.concatenate([self.id_first, first + np.cumsum(counts) - counts])
        self.id_count = np.concatenate([self.id_count, counts])

    def prefixes(self, chunk: bytes, total: int) -> np.ndarray:
        """Per byte of the chunk, the tokens of its code points that end there or before."""
        if chunk in self.inner:
            return self.inner[chunk]
        text = chunk.decode("utf-8", "replace")
        divided = self._singly if len(chunk) <= COUNTED_SINGLY else self._divided
        points = np.array([0, *divided(text)])
        points[-1] = total
        ends = np.cumsum([len(c.encode()) for c in text])
        counts = points[np.searchsorted(ends, np.arange(1, len(chunk) + 1), side="right")]
        if len(chunk) <= COUNTED_SINGLY:
            self.inner[chunk] = counts
        return counts

    def _singly(self, text: str) -> list[int]:
        found: list[int] = []
        for first in range(1, len(text) + 1, 1000):
            found += [len(x) for x in self._encode([text[:k] for k in range(first, min(first + 1000, len(text) + 1))])]
        return found

    def _divided(self, text: str) -> list[int]:
        """Tokens of each prefix of a long chunk. Nothing is merged across a special token's end."""
        found, before, first = [], 0, 0
        for last in [*(m.end() for m in self.special.finditer(text)), len(text)]:
            if last > first:
                part = text[first:last]
                points = self._by_runs(part) or self._singly(part)
                points[-1] = len(self._encode([part])[0])
                found += [before + k for k in points]
                before, first = found[-1], last
        return found

    def _by_runs(self, text: str) -> list[int] | None:
        """Tokens of each prefix, from the tokenizer's own runs; None if it does not take characters one by one."""
        normalizer = self.tokenizer.normalizer
        plain = normalizer.normalize_str(text) if normalizer else text
        # A prefix of a composed text is composed.
        if len(plain) != len(text) or not unicodedata.is_normalized("NFC", text) or any(len(c.lower()) != 1 for c in text):
            return None
        found, before, at = [], 0, 0
        for symbols, (first, last) in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain):
            run = plain[first:last]
            ends = np.cumsum([len(c.encode()) for c in run]).tolist()
            counts = None
            if ends[-1] > COUNTED_SINGLY and len(symbols) == ends[-1] and self.runs():
                counts = self.runs().counts(symbols, ends)
            counts = counts or self._singly(run)
            found += [before] * (first - at) + [before + k for k in counts]
            before, at = found[-1], last
        return found + [before] * (len(text) - at)


_encoders: dict[int, ChunkEncoder] = {}


def encoder(definition: str) -> ChunkEncoder:
    """This worker's encoder, with what it already knows."""
    key = hash(definition)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(definition)
    return _encoders[key]


def read_definition(path: str) -> str:
    """The tokenizer's file; it goes with the tasks, so executors need no copy."""
    with open(path, encoding="utf-8") as file:
        return file.read()
