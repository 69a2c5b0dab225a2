import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesops.llm import packing, token_counts, tokens
from salesops.llm.textarrays import pieces
from salesops.llm.tokens import encoder, read_definition
from tests.llm.conftest import ODD, SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ALPHABET = "aBé́İ'st,.!? \n 　日1-<|>"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=30))
def test_prefixes_of_any_text(text):
    for_batch = token_counts._prefixes(read_definition(PATH))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["key", "text"])
    (counted,) = list(for_batch(iter([batch])))
    assert counted.column(1)[0].as_py() == [len(ids_of(text[:k])) for k in range(len(text) + 1)]


def test_counts(odd, none):
    rows = token_counts.token_counts(odd, PATH, 3).collect()
    want = sorted((str(k), len((t or "").encode()), len(ids_of(t))) for k, t in ODD)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    for r in rows:
        text = next(t for k, t in ODD if k == r.doc_id and len((t or "").encode()) == r.n_bytes) or ""
        assert r.over_limit == (r.n_tokens > 3)
        assert len(ids_of(text[: r.kept_chars])) <= 3
        if r.doc_id != 8:  # one chunk that is not divided
            beyond = text[: r.kept_chars + 40]
            assert all(len(ids_of(beyond[:k])) > 3 for k in range(r.kept_chars + 1, len(beyond) + 1))
    assert token_counts.token_counts(none, PATH, 3).count() == 0


def dense_text(draw, size):
    """No white space: runs of letters, digits and symbols of many lengths and scripts."""
    parts = []
    while sum(map(len, parts)) < size:
        of = draw.choice(["日本語中文字", "abcdefghij", "AbCdЖяéß", "0123456789", "/+=-_.!?", "ไทยกรุงเทพ", "😀👍🏽", "'s'll", "<|endoftext|>"])
        if of == "<|endoftext|>":
            parts.append(of)
        else:
            parts.append("".join(draw.choice(list(of), int(draw.integers(1, 80)))))
    return "".join(parts)[:size]


LONG_CHUNKS = ["x" * 400, "日" * 300, "https://" + "the-quick_brown.fox/" * 20, "e\u0301" * 60 + "İ" * 30, "internationalization" * 12]


@pytest.mark.parametrize("text", [*LONG_CHUNKS, *(dense_text(np.random.default_rng(k), 400) for k in range(12))])
def test_prefixes_inside_long_chunks(text):
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["key", "text"])
    (counted,) = list(token_counts._prefixes(read_definition(PATH))(iter([batch])))
    assert counted.column(1)[0].as_py() == [len(ids_of(text[:k])) for k in range(len(text) + 1)]


@pytest.mark.parametrize("text", ["日" * 5_000, "x" * 30_000])
def test_long_runs_are_cut_at_the_limit(text):
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["key", "text"])
    (counted,) = list(token_counts._count(read_definition(PATH), 300)(iter([batch])))
    kept = counted.column(3)[0].as_py()
    assert 0 < kept < len(text) and len(ids_of(text[:kept])) <= 300
    assert all(len(ids_of(text[:k])) > 300 for k in range(kept + 1, kept + 60))


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 2)
    known = encoder(read_definition(PATH))
    for text in ("a b c", "d e", "a d f"):
        (piece,) = pieces(pa.array([text]))
        found = known.find(piece)
        assert known.id_count[found.known].sum() == len(ids_of(text))


def test_first_fit_decreasing():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 101, 300).tolist()
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room, want = [], {}
    for k in sorted(range(300), key=lambda i: -sizes[i]):
        at = next((b for b, r in enumerate(room) if r >= sizes[k]), len(room))
        if at == len(room):
            room.append(100)
        want[k] = (at, 100 - room[at])
        room[at] -= sizes[k]
    assert [want[k] for k in range(300)] == list(zip(bins, offsets, strict=True))


def checked(rows, texts, capacity):
    """Every id lies in one piece, sequences have no gaps; returns the share of padding."""
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, text in texts:
        ids = np.array([*ids_of(text), 2], dtype="<u4")
        found, at = sorted(parts[key], key=lambda r: r.start), 0
        for r in found:
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / total


def test_packing(spark, odd, none):
    rows = packing.pack(odd.where("doc_id <> 5"), PATH, 64, group_documents=3).collect()
    checked(rows, [(k, t) for k, t in ODD if k not in (5, None)], 64)
    assert packing.pack(odd, PATH, 64).selectExpr("sum(length)").first()[0] == sum(len(ids_of(t)) + 1 for _, t in ODD)
    assert packing.pack(none, PATH).count() == 0
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    assert checked(packing.pack(documents, PATH).collect(), texts, 4096) < 0.02


def test_packed_ids(odd):
    rows = packing.pack(odd.where("doc_id = 7"), PATH, 1000, keep_ids=True).collect()
    joined = [x for r in sorted(rows, key=lambda r: r.start) for x in r.ids]
    assert joined == [*ids_of(ODD[9][1]), 2]


@pytest.mark.parametrize("groups", [1, 5])
def test_groups_are_packed_alone(odd, groups):
    rows = packing.pack(odd, PATH, 64, group_documents=-(-13 // groups)).collect()
    assert len({r.sequence_id >> 31 for r in rows}) <= groups
