import random
import re
import time
import zlib
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from salesops.llm import periods, queries
from tests.llm.conftest import SMALL


def plain_runs(words):
    """(start, length, period) by comparing all words with those a period further, for every period."""
    n, found = len(words), []
    for period in range(1, n // 4 + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end + period - start
            stretch = words[start : start + length]
            if length >= max(6, 4 * period) and all(
                any(stretch[i] != stretch[i + p] for i in range(length - p)) for p in range(1, period)
            ):
                found.append((start, length, period))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def found_in(texts):
    words = np.array([w for t in texts for w in t], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    rows = zip(*(x.tolist() for x in periods.find_runs(words, bounds)), strict=True)
    return [(start, end - start, period) for start, end, period in rows], bounds.tolist()


def agrees(texts):
    found, bounds = found_in(texts)
    want = [(start + base, length, period) for t, base in zip(texts, bounds) for start, length, period in plain_runs(t)]
    assert found == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=6))
def test_few_words(texts):
    agrees(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=8), st.integers(1, 9)), max_size=8))
def test_repeated_blocks(blocks):
    text = [w for block, times in blocks for w in block * times]
    agrees([text, text[3:], text])


def test_known_words():
    fibonacci, morse = [0], [bin(i).count("1") & 1 for i in range(500)]
    longer = [0, 1]
    while len(longer) < 400:
        fibonacci, longer = longer, longer + fibonacci
    agrees([longer, morse, [7] * 300, [*range(400)], [], [1]])


def test_long_runs_take_no_square():
    begun = time.perf_counter()
    found, _ = found_in([[0] * 200_000, [*range(10)] * 20_000, [k // 3 % 2 for k in range(100_000)]])
    assert [(length, period) for _, length, period in found] == [(200_000, 1), (200_000, 10), (100_000, 6)]
    assert time.perf_counter() - begun < 30


def test_long_periods():
    """Twice a period of more than 32 words is no period, though a boundary has 64 equal words on one side."""
    run = [k % 34 for k in range(297)]
    texts = [[1000, *run, 1001], run[99:105], run[286:293], run[230:242]]
    agrees(texts)
    assert found_in(texts)[0] == [(1, 297, 34)]


def test_every_symbol_is_two_symbols():
    rnd = random.Random(5)
    words = np.array([rnd.randrange(3) for _ in range(3000)])
    bounds = np.array([0, 1000, 1000, 3000])
    s = periods.compress(words, bounds)
    assert (s.low < s.middle).all() and (s.middle < s.high).all()
    for k in range(len(s.low)):
        spelled = words[s.low[k] : s.high[k]].tolist()
        for place in s.places[s.of_symbol[k] : s.of_symbol[k + 1]].tolist():
            assert words[place : place + len(spelled)].tolist() == spelled
            assert place >= 1000 or place + len(spelled) <= 1000
    # Each text ends up as one symbol.
    assert {(0, 1000), (1000, 3000)} <= set(zip(s.low.tolist(), s.high.tolist()))


def test_odd_rows(spark, odd, none):
    rows = odd.collect()
    found = periods.periodic_runs(odd).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in rows)
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append(r.text)
    for r in found:
        if r.doc_id == 7:
            assert [tuple(x) for x in r.runs] == [(0, 40_000, 2)] and r.collapsed == "lorem ipsum" and r.n_words == 40_000
        else:
            assert not r.runs and r.collapsed in {" ".join(split(t)) for t in texts[r.doc_id]}
    assert periods.periodic_runs(none).collect() == []


def test_white_space(spark):
    """Only 0x20 and 0x09 to 0x0D part words."""
    text = " a b\x1cc\x85d e\n\v\f\r\tA a A a A a A a A \x1f　"
    row = periods.periodic_runs(spark.createDataFrame([("k", text)], "key string, text string"), "key").first()
    words = split(text)
    assert row.n_words == len(words) and [tuple(x) for x in row.runs] == plain_runs(words)
    assert row.collapsed == collapsed(words, plain_runs(words))


def test_query_by_brute_force(spark):
    want = []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words = split(r.text)
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        shown = (*best, best[1] * 1000 // best[2]) if best else (None,) * 4
        want.append((r.doc_id, len(runs), *shown, *(sha256(t.encode()).hexdigest() for t in (lines, collapsed(words, runs)))))
    found = [tuple(r) for r in queries.op13_periodic_runs(spark, SMALL).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in found) > 5
