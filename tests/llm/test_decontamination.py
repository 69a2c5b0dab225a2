import random
import re

import pytest

from salesops.llm import decontamination as dc
from tests.llm.conftest import ODD, SMALL


def least_distance(item, text):
    """Sellers' table: least distance of the item to a part of the text."""
    before, best = list(range(len(item) + 1)), len(item)
    for c in text:
        row = [0]
        for k, x in enumerate(item):
            row.append(min(before[k + 1] + 1, row[-1] + 1, before[k] + (x != c)))
        before, best = row, min(best, row[-1])
    return best


def distances(item, text):
    """Distance of the item to each beginning of the text."""
    before, found = list(range(len(item) + 1)), [len(item)]
    for j, c in enumerate(text, 1):
        row = [j]
        for k, x in enumerate(item):
            row.append(min(before[k + 1] + 1, row[-1] + 1, before[k] + (x != c)))
        before = row
        found.append(row[-1])
    return found


def held(item, text):
    """Whether the item is there, with its budget, and between words if it is short."""
    errors = dc.budget(item)
    if len(item) >= dc.SHORT_CHARS:
        return least_distance(item, text) <= errors
    inner = {m.start() + 1 for m in re.finditer("(?=[a-z0-9][a-z0-9])", text)}
    return any(
        distance <= errors and begin + j not in inner
        for begin in range(len(text) + 1)
        if begin not in inner
        for j, distance in enumerate(distances(item, text[begin : begin + len(item) + errors]))
    )


def test_bit_parallel_distance():
    draw = random.Random(1)
    for _ in range(300):
        item = "".join(draw.choice("abc") for _ in range(draw.randint(1, 80)))
        text = "".join(draw.choice("abc") for _ in range(draw.randint(0, 120)))
        distance, end = dc.Pattern(item).nearest(text)
        assert distance == least_distance(item, text) == least_distance(item, text[:end])


def edited(text, edits, draw):
    text = list(text)
    for _ in range(edits):
        at, what = draw.randrange(len(text)), draw.random()
        if what < 0.34:
            text[at] = draw.choice("abc xyz")
        elif what < 0.67:
            text.insert(at, draw.choice("abc xyz"))
        else:
            text.pop(at)
    return dc.normalised("".join(text))


@pytest.mark.parametrize("seed", range(3))
def test_finds_what_brute_force_finds(seed):
    draw = random.Random(seed)
    words = ["ab", "cab", "bca", "aa", "cc", "xyz", "zy", "abcabc"]
    items = [(k, " ".join(draw.choice(words) for _ in range(draw.randint(8, 40)))) for k in range(12)]
    finder = dc.Finder(items, 0.1)
    for _ in range(60):
        key, item = draw.choice(items)
        middle = edited(item, draw.randint(0, dc.budget(item) + 3), draw)
        text = dc.normalised(" ".join(draw.choice(words) for _ in range(9)) + " " + middle + " zy " * draw.randint(0, 9))
        found = {x for k, _, _, _ in finder.matches(text) for x in finder.ids[finder.items[k]]}
        assert found == {k for k, x in items if held(x, text)}
        for k, distance, begin, end in finder.matches(text):
            assert least_distance(finder.items[k], text[begin:end]) == distance


def test_documents(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "the SAME text,\n twice over, again."), (2, None), (3, "short"), (4, "The same text, twice over, again.")],
        "item_id long, text string",
    )
    rows = sorted(tuple(r) for r in dc.find_passages(odd, items).collect())
    assert rows == sorted([(k, item, 0, 0, 5) for k in (5, 5, 6) for item in (1, 4)])
    kept = dc.without_passages(odd, items)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for k, _ in ODD if k not in (5, 6))
    assert dc.find_passages(none, items).count() == 0 == dc.find_passages(odd, items.limit(0)).count()
    assert dc.without_passages(odd, items.limit(0)).count() == len(ODD)


@pytest.mark.parametrize("seed", range(3))
def test_finds_short_items_as_brute_force_does(seed):
    draw = random.Random(seed)
    words = ["ab", "cab", "a", "xyz?", "(zy)", "abcabc", "日本", "q1"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 12))) for _ in range(40)]
    items = list(enumerate(dict.fromkeys(texts)))
    assert any(len(x) < dc.SHORT_CHARS for _, x in items) and any(len(x) >= dc.SHORT_CHARS for _, x in items)
    finder = dc.Finder(items, 0.1)
    for _ in range(80):
        text = " ".join(draw.choice(words) + draw.choice(["", "", "b", "!"]) for _ in range(30))
        if draw.random() < 0.5:
            text += " " + edited(draw.choice(items)[1], draw.randint(0, 2), draw) + draw.choice(["", " ab", "b"])
        text = dc.normalised(text)
        found = {x for k, _, _, _ in finder.matches(text) for x in finder.ids[finder.items[k]]}
        assert found == {k for k, x in items if held(x, text)}


def test_short_items(spark):
    documents = spark.createDataFrame(
        [
            (1, "Who wrote  HAMLET? Nobody."), (2, "who wrote hamlets?"), (3, "東京の首都はどこ"), (4, "nothing"), (5, "ha ha ha"),
            (6, "She who wrte Hamlet"), (7, "who wroteth hamlets"), (8, "anywho wrote hamlet"),
        ],
        "doc_id long, text string",
    )
    items = [(1, "Who wrote Hamlet"), (2, "首都"), (3, " "), (4, "thing"), (5, "ha ha"), (1, "Who wrote Hamlet")]
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = sorted(tuple(r) for r in dc.find_passages(documents, items).collect())
    assert rows == [(1, 1, 0, 0, 2), (2, 1, 1, 0, 2), (3, 2, 0, 0, 0), (5, 5, 0, 0, 1), (5, 5, 0, 1, 2), (6, 1, 1, 1, 3)]
    assert sorted(r.doc_id for r in dc.without_passages(documents, items).collect()) == [4, 7, 8]


def test_blocks_of_items(spark, monkeypatch):
    documents, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(tuple(r) for r in dc.find_passages(documents, items).collect())
    texts = {r.doc_id: dc.normalised(r.text) for r in documents.collect()}
    exact = {(k, r.item_id) for r in items.collect() for k, t in texts.items() if dc.normalised(r.text) in t}
    assert exact and exact == {(r[0], r[1]) for r in whole if r[2] == 0}
    for key, item, _, first, last in whole:
        words = texts[key].split(" ")[first : last + 1]
        text = next(dc.normalised(r.text) for r in items.collect() if r.item_id == item)
        assert least_distance(text, " ".join(words)) <= dc.budget(text)
    for bound, least in (("BLOCK_ITEMS", 15), ("BLOCK_BYTES", 2000)):
        with monkeypatch.context() as small:
            small.setattr(dc, bound, least)
            assert sorted(tuple(r) for r in dc.find_passages(documents, items).collect()) == whole
    monkeypatch.setattr(dc, "BLOCK_BYTES", 2000)
    clean = {k for k in texts} - {r[0] for r in whole}
    assert {r.doc_id for r in dc.without_passages(documents, items).collect()} == clean
