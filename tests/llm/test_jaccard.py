import random
import re
from collections import Counter
from pathlib import Path

import pytest

from salesops import session
from salesops.llm import graphs, jaccard
from salesops.llm.graphs import components
from tests.llm.conftest import ODD, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(texts):
    for text in texts:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        yield frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Every pair that shares a shingle, and union-find."""
    sets = list(sets_of(t for _, t in rows))
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, shingles in enumerate(sets):
        for s in shingles:
            holders.setdefault(s, []).append(k)
    for k, shingles in enumerate(sets):
        shared = Counter(j for s in shingles for j in holders[s] if j < k)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(shingles) + len(sets[j]) - n):
                parent[top(k)] = top(j)
    members = {}
    for k, (key, _) in enumerate(rows):
        members.setdefault(top(k), []).append(key)
    least = {r: min((k for k in m if k is not None), default=None) for r, m in members.items()}
    return sorted(((key, len(sets[k]), least[top(k)]) for k, (key, _) in enumerate(rows)), key=str), members


def found(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def edited_groups(seed, groups=40):
    draw = random.Random(seed)
    words, rows = [f"w{k}" for k in range(60)], []
    for _ in range(groups):
        base = [draw.choice(words) for _ in range(draw.choice([3, 5, 6, 8, 20, 60, 150]))]
        for _ in range(draw.randint(1, 10)):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                at, what = draw.randrange(len(text)), draw.random()
                if what < 0.4:
                    text[at] = draw.choice(words)
                elif what < 0.7:
                    text.insert(at, draw.choice(words))
                elif len(text) > 1:
                    text.pop(at)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [2048, 3])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = [*edited_groups(block), (None, "w1 w2 w3 w4 w5 w6"), (0, "w1 w2 w3 w4 w5 w6")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(jaccard.near_duplicates(frame)) == brute(rows)[0]


def test_one_key_of_many_texts(spark, monkeypatch):
    """A third of the rows share an id, a third have none: only the texts asked for are fetched."""
    compare = jaccard._compare

    def strict(batches):
        def asked(batch):
            sets = [x for _, found in jaccard.sets_of(batch.column(4)) for x in found]
            assert [int(jaccard.node_of(x)) for x in sets] == batch.column(3).to_pylist()
            return batch

        return compare(asked(b) for b in batches)

    monkeypatch.setattr(jaccard, "_compare", strict)
    rows = [((5, None, k)[k % 3], text) for k, text in edited_groups(9, 10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(jaccard.near_duplicates(frame)) == brute(rows)[0]


def test_small_tables_take_few_files(many_ranges, monkeypatch):
    """Links and pairs are not written in a file per shuffle partition: each file starts processes on its executor."""
    spark, files = many_ranges, []

    def stored(frame, **options):
        table = session.materialize(frame, **options)
        if set(table.columns) in ({"high", "low"}, {"lead", "node"}):
            files.append(len(table.inputFiles()))
        return table

    for module in (graphs, jaccard):
        monkeypatch.setattr(module, "materialize", stored)
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    rows = edited_groups(3, groups=80)
    wanted, _ = brute(rows)
    assert found(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == wanted
    assert max(files) > 1 and max(files) <= session.TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_odd_rows(odd, none, no_broadcast):
    assert found(jaccard.near_duplicates(odd)) == brute(ODD)[0]
    assert jaccard.near_duplicates(none).count() == 0


def test_one_of_each(spark, odd, none):
    kept = sorted((r.doc_id, r.text) for r in jaccard.one_of_each(odd.where("text is not null and doc_id is not null")).collect())
    want = {t: min(k for k, u in ODD if u == t and k is not None) for k, t in ODD if t and t.strip() and k is not None}
    blank = [(k, t) for k, t in ODD if t is not None and not t.strip()]
    assert kept == sorted([*((k, t) for t, k in want.items()), *blank])
    assert jaccard.one_of_each(none).columns == odd.columns
    assert jaccard.one_of_each(odd).count() == len(want) + 5  # three without words have a key, one has none, and one text
    rows = edited_groups(9, 10)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in jaccard.one_of_each(frame).collect()} == {min(m) for m in brute(rows)[1].values()}


def test_given_documents(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(jaccard.near_duplicates(documents)) == brute(rows)[0]


def test_bitmaps_never_rule_out_too_much():
    draw = random.Random(4)
    import numpy as np

    for _ in range(300):
        one = np.unique(np.array([draw.getrandbits(64) for _ in range(draw.randint(1, 400))], dtype=np.uint64))
        other = np.unique(np.concatenate([one[: draw.randint(0, len(one))], np.array([draw.getrandbits(64) for _ in range(40)], dtype=np.uint64)]))
        width = min(len(jaccard.bitmap(one)), len(jaccard.bitmap(other)))
        a, b = (jaccard.folded(jaccard.bitmap(x), width).view(np.uint64) for x in (one, other))
        apart = int(np.bitwise_count(a ^ b).sum())
        assert len(np.intersect1d(one, other)) <= (len(one) + len(other) - apart) / 2


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(100, 164)] + [(7, 3), (9, 7)], "high long, low long")
    found_ = {(r.high, r.low) for r in components(links).collect()}
    assert found_ == {(k, 100) for k in range(101, 165)} | {(7, 3), (9, 3)}
    assert components(links.limit(0)).count() == 0


def test_stored_tables_have_no_mark(spark):
    """The file that marks a job's success would start two processes on the driver for each table."""
    table, folder = session.written(spark.range(3).toDF("low"))
    assert table.count() == 3
    assert "_SUCCESS" not in {p.name for p in Path(folder.removeprefix("file:")).iterdir()}
