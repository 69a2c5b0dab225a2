import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from salesops import session
from salesops.llm import language_model as lm
from tests.llm.conftest import ODD, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def base(rows):
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0 for k, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    for (key, text), h in zip(rows, held, strict=True):
        own = tokens(text)
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        yield str(key), h, len(own), sum(counts[w] > 0 for w in own), total, round(score, 4)


def found(frame):
    rows = frame.collect()
    assert all(r.score < 0 and r.perplexity > 1 for r in rows)
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)


@pytest.mark.parametrize("frequent", [1 << 17, 300])
def test_base_and_gain(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    scored = lm.score(documents).cache()
    assert found(scored) == sorted(base([(r.doc_id, r.text) for r in documents.collect()]))
    base_sum, score_sum = scored.where("held_out").selectExpr("sum(base_score)", "sum(score)").first()
    assert score_sum > base_sum + 0.3 * abs(base_sum) * 0.1
    scored.unpersist()


def test_odd_rows(odd, none):
    assert found(lm.score(odd)) == sorted(base(ODD))
    assert lm.score(none).count() == 0
    assert lm.score(odd.where("doc_id is null")).count() == 2  # nothing to learn from


def test_probabilities_add_up(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model, counted = lm.fit(documents)
    assert np.allclose(model.classes.sum(axis=1), 1)
    own = set(model.lexicon.words[model.lexicon.classes != model.lexicon.rare].view(np.int64).tolist())
    rare = np.array([r["count"] for r in counted.collect() if r["word"] not in own])
    assert math.isclose(model.rare.of(rare).sum() + model.rare.unknown, 1, rel_tol=1e-9)


def test_seating_keeps_customers():
    rng = np.random.default_rng(1)
    for customers in (1, 2, 3, 50, 10_000, 1_000_000):
        for pull in (1e-9, 0.3, 40.0):
            sizes = lm.seat(customers, pull, 0.6, rng)
            assert sum(sizes) == customers and min(sizes) >= 1
            lm.reseat(sizes, 200, 0.2, 1.0, 0.6, 5, rng)
            assert sum(sizes) == customers and min(sizes) >= 1


def test_gibbs_reaches_the_right_number_of_tables():
    """Tables of 4 customers against the exact posterior, from all seatings' weights."""
    discount, strength, weight, others, customers = 0.5, 1.0, 0.3, 2, 4

    def partitions(n):
        if n == 0:
            yield []
            return
        for rest in partitions(n - 1):
            for k in range(len(rest)):
                yield [*rest[:k], rest[k] + 1, *rest[k + 1 :]]
            yield [*rest, 1]

    mass = Counter()
    for sizes in partitions(customers):
        value = 1.0
        for k in range(len(sizes)):
            value *= (strength + discount * (others + k)) * weight
        for size in sizes:
            for k in range(1, size):
                value *= k - discount
        mass[len(sizes)] += value
    want = sum(t * m for t, m in mass.items()) / sum(mass.values())
    rng, sizes, total = np.random.default_rng(3), [customers], 0
    for _ in range(20_000):
        lm.reseat(sizes, 1, weight, strength, discount, others, rng)
        total += len(sizes)
    assert abs(total / 20_000 - want) < 0.05


def pair_texts():
    """Ten pairs of words that always stand together, all words equally often."""
    draw = np.random.default_rng(5)
    return [(k, " ".join(f"left{i} right{i}" for i in draw.permutation(10))) for k in range(1, 60)]


@pytest.mark.parametrize("listed", [1 << 20, 0])
def test_every_word_is_a_context_of_its_own(spark, monkeypatch, listed):
    """Words of no class of their own: only what follows them tells the texts apart."""
    monkeypatch.setattr(lm, "CLASSES", 2)
    monkeypatch.setattr(lm, "FREQUENT_PAIRS", listed, raising=False)
    asked = [(None, "left3 right3 left7 right7"), (None, "left3 right7 left7 right3")]
    rows = lm.score(spark.createDataFrame(pair_texts() + asked, "doc_id long, text string")).where("doc_id is null").collect()
    assert rows[0].base_score == pytest.approx(rows[1].base_score)
    assert abs(rows[0].score - rows[1].score) > 2


@pytest.mark.parametrize("dishes, frequent", [(4096, 1 << 17), (2, 5)])
def test_probabilities_after_each_word_add_up(spark, monkeypatch, dishes, frequent):
    monkeypatch.setattr(lm, "CLASSES", 4)
    monkeypatch.setattr(lm, "DISHES", dishes)
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    texts = spark.createDataFrame([(t + f" odd{k % 7} left{k % 4}",) for k, t in pair_texts()], "text string")
    model, counted, fitted = lm.fit_all(texts)
    words = {r["word"]: r["count"] for r in counted.collect()}
    hashes = np.array([*words, 12345], dtype=np.int64)
    classes, _ = model.lexicon.find(hashes.view(np.uint64))
    inside = np.where(classes == model.lexicon.rare, model.rare.of(np.array([*words.values(), 0])), 1.0)
    rows = fitted.collect()
    contexts = {r["context"]: np.array(r["weights"]) for r in rows if r["kind"] == 1}
    assert set(contexts) == set(words)
    for context, weights in contexts.items():
        own = classes[hashes == context][0]
        backed = np.array([(weights * model.samples.classes[:, own, c]).mean() for c in classes]) * inside
        seen = {r["word"]: 10 ** r["log"] for r in rows if r["kind"] == 0 and r["context"] == context}
        assert sum(seen.get(w, b) for w, b in zip(hashes.tolist(), backed, strict=True)) == pytest.approx(1)


@pytest.mark.parametrize("customers, pull, discount", [(4, 0.9, 0.5), (20, 0.3, 0.6), (60, 40.0, 0.5), (64, 300.0, 0.9)])
def test_all_customers_of_a_dish_are_seated_anew(customers, pull, discount):
    """From one table each, a few sweeps reach the exact distribution of the number of tables."""
    rng, counts, pulls = np.random.default_rng(7), np.full(4_000, customers), np.full(4_000, pull)
    seating = lm.Seating(counts, np.ones(4_000, dtype=np.int64), np.ones(4_000, dtype=np.int64))
    for _ in range(lm.BURN_IN + lm.SWEEPS):
        seating = lm.reseated(seating, counts, pulls, discount, rng)
    want = lm.table_numbers(customers, pull, discount)[customers]
    at = np.arange(customers + 1)
    mean = (want * at).sum()
    deviation = ((want * at**2).sum() - mean**2) ** 0.5
    assert abs(seating.tables.mean() - mean) < 0.1 * deviation
    assert abs(seating.tables.std() - deviation) < 0.1 * deviation


def test_large_dishes_leave_their_first_seating():
    """A million customers: about pull / discount tables, whatever they began with; counts may change."""
    rng, counts, pulls = np.random.default_rng(8), np.full(100, 1_000_000), np.full(100, 50.0)
    means = []
    for first in (1, 400):
        places = np.tile(np.arange(1, first + 1), 100)
        seating = lm.Seating(counts, np.full(100, first), places)
        for _ in range(lm.BURN_IN + lm.SWEEPS):
            seating = lm.reseated(seating, counts, pulls, 0.6, rng)
        means.append(seating.tables.mean())
    assert abs(means[0] - means[1]) < 0.05 * means[0]
    fewer = lm.reseated(seating, counts // 2, pulls, 0.6, rng)
    assert (np.bincount(np.repeat(np.arange(100), fewer.tables)) == fewer.tables).all() and fewer.opened.max() <= 500_000


def test_rare_words_of_a_count_are_drawn_each():
    counts, many = np.array([1, 2, 3, 100]), np.array([5_000, 2_000, 900, 40])
    rare = lm.fit_rare(counts, many)
    assert (rare.probabilities * many).sum() + rare.unknown == pytest.approx(1)
    assert (np.diff(rare.probabilities) > 0).all()


def test_crowds_are_gamma_numbers():
    """Mean and deviation of gamma numbers; the same key draws the same."""
    keys = np.random.default_rng(1).integers(0, 1 << 63, 40_000).astype(np.uint64)
    for tables in (0, 3, 5_000):
        shape = 1 / 0.6 + tables
        drawn = lm.crowds(np.full(len(keys), tables), 1.0, 0.6, keys, 2)
        assert abs(drawn.mean() / (0.6 * shape) - 1) < 0.02
        assert abs(drawn.std() / (0.6 * shape**0.5) - 1) < 0.03
        assert (drawn[:9] == lm.crowds(np.full(9, tables), 1.0, 0.6, keys[:9], 2)).all()
    assert (lm.crowds(np.ones(9), 1.0, 0.6, keys[:9], 1) != lm.crowds(np.ones(9), 1.0, 0.6, keys[:9], 2)).all()


@pytest.mark.parametrize("pull, discount", [(0.01, 0.5), (0.9, 0.3), (300.0, 0.9)])
def test_small_dishes_have_the_exact_distribution(pull, discount):
    weights, want = lm.table_weights(lm.EXACT, discount), lm.table_numbers(lm.EXACT, pull, discount)
    uniforms = np.random.default_rng(2).random(60_000)
    for customers in (2, 3, 17, lm.EXACT):
        found = lm.drawn_tables(np.full(len(uniforms), customers), np.full(len(uniforms), pull), weights, uniforms)
        share = np.bincount(found, minlength=lm.EXACT + 1) / len(found)
        assert np.abs(share - want[customers]).max() < 0.01


def test_lists_and_copies_change_no_score(spark, monkeypatch):
    """The lists only say where a word or pair is looked up; equal rows score as one of them does."""
    monkeypatch.setattr(lm, "CLASSES", 4)
    texts = [(k, f"{t} odd{k % 7} left{k % 4} once{k} {'twice' if k % 30 == 0 else ''}") for k, t in pair_texts()]
    texts += [texts[0], texts[1], (99, "never left3 once5 right3"), (None, "never seen once7 left1 right1"), (None, "never seen once7 left1 right1")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    found = []
    for frequent, pairs in ((1 << 17, 1 << 20), (5, 0), (20, 7)):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        monkeypatch.setattr(lm, "FREQUENT_PAIRS", pairs)
        found.append(sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in lm.score(rows).collect()))
    for other in found[1:]:
        for one, two in zip(found[0], other, strict=True):
            assert one[:3] == two[:3] and one[3:] == pytest.approx(two[3:], abs=1e-4)


def test_small_tables_take_few_files(many_ranges, monkeypatch):
    """Seatings are not written in a file per shuffle partition: each file starts processes on its executor."""
    spark, files, marks = many_ranges, [], []

    def written(frame, *args, **options):
        table, folder = session.written(frame, *args, **options)
        files.append(("cells" in table.columns or "inside" in table.columns, len(table.inputFiles())))
        marks.append(os.path.exists(f"{folder.removeprefix('file:')}/_SUCCESS"))
        return table, folder

    monkeypatch.setattr(lm, "written", written, raising=False)
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    texts = [(k, f"{t} {' '.join(f'some{k % 9}word{i}' for i in range(40))}") for k, t in pair_texts()]
    assert lm.score(spark.createDataFrame(texts, "doc_id long, text string")).count() == len(texts)
    states = [n for state, n in files if state]
    assert len(states) == 2 + lm.BURN_IN + lm.SWEEPS
    assert max(states) <= session.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert not any(marks)


def test_only_open_questions_are_looked_up(spark, monkeypatch):
    """Words are looked up once a pair, and a listed word whose pair a list holds not at all."""
    monkeypatch.setattr(lm, "CLASSES", 4)
    monkeypatch.setattr(lm, "FREQUENT", 12)
    rows = spark.createDataFrame([(1, "a b a b rare a other rare")], "doc_id long, text string")
    model, known = lm.fit(rows.select("text"))
    hashes = {w: h for text in ("a", "b", "rare", "other") for _, s, _ in lm.tokens(pa.array([text])) for w, h in [(text, s[0])]}
    kept = [w for w in ("a", "b")]
    order = np.argsort([hashes[w] for w in kept])
    own = np.array([hashes[kept[k]] for k in order] + [lm._END], dtype=np.uint64)
    place = np.argsort(own)
    lexicon = lm.Lexicon(own[place], np.array([3, 2, 1])[place], np.array([1, 2, 0])[place], 4)
    model = model._replace(lexicon=lexicon, samples=lm.Samples(np.full((lm.SWEEPS, 5, 5), 0.2), 0.5))
    shared = spark.sparkContext.broadcast((np.sort(lm._joined(np.array([hashes["rare"]]), np.array([hashes["a"]]))), np.zeros(1), np.ones((3, lm.SWEEPS))))
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([1]), pa.array([False]), pa.array(["a b a b rare a other rare"])], names=["id", "key", "held_out", "text"])
    lone = [r for b in lm._rare_pairs(model, shared, both=True)([batch]) for r in b.to_pylist()]
    one = [r for b in lm._rare_pairs(model, shared, both=False)([batch]) for r in b.to_pylist()]
    signed = {w: int(np.uint64(h).view(np.int64)) for w, h in hashes.items()}
    assert [(r["context"], r["word"], r["times"]) for r in lone] == [(signed["other"], signed["rare"], 1)]
    # b rare, a other, rare and the end; not rare a, which a list holds.
    end = sorted((r["key"], r["kind"]) for r in one)
    assert end == sorted([(signed["rare"], lm._OF_WORD), (signed["other"], lm._OF_WORD), (signed["rare"], lm._OF_CONTEXT)])


def test_pairs_travel_in_a_row_per_bucket():
    """Counting passes on as many rows as there are buckets, not one per pair; nothing is lost on the way."""
    texts = [t for _, t in pair_texts()]
    streams = [s for _, s, _ in lm.tokens(pa.array([" ".join(texts)]))]
    found, counts = np.unique(np.concatenate(streams), return_counts=True)
    lexicon = lm.Lexicon(found, counts, np.arange(len(found)), len(found))
    flags = pa.array([True] * len(texts))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), flags, flags], names=["text", "learned", "asked"])
    rows = [r for b in lm._count_pairs(lexicon, 4)([batch, batch]) for r in b.to_pylist()]
    assert sorted(r["bucket"] for r in rows) == [0, 1, 2, 3, 4]
    pairs = Counter()
    for text in texts:
        own = tokens(text)
        pairs.update(zip([None, *own[:-1]], own, strict=True))
    given = np.concatenate([np.frombuffer(r["count"], dtype=np.int64) for r in rows if r["bucket"] < 4])
    assert sorted((given % lm.ASKED).tolist()) == sorted(2 * n for n in pairs.values())
    assert (given > lm.ASKED).all()


def test_finder_agrees_with_a_search():
    draw = np.random.default_rng(4)
    for size in (0, 1, 7, 5_000):
        keys = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64))
        asked = np.concatenate([keys, draw.integers(0, 1 << 63, 1_000).astype(np.uint64), np.array([0, lm._END], dtype=np.uint64)])
        at = {k: n for n, k in enumerate(keys.tolist())}
        assert lm.Finder(keys).place(asked).tolist() == [at.get(k, -1) for k in asked.tolist()]
    shared = lm.Finder(keys)
    assert (shared.table == -2).any()  # slots of several keys are searched
