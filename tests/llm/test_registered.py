import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from salesops.llm import decontamination, queries, quality, toxicity
from salesops.session import materialize
from tests.llm.conftest import SMALL
from tests.llm.test_jaccard import brute
from tests.llm.test_tokens import checked

GIVEN = "/root/testdata/sf0.01"


def test_all_are_registered():
    names = [*queries.QUERIES]
    assert [int(n[2:].split("_")[0]) for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert {*names, "pipeline"} <= {*__spark_entry__.queries()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    with duckdb.connect() as db:
        for table in ("documents", "conversations"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
        columns = ", ".join(found.columns)
        want = db.execute(f"SELECT {columns} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_stages(spark):
    """Each stage against a plain version of its decision on the same input."""
    labels, items = (spark.read.parquet(f"{GIVEN}/{t}.parquet") for t in ("labels", "benchmark"))
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, GIVEN))
        texts = {r.doc_id: r.text for r in before.collect()}
        if name == "packing":
            assert checked(docs.collect(), [*texts.items()], corpus_pipeline.CAPACITY) < 0.02
            continue
        assert docs.columns == columns
        kept = {r.doc_id for r in docs.collect()}
        if name == "toxicity":
            assert kept == {r.doc_id for r in toxicity.classify(before, labels).where("toxic = 0").collect()}
        elif name == "quality":
            assert kept == {r.doc_id for r in quality.classify(before, labels).where("predicted = 1").collect()}
        elif name == "near_duplicates":
            assert kept == {min(m) for m in brute([*texts.items()])[1].values()}
        else:
            finder = decontamination.Finder([(r.item_id, decontamination.normalised(r.text)) for r in items.collect()], 0.1)
            assert kept == {k for k, t in texts.items() if not [*finder.matches(t)]}
            whole = [decontamination.normalised(r.text) for r in items.collect()]
            assert not any(i in decontamination.normalised(texts[k]) for k in kept for i in whole)
            assert len(kept) < len(texts)


def test_stages_with_odd_rows(spark, odd, none):
    """Null and repeated ids, empty and long texts, clashing columns: rows are kept as they are or go; no rows give no rows."""
    docs, nothing = odd, none
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs, nothing = materialize(stage(spark, docs, SMALL)), materialize(stage(spark, nothing, SMALL))
        assert nothing.count() == 0
        after = [tuple(r) for r in docs.collect()]
        if name == "packing":
            assert {(r.doc_id, r.doc_tokens) for r in docs.collect() if r.start == 0 and r.doc_tokens == 1} <= {(r[0], 1) for r in before}
            assert sum(r.start == 0 for r in docs.collect()) == len(before)
            continue
        assert docs.columns == odd.columns
        left = list(before)
        for row in after:
            left.remove(row)
        if name == "near_duplicates":
            texts = [r[1] for r in after]
            assert texts.count("The same text, twice over, again.") == min([r[1] for r in before].count("The same text, twice over, again."), 1)
            assert sum(not (t or "").split() for t in texts) == sum(not (r[1] or "").split() for r in before)
