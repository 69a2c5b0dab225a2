import numpy as np
import pyarrow as pa
import pytest

from salesops.llm import quality, queries, toxicity
from tests.llm.conftest import ODD

GIVEN = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return tuple(spark.read.parquet(f"{GIVEN}/{t}.parquet") for t in ("documents", "labels"))


def test_chain_learns_toxic_words(spark):
    draw = np.random.default_rng(5)
    rows, labels = [], []
    for k in range(1200):
        words = [f"w{x}" for x in draw.integers(0, 400, 60)]
        toxic = k % 6 == 0
        for _ in range(int(draw.integers(1, 6)) if toxic else 0):
            words.insert(int(draw.integers(0, 60)), f"Nasty{draw.integers(0, 4)},")
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, toxic int")
    known = known.union(spark.createDataFrame([(k, t) for k, t in labels if k % 4 == 0], "doc_id long, toxic int"))
    found = {r.doc_id: r for r in toxicity.classify(frame, known).collect()}
    assert [found[k].toxic for k, _ in labels] == [t for _, t in labels]
    assert all(0 <= r.p_frequent <= 1 and 0 <= r.p_repeated <= 1 for r in found.values())
    long = spark.createDataFrame([(1, "w1 " * 20_000 + "nasty3"), (2, "w1 w2 " * 20_000)], "doc_id long, text string")
    chain = toxicity.fit(frame, known)
    assert [r[1] > 0.5 for r in sorted(toxicity.score(long, chain, ["a", "b", "c"]).select("doc_id", "c").collect())] == [True, False]


def test_later_models_learn_from_unseen_probabilities(monkeypatch):
    """Of a label that features only repeat by chance, the in-sample fit is better than the out-of-fold one."""
    draw = np.random.default_rng(6)
    rows, width = 300, 400
    text = np.repeat(np.arange(rows), 5)
    place = draw.integers(0, width, len(text))
    labels = draw.integers(0, 2, (rows, 2)).astype(float)
    seen = []
    fit = toxicity._logistic
    monkeypatch.setattr(toxicity, "_logistic", lambda *a, **b: seen.append(a[4]) or fit(*a, **b))
    chain = toxicity.fit_chain(np.arange(width, dtype=np.uint64), text, place, np.ones(len(text)), labels, np.arange(rows) % 3)
    earlier = seen[-1][:, 0]
    own = chain.predict(rows, text, place, np.ones(len(text)))[:, 0]
    accuracy = [((p > 0.5) == labels[:, 0]).mean() for p in (earlier, own)]
    assert accuracy[0] < 0.6 < 0.8 < accuracy[1]


def test_toxicity_held_out(given):
    documents, labels = given
    rows = toxicity.classify(documents, labels.where("doc_id % 3 <> 0")).join(
        labels.withColumnRenamed("toxic", "given"), "doc_id"
    )
    (caught, wrong) = rows.where("doc_id % 3 = 0").selectExpr("avg(if(given = 1, toxic, null))", "avg(if(given = 0, toxic, null))").first()
    assert caught > 0.6 and wrong < 0.02  # some toxic words occur in one labelled document only


def test_odd_rows(spark, odd, none, given):
    labels = spark.createDataFrame(
        [(5, 1, 1), (6, 0, 0), (4, None, None), (None, 1, 1), (99, 1, 0), (5, 0, 1), (7, 1, 5)], "doc_id long, quality int, toxic int"
    )
    for found, column in ((toxicity.classify(odd, labels), "p_toxic"), (quality.classify(odd, labels), "score")):
        rows = found.collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(k) for k, _ in ODD)
        assert all(0 <= r[column] <= 1 for r in rows)
    assert {r.p_toxic for r in toxicity.classify(odd, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert toxicity.classify(none, labels).count() == 0 == quality.classify(none, labels).count()
    for kept in (toxicity.without_toxic(odd, labels), quality.without_poor(odd, given[1])):
        assert kept.columns == odd.columns and kept.count() <= len(ODD)


def test_quality_held_out(given):
    documents, labels = given
    rows = quality.classify(documents, labels).join(labels, "doc_id").where("held_out")
    right, kept = rows.selectExpr("avg(cast(predicted = quality as int))", "avg(if(quality = 1, predicted, null))").first()
    assert right > 0.97 and kept > 0.97


def test_density_is_the_shrunken_gaussian(spark):
    draw = np.random.default_rng(8)
    side = len(quality.STATISTICS)
    rows = [(k % 2, (draw.normal(size=side) * (1 + k % 2) + (k % 2)).tolist()) for k in range(400)]
    model = quality.fit(spark.createDataFrame(rows, "label long, statistics array<double>"))
    data = np.array([r[1] for r in rows])
    label = np.array([r[0] for r in rows])
    scaled = (data - data.mean(axis=0)) / data.std(axis=0)
    own = [np.cov(scaled[label == k].T, bias=True) for k in (0, 1)]
    pooled = (own[0] + own[1]) / 2
    density = []
    for k in (0, 1):
        mixed = (1 - quality.TOWARDS_POOLED) * own[k] + quality.TOWARDS_POOLED * pooled
        mixed = (1 - quality.TOWARDS_SPHERE) * mixed + quality.TOWARDS_SPHERE * np.trace(mixed) / side * np.eye(side)
        away = scaled - scaled[label == k].mean(axis=0)
        density.append(-0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(mixed), away) + np.linalg.slogdet(mixed)[1]))
    assert np.allclose(model.score(data), 1 / (1 + np.exp(density[0] - density[1])), atol=1e-8)


def test_op1_passes_small_batches(spark, tmp_path, monkeypatch):
    """Rows of a batch are seen as the probability; a table of one file was one batch before."""
    spark.range(5_000).selectExpr("id AS doc_id", "concat('some words of ', id) AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def sizes(chain, categories):
        def run(batches):
            for batch in batches:
                seen = pa.array([float(batch.num_rows)] * batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column(0), *[seen] * categories], names=["key", *[f"p{k}" for k in range(categories)]])

        return run

    monkeypatch.setattr(toxicity, "_score", sizes)
    kept = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {k: spark.conf.get(k) for k in kept}
    for k in kept:
        spark.conf.unset(k)
    try:
        found = queries.op1_toxicity(spark, str(tmp_path))
        most, rows = found.selectExpr("max(p_toxic)", "count(*)").first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert most <= 1024 and rows == 5_000


def test_sample_comes_as_columns(given, monkeypatch):
    """The features to learn from reach the driver as Arrow columns, never as Python rows of lists."""
    fitted, (documents, labels) = [], given
    monkeypatch.setattr(type(documents), "toPandas", lambda self: pytest.fail("rows of lists"))
    monkeypatch.setattr(toxicity, "fit_chain", lambda *a: fitted.append(a))
    toxicity.fit(documents, labels)
    hashes, text, place, value, marks, folds = fitted[0]
    drawn = toxicity._sample(documents, labels, "toxic", "doc_id", "text").orderBy("drawn").collect()
    assert len(drawn) == len(marks) == len(folds) and [r.label for r in drawn] == marks[:, -1].tolist()
    for k in range(0, len(drawn), 97):
        (piece,) = toxicity.pieces(toxicity._lowered(pa.array([drawn[k].text])))
        _, places, values = toxicity.Chain(hashes, [], [], []).lookup(*toxicity.features(piece))
        assert place[text == k].tolist() == places.tolist() and value[text == k].tolist() == values.tolist()
