import numpy as np
import pyarrow as pa

from terrawatt.llm.pu_quality import features, fit_non_negative, prior_from_histograms, risk_gradient, risk_parts, score_quality
from terrawatt.llm.queries import op4_pu_quality
from tests.harness import SF_DIR


def test_held_out_accuracy(spark):
    sf = SF_DIR.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op4_pu_quality(spark, sf).join(labels, "doc_id").where("held_out").collect()
    good = np.mean([r.predicted for r in rows if r.quality == 1])
    bad = np.mean([r.predicted for r in rows if r.quality == 0])
    assert good > 0.85 and bad < 0.1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_prior_and_risk_on_two_clouds():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, (3000, 1))
    unlabelled = np.vstack([rng.normal(2, 1, (2100, 1)), rng.normal(-2, 1, (900, 1))])
    bins = np.linspace(-6, 6, 101)
    prior = prior_from_histograms(np.histogram(positive, bins)[0], np.histogram(unlabelled, bins)[0])
    assert 0.6 < prior < 0.8
    model = fit_non_negative(positive, unlabelled, prior)
    assert model.logit(np.array([[2.0]]))[0] > 1 and model.logit(np.array([[-2.0]]))[0] < -1


def test_features_do_not_depend_on_the_batch():
    texts = ["a b c\nd", None, "", "ÄÖ ## !!", "x" * 1000]
    whole = features(pa.array(texts, pa.string()))
    assert np.array_equal(whole, np.vstack([features(pa.array([t], pa.string())) for t in texts]))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "some words here", 5), (3, "some words here", 5), (None, "x", 5)], "doc_id long, text string, x int")
    nothing = spark.createDataFrame([], "doc_id long")
    assert [r.score for r in score_quality(docs, nothing).collect()] == [1.0] * 5
    some = spark.createDataFrame([(3,), (None,), (99,)], "doc_id long")
    assert len(score_quality(docs, some).collect()) == 5
    assert sorted(r.x for r in score_quality(docs.withColumn("x", docs.x.cast("long")), some, key_col="x").collect()) == [5] * 5
    assert score_quality(docs.where("false"), some).count() == 0


def test_risk_and_gradient_like_brute_force():
    """Both parts of the risk row by row, and the gradient by differences, on either side of zero."""
    rng = np.random.default_rng(1)
    p, u = rng.normal(1, 1, (30, 3)), rng.normal(0, 0.2, (40, 3))
    loss = lambda z: np.log(1 + np.exp(-z))
    sides = set()
    for w, prior in zip(rng.normal(0, 2, (40, 3)), [0.4, 0.95] * 20, strict=True):
        good, bad = risk_parts(w, p, u, prior)
        assert np.isclose(good, prior * sum(loss(x @ w) for x in p) / 30)
        assert np.isclose(bad, sum(loss(-(x @ w)) for x in u) / 40 - prior * sum(loss(-(x @ w)) for x in p) / 30)
        part = (lambda v: sum(risk_parts(v, p, u, prior))) if bad >= 0 else (lambda v: -risk_parts(v, p, u, prior)[1])
        slopes = [(part(w + e) - part(w - e)) / 2e-6 for e in np.eye(3) * 1e-6]
        assert np.allclose(risk_gradient(w, p, u, prior), slopes, atol=1e-6)
        sides.add(bool(bad >= 0))
    assert sides == {True, False}


def test_ties_at_the_limit_and_long_texts(spark):
    """Equal texts have equal scores, and one at the limit counts as good; a long text is scored whole."""
    rows = [(i, ("fine words in a row. " if i % 2 else "x| # $$ ") * 40) for i in range(200)] + [(900, "fine words in a row. " * 40), (901, "fine words in a row. " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_quality(docs, docs.where("doc_id % 4 = 1 AND doc_id < 200").select("doc_id")).collect()}
    assert got[900] == got[1] == got[199] > got[0] and 0 <= got[901] <= 1
