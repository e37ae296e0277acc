import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawatt.llm.queries import domains, held_out, op8_soft_mixing
from terrawatt.llm.soft_mixing import KEPT, LEAST_GAIN, MOST_COPIES, STEP_SIZES, fit_rates, mixed, posteriors

WORDS = {"x": "alpha beta gamma", "y": "delta epsilon zeta"}


def corpus(spark):
    own = lambda i: " ".join(f"u{i}n{k}" for k in range(15))
    rows = [(i, " ".join([own(i)] + [WORDS["x" if i % 12 else "y"]] * (1 + i % 5)), 0, 0) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, n_tokens int")
    labelled = spark.createDataFrame([(i, "x" if i % 12 else "y") for i in range(1200) if i % 5], "id long, domain string")
    return docs, labelled


def test_targets_are_met_and_rates_are_nonnegative(spark):
    docs, labelled = corpus(spark)
    rows = mixed(docs, labelled, {"x": 0.97, "y": 0.03}, "x").toPandas()
    assert len(rows) == 1200 and (rows.rate >= 0).all()
    x, y = ((rows.rate * rows.n_tokens * rows[c]).sum() for c in ("p_x", "p_y"))
    assert y / (x + y) == pytest.approx(0.03, abs=1e-6) and x == pytest.approx((rows.n_tokens * rows.p_x).sum(), rel=1e-6)
    assert (np.abs(rows.copies - rows.rate) < 1).all()
    assert (rows.p_x.round() == [float(bool(i % 12)) for i in rows.doc_id]).all()


def test_steps_like_numpy(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.5, 0.5, 0.5], 100)
    n = rng.integers(0, 50, 100)
    table = spark.createDataFrame([(int(a), *map(float, q)) for a, q in zip(n, p, strict=True)], "n_tokens long, p0 double, p1 double, p2 double")
    target, low, high = np.array([100.0, 900.0, 2000.0]), 0.2 * p[:, 0], 2.5
    rate, expected = fit_rates(table, target, F.col("p0") * 0.2, high, rounds=6)
    r = np.ones(100)
    sums = lambda r: ((r * n)[:, None] * p).sum(0)
    mass = np.maximum(sums(r), 1)
    loss = lambda r: ((sums(r) - target) ** 2 / mass).sum()
    for _ in range(6):
        inside = n * ((r > low) & (r < high))
        step = np.linalg.solve((p * inside[:, None]).T @ p + np.diag(1e-6 * mass), target - sums(r))
        better = [new for size in STEP_SIZES if loss(new := np.clip(r + size * p @ step, low, high)) < loss(r)]
        if not better:
            break
        small = loss(r) - loss(better[0]) < LEAST_GAIN * loss(r)
        r = better[0]
        if small:
            break
    got = np.array([x.r for x in table.select(rate.alias("r")).collect()])
    assert np.allclose(got, r, atol=1e-6) and np.allclose(expected, sums(r), rtol=1e-6)


def test_a_hundredth_keeps_its_clean_documents(spark):
    """Targets that the posteriors there cannot meet leave the corpus as it is, within the bounds."""
    rows = op8_soft_mixing(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    clean = rows.merge(labels[(labels.toxic == 0) & (labels.quality == 1)], on="doc_id")
    assert len(rows) == 1000 and len(clean) > 100
    assert (rows.rate <= MOST_COPIES + 1e-9).all() and (rows.rate >= KEPT * rows.p_clean - 1e-9).all()
    assert (clean.copies > 0).mean() > 0.75
    toxic = rows.merge(labels[labels.toxic == 1], on="doc_id")
    assert toxic.copies.mean() < 0.5 * clean.copies.mean()
    for d in ("clean", "low", "toxic"):
        assert (rows.rate * rows.n_tokens * rows[f"p_{d}"]).sum() == pytest.approx(rows[f"reached_{d}"][0], rel=1e-6)


def test_odd_rows_and_no_python(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "alpha beta"), (3, "alpha beta"), (None, "zeta"), (4, "w " * 30000)], "doc_id long, text string")
    _, labelled = corpus(spark)
    got = mixed(docs, labelled, {"x": 0.5, "y": 0.5}, "x")
    assert "Python" not in got._jdf.queryExecution().toString()
    rows = got.collect()
    assert sorted(((r.doc_id or 0), r.n_tokens) for r in rows) == [(0, 1), (1, 0), (2, 0), (3, 2), (3, 2), (4, 30000)]
    assert all(r.rate >= 0 and r.p_x + r.p_y == pytest.approx(1) for r in rows)
    none = mixed(docs, labelled.where("false"), {"x": 0.5, "y": 0.5}, "x")
    assert all(r.rate == 1.0 and r.copies == 1 for r in none.collect())
    assert mixed(docs.where("false"), labelled, {"x": 0.5, "y": 0.5}, "x").count() == 0
    assert posteriors(docs.selectExpr("doc_id AS id", "text"), labelled, ["x", "y"]).count() == 6


@pytest.mark.parametrize("share", [4, 2])
def test_few_labels_and_even_domains_separate(spark, share):
    rows = [(i, " ".join([f"u{i} v{i} w{i}"] + [WORDS["x" if i % share else "y"]] * (1 + i % 5))) for i in range(200)]
    docs = spark.createDataFrame(rows, "id long, text string")
    labelled = spark.createDataFrame([(i, "x" if i % share else "y") for i in range(0, 200, 3)], "id long, domain string")
    got = posteriors(docs, labelled, ["x", "y"]).collect()
    assert len(got) == 200 and all(abs(r.p0 - bool(r.id % share)) < 0.05 for r in got)


def test_held_out_labels_at_a_hundredth(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("cast(doc_id AS long) AS id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    unseen = labels.where(held_out()).selectExpr("cast(doc_id AS long) AS id", "toxic", "quality")
    p = posteriors(docs, domains(labels), ["clean", "low", "toxic"]).join(unseen, "id").toPandas()
    truth = np.where(p.toxic == 1, 2, np.where(p.quality == 0, 1, 0))
    q = p[["p0", "p1", "p2"]].to_numpy()
    # The shares of the domains as everybody's posterior have a loss of 0.87 here.
    assert -np.log(q[np.arange(len(q)), truth]).mean() < 0.6
    assert q[truth == 2, 2].mean() > 0.5 and q[truth != 2, 2].mean() < 0.1
    assert q[truth == 1, 1].mean() > 3 * q[truth == 0, 1].mean()


def test_labels_that_nothing_tells_apart_are_reported(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(20)], "id long, text string")
    labelled = spark.createDataFrame([(i, "xy"[i % 2]) for i in range(20)], "id long, domain string")
    with pytest.warns(UserWarning, match="tells the domains apart"):
        assert all(r.p0 == pytest.approx(0.5) for r in posteriors(docs, labelled, ["x", "y"]).collect())


def test_overlapping_domains_meet_their_targets(spark):
    rng = np.random.default_rng(1)
    first = rng.uniform(0.4, 0.6, 300)
    rows = [(int(n), float(a), float(1 - a)) for n, a in zip(rng.integers(1, 50, 300), first, strict=True)]
    table = spark.createDataFrame(rows, "n_tokens long, p0 double, p1 double")
    whole = sum(r[0] for r in rows)
    target = np.array([0.56, 0.44]) * whole
    rate, expected = fit_rates(table, target)
    got = table.select("*", rate.alias("r")).toPandas()
    assert (got.r >= 0).all() and np.allclose([(got.r * got.n_tokens * got[c]).sum() for c in ("p0", "p1")], target, rtol=1e-6)
    assert np.allclose(expected, target, rtol=1e-6)


def test_unreachable_targets_are_reported(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(20)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "xy"[i % 2]) for i in range(20)], "id long, domain string")
    with pytest.warns(UserWarning, match="targets are not met"):
        rows = mixed(docs, labelled, {"x": 0.9, "y": 0.1}, "x").collect()
    assert len(rows) == 20 and all(0.4 <= r.rate <= MOST_COPIES for r in rows)
    assert all((r.wanted_x, r.wanted_y) == (pytest.approx(20), pytest.approx(20 / 9)) and r.reached_y > 5 for r in rows)


def test_rows_without_an_id_or_with_the_same_are_documents_of_their_own(spark):
    docs, labelled = corpus(spark)
    twin = docs.where("doc_id < 60").select(F.lit(None).cast("long").alias("doc_id"), "text", (F.col("doc_id") + 10_000).alias("key"))
    same = twin.select(F.lit(5000).cast("long").alias("doc_id"), "text", (F.col("key") + 10_000).alias("key"))
    rows = docs.select("doc_id", "text", F.col("doc_id").alias("key")).unionByName(twin).unionByName(same)
    got = mixed(rows, labelled, {"x": 0.9, "y": 0.1}, "x", key_col="key").collect()
    assert sorted(r.key for r in got) == [*range(1200), *range(10_000, 10_060), *range(20_000, 20_060)]
    assert all((r.p_x > 0.5) == bool(r.key % 10_000 % 12) for r in got) and len({r.copies for r in got if r.doc_id is None}) > 1
