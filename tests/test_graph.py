"""Degrees, components, formulas."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrawatt.operators import formula as fm
from terrawatt.operators import graph as gr


@pytest.fixture(scope="module")
def sample(spark):
    vertices = [("A", 1.0, "Subscriber", {"k": "v"}), ("B", 2.0, "Building", {})]
    return gr.graph_to_dataframes(spark, vertices, [("A", "B", 1.0, "ConnectedTo", {})])


def value(f, v, e):
    return fm.evaluate(f, v, e).first().value


def test_degree_isolated_and_loop(spark):
    v = spark.createDataFrame([("A",), ("B",), ("C",)], "id string")
    e = spark.createDataFrame([("A", "B"), ("A", "A")], "src string, dst string")
    assert {r.id: r.degree for r in gr.graph_degree(v, e).collect()} == {"A": 2, "B": 1, "C": 0}


def test_sample_graph_models(sample):
    v, e = sample
    assert {r.id: r.degree for r in gr.graph_degree(v, e).collect()} == {"A": 1, "B": 1}
    assert value(fm.avg_edges(1.0) * fm.max_vertices(1.0), v, e) == 1.0
    assert value(fm.model_risk(), v, e) == 2.0
    assert value(fm.model_influence(), v, e) == 1.0


def test_empty_edges_average_zero(sample):
    v, e = sample
    assert value(fm.avg_edges(fm.EdgeField("weight")), v, e.limit(0)) == 0.0


def test_every_node_type(sample):
    v, e = sample
    c = fm.Const
    total = fm.sum_vertices(fm.VertexField("value"))
    assert value(total + 1, v, e) == 4.0 and value(total - 1, v, e) == 2.0
    assert value(total / 2, v, e) == 1.5 and value(1 / total * 3, v, e) == 1.0
    assert value(fm.log(c(1.0)), v, e) == 0.0 and value(fm.normalize(total), v, e) == 1.0
    assert [value(f, v, e) for f in (total > 3, total < 3, total >= 3, total <= 3, total.eq(3), total.ne(3))] == [0, 0, 1, 1, 1, 0]
    assert value(fm.If(c(0), c(1), c(2)), v, e) == 2.0 and value(fm.If(c(0.1), c(1), c(2)), v, e) == 1.0
    assert value(fm.avg_vertices(fm.VertexField("value") * 2), v, e) == 3.0


def test_literals():
    assert fm.formula_literal_eval((fm.Const(2) + 3) * 4 / 2) == 10.0
    with pytest.raises(ValueError):
        fm.formula_literal_eval(fm.VertexField("value"))


def test_field_needs_context(sample):
    with pytest.raises(ValueError):
        fm.evaluate(fm.VertexField("value"), *sample)
    with pytest.raises(ValueError):
        fm.evaluate(fm.sum_edges(fm.VertexField("value")), *sample)


def test_components_chain_and_star(spark):
    v = spark.range(60).select(F.col("id"))
    chain = spark.range(19).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    star = spark.range(21, 50).select(F.lit(20).cast("long").alias("src"), F.col("id").alias("dst"))
    got = {r.id: r.component for r in gr.connected_components(v, chain.union(star)).collect()}
    assert {got[i] for i in range(20)} == {0} and {got[i] for i in range(20, 50)} == {20} and got[55] == 55


def test_k_hop_estimate_near_exact(spark):
    v = spark.range(30).select(F.col("id"))
    e = spark.range(29).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = {r.id: r.reachability_score * 29 for r in gr.graph_metrics(v, e, k=3).collect()}
    assert abs(got[0] - 3) < 0.1 and abs(got[15] - 6) < 0.1


def test_k_hop_sketches_meet_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(gr, "BLOCK_SKETCHES", 4)
    monkeypatch.setattr(gr, "PASS_BLOCKS", 3)
    v = spark.range(40).select(F.col("id")).union(spark.sql("SELECT CAST(NULL AS BIGINT)")).union(spark.range(1))
    hub = spark.range(1, 30).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    e = hub.union(hub).union(spark.createDataFrame([(29, 30), (30, 31), (5, 5), (3, 99), (None, 7)], "src long, dst long"))
    got = {r.id: r.reachability_score * 41 for r in gr.graph_metrics(v, e, k=2).collect()}
    want = {0: 30, 29: 31, 30: 3, 31: 2, 5: 29, 3: 29, 35: 0}  # 99 is no vertex and not counted
    assert len(got) == 40 and all(abs(got[i] - n) < 0.1 for i, n in want.items())


def test_k_hops_send_one_sketch_to_a_block(spark, monkeypatch):
    """What is joined grows with vertices and blocks, not with the links."""
    sent = []
    write = gr.Stored.write
    monkeypatch.setattr(gr.Stored, "write", lambda self, df, name, *a, **k: sent.append((name, df)) or write(self, df, name, *a, **k))
    left, right = spark.range(60), spark.range(100, 160)
    e = left.select(F.col("id").alias("src")).crossJoin(right.select(F.col("id").alias("dst")))
    gr.graph_metrics(left.union(right), e, k=1).collect()
    (merged,) = [df for name, df in sent if name == "hop1"]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # No exchange after the links have met the sketches: both sides were dealt by block before.
    assert "hll_union_agg" in plan and "Exchange" not in plan[: plan.index("Join")]


def test_components_shrink_at_once(spark, monkeypatch):
    """After the first round few links are left, in whatever order ids are; the rounds of a long path stay few."""
    rows = {}
    write = gr.Stored.write

    def counted(self, df, name, *a, **k):
        out = write(self, df, name, *a, **k)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(gr.Stored, "write", counted)
    v = spark.range(4000).select(F.format_string("v%05d", "id").alias("id"))
    e = spark.range(60000).select(F.pmod(F.xxhash64("id"), F.lit(2000)).alias("a"), (2000 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2000))).alias("b"))
    e = e.select(F.format_string("v%05d", "a").alias("src"), F.format_string("v%05d", "b").alias("dst"))
    found = gr.connected_components(v, e).groupBy("component").count().collect()
    assert max(found, key=lambda r: r["count"])["count"] > 3900 and rows["links1"] < rows["links0"] / 2 and "parents5" not in rows
    rows.clear()
    path = spark.range(2000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert gr.connected_components(spark.range(2001), path).where("component <> 0").isEmpty() and len(rows) < 60


def hops(v, e, k, **more):
    others = v.count() - 1
    return {r.id: round(r.reachability_score * others) + 1 for r in gr.graph_metrics(v, e, k=k, **more).collect()}


def test_k_hops_do_not_follow_the_order_of_links(spark):
    """Estimates follow from who is reached, not from which sketch came first."""
    v = spark.range(900)
    e = spark.range(27000).select((F.col("id") % 300).alias("src"), (300 + F.pmod(F.xxhash64("id"), F.lit(600))).alias("dst"))
    found = [hops(v, e.repartition(n, "dst").orderBy(F.xxhash64("src", "dst", F.lit(n))).repartition(n, "src"), 2) for n in (2, 3, 5)]
    assert found[0] == found[1] == found[2] and all(abs(n / 644 - 1) < 0.07 for i, n in found[0].items() if i >= 300)


@pytest.mark.parametrize("lg", [4, 7, 9, 12])
def test_k_hop_estimates_equal_those_of_united_sketches(spark, lg):
    half = F.col("id") % 2
    e = spark.range(700).select((F.col("id") * 2).alias("src")).crossJoin(spark.range(3).select((F.col("id") * 2 + 1).alias("dst")))
    e = e.union(spark.range(700).select((F.col("id") * 2 + 1).alias("src")).crossJoin(spark.range(3).select((F.col("id") * 2).alias("dst"))))
    sketches = spark.range(1400).groupBy(half).agg(F.hll_sketch_agg("id", lg).alias("s"))
    want = sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("s"))).scalar()
    assert {n for i, n in hops(spark.range(1400), e, 3, lg_config=lg).items()} == {spark.range(1).select(want).first()[0]}


def test_crowded_blocks_are_shared_out(spark, monkeypatch):
    """A hub's links go to several tasks and its parts are united."""
    v, hub = spark.range(2001), spark.range(1, 2001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    e = hub.union(hub.select("dst", "src")).union(spark.createDataFrame([(1, 2), (2, 2)], "src long, dst long"))
    whole = hops(v, e, 2)
    dealt, gather = [], gr.reach.gather
    monkeypatch.setattr(gr.reach, "gather", lambda pieces: dealt.append(pieces) or gather(pieces))
    monkeypatch.setattr(gr, "BLOCK_LINKS", 800)
    monkeypatch.setattr(gr, "PASS_BLOCKS", 3)
    shared = hops(v, e, 2)
    assert dealt[0].share.max() > 2 and len(shared) == 2001 and all(abs(n / 2001 - 1) < 0.06 and abs(n / whole[i] - 1) < 0.04 for i, n in shared.items())
    assert all(abs(n - (2 if i > 2 else 3)) <= 0 for i, n in hops(v, e, 1).items() if i)


def test_k_hops_of_words_strangers_and_odd_rows(spark):
    v = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",), ("",)], "id string")
    e = spark.createDataFrame([("a", "x"), ("x", "b"), ("b", "b"), (None, "a"), ("c", None), ("", "c"), ("y", "z")], "src string, dst string")
    for k, want in ((0, (1, 1, 1, 0)), (1, (1, 1, 1, 1)), (2, (2, 2, 1, 1)), (3, (2, 2, 1, 1))):  # an empty word leaves no mark in a sketch
        assert hops(v, e, k) == dict(zip("abc", want)) | {"": want[3]}
    assert hops(v.limit(0).union(v.limit(0)), e.limit(0), 2) == {}


def test_sketches_go_to_a_piece_in_one_row():
    """What a task sends to a piece is one row, however many sketches it holds."""
    n = 20_000
    listed = np.zeros((n, 12), np.uint8)
    listed[:, :8] = [2, 1, 7, 12, 3, 8, 1, 8]
    listed[:, 8:] = (np.arange(n, dtype="<u4") | 1 << 26).view(np.uint8).reshape(n, 4)
    to = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * n + 1, 2), pa.int32()), pa.array(np.tile([3, 5], n).astype(np.int32)))
    rows = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), gr.reach._binaries(listed, np.full(n, 12)), to], ["key", "s", "targets"])
    sent = [*gr.reach.send(4, 9, 12)(iter([rows.slice(0, 7000), rows.slice(7000)]))]
    assert [x.column("piece").to_pylist() for x in sent] == [[5]] and sent[0].nbytes < 21 * n


def test_registers_are_packed_whole():
    some = np.random.default_rng(3)
    for share in (0, 0.01, 0.2, 1):
        rows = (some.random((50, 256)) < share) * some.integers(1, 63, (50, 256), np.uint8)
        rows[7] = 0
        assert np.array_equal(gr.reach.unpacked_registers(*gr.reach.packed_registers(rows.astype(np.uint8)), 256), rows)
