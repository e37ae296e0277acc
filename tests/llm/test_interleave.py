import zlib
from collections import Counter

from terrawatt.llm.interleave import interleaved_shards
from terrawatt.llm.ranking import ranked_by_sort


def test_sizes_slots_and_mixture(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = interleaved_shards(docs, 9).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 2000 and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(9))
    for s in range(9):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    source = {i: s for i, _, s in rows}
    whole = Counter(source.values())
    for s in range(9):
        mine = Counter(source[r.doc_id] for r in got if r.shard == s)
        assert all(abs(mine[k] - n / 9) <= 1.5 for k, n in whole.items())
    again = {r.doc_id: (r.shard, r.slot) for r in interleaved_shards(docs.repartition(3), 9).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}


def test_odd_rows(spark):
    rows = [(1, None, None, 9), (2, "", "a", 9), (3, "é漢", "a", 9), (3, "é漢", "a", 9), (None, "x", None, 9), (4, "long " * 50000, "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    got = interleaved_shards(docs, 4).collect()
    assert len(got) == 6 and all(r.law == "rows" and r.grown_shard is None for r in got)
    for r in got:
        text = next((t or "" for i, t, _, _ in rows if i == r.doc_id)).encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes.values()) == [1, 1, 2, 2]
    assert interleaved_shards(docs.where("false"), 4).collect() == []


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    assert "Python" not in interleaved_shards(docs, 4)._jdf.queryExecution().toString()


def test_rank_by_sort_in_hot_groups(spark):
    rows = [("a" if i % 3 else None, i * 7 % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, o long, tie long").repartition(5)
    got = {(r.k, r.o): r.rank for r in ranked_by_sort(df, "k", ["o", "tie"], "rank").collect()}
    for key in ("a", None):
        order = sorted(o for k, o, _ in rows if k == key)
        assert [got[key, o] for o in order] == list(range(len(order)))
