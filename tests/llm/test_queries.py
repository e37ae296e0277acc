"""The registered queries against their SQL, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from terrawatt.llm.queries import ORACLE_SQL, QUERIES
from tests.harness import SF_DIR, compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck(), ORACLE_SQL[name]) is None


def test_all_are_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


def test_stages_keep_the_columns_and_the_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = docs.columns
    extra = docs.select("*", F.lit(1).alias("score"), F.lit("x").alias("lang_pred"), F.lit(2).alias("gone_id"), F.lit(3).alias("mixed_id"), F.lit(4).alias("copy"))
    odd = extra.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), *extra.columns[2:])
    rows = extra.unionByName(odd).unionByName(extra.where("doc_id < 5"))
    for (name, stage), n in zip(corpus_pipeline.STAGES[:4], (9, 4, 10, 8), strict=True):
        kept = stage(spark, rows, SF_DIR)
        assert kept.columns == extra.columns
        ids = [r.doc_id for r in kept.collect()]
        assert 0 < len(ids) <= 230, name
        if n == 10:
            assert len(ids) == len(set(ids))
        assert stage(spark, rows.where("false"), SF_DIR).count() == 0
    assert first == docs.columns and [n for n, _ in corpus_pipeline.STAGES][-1] == "byte-level BPE"


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < got.count() <= 220


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_rows_of_one_id_or_none_are_decided_by_their_own_text(spark):
    """Two texts under one id both stay; copies without an id go; a bad text takes no other row with it."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1 AND toxic = 0")
    good = [r.text for r in docs.join(labels, "doc_id").where("length(text) > 600 AND lang = 'en'").orderBy("doc_id").limit(3).collect()]
    rows = [(1, good[0]), (1, good[1]), (None, good[0]), (None, good[0]), (2, good[1]), (None, good[2])]
    odd = spark.createDataFrame([(i, t, "en", "s", len(t), 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row_key int")
    kept = corpus_pipeline.near_dedup(spark, odd, SF_DIR)
    assert kept.columns == odd.columns and pairs(kept) == sorted([(1, good[0]), (1, good[1]), (None, good[2])], key=str)
    bad = "| # $$ | ## || $ # |\n" * 60
    both = docs.unionByName(spark.createDataFrame([(5000, good[0], "en", "s", 1), (5000, bad, "en", "s", 1), (None, good[1], "en", "s", 1), (None, bad, "en", "s", 1)], docs.schema))
    left = pairs(corpus_pipeline.quality(spark, both, SF_DIR).where("doc_id IS NULL OR doc_id = 5000"))
    assert left == sorted([(5000, good[0]), (None, good[1])], key=str)


def test_stages_keep_clean_documents_and_drop_what_they_should(spark):
    """Kept ids against labels and texts: letters for the language, quality labels, one of each equal text."""
    sf = SF_DIR.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = {k for k, r in labels.items() if r.quality == 1 and r.toxic == 0}
    low = {k for k, r in labels.items() if r.quality == 0}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    first = corpus_pipeline.language(spark, docs, sf)
    assert len(ids(first) & clean) > 0.98 * len(clean)
    second = ids(corpus_pipeline.quality(spark, docs, sf))
    assert len(second & clean) > 0.85 * len(clean) and len(second & low) < 0.15 * len(low)
    third = ids(corpus_pipeline.near_dedup(spark, docs, sf))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len({texts[k] for k in third}) == len(third) and {min(k for k, t in texts.items() if t == texts[x]) for x in third} == third
    fourth = ids(corpus_pipeline.mixing(spark, docs, sf))
    assert len(fourth & clean) > 0.75 * len(clean)
