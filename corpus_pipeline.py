"""From raw documents to token digests: the stages of the training-corpus pipeline.

Every stage takes what its predecessor kept, with the columns of `documents`, and its decisions
take effect: rejected documents go, one document of each near-duplicate group stays, documents are
thinned or repeated by their fitted rates. The last stage returns token counts and digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawatt.llm.bpe import bpe_digest
from terrawatt.llm.dart_minhash import near_duplicates
from terrawatt.llm.langid import identify
from terrawatt.llm.pu_quality import score_quality
from terrawatt.llm.queries import RANKS, domains, language_training, table, trusted_positives
from terrawatt.llm.scratch import Scratch
from terrawatt.llm.soft_mixing import mixed

#: A language is accepted at this posterior; `und` never is.
LEAST_LANGUAGE = 0.35
#: A document is rejected below this quality.
LEAST_QUALITY = 0.7
#: Wanted shares of tokens. Low documents are gone by then, so they have no share.
MIXTURE = {"clean": 0.99, "toxic": 0.01}


def columns(docs: DataFrame) -> list[Column]:
    return [docs[f"`{c}`"] for c in docs.columns]


def keyed(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """(stored rows with a key of their own, its name): decisions go by rows, since ids may repeat or be null."""
    name = "row_key"
    while name in docs.columns:
        name += "_"
    return Scratch(docs.sparkSession, label).keep(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def without(rows: DataFrame, gone: DataFrame, key: str, label: str) -> DataFrame:
    """The rows whose key is not in `gone`; these keys are written first, so that Spark knows their size when it picks the join."""
    keys = Scratch(rows.sparkSession, label).keep(gone.select(key), "gone")
    return rows.join(keys, key, "left_anti").drop(key)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and those whose language stays open."""
    found = identify(docs.select(F.struct(*columns(docs)).alias("row"), "text"), language_training(docs), RANKS)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)).select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of low quality."""
    rows, key = keyed(docs, "quality")
    scored = score_quality(rows, trusted_positives(table(spark, sf_dir, "labels")), key_col=key)
    return without(rows, scored.where(F.col("score") < LEAST_QUALITY), key, "quality")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: that of the smallest id."""
    rows, key = keyed(docs, "near-dedup")
    return without(rows, near_duplicates(rows, key_col=key).where(~F.col("kept")), key, "near-dedup")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says, rounded by a hash of its id and text."""
    rows, key = keyed(docs, "mixing")
    rates = mixed(rows, domains(table(spark, sf_dir, "labels")), MIXTURE, "clean", key_col=key).select(F.col(key).alias("mixed_key"), F.col("copies").alias("mixed_copies"))
    # Most rows are kept once; the others' rates are written first, so that Spark knows their size when it picks the join.
    other = Scratch(spark, "mixing").keep(rates.where("mixed_copies <> 1"), "copies")
    kept = rows.join(other, rows[key] == other["mixed_key"], "left")
    copies = F.explode(F.array_repeat(F.lit(0), F.coalesce(other["mixed_copies"], F.lit(1)))).alias("copy")
    return kept.select(F.struct(*columns(rows.drop(key))).alias("row"), copies).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe_digest(docs, RANKS)


STAGES = [
    ("language ID", language),
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("mixing", mixing),
    ("byte-level BPE", encode),
]

#: Learned stages and BPE merges have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
