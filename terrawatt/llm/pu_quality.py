"""Quality classifier from positives and unlabelled text only.

The trusted positives are rows labelled good; labels of bad rows are never used. The classifier
minimises the non-negative unbiased risk of positive-unlabelled learning, whose class prior is
estimated from how the scores of all documents and of all positives are distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.rule_ledger import measure
from terrawatt.llm.scratch import Scratch
from terrawatt.llm.textcore import buffers, mix, slices

#: Expected rows of each of the two training samples (documented bound of the fit).
TRAIN_ROWS = 8192
#: Buckets of the hashed frequencies of adjacent byte pairs.
PAIR_BUCKETS = 32
_BINS = 200


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text: ratios of the rule measurements in two scales, and byte-pair frequencies."""
    m = {k: v.astype(float) for k, v in measure(texts).items()}
    words, lines, letters = (np.maximum(m[k], 1.0) for k in ("n_words", "n_lines", "n_letters"))
    ratios = np.stack(
        [m["n_symbols"] / words, m["n_dup_lines"] / lines, m["n_repeat_words"] / words, m["n_alpha_words"] / words, m["n_upper"] / letters, m["n_table_marks"] / words, m["n_twin_words"] / words], 1
    )
    plain = np.stack([np.log1p(m["n_words"]), m["word_chars"] / words, np.log1p(lines / words * 100), m["n_words"] > 0], 1)
    data, offsets = buffers(texts)
    n = len(offsets) - 1
    pairs = np.zeros((n, PAIR_BUCKETS))
    if len(data) > 1:
        table = (mix(np.arange(65536, dtype=np.uint64)) % np.uint64(PAIR_BUCKETS)).astype(np.int64)
        bucket = table[data[:-1].astype(np.int64) * 256 + data[1:]]
        doc = np.repeat(np.arange(n), np.diff(offsets))[:-1]
        inside = np.ones(len(bucket), bool)
        ends = offsets[1:-1]
        inside[ends[(ends > 0) & (ends < len(data))] - 1] = False
        pairs = np.bincount((doc * PAIR_BUCKETS + bucket)[inside], minlength=n * PAIR_BUCKETS).reshape(n, PAIR_BUCKETS)
    freq = pairs / np.maximum(pairs.sum(1, keepdims=True), 1.0)
    return np.hstack([plain, ratios, np.minimum(ratios * 10, 1.0), np.sqrt(freq)]).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


class Linear:
    """A standardised linear score; `fit` minimises a risk given by its gradient with Adam steps."""

    def __init__(self, x: np.ndarray):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.w = np.zeros(x.shape[1] + 1)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.rows(x) @ self.w

    def fit(self, gradient, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> Linear:
        m, v = np.zeros_like(self.w), np.zeros_like(self.w)
        for t in range(1, steps + 1):
            g = gradient(self.w) + decay * self.w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return self


def contrast(positives: np.ndarray, unlabelled: np.ndarray) -> Linear:
    """Positives against unlabelled rows by logistic regression: only ranks rows, for the prior."""
    model = Linear(unlabelled)
    p, u = model.rows(positives), model.rows(unlabelled)
    return model.fit(lambda w: -p.T @ _sigmoid(-p @ w) / len(p) + u.T @ _sigmoid(u @ w) / len(u), decay=5.0 / len(p))


def prior_from_histograms(positive: np.ndarray, everything: np.ndarray) -> float:
    """Class prior by the best bin: the least ratio of the shares of all rows and of positives above a score.

    Above a score that no negative reaches the ratio is the prior; elsewhere negatives raise it. A
    margin for the sampling error of both shares keeps thin tails from being chosen.
    """
    n_p, n_u = positive.sum(), everything.sum()
    above_p, above_u = np.cumsum(positive[::-1]) / n_p, np.cumsum(everything[::-1]) / n_u
    slack = np.sqrt(np.log(20) / (2 * n_u)) + np.sqrt(np.log(20) / (2 * n_p))
    usable = above_p > 0
    bound = (above_u[usable] + slack) / above_p[usable]
    best = int(np.argmin(bound))
    return float(np.clip(above_u[usable][best] / above_p[usable][best], 0.01, 0.99))


def risk_parts(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """(risk of positives, estimated risk of negatives), with logistic loss; the latter may be below zero."""
    fp, fu = p @ w, u @ w
    return prior * np.logaddexp(0, -fp).mean(), np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()


def risk_gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the sum of both parts, or, where the negative risk is below zero, the one that raises it."""
    fp, fu = p @ w, u @ w
    g_negative = u.T @ _sigmoid(fu) / len(u) - prior * p.T @ _sigmoid(fp) / len(p)
    g_positive = -prior * p.T @ _sigmoid(-fp) / len(p)
    return g_positive + g_negative if risk_parts(w, p, u, prior)[1] >= 0 else -g_negative


def fit_non_negative(positives: np.ndarray, unlabelled: np.ndarray, prior: float) -> Linear:
    """Minimise  prior E_P[l(f)] + max(0, E_U[l(-f)] - prior E_P[l(-f)])  with logistic loss l.

    Where the estimated negative risk falls below zero the step goes against it, so that the model
    cannot gain by fitting single unlabelled rows.
    """
    model = Linear(unlabelled)
    p, u = model.rows(positives), model.rows(unlabelled)

    def gradient(w: np.ndarray) -> np.ndarray:
        return risk_gradient(w, p, u, prior)

    return model.fit(gradient, decay=1.0 / len(p))


def score_quality(
    docs: DataFrame, positives: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, key_col: str | None = None
) -> DataFrame:
    """(id, score): how likely each document is good, 0 to 1; `key_col`, a long of the input if given, is carried along.

    `positives` holds the ids of trusted positives. The prior is estimated over all documents; the
    fit takes about `train_rows` positives and as many documents of any kind, chosen by a hash of
    their ids. With no positive nothing is known against a document and every score is 1. Null and
    empty texts are scored by their (zero) features. Repeated rows each get a row; other columns of
    the input are ignored.
    """
    spark = docs.sparkSession

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = features(part.column("text"))
                offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))], names=["id", "key", "x"])

    scratch = Scratch(spark, "pu")
    key = F.col(key_col) if key_col else F.lit(None)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), key.cast("long").alias("key"), F.col(text_col).alias("text"))
    table = scratch.keep(slim.mapInArrow(extract, "id long, key long, x array<float>"), "features")
    trusted = positives.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    good = table.join(trusted, "id", "left_semi")
    n_good, n_all = good.count(), table.count()

    def sample(df: DataFrame, n: int, seed: int) -> np.ndarray:
        chosen = df.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < min(1.0, train_rows / max(n, 1)) * (1 << 30))
        rows = chosen.orderBy("id").select("x").toPandas().x
        return np.array(rows.tolist(), float)

    model = None
    if n_good and n_all:
        p, u = sample(good, n_good, 1), sample(table, n_all, 2)
        if len(p) and len(u):
            # The ranker learns from one half of the ids and the prior is read off the other half: positives
            # that it was fitted on would score too high and press the prior down.
            half = lambda df, k: df.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(2)) == k)
            p_half, u_half = sample(half(good, 0), n_good, 1), sample(half(table, 0), n_all, 2)
            split = len(p_half) > 0 and len(u_half) > 0 and not half(good, 1).isEmpty()
            ranker = contrast(p_half, u_half) if split else contrast(p, u)

            def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if len(batch):
                        x = batch.column("x")
                        z = ranker.logit(np.asarray(x.flatten()).reshape(len(x), -1))
                        b, n = np.unique(np.clip((_sigmoid(z) * _BINS).astype(int), 0, _BINS - 1), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(n)], names=["bin", "n"])

            def histogram(df: DataFrame) -> np.ndarray:
                out = np.zeros(_BINS)
                for r in df.select("x").mapInArrow(bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
                    out[r["bin"]] = r["n"]
                return out

            model = fit_non_negative(p, u, prior_from_histograms(*(histogram(half(df, 1) if split else df) for df in (good, table))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            got = np.ones(len(x))
            if model is not None and len(x):
                got = _sigmoid(model.logit(np.asarray(x.flatten()).reshape(len(x), -1)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(got)], names=["id", "key", "score"])

    carried = [F.col("key").alias(key_col)] if key_col else []
    return table.mapInArrow(score, "id long, key long, score double").select(F.col("id").alias(id_col), *carried, "score")
