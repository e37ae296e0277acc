"""Mixing to target weights with soft domain membership, in DataFrame operations only.

A naive Bayes classifier, learned from a table of labelled rows, gives every document a posterior over
domains. Projected-gradient least squares then fits a nonnegative rate per document so that the
expected tokens of each domain, rate x tokens x posterior summed over documents, meet the targets.
Rates stay within bounds, so that targets out of reach give the nearest mixture within them and never
an emptied corpus.
"""

from __future__ import annotations

import math
import warnings
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.scratch import Scratch

#: Words that differ between domains by chance alone and still enter the model, in expectation.
FALSE_WORDS = 1.0
#: Labelled documents of each domain that the classifier is fitted on, in expectation (documented bound of the fit).
TRAIN_DOCS = 20_000
#: Parts of the labelled documents; each is scored by words of the other parts to weigh the scores.
FOLDS = 4
#: Most gradient steps; fitting ends before where the gap, as a share of a domain's tokens, or the gain of a step is below these.
ROUNDS, LEAST_GAP, LEAST_GAIN = 25, 1e-9, 1e-3
STEP_SIZES = (1.0, 0.25, 0.0625, 0.015625)
#: Bounds of a rate: at least this share of the document's posterior of the anchor domain, and at most so many copies.
KEPT, MOST_COPIES = 0.8, 4.0
#: The model is broadcast up to so many words (about 50 bytes each); beyond, the join shuffles.
BROADCAST_WORDS = 2_000_000


def words_of(text: Column) -> Column:
    """Lower-case words between white space, without empty ones."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\u000B\\f\\r]+"), "")


def token_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def _keys(words: Column) -> Column:
    """64-bit keys of the distinct words without the punctuation around them."""
    return F.array_distinct(F.transform(F.array_distinct(words), lambda w: F.xxhash64(F.btrim(w, F.lit(".,;:!?")))))


def _ratio(k, rest, n, m, lib=np):
    """Likelihood ratio statistic of k in n documents against `rest` in m, as arrays or (lib F) columns."""
    share = (k + rest) / (n + m)

    def part(x, e):
        if lib is F:
            return F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)), 0.0)

    return 2 * (part(k, share * n) + part(n - k, n - share * n) + part(rest, share * m) + part(m - rest, m - share * m))


def _threshold(totals: np.ndarray, words: np.ndarray, docs_in: np.ndarray) -> tuple[float, int]:
    """(least significant statistic, least documents that can reach it).

    One-sided and corrected for the number of tests, words x domains; a word too rare or too common to reach the
    threshold whatever its domains are is no test. `words` words are in `totals` documents.
    """
    n = docs_in[:, None]
    most = np.minimum(totals[None, :], n)
    reach = np.where((n > 0) & (n < docs_in.sum()), _ratio(most, totals[None, :] - most, n, docs_in.sum() - n), 0.0)
    grid = np.sort(np.unique(reach))[::-1]
    order = np.argsort(-reach, axis=None)
    tests = np.cumsum(np.broadcast_to(words, reach.shape).ravel()[order])[np.searchsorted(-reach.ravel()[order], -grid, "right") - 1]
    cut = np.array([NormalDist().inv_cdf(1 - min(0.5, FALSE_WORDS / max(t, 1.0))) ** 2 for t in tests])
    # Tests fall and the threshold with them as the reach asked for rises; the least reach that meets its own threshold counts.
    fits = np.flatnonzero(grid >= cut)
    least = float(cut[fits[-1]]) if len(fits) else np.inf
    able = totals[(reach >= least).any(0)]
    return least, int(able.min()) if len(able) else 0


def weigh(scores: np.ndarray, domain: np.ndarray, k: int) -> np.ndarray:
    """Weights (k + 1 x k, the last row added) that turn scores of unseen documents into log posteriors.

    Multinomial logistic regression by Newton steps, with a unit ridge on the weights and one document of each
    domain added without any evidence.
    """
    x = np.vstack([np.column_stack([scores, np.ones(len(scores))]), np.column_stack([np.zeros((k, k)), np.ones(k)])])
    y = np.vstack([np.eye(k)[domain], np.eye(k)])
    ridge = np.append(np.ones(k), 1e-6)[:, None] * np.ones(k)

    def loss(w):
        z = x @ w
        top = z.max(1)
        return (top + np.log(np.exp(z - top[:, None]).sum(1)) - (z * y).sum(1)).sum() + (ridge * w * w).sum() / 2

    w = np.zeros((k + 1, k))
    for _ in range(100):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        gradient = x.T @ (p - y) + ridge * w
        hessian = np.block([[(x * (p[:, i] * ((i == j) - p[:, j]))[:, None]).T @ x for j in range(k)] for i in range(k)])
        step = np.linalg.solve(hessian + np.diag(ridge.T.ravel()), gradient.T.ravel()).reshape(k, k + 1).T
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def word_model(docs: DataFrame, labelled: DataFrame, domains: list[str], train_docs: int) -> tuple[np.ndarray, DataFrame]:
    """(log prior by domain of a document without model words, table of word key -> weighted log odds) from labelled documents.

    Words count once per document, and documents that agree in three least hashes of their words once
    per domain, so that a text with many exact or near copies lends its words little weight. The model
    keeps the words that some domain has significantly more often than the other labels, by a likelihood
    ratio test corrected for the number of words; domains that do not differ take the overall frequency.
    Presence and absence of these words both count. Words go together (language, length), so their plain sum
    is far too sure: each part of the documents is scored by the words of the others, and a regression
    on these scores weighs them. Domains are sampled each for itself; the prior makes up for it.
    """
    k, spark = len(domains), docs.sparkSession
    scratch = Scratch(spark, "mixing-model")
    own = labelled.select("id", "domain").where(F.col("domain").isin(domains)).dropDuplicates(["id"])
    sizes = {r["domain"]: r["n"] for r in own.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    rates = [min(1.0, train_docs / max(sizes.get(d, 0), 1)) for d in domains]
    which = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")).cast("int") - 1
    own = own.select("id", which.alias("domain"))
    own = own.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < F.get(F.array(*[F.lit(r) for r in rates]), F.col("domain")) * (1 << 30))
    own = scratch.keep(own, "labels")  # at most train_docs of each domain in expectation: sent to the texts, which stay where they are
    known = docs.join(F.broadcast(own), "id").select("domain", F.explode(F.array(words_of(F.col("text")))).alias("words")).select("domain", _keys(F.col("words")).alias("keys"))
    least = [F.array_min(F.transform("keys", lambda w, s=s: F.xxhash64(w, F.lit(s)))) for s in range(3)]
    known = known.withColumn("print", F.xxhash64(*least)).dropDuplicates(["domain", "print"])
    known = scratch.keep(known.withColumn("fold", F.pmod("print", F.lit(FOLDS)).cast("int")), "known")
    docs_in = np.zeros((FOLDS, k))
    for r in known.groupBy("fold", "domain").agg(F.count(F.lit(1)).alias("n")).collect():
        docs_in[r["fold"], r["domain"]] = r["n"]
    cells = [(f, i) for f in range(FOLDS) for i in range(k)]
    sums = [F.sum(((F.col("fold") == f) & (F.col("domain") == i)).cast("long")).cast("double").alias(f"n{f}_{i}") for f, i in cells]
    counts = known.select("fold", "domain", F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("total"), *sums)
    counts = scratch.keep(counts.where("total > 1"), "counts")
    tally = counts.groupBy("total").agg(F.count(F.lit(1)).cast("double").alias("words")).orderBy("total").collect()
    limit, rarest = _threshold(np.array([r["total"] for r in tally]), np.array([r["words"] for r in tally]), docs_in.sum(0)) if tally else (np.inf, 0)

    # One row per word and part left out, and one (FOLDS) with nothing left out.
    left = np.array([docs_in.sum(0) - (docs_in[f] if f < FOLDS else 0) for f in range(FOLDS + 1)])
    rows = [
        F.struct(
            F.lit(v).alias("part"),
            *[sum((F.col(f"n{f}_{i}") for f in range(FOLDS) if f != v), F.lit(0.0)).alias(f"c{i}") for i in range(k)],
            *[F.lit(float(left[v, i])).alias(f"d{i}") for i in range(k)],
        )
        for v in range(FOLDS + 1)
    ]
    able = counts.where((F.col("total") >= rarest) & F.lit(bool(np.isfinite(limit))))
    split = able.select("key", F.explode(F.array(*rows)).alias("row")).select("key", "row.*")
    c, d = [F.col(f"c{i}") for i in range(k)], [F.col(f"d{i}") for i in range(k)]
    split = split.select("*", sum(c[1:], c[0]).alias("seen"), sum(d[1:], d[0]).alias("all")).where("seen > 0 AND seen < all")
    share = F.col("seen") / F.col("all")
    tells, told, split_p = [], F.lit(False), []
    for i in range(k):
        differs = (d[i] > 0) & (d[i] < F.col("all")) & (_ratio(c[i], F.col("seen") - c[i], d[i], F.col("all") - d[i], F) >= F.lit(float(limit)))
        tells.append(differs.alias(f"t{i}"))
        told = told | (F.col(f"t{i}") & (c[i] > share * d[i]))
        p = F.when(F.col(f"t{i}"), (c[i] + share * 2.0) / (d[i] + 2.0)).otherwise(share)
        split_p.append(F.least(F.greatest(p, F.lit(1e-6)), F.lit(0.999)).alias(f"p{i}"))
    split = split.select("*", *tells).where(told).select("key", "part", *split_p)
    logs = [[F.log(F.col(f"p{i}") / (1 - F.col(f"p{i}"))) for i in range(k)], [F.log(1 - F.col(f"p{i}")) for i in range(k)]]
    centred = [[(x - sum(of[1:], of[0]) / k).alias(f"{name}{i}") for i, x in enumerate(of)] for name, of in zip("la", logs, strict=True)]
    model = scratch.keep(split.select("key", "part", *centred[0], *centred[1]), "words")

    none = np.zeros((FOLDS + 1, k))  # log odds where no word of the model is present
    for r in model.groupBy("part").agg(*[F.sum(f"a{i}").alias(f"a{i}") for i in range(k)]).collect():
        none[r["part"]] = [r[f"a{i}"] for i in range(k)]
    if not none[FOLDS].any() and docs_in.any():
        warnings.warn("no word tells the domains apart: every document gets their shares as its posterior", stacklevel=2)
    words = known.select("domain", "print", "fold", F.explode_outer("keys").alias("key"))
    met = words.join(model.where(F.col("part") < FOLDS).withColumnRenamed("part", "fold"), ["fold", "key"], "left")
    found = met.groupBy("domain", "print").agg(F.first("fold").alias("fold"), *[F.coalesce(F.sum(f"l{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(k)]).toPandas()
    scores = found[[f"s{i}" for i in range(k)]].to_numpy(float).reshape(-1, k) + none[found["fold"].to_numpy(int)]
    w = weigh(scores, found["domain"].to_numpy(int), k)
    prior = none[FOLDS] @ w[:k] + w[k] - np.log(rates)
    mixed_logs = [sum((F.col(f"l{i}") * float(w[i, j]) for i in range(1, k)), F.col("l0") * float(w[0, j])).alias(f"l{j}") for j in range(k)]
    model = scratch.keep(model.where(F.col("part") == FOLDS).select("key", *mixed_logs), "model")
    scratch.drop("labels", "known", "counts", "words")
    return prior, model


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of `docs` (id, text, others) with n_tokens and p0 .. pk, domain probabilities that sum to 1, without the text.

    A document's text is split once; its distinct words are exploded, meet the model table and are
    summed by row before any shuffle, as all words of a row are in one partition.
    """
    prior, model = word_model(docs, labelled, domains, train_docs)
    model = model.withColumnRenamed("key", "_key")
    if model.count() <= BROADCAST_WORDS:
        model = F.broadcast(model)
    carried = [c for c in docs.columns if c != "text"]
    # The text's words pass a generator, beyond which their expression is not repeated.
    split = docs.select(*carried, F.monotonically_increasing_id().alias("_row"), F.explode(F.array(words_of(F.col("text")))).alias("_words"))
    keyed = split.select(*carried, "_row", F.size("_words").alias("_n"), F.posexplode_outer(_keys(F.col("_words"))).alias("_nth", "_key")).join(model, "_key", "left")
    logs = [F.coalesce(F.sum(f"l{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(len(domains))]
    tokens = F.coalesce(F.sum(F.when(F.coalesce("_nth", F.lit(0)) == 0, F.col("_n"))), F.lit(0)).cast("long").alias("n_tokens")
    scored = keyed.groupBy("_row").agg(*[F.first(c).alias(c) for c in carried], tokens, *logs)
    score = [F.col(f"s{i}") + F.lit(float(prior[i])) for i in range(len(domains))]
    best = F.greatest(*score) if len(score) > 1 else score[0]
    weights = [F.exp(s - best) for s in score]
    total = sum(weights[1:], weights[0])
    return scored.select(*carried, "n_tokens", *[(w / total).alias(f"p{i}") for i, w in enumerate(weights)])


def fit_rates(table: DataFrame, targets: np.ndarray, low: Column | None = None, high: float = MOST_COPIES, rounds: int = ROUNDS) -> tuple[Column, np.ndarray]:
    """(rate as an expression over p0 .. pk, expected tokens by domain under it).

    Minimises  sum_k (E_k - T_k)^2 / m_k,  E_k = sum_d r_d n_d p_dk,  over `low` <= r <= `high` (low: 0) by
    projected gradient from r = 1, where m_k are the tokens of domain k at r = 1. A step moves r_d by
    sum_k p_dk c_k and cuts it at the bounds. c is the gap T - E scaled by the k x k curvature,
    sum n_d p_d p_d' over the documents strictly inside the bounds, so a step would close the gap if nothing were cut;
    the first of STEP_SIZES that lowers the sum is taken. Documents weigh n_d, so long ones move no further
    than short ones. Each step is one aggregation to k + k x k sums for each size; rates are never stored, since they
    follow from the posteriors and the steps so far. It ends when every gap is below LEAST_GAP, a step
    gains less than LEAST_GAIN of the sum, or after `rounds` steps.
    """
    k = len(targets)
    p = [F.col(f"p{i}") for i in range(k)]
    low = F.lit(0.0) if low is None else low
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    base = table.select(*p, F.col("n_tokens").cast("double").alias("n"), low.alias("low"))
    cut = lambda r: F.least(F.lit(float(high)), F.greatest(low, r))

    def at(rate: Column, moves: list[Column]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(tokens by domain, curvature) after each of the moves."""
        rows = base.withColumn("rate", rate).select(*p, "n", "low", *[cut(F.col("rate") + m).alias(f"r{s}") for s, m in enumerate(moves)])
        sums = []
        for s in range(len(moves)):
            r = F.col(f"r{s}")
            inside = F.when((r > F.col("low")) & (r < high), F.col("n")).otherwise(0.0)
            sums += [F.sum(F.col("n") * r * p[i]).alias(f"e{s}_{i}") for i in range(k)] + [F.sum(inside * p[i] * p[j]).alias(f"h{s}_{i}_{j}") for i, j in pairs]
        got = rows.agg(*sums).first()
        out = []
        for s in range(len(moves)):
            curve = np.zeros((k, k))
            for i, j in pairs:
                curve[i, j] = curve[j, i] = got[f"h{s}_{i}_{j}"] or 0.0
            out.append((np.array([got[f"e{s}_{i}"] or 0.0 for i in range(k)]), curve))
        return out

    rate: Column = F.lit(1.0)
    ((expected, curve),) = at(rate, [F.lit(0.0)])
    mass = np.maximum(expected, 1.0)
    loss = lambda e: float(((targets - e) ** 2 / mass).sum())
    for _ in range(rounds):
        gap = targets - expected
        if np.abs(gap / mass).max() < LEAST_GAP:
            break
        step = np.linalg.solve(curve + np.diag(1e-6 * mass), gap)
        moves = [sum((p[i] * float(size * step[i]) for i in range(1, k)), p[0] * float(size * step[0])) for size in STEP_SIZES]
        tried = at(rate, moves)
        best = next((s for s, (e, _) in enumerate(tried) if loss(e) < loss(expected)), None)
        if best is None:
            break
        gain = loss(expected) - loss(tried[best][0])
        small = gain < LEAST_GAIN * loss(expected)
        rate, (expected, curve) = cut(rate + moves[best]), tried[best]
        if small:
            break
    return rate, expected


def mixed(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], anchor: str, id_col: str = "doc_id",
    text_col: str = "text", train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS, kept: float = KEPT, most_copies: float = MOST_COPIES, key_col: str | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, a posterior `p_<domain>` per domain, rate, copies, and the tokens
    `wanted_<domain>` and `reached_<domain>` in expectation, the same in every row; `key_col`, if given, is carried along.

    `labelled` has (id, domain) rows; `weights` are the wanted shares of tokens. The total is what keeps
    the `anchor` domain as large as it is, so a weight below a domain's natural share thins it out and
    one above repeats it. A rate is at least `kept` times the document's posterior of the anchor
    domain and at most `most_copies`: where posteriors are too soft or weights too far from what there is,
    the targets are missed (a warning says so) and not the corpus. `copies` is the rate rounded down or up by a hash of id and text,
    so its mean is the rate. A null or empty text has no tokens, posteriors by the prior and takes part with its rate.
    Without labelled rows nothing is known of the domains and every rate is 1. Rows that repeat an id, or have none,
    are documents of their own; labels go by the id. Other columns of the input are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    domains = sorted(weights)
    own = [F.col(key_col).alias("key")] if key_col else []
    slim = docs.select(*own, F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("print"), F.col(text_col).alias("text"))
    table = scratch.keep(posteriors(slim, labelled, domains, train_docs), "posteriors")
    tokens = F.col("n_tokens").cast("double")
    i = domains.index(anchor)
    whole = float(table.agg(F.sum(tokens * F.col(f"p{i}"))).first()[0] or 0.0) / (weights[anchor] / math.fsum(weights.values()))
    targets = np.array([weights[d] for d in domains]) / math.fsum(weights.values()) * whole
    rate, expected = F.lit(1.0), targets
    if not labelled.isEmpty():
        rate, expected = fit_rates(table, targets, F.col(f"p{i}") * F.lit(float(kept)), most_copies, rounds)
        if np.abs(targets - expected).max() > 1e-6 * max(whole, 1.0):
            reached = ", ".join(f"{d} {e:.6g} of {t:.6g}" for d, e, t in zip(domains, expected, targets, strict=True))
            warnings.warn(f"the mixing targets are not met within the bounds of the rates; expected tokens: {reached}", stacklevel=2)
    draw = F.pmod(F.xxhash64("print", F.lit(23)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    names = [F.col(f"p{j}").alias(f"p_{d}") for j, d in enumerate(domains)]
    totals = [F.lit(float(x[j])).alias(f"{name}_{d}") for name, x in (("wanted", targets), ("reached", expected)) for j, d in enumerate(domains)]
    copies = (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("int").alias("copies")
    carried = [F.col("key").alias(key_col)] if key_col else []
    return table.withColumn("rate", rate).select(*carried, F.col("id").alias(id_col), "n_tokens", *names, "rate", copies, *totals)
