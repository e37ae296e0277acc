"""Quality rules as a bitmask ledger: every rule is evaluated once, policies only combine bits.

`ledger` stores measurements and failure bits per document. `apply_policy` turns bits into a verdict
under a named, versioned policy; `ablations` tells, by bitwise aggregation, how many documents each
rule of a policy rejects, alone or among others. Changing a policy never reads a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.textcore import buffers, mix, owners, slices, span_hash, tile, word_spans

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alpha_words", "n_upper", "n_letters", "n_table_marks", "n_twin_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_ALPHA[0xC3:0xF5] = True  # lead bytes of characters beyond ASCII: letters in nearly every script


@dataclass(frozen=True)
class Rule:
    """A named rule; its position in RULES is its bit. `sql` is true where a document fails."""

    name: str
    sql: str


#: Only ever append: stored bits keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_ratio", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("few_alphabetic_words", "10 * n_alpha_words < 7 * n_words"),
    Rule("shouting", "10 * n_upper > 5 * n_letters"),
    Rule("table_marks", "5 * n_table_marks > n_words"),
    Rule("too_many_words", "n_words > 1000000"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STRICT = Policy(
    "web_text", 1,
    ("few_words", "repeated_windows", "symbol_ratio", "duplicate_lines", "short_words", "long_words", "few_alphabetic_words", "shouting", "table_marks", "too_many_words"),
)


def _totals(index: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(index, weights, minlength=n).astype(np.int64)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """All measurements of a batch. Words are runs of bytes other than ASCII white space."""
    data, offsets = buffers(texts)
    n = len(offsets) - 1
    starts, ends, doc = word_spans(data, offsets)
    out = {"n_words": _totals(doc, n)}
    upto = lambda flags: np.append(0, np.cumsum(flags, dtype=np.int64))
    between = lambda sums, a, b: sums[b] - sums[a]
    lead = (data & 0xC0) != 0x80
    points = upto(lead)
    out["word_chars"] = _totals(doc, n, between(points, starts, ends)) if len(doc) else np.zeros(n, np.int64)
    out["n_symbols"] = between(upto(_SYMBOL[data]), offsets[:-1], offsets[1:])
    out["n_upper"] = between(upto(_UPPER[data]), offsets[:-1], offsets[1:])
    letters = upto(_ALPHA[data])
    out["n_letters"] = between(letters, offsets[:-1], offsets[1:])
    out["n_alpha_words"] = _totals(doc[between(letters, starts, ends) > 0], n)
    bars = (ends - starts == 1) & (data[starts] == 124) if len(starts) else np.zeros(0, bool)
    out["n_table_marks"] = _totals(doc[bars], n)

    # Lines: every text gets a closing newline, so that equal lines are equal byte spans.
    if len(data):
        closed, closed_offsets = buffers(pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())))
        breaks = np.flatnonzero(closed == 10)
        firsts = np.append(0, breaks[:-1] + 1)
        line_doc = owners(closed_offsets, firsts)
        wordy = np.unique(np.searchsorted(breaks, starts + doc, "left"))  # the closing newlines shift text d by d bytes
        codes = np.asarray(tile(closed, firsts).dictionary_encode().indices)[wordy]
        line_doc = line_doc[wordy]
        out["n_lines"] = _totals(line_doc, n)
        distinct = np.unique(line_doc * (codes.max(initial=0) + 1) + codes) if len(codes) else codes
        out["n_dup_lines"] = out["n_lines"] - (_totals(distinct // (codes.max() + 1), n) if len(codes) else 0)
    else:
        out["n_lines"] = out["n_dup_lines"] = np.zeros(n, np.int64)

    # Words inside three-word windows that occur twice or more in their text.
    out["n_repeat_words"] = out["n_twin_words"] = np.zeros(n, np.int64)
    if len(starts) > 1:
        h = span_hash(data, starts, ends - starts)
        out["n_twin_words"] = _totals(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], n)
        first = np.flatnonzero(doc[2:] == doc[:-2])
        key = mix(h[first] ^ mix(h[first + 1] ^ mix(h[first + 2] ^ mix(doc[first].astype(np.uint64) + np.uint64(1)))))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        cover = np.zeros(len(starts), bool)
        for k in range(3):
            cover[first[again] + k] = True
        out["n_repeat_words"] = _totals(doc[cover], n)
    return out


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the measurements and `fail_bits`, bit i set where RULES[i] fails.

    A null or empty text has no words and fails `few_words`. Repeated rows each get a row; other
    columns of the input are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                got = measure(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(got[m]) for m in MEASURES)], names=[id_col, *MEASURES])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    measured = slim.mapInArrow(run, f"{id_col} long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(rule.sql), F.lit(BIT[rule.name])).otherwise(F.lit(0)).cast("long") for rule in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total)


def fails(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: Policy, out_col: str = "kept") -> DataFrame:
    """Adds the verdict of the policy and its name and version."""
    return rows.withColumn(out_col, ~fails(policy)).withColumn("policy", F.lit(f"{policy.name}/{policy.version}"))


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """(rule, failed, only_this, kept_without): per rule of the policy how many documents fail it,
    fail nothing else of the policy, and would be kept if the rule were dropped.

    Documents are first counted by their masked bits (at most 2^rules rows whatever the input), and
    the rules are told apart on those counts.
    """
    mask = F.lit(policy.mask).cast("long")
    counts = rows.select(F.col("fail_bits").bitwiseAND(mask).alias("bits")).groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules])
    each = counts.select("bits", "n", F.inline(rules))
    failed = F.col("bits").bitwiseAND(F.col("bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return each.groupBy("rule").agg(
        count(failed).alias("failed"), count(F.col("bits") == F.col("bit")).alias("only_this"), count(rest == 0).alias("kept_without")
    )


def quality_rules(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The ledger with `base_failed` and `kept`: documents that fail the base policy go, the others as `policy` says."""
    rows = apply_policy(ledger(docs).withColumn("base_failed", fails(BASE)), policy)
    return rows.withColumn("kept", F.col("kept") & ~F.col("base_failed"))
