import collections
import random
import re

import pyarrow as pa

from terrawatt.llm.rule_ledger import BASE, BIT, RULES, STRICT, Policy, ablations, apply_policy, ledger, measure, quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_measurements_like_brute_force():
    rng = random.Random(3)
    parts = ["a ", "b ", "é", "\n", "c\n", "#", " ", "\t", "漢 ", "|", " | ", "\x0b"]
    texts = [None, "", " ", "\n\n", "a b c a b c", "x\nx\nx"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    got = measure(pa.array(texts, pa.string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(got[k][i]) for k in names) for i in range(len(texts))] == [brute(t) for t in texts]


CLEAN = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
ROWS = [(1, CLEAN, 7), (2, None, 7), (3, "", 7), (4, CLEAN.upper(), 7), (5, CLEAN.replace(" ", " | "), 7), (1, CLEAN, 7), (6, "a b c " * 40, 7), (None, CLEAN, 7)]


def test_verdicts_and_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, fail_bits long")
    got = [(r.doc_id, r.base_failed, r.kept) for r in quality_rules(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, False, True), (1, False, True), (2, True, False), (3, True, False), (4, False, False), (5, False, False), (6, True, False), (None, False, True)], key=str
    )
    assert quality_rules(docs.where("false")).count() == 0


def test_policies_and_ablations_from_bits_alone(spark):
    rows = ledger(spark.createDataFrame(ROWS, "doc_id long, text string, extra long")).select("doc_id", "fail_bits")
    bits = [r.fail_bits for r in rows.collect()]
    got = {r.rule: (r.failed, r.only_this, r.kept_without) for r in ablations(rows, STRICT).collect()}
    for rule in STRICT.rules:
        bit = BIT[rule]
        own = [b & STRICT.mask for b in bits]
        assert got[rule] == (sum(b & bit > 0 for b in own), sum(b == bit for b in own), sum(b & ~bit == 0 for b in own))
    lenient = Policy("lenient", 2, ("shouting",))
    assert sum(not r.kept for r in apply_policy(rows, lenient).collect()) == sum(b & BIT["shouting"] > 0 for b in bits) == 1
    assert len(BIT) == len(RULES) and BASE.mask == 3
