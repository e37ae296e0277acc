"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawatt.llm.bpe import bpe_digest
from terrawatt.llm.chunk_factors import source_divergence
from terrawatt.llm.dart_minhash import near_duplicates
from terrawatt.llm.interleave import interleaved_shards
from terrawatt.llm.langid import identify
from terrawatt.llm.phrase_trees import collocations
from terrawatt.llm.pivot_search import nearest
from terrawatt.llm.pu_quality import score_quality
from terrawatt.llm.pstable_dedup import near_vectors
from terrawatt.llm.quote_links import link_quotations
from terrawatt.llm.rule_ledger import quality_rules
from terrawatt.llm.separator_scan import document_token_counts
from terrawatt.llm.soft_mixing import mixed

#: Marks the end of a document in token files; the vocabulary ends one below.
END_OF_DOCUMENT = 50256
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op1_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"), RANKS)


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits"
    )


def language_training(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out()).select(F.col("doc_id").cast("long").alias("id"), "text", "lang")


def op3_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(table(spark, sf_dir, "documents"), 40)


def trusted_positives(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out() & (F.col("quality") == 1)).select("doc_id")


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), trusted_positives(table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_quotations(table(spark, sf_dir, "conversations"))
    return linked.select(
        "conv_id", "turn", "role", "position", "parent_turn", "root_turn", "depth", "n_quoted", "n_linked",
        F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"),
    )


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_token_counts(table(spark, sf_dir, "documents"), RANKS, END_OF_DOCUMENT)


#: Wanted shares of tokens: documents like the toxic ones are to be rare, low ones rarer than they are.
MIXTURE = {"clean": 0.97, "low": 0.02, "toxic": 0.01}


def domains(labels: DataFrame) -> DataFrame:
    """(id, domain) from the labels that a model may learn from."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.where(~held_out()).select(F.col("doc_id").cast("long").alias("id"), domain.alias("domain")).where("domain IS NOT NULL")


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), domains(table(spark, sf_dir, "labels")), MIXTURE, "clean")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), language_training(docs), RANKS)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_chunk_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_phrase_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_pstable": op1_pstable,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_interleave": op3_interleave,
    "op4_pu_quality": op4_pu_quality,
    "op5_rule_ledger": op5_rule_ledger,
    "op6_quote_links": op6_quote_links,
    "op7_separator_scan": op7_separator_scan,
    "op8_soft_mixing": op8_soft_mixing,
    "op9_language_id": op9_language_id,
    "op10_dart_minhash": op10_dart_minhash,
    "op11_chunk_factors": op11_chunk_factors,
    "op12_phrase_trees": op12_phrase_trees,
    "op13_pivot_search": op13_pivot_search,
}

#: DuckDB statements; the operators that SQL cannot express are tested against brute force instead.
ORACLE_SQL: dict[str, str] = {
    # CRC-32 by pieces of 256 bytes (the first may be shorter), each byte by byte over the hex form of the
    # text; `shifts` says what 256 more bytes make of each bit of what came before.
    "op3_interleave": r"""
WITH RECURSIVE crc_steps AS (
  SELECT range AS n, range AS c, 0 AS step FROM range(256)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc_steps WHERE step < 8
), crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM crc_steps WHERE step = 8
), shift_steps AS (
  SELECT range AS j, 1::BIGINT << range AS c, 0 AS step FROM range(32)
  UNION ALL
  SELECT j, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM shift_steps WHERE step < 2048
), shifts AS (
  SELECT list(c ORDER BY j) AS m FROM shift_steps WHERE step = 2048
), texts AS (
  SELECT row_number() OVER () AS k, doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents
), cut_texts AS (
  SELECT *, len(h) // 2 AS n, (len(h) // 2 - 1) % 256 + 1 AS head FROM texts
), pieces AS (
  SELECT k, h, head, unnest(range(0, (n + 255) // 256)) AS i FROM cut_texts
), bytes AS (
  SELECT k, i, list_prepend(CASE WHEN i = 0 THEN 4294967295 ELSE 0 END::BIGINT, list_transform(range(0, len(p) // 2), lambda j: ('0x' || p[2 * j + 1 : 2 * j + 2])::BIGINT)) AS b
  FROM (SELECT k, i, CASE WHEN i = 0 THEN h[1 : 2 * head] ELSE h[2 * (head + (i - 1) * 256) + 1 : 2 * (head + i * 256)] END AS p FROM pieces)
), registers AS (
  SELECT k, list(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])) ORDER BY i) AS r FROM bytes, crc_table GROUP BY k
), summed AS (
  SELECT doc_id, source, n + 16 AS size, coalesce(xor(list_reduce(r, lambda a, x: xor(x,
           list_reduce(list_transform(range(32), lambda j: CASE WHEN (a >> j) & 1 = 1 THEN m[j + 1] ELSE 0 END), lambda u, v: xor(u, v)))), 4294967295), 0) AS crc
  FROM cut_texts LEFT JOIN registers USING (k), shifts
), drawn AS (
  SELECT *, md5(concat_ws('|', '0', doc_id::VARCHAR, crc::VARCHAR)) AS draw, count(*) OVER (PARTITION BY source) AS n FROM summed
), fractions AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY draw, doc_id) - 1)::DOUBLE / (2 * n) AS fraction FROM drawn
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, draw, doc_id) - 1 AS pos, count(*) OVER () AS total FROM fractions
), cut AS (
  SELECT *, (pos * 40 // total)::INTEGER AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'rows' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM cut
""",
    "op5_rule_ledger": r"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), spots AS (
  SELECT k, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS w FROM texts
), windows AS (
  SELECT k, i, w || chr(0) || lead(w) OVER p || chr(0) || lead(w, 2) OVER p AS triple FROM spots WINDOW p AS (PARTITION BY k ORDER BY i)
), again AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, triple) AS n FROM windows WHERE triple IS NOT NULL) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT i + d) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS shift(d) GROUP BY k
), lines AS (
  SELECT k, unnest(string_split(text, chr(10))) AS line FROM texts
), line_counts AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k
), measured AS (
  SELECT doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z\x{C0}-\x{10FFFF}]'))) AS n_alpha_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^A-Za-z\x{C0}-\x{10FFFF}]', '', 'g')) AS n_letters,
         len(list_filter(words, lambda x: x = '|')) AS n_table_marks
  FROM texts LEFT JOIN covered USING (k) LEFT JOIN line_counts USING (k)
), marked AS (
  SELECT *, (n_words < 50)::BIGINT + (100 * n_repeat_words > 50 * n_words)::BIGINT * 2 + (10 * n_symbols > n_words)::BIGINT * 4
            + (2 * n_dup_lines > n_lines)::BIGINT * 8 + (word_chars < 3 * n_words)::BIGINT * 16 + (word_chars > 12 * n_words)::BIGINT * 32
            + (10 * n_alpha_words < 7 * n_words)::BIGINT * 64 + (10 * n_upper > 5 * n_letters)::BIGINT * 128
            + (5 * n_table_marks > n_words)::BIGINT * 256 + (n_words > 1000000)::BIGINT * 512 AS fail_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM marked
""",
    "op11_chunk_factors": r"""
WITH docs AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), uses AS (
  SELECT k, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT k) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, kept.term, kept.n AS lang_n, count(u.k) AS n
  FROM groups g JOIN kept USING (lang) LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = kept.term
  GROUP BY ALL
), rated AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p,
         1 + 1000000000::HUGEINT * (lang_n + 1) // (total + v) AS q
  FROM cells JOIN langs USING (lang)
), pairs AS (
  SELECT g.lang, g.source, h.source AS item, coalesce(sum((a.p - b.p) * (a.p - b.p) // b.p), 0)::BIGINT AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN rated a ON a.lang = g.lang AND a.source = g.source
  LEFT JOIN rated b ON b.lang = h.lang AND b.source = h.source AND b.term = a.term
  GROUP BY ALL
), both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM rated WHERE n > 0 AND p > q
), placed AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM both_parts
)
SELECT * FROM placed WHERE part = 'pair' OR rank <= 200
""",
    "op12_phrase_trees": r"""
WITH pieces AS (
  SELECT row_number() OVER () AS k, lang, words FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
  ) WHERE len(words) > 0
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
), spans AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), counts AS (
  SELECT lang, words[i : i + size - 1] AS p, count(*) AS f
  FROM spans, range(1, 5) AS sizes(size) WHERE i + size - 1 <= len(words)
  GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT lang, p, f AS a FROM counts WHERE len(p) > 1
), cuts AS (
  SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a // (l.f + r.f))::BIGINT AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.p = c.p[1 : k] JOIN counts r ON r.lang = c.lang AND r.p = c.p[k + 1 :]
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_spans AS (
  SELECT lang, p, a, unnest([[2, 1], [2, 2], [2, 3], [3, 1], [3, 2]]) AS s FROM candidates
), held AS (
  SELECT lang, p[s[2] : s[2] + s[1] - 1] AS p, max(a) AS longest FROM inner_spans WHERE s[1] < len(p) AND s[2] + s[1] - 1 <= len(p) GROUP BY 1, 2
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.p, ' ')) AS rank,
       array_to_string(b.p, ' ') AS phrase, a, l, r, n, score
FROM best b JOIN totals USING (lang) LEFT JOIN held h ON h.lang = b.lang AND h.p = b.p
WHERE longest IS NULL OR 100 * longest < 80 * a
QUALIFY rank <= 2000
""",
    "op13_pivot_search": r"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
""",
}
