"""Source divergence by chunk factorization.

Runs of text between white space (chunks) are counted per document. Every globally distinct chunk is
split into terms once; the terms are joined back to the counts, which gives documents and occurrences
of each term by language and source. Their smoothed frequencies tell how sources of a language differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawatt.llm.scratch import Scratch
from terrawatt.llm.textcore import buffers, ragged, slices, span_hash, word_spans
from terrawatt.llm.units import each_unit

#: Terms are runs of these bytes: ASCII letters and everything beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Text and documents whose chunks are counted together (a longer text stands alone); documents are numbered in 16 bits.
UNIT_BYTES, UNIT_DOCS = 8 << 20, 1 << 16
#: Chunks of units per bucket of chunks, and of terms.
BUCKET_ROWS = 300_000
#: A term counts from so many documents of its language on.
LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: (term, source) rows whose source pairs are summed in one unit of work, and pairs held at once there.
PAIR_ROWS, PAIRS = 200_000, 1 << 21


def _blob(columns: dict[str, pa.Array]) -> bytes:
    """Columns as one compressed value."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _table(blobs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs]).unify_dictionaries().combine_chunks()


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else column.chunk(0)


def _spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> pa.Array:
    packed = data[ragged(starts, lens)] if len(starts) else data[:0]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(0, np.cumsum(lens))), pa.py_buffer(packed)])


def _hashes(chunks: pa.Array) -> np.ndarray:
    """32-bit hashes of binary values."""
    data, offsets = buffers(chunks)
    return (span_hash(data, offsets[:-1], np.diff(offsets)) >> np.uint64(32)).astype(np.int64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets that follow the order of the hashes."""
    return hashes * buckets >> 32


class Unit:
    """Counts of the chunks in a run of documents."""

    def __init__(self) -> None:
        self.bytes, self.docs = 0, 0
        self.chunks: list[pa.Array] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.langs: list[pa.Array] = []
        self.sources: list[pa.Array] = []

    def add(self, batch: pa.RecordBatch) -> None:
        data, offsets = buffers(batch.column("text"))
        data = _LOWER[data]
        starts, ends, doc = word_spans(data, offsets)
        coded = _spans(data, starts, ends - starts).dictionary_encode()
        own, own_offsets = buffers(coded.dictionary)
        terms = np.append(0, np.cumsum(_TERM[own]))[own_offsets]
        some = np.flatnonzero(terms[1:] > terms[:-1])
        place = np.full(len(coded.dictionary), -1)
        place[some] = np.arange(len(some))
        code = place[np.asarray(coded.indices)]
        used = code >= 0
        key, n = np.unique(doc[used] * max(1, len(some)) + code[used], return_counts=True)
        before = sum(len(c) for c in self.chunks)
        self.parts.append((key // max(1, len(some)) + self.docs, key % max(1, len(some)) + before, n))
        self.chunks.append(coded.dictionary.take(pa.array(some)))
        self.langs.append(batch.column("lang").cast(pa.string()))
        self.sources.append(batch.column("source").cast(pa.string()))
        self.docs += len(batch)
        self.bytes += len(data)

    def row(self, number: int) -> pa.RecordBatch:
        """(unit, n_chunks, chunks, uses, groups, lang, source): distinct chunks by hash, the documents of each with counts, each document's (lang, source)."""
        coded = pa.concat_arrays(self.chunks).dictionary_encode()
        doc, code, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        by_hash = np.argsort(_hashes(coded.dictionary), kind="stable")
        place = np.empty(len(by_hash), np.int64)
        place[by_hash] = np.arange(len(by_hash))
        code = place[np.asarray(coded.indices)[code]] if len(code) else code
        order = np.argsort(code, kind="stable")
        lang, source = (pa.concat_arrays(x).dictionary_encode() for x in (self.langs, self.sources))
        pair, group = np.unique(np.asarray(lang.indices).astype(np.int64) * len(source.dictionary) + np.asarray(source.indices), return_inverse=True)
        values = [
            pa.array([number]), pa.array([len(by_hash)]), pa.array([_blob({"chunk": coded.dictionary.take(pa.array(by_hash))})]),
            pa.array([_blob({"doc": pa.array(doc[order].astype(np.uint16)), "n": pa.array(n[order]), "code": pa.array(code[order].astype(np.uint32))})]),
            pa.array([_blob({"group": pa.array(group.astype(np.uint16))})]),
            pa.array([lang.dictionary.take(pa.array(pair // len(source.dictionary))).to_pylist()]), pa.array([source.dictionary.take(pa.array(pair % len(source.dictionary))).to_pylist()]),
        ]
        return pa.RecordBatch.from_arrays(values, names=["unit", "n_chunks", "chunks", "uses", "groups", "lang", "source"])


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, unit = TaskContext.get().partitionId() << 32, Unit()
    for batch in batches:
        for part in (run.slice(at, UNIT_DOCS) for run in slices(batch, "text") for at in range(0, len(run), UNIT_DOCS)):
            if unit.docs and (unit.bytes + part.column("text").nbytes > UNIT_BYTES or unit.docs + len(part) > UNIT_DOCS):
                yield unit.row(number)
                number, unit = number + 1, Unit()
            unit.add(part)
    if unit.docs:
        yield unit.row(number)


def _dealt_chunks(buckets: int):
    """(bucket, unit, start, chunks): each unit's chunks by buckets; `start` is the place of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, blob in zip(batch.column("unit").to_pylist(), batch.column("chunks").to_pylist(), strict=True):
                chunks = _whole(_table([blob]), "chunk")
                own = _bucket(_hashes(chunks), buckets)
                cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
                for a, b in zip(cuts.tolist(), np.append(cuts, len(own))[1:].tolist(), strict=True):
                    yield pa.RecordBatch.from_arrays([pa.array([int(own[a])]), pa.array([unit]), pa.array([a]), pa.array([_blob({"chunk": chunks[a:b]})])], names=["bucket", "unit", "start", "chunks"])

    return run


def tokenized(chunks: pa.Array) -> pa.LargeListArray:
    """The terms of each chunk (large_binary)."""
    data, offsets = buffers(chunks)
    inside = _TERM[data]
    first, last = np.zeros(len(data), bool), np.zeros(len(data), bool)
    edges = offsets[:-1][np.diff(offsets) > 0]
    if len(data):
        first[1:], last[:-1] = ~inside[:-1], ~inside[1:]
        first[edges] = True
        last[np.append(edges[1:], len(data)) - 1] = True
    starts, ends = np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, offsets)), _spans(data, starts, ends - starts))


def _tokenize_bucket(held: pa.Table) -> pa.RecordBatch:
    """(unit, start, terms): every distinct chunk of the bucket is tokenized once and its terms are given back to the units."""
    blobs = [_whole(_table([b]), "chunk") for b in held.column("chunks").to_pylist()]
    coded = pa.concat_arrays(blobs).dictionary_encode()
    lists, codes = tokenized(coded.dictionary), np.asarray(coded.indices)
    ends = np.cumsum([len(b) for b in blobs])
    terms = [_blob({"terms": lists.take(pa.array(codes[e - len(b) : e]))}) for b, e in zip(blobs, ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([held.column("unit").combine_chunks(), held.column("start").combine_chunks(), pa.array(terms, pa.binary())], names=["unit", "start", "terms"])


def _sums(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order and the sums of the values at each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return [key[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)]


def _term_blob(term: pa.Array, lang: pa.Array, source: pa.Array, n: np.ndarray, docs: np.ndarray) -> bytes:
    return _blob({"term": term.dictionary_encode(), "lang": lang.dictionary_encode(), "source": source.dictionary_encode(), "n": pa.array(n), "docs": pa.array(docs)})


def _merge_terms(buckets: int):
    """(bucket, stats) of one unit: the terms of its chunks meet the documents that have them."""

    def work(held: pa.Table) -> pa.RecordBatch:
        blob = {c: held.column(c).drop_null().to_pylist() for c in ("terms", "uses", "groups", "start")}
        group = np.asarray(_whole(_table(blob["groups"]), "group")).astype(np.int64)
        named = [np.array(x, object) for x in (held.column(c).drop_null()[0].as_py() for c in ("lang", "source"))]
        if not blob["terms"]:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.binary())], names=["bucket", "stats"])
        lists = _whole(_table([blob["terms"][i] for i in np.argsort(blob["start"])]), "terms")
        coded = lists.flatten().dictionary_encode()
        size = np.diff(np.asarray(lists.offsets))
        uses = _table(blob["uses"])
        doc, n, code = (np.asarray(_whole(uses, c)).astype(np.int64) for c in ("doc", "n", "code"))
        term = np.asarray(coded.indices).astype(np.int64)[ragged((np.cumsum(size) - size)[code], size[code])]
        doc, n = np.repeat(doc, size[code]), np.repeat(n, size[code])
        key, n = _sums(term * UNIT_DOCS + doc, n)
        cell, n, docs = _sums(key // UNIT_DOCS * len(named[0]) + group[key % UNIT_DOCS], n, np.ones(len(key), np.int64))
        own = _bucket(_hashes(coded.dictionary), buckets)[cell // len(named[0])]
        order = np.argsort(own, kind="stable")
        own, cell, n, docs = own[order], cell[order], n[order], docs[order]
        terms = coded.dictionary.take(pa.array(cell // len(named[0])))
        lang, source = (pa.array(x, pa.string()).take(pa.array(cell % len(named[0]))) for x in named)
        cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        stats = [_term_blob(terms[a:b], lang[a:b], source[a:b], n[a:b], docs[a:b]) for a, b in zip(cuts.tolist(), np.append(cuts, len(own))[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(own[cuts]), pa.array(stats, pa.binary())], names=["bucket", "stats"])

    return work


def _bucket_sums(held: pa.Table):
    """(terms, langs, sources, codes of each, n, docs) of the term statistics held, folded."""
    table = _table(held.column("stats").to_pylist())
    term, lang, source = (_whole(table, c) for c in ("term", "lang", "source"))
    wide = len(lang.dictionary), len(source.dictionary)
    at = [np.asarray(x.indices).astype(np.int64) for x in (term, lang, source)]
    key, n, docs = _sums((at[0] * wide[0] + at[1]) * wide[1] + at[2], *(np.asarray(_whole(table, c)) for c in ("n", "docs")))
    codes = key // wide[1] // wide[0], key // wide[1] % wide[0], key % wide[1]
    return [x.dictionary.take(pa.array(c)) for x, c in zip((term, lang, source), codes, strict=True)], codes, n, docs


def _fold_bucket(held: pa.Table) -> pa.RecordBatch:
    values, _, n, docs = _bucket_sums(held)
    return pa.RecordBatch.from_arrays([held.column("bucket")[:1].combine_chunks(), pa.array([_term_blob(*values, n, docs)], pa.binary())], names=["bucket", "stats"])


def _finish_bucket(least_docs: int):
    """(lang, source, term, n, docs, lang_n) of the bucket's terms that are in `least_docs` documents of the language."""

    def work(held: pa.Table) -> pa.RecordBatch:
        (term, lang, source), codes, n, docs = _bucket_sums(held)
        _, inverse = np.unique(codes[0] * (int(codes[1].max(initial=0)) + 1) + codes[1], return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(inverse[order]) > 0)[: len(order)])
        lang_n, lang_docs = (np.add.reduceat(v[order], first)[inverse] if len(first) else v for v in (n, docs))
        kept = pa.array(np.flatnonzero(lang_docs >= least_docs))
        values = [lang, source, term.cast(pa.binary()).cast(pa.string()), pa.array(n), pa.array(docs), pa.array(lang_n)]
        return pa.RecordBatch.from_arrays([v.take(kept) for v in values], names=["lang", "source", "term", "n", "docs", "lang_n"])

    return work


def chunk_terms(docs: DataFrame, scratch: Scratch, least_docs: int = 1, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, docs, lang_n) and all (lang, source) of `docs` (text, lang, source).

    n are a term's occurrences in the source and lang_n in the language, docs the documents of the source
    that have it; terms in less than `least_docs` documents of their language are left out.

    Units of about 8 MB of text hold which documents have which chunk. Their distinct chunks go, packed, to
    buckets by hash, where each is tokenized once, and the terms go back to the units; a hot chunk is there
    once per unit. Units meet terms with documents and send sums, again by buckets. A bucket has
    about `bucket_rows` chunks of units; sums of a hot term are folded as they arrive.
    """
    slim = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    schema = "unit long, n_chunks long, chunks binary, uses binary, groups binary, lang array<string>, source array<string>"
    counted = scratch.keep(slim.mapInArrow(_count_chunks, schema), "counted")
    buckets = min(1 << 30, max(1, -(-int(counted.agg(F.sum("n_chunks")).first()[0] or 0) // bucket_rows)))
    dealt = counted.select("unit", "chunks").mapInArrow(_dealt_chunks(buckets), "bucket long, unit long, start long, chunks binary").repartition("bucket").sortWithinPartitions("bucket")
    terms = dealt.mapInArrow(each_unit(["bucket"], _tokenize_bucket), "unit long, start long, terms binary")
    rows = terms.unionByName(counted.select("unit", "uses", "groups", "lang", "source"), allowMissingColumns=True).repartition("unit").sortWithinPartitions("unit")
    met = rows.mapInArrow(each_unit(["unit"], _merge_terms(buckets)), "bucket long, stats binary").repartition("bucket").sortWithinPartitions("bucket")
    stats = met.mapInArrow(each_unit(["bucket"], _finish_bucket(least_docs), _fold_bucket), "lang string, source string, term string, n long, docs long, lang_n long")
    stats = scratch.keep(stats, "stats")
    groups = scratch.keep(counted.select(F.inline(F.arrays_zip("lang", "source"))).distinct(), "groups")
    scratch.drop("counted")
    return stats, groups


def _frequency(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + 1) / (total + terms)), exact."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide, (total + terms).cast("decimal(20,0)"))


def _deviation(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(held: pa.Table) -> pa.RecordBatch:
    """(lang, source, item, value): over the terms that two sources share, what their pair adds to the sums with one or none of them.

    Sums are exact: values are split into 30-bit halves, and so many are added at once that doubles hold them.
    """
    lang, source, term = (held.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source", "term"))
    wide = len(source.dictionary)
    group, own = np.unique(np.asarray(lang.indices).astype(np.int64) * wide + np.asarray(source.indices), return_inverse=True)
    word = np.asarray(lang.indices).astype(np.int64) * len(term.dictionary) + np.asarray(term.indices)
    order = np.argsort(word, kind="stable")
    own, word = own[order], word[order]
    p, none = (np.asarray(held.column(c))[order] for c in ("p", "none"))
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    size = np.diff(np.append(first, len(word)))
    start, width = np.repeat(first, size), np.repeat(size, size)
    done = np.cumsum(width)
    f = lambda x, y: (x - y) * (x - y) // y
    sums: dict[int, int] = {}
    at = 0
    while at < len(word):
        stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS, "right")))
        a = np.repeat(np.arange(at, stop), width[at:stop])
        b = ragged(start[at:stop], width[at:stop])
        differ = a != b
        a, b = a[differ], b[differ]
        value = f(p[a], p[b]) - f(p[a], none[b]) - f(none[a], p[b]) + f(none[a], none[b])
        cell, inverse = np.unique(own[a] * len(group) + own[b], return_inverse=True)
        high, low = (np.bincount(inverse, x, minlength=len(cell)) for x in (value >> 30, value & ((1 << 30) - 1)))
        for c, h, x in zip(cell.tolist(), high.tolist(), low.tolist(), strict=True):
            sums[c] = sums.get(c, 0) + (int(h) << 30) + int(x)
        at = stop
    cell = np.array(list(sums), np.int64)
    a, b = group[cell // len(group)], group[cell % len(group)]
    return pa.RecordBatch.from_arrays(
        [lang.dictionary.take(pa.array(a // wide)), source.dictionary.take(pa.array(a % wide)), source.dictionary.take(pa.array(b % wide)), pa.array(list(sums.values()), pa.decimal128(38, 0))],
        names=["lang", "source", "item", "value"],
    )


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
    pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from the others of its language.

    Terms are runs of ASCII letters and characters beyond ASCII, with A-Z lower-cased; a language keeps
    those in at least `least_docs` of its documents. Part `pair` has a row for every other source of the
    language, with the deviation summed over all kept terms; part `term` has the `top` terms that the
    source uses more than its language. Integer arithmetic throughout, by one rule for all sizes.

    A pair's sum is split: terms that neither source has, and terms that one of them has, follow from the
    sources' counts of equal frequencies; only terms that both have are met pair by pair, inside units
    of about `pair_rows` rows that hold all sources of a term and emit one sum per pair.

    Null text, lang and source are ''. A source without terms has its pairs, with all counts zero; a language
    without kept terms has pairs of value 0; a language with one source has no pairs. Repeated rows are
    documents of their own. An empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    slim = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    used, groups = chunk_terms(slim, scratch, least_docs)
    # A term's count in its language is on each of its rows; its first source alone adds it up.
    langs = used.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    own = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own_terms"))
    totals = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "own_terms", "lang_total", "terms"])
    totals = totals.withColumn("none", F.when(F.col("terms") > 0, _frequency(F.lit(0), F.col("total"), F.greatest("terms", F.lit(1)))))
    totals = scratch.keep(totals, "totals")
    rated = used.join(totals.drop("own_terms"), ["lang", "source"]).select(
        "lang", "source", "term", "none", _frequency(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _frequency(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    rated = scratch.keep(rated, "rated")

    wide = lambda c: c.cast("decimal(38,0)")
    other = totals.select("lang", F.col("source").alias("item"), F.col("none").alias("item_none"), F.col("own_terms").alias("item_terms"))
    every = totals.join(other, "lang").where("source <> item")
    neither = every.select("lang", "source", "item", F.coalesce(wide(F.col("terms") - F.col("own_terms") - F.col("item_terms")) * wide(_deviation(F.col("none"), F.col("item_none"))), wide(F.lit(0))).alias("value"))
    equal = rated.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    met = equal.join(other, "lang").where("source <> item")
    one = met.select("lang", F.inline(F.array(
        F.struct("source", "item", (wide(F.col("n")) * wide(_deviation(F.col("p"), F.col("item_none")))).cast("decimal(38,0)").alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), (wide(F.col("n")) * wide(_deviation(F.col("item_none"), F.col("p")))).cast("decimal(38,0)").alias("value")),
    )))
    units = max(1, -(-rated.count() // pair_rows))
    dealt = rated.select(F.pmod(F.xxhash64("lang", "term"), F.lit(units)).alias("unit"), "lang", "source", "term", "p", "none").repartition("unit").sortWithinPartitions("unit")
    both = dealt.mapInArrow(each_unit(["unit"], _pair_sums), "lang string, source string, item string, value decimal(38,0)")
    pairs = neither.withColumn("value", wide(F.col("value"))).unionByName(one).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    terms = rated.where("p > q").select("lang", "source", F.col("term").alias("item"), _deviation(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).select(columns)
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= top).withColumn("part", F.lit("term")).select(columns)
    result = scratch.keep(pairs.unionByName(terms), "result")
    scratch.drop("stats", "groups", "totals", "rated")
    return result
