"""Token counts of flat token files by a separator scan.

A flat file is a stream of token ids without an index: document after document, each closed by an
end-of-document id. It is read in blocks that know nothing of document boundaries. Every block is
searched on its own with one vectorised comparison; what is cut at block edges is stitched by a
prefix scan over one small summary row per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrawatt.llm.bpe import Encoder, tables
from terrawatt.llm.scratch import Scratch
from terrawatt.llm.shipping import shipped
from terrawatt.llm.textcore import slices

#: Ids of 16 bits hold vocabularies of up to 65,536 tokens.
DTYPE = "<u2"
BLOCK_BYTES = 1 << 18


def flat_blocks(docs: DataFrame, ranks_path: str, separator: int, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes documents into flat streams, one per input partition: (file, block, data, closed).

    `data` is the next `block_bytes` of the stream, cut anywhere; `closed` lists the ids of the
    documents whose separator lies in the block, in order. The scan does not read it: it only gives
    back names to documents that the scan numbers. A null text is an empty document.
    """
    if separator >= 1 << 16:
        raise ValueError("the separator does not fit 16 bits")
    shared = tables(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shipped(shared))
        file, block = TaskContext.get().partitionId(), 0
        size = block_bytes // 2
        rest, closed = np.zeros(0, DTYPE), []  # closed: (position of the separator in `rest`, id)

        def cut(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal rest, closed, block
            while len(rest) >= size or (final and len(rest)):
                here = [d for at, d in closed if at < size]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([rest[:size].tobytes()], pa.binary()), pa.array([here], pa.list_(pa.int64()))],
                    names=["file", "block", "data", "closed"],
                )
                closed = [(at - size, d) for at, d in closed if at >= size]
                rest, block = rest[size:], block + 1

        for batch in batches:
            for part in slices(batch, "text"):
                ids, upto = encoder.encode(part.column("text"))
                n = len(part)
                at = upto[1:] + np.arange(n)  # each separator follows its document
                stream = np.full(len(ids) + n, separator, DTYPE)
                own = np.ones(len(stream), bool)
                own[at] = False
                stream[own] = ids
                closed += zip((at + len(rest)).tolist(), part.column("id").to_pylist(), strict=True)
                rest = np.concatenate([rest, stream])
                yield from cut(False)
        yield from cut(True)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "file long, block long, data binary, closed array<long>")


def read_flat_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, data) of raw token files below `path`, each read by one task and cut into blocks.

    Spark's binary reader takes files of up to 2 GB; larger streams come as several files, each of
    which ends with a separator or continues nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                view = memoryview(content.as_buffer())
                for k, at in enumerate(range(0, len(view), block_bytes)):
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([k], pa.int64()), pa.array([bytes(view[at : at + block_bytes])], pa.binary())], names=["file", "block", "data"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, block long, data binary")


def scan(blocks: DataFrame, separator: int, dtype: str = DTYPE) -> DataFrame:
    """(file, ordinal, n_tokens): the token count of each document, numbered from 0 within its file.

    Tokens after a file's last separator are a document of their own; an empty rest is none. Blocks
    hold whole ids (their length is a multiple of the id's size), null data counts as empty, and
    (file, block) is unique.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, data in zip(batch.column("file"), batch.column("block"), batch.column("data"), strict=True):
                ids = np.frombuffer(data.as_buffer() if data.is_valid else b"", dtype)
                at = np.flatnonzero(ids == separator)
                head = int(at[0]) if len(at) else len(ids)
                tail = len(ids) - int(at[-1]) - 1 if len(at) else len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.as_py()], file_type), pa.array([block.as_py()], pa.int64()), pa.array([len(at)], pa.int64()), pa.array([head], pa.int64()), pa.array([tail], pa.int64()), pa.array([np.diff(at) - 1], pa.list_(pa.int64()))],
                    names=["file", "block", "n_ends", "head", "tail", "inner"],
                )

    kind = blocks.schema["file"].dataType.simpleString()
    file_type = pa.string() if kind == "string" else pa.int64()
    found = blocks.select("file", "block", "data").mapInArrow(search, f"file {kind}, block long, n_ends long, head long, tail long, inner array<long>")
    found = Scratch(blocks.sparkSession, "separators").keep(found, "summaries")
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A run starts behind each block with a separator; what a run has left open is the tail of that
    # block and all of the blocks without a separator after it.
    numbered = found.select("file", "block", "n_ends", "head", "tail", "inner", F.coalesce(F.sum("n_ends").over(so_far), F.lit(0)).alias("before"))
    run = Window.partitionBy("file", "before").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_tail = F.lag("open_tail").over(Window.partitionBy("file").orderBy("block"))
    numbered = numbered.withColumn("open_tail", F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.lit(0)))
    whole = F.when(F.col("n_ends") == 0, F.col("tail")).otherwise(F.lit(0))
    numbered = numbered.withColumn("carried", F.coalesce(F.sum(whole).over(run), F.lit(0))).withColumn("entered", F.coalesce(last_tail, F.lit(0)))
    carry = F.col("carried") + F.max("entered").over(Window.partitionBy("file", "before").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    stitched = numbered.withColumn("carry", carry)
    ended = stitched.where("n_ends > 0").select(
        "file", "before", F.posexplode(F.concat(F.array(F.col("carry") + F.col("head")), "inner")).alias("k", "n_tokens")
    )
    ended = ended.select("file", (F.col("before") + F.col("k")).alias("ordinal"), "n_tokens")
    total = stitched.groupBy("file").agg(
        F.sum("n_ends").alias("ordinal"), F.max_by(F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("head")), "block").alias("n_tokens")
    )
    return ended.unionByName(total.where("n_tokens > 0").select("file", "ordinal", "n_tokens"))


def document_token_counts(docs: DataFrame, ranks_path: str, separator: int, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens) per document: written as flat token streams, counted by the scan, named by ordinal.

    Null and empty texts have no tokens. Repeated rows each get a row. An id in the text that equals
    the separator cannot occur: the separator is none of the vocabulary's ids.
    """
    scratch = Scratch(docs.sparkSession, "flat")
    blocks = scratch.keep(flat_blocks(docs, ranks_path, separator, block_bytes, id_col), "blocks")
    counts = scan(blocks, separator)
    marked = blocks.select("file", "block", "closed")
    before = F.coalesce(F.sum(F.size("closed")).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    names = marked.withColumn("before", before).select("file", "before", F.posexplode("closed").alias("k", "id")).select("file", (F.col("before") + F.col("k")).alias("ordinal"), "id")
    result = scratch.keep(names.join(counts, ["file", "ordinal"]).select(F.col("id").alias(id_col), "n_tokens"), "result")
    scratch.drop("blocks")
    return result
