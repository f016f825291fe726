"""Token counts from flat token files by a separator scan.

A token file is nothing but ids of a fixed width, documents one after the other with
an end-of-document id after each; there is no index.  It is read in blocks of a fixed
number of ids that ignore document boundaries.  In every block the end ids are found
by one vectorised comparison; a prefix scan over the blocks of a file then gives each
block the place where it starts, the number of documents before it and the end of the
last one, which stitches documents that cross blocks, however many.

Defined results: ids after the last end id of a file belong to no document; a document
may have no ids; null and empty texts are documents of no ids; repeated rows are
documents of their own.  An empty table gives an empty result.  A very long text goes over
as many blocks as it needs.  Only the id and the text are read, so clashing names do no
harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duescore.llm.common import slices, stage_path
from duescore.llm.tokens import Encoder, vocabulary_path

WIDTH = "<u2"
#: The vocabulary's own end-of-text id; texts are encoded so that it never occurs in them.
END_ID = 50256
BLOCK_IDS = 1 << 18
#: Blocks of a file that a task reads at a time.
READ_BLOCKS = 64


def write_token_stream(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the documents as one flat stream of ids per task, cut into blocks: rows
    (stream, block, data, ids_ended); the last column, which the scan never reads,
    names the documents that end in the block."""
    vocab = vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocab, added=False)
        stream = TaskContext.get().partitionId()
        rest = np.zeros(0, WIDTH)
        names: list[pa.Array] = []
        block = 0
        kind = None

        def cut(data: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal block, names, rest
            ended = pa.concat_arrays(names) if names else pa.array([], kind)
            at = used = 0
            while len(data) - at >= block_ids or (last and at < len(data)):
                part = data[at : at + block_ids]
                at += len(part)
                n = int((part == END_ID).sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([stream], pa.int64()), pa.array([block], pa.int64()), pa.array([part.tobytes()], pa.binary()), pa.array([ended.slice(used, n).to_pylist()], pa.list_(kind))],
                    names=["stream", "block", "data", "ids_ended"],
                )
                used += n
                block += 1
            rest, names = data[at:], [ended.slice(used)]

        for b in slices(batches, text_col):
            kind = b.schema.field(id_col).type
            ids, row = encoder.encode(b.column(text_col))
            names.append(b.column(id_col))
            yield from cut(np.concatenate([rest, np.insert(ids, row[1:], END_ID).astype(WIDTH)]), False)
        if len(rest):
            yield from cut(rest, True)

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"stream bigint, block bigint, data binary, ids_ended array<{kind}>")
    out.write.option("compression", "zstd").parquet(path)


def file_blocks(spark: SparkSession, path: str, width: str = WIDTH, block_ids: int = BLOCK_IDS, read_blocks: int = READ_BLOCKS) -> DataFrame:
    """Blocks (stream, block, data) of flat binary token files; the stream is the file's name.

    Files are cut by their lengths into ranges of ``read_blocks`` blocks, and a task reads
    the bytes of its ranges alone, so a file of any size is read by many tasks."""
    step = block_ids * np.dtype(width).itemsize
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("stream"), "length").where("length > 0")
    last = F.floor((F.col("length") - 1) / step)
    ranges = files.select("stream", "length", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(read_blocks).cast("long"))).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for name, length, first in zip(*(b.column(c).to_pylist() for c in ("stream", "length", "first"))):
                local = name.startswith("file:")
                system, file = (fs.LocalFileSystem(), re.sub("^file:/+", "/", name)) if local else fs.FileSystem.from_uri(quote(name, safe=":/@+=,~"))
                with system.open_input_file(file) as f:
                    for k in range(first, min(first + read_blocks, -(-length // step))):
                        data = f.read_at(min(step, length - k * step), k * step)
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int64()), pa.array([data], pa.binary())], names=["stream", "block", "data"])

    return ranges.repartition("stream", "first").mapInArrow(run, "stream string, block bigint, data binary")


def block_ends(blocks: DataFrame, end_id: int = END_ID, width: str = WIDTH) -> DataFrame:
    """(stream, block, n_ids, ends): the places of the end ids in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends, sizes = [], []
            for data in b.column("data"):
                ids = np.frombuffer(data.as_buffer(), width)
                ends.append(np.flatnonzero(ids == end_id).astype(np.int32))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [b.column("stream"), b.column("block"), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int32()))], names=["stream", "block", "n_ids", "ends"]
            )

    kind = blocks.schema["stream"].dataType.simpleString()
    return blocks.select("stream", "block", "data").mapInArrow(run, f"stream {kind}, block bigint, n_ids bigint, ends array<int>")


def token_counts(blocks: DataFrame, end_id: int = END_ID, width: str = WIDTH) -> DataFrame:
    """(stream, nth, block, nth_in_block, start, n_tokens): every ended document of each
    stream, its first id's place in the stream and its number of ids."""
    before = Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    scanned = block_ends(blocks, end_id, width)
    scanned = scanned.withColumn("from", F.coalesce(F.sum("n_ids").over(before), zero))
    scanned = scanned.withColumn("docs_before", F.coalesce(F.sum(F.size("ends")).over(before), zero))
    last = F.when(F.size("ends") > 0, F.col("from") + F.element_at("ends", -1))
    scanned = scanned.withColumn("last", last).withColumn("open_from", F.coalesce(F.max("last").over(before) + 1, zero))
    each = scanned.select(
        "stream", "block", "docs_before", "open_from", "from", "ends", F.posexplode("ends").alias("nth_in_block", "end")
    )
    start = F.when(F.col("nth_in_block") == 0, F.col("open_from")).otherwise(F.col("from") + F.get("ends", F.col("nth_in_block") - 1) + 1)
    return each.select(
        "stream", (F.col("docs_before") + F.col("nth_in_block")).alias("nth"), "block", "nth_in_block", start.alias("start"),
        (F.col("from") + F.col("end") - start).alias("n_tokens"),
    )


def document_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Writes the documents as flat token streams and counts the tokens of each by the
    scan: id, stream, nth, start, n_tokens.  The names of the documents come from the
    column beside the data, by block and place."""
    spark = docs.sparkSession
    path = stage_path(spark, "token-stream")
    write_token_stream(docs, path, vocabulary, id_col=id_col, text_col=text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    stored = spark.read.schema(f"stream bigint, block bigint, data binary, ids_ended array<{kind}>").parquet(path)
    names = stored.select("stream", "block", F.posexplode("ids_ended").alias("nth_in_block", id_col))
    return token_counts(stored).join(names, ["stream", "block", "nth_in_block"]).select(id_col, "stream", "nth", "start", "n_tokens")
