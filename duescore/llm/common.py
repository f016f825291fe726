"""Helpers shared by the operators: stage tables in the cluster's shared folder
and vectorised word finding over Arrow text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duescore.session import ensure_checkpoint_dir

#: Text bytes worked on at a time inside a task (a longer single text is one slice).
SLICE_BYTES = 2 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local session without one gets its own."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/llm-stages/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet stage table in the shared folder and read it back:
    lineage is cut, a lost executor costs one task, and each row is made once."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_uid(df: DataFrame, name: str = "_uid") -> DataFrame:
    """A row number unique within this scan, for rows whose ids may be null or repeated.
    Only stable once the rows are written, so callers stage the result."""
    return df.withColumn(name, F.monotonically_increasing_id())


# --- words in Arrow text columns -------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Byte classes. UTF-8 bytes from 0x80 on only occur in characters outside ASCII,
#: which both word rules count as part of a word, so bytes can be classified alone.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[offsets[0] : offsets[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``most`` bytes of text, so that the working
    arrays of a task stay bounded (one text longer than that is a run of its own)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        lo = 0
        while lo < b.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi
    pa.default_memory_pool().release_unused()  # a worker lives on after its task


class Words:
    """Words of a text column: maximal runs of bytes of a class after A-Z are lower-cased.

    ``starts``/``ends`` are byte positions in ``low`` (the lower-cased bytes of all
    rows), ``row`` the offsets of each row's words in these arrays."""

    def __init__(self, texts: pa.Array, word_class: np.ndarray):
        data, self.offsets = text_buffer(texts)
        self.low = LOWER[data]
        self.mask = word_class[self.low]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = self.mask[:-1]
        self.starts = np.flatnonzero(self.mask & (~before | edge[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = self.mask[1:]
        self.ends = np.flatnonzero(self.mask & (~after | edge[1:])) + 1
        self.row = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """(code of each word, the distinct words as binary)."""
        if not len(self):
            return np.zeros(0, np.int32), pa.array([], pa.binary())
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        arr = pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.low[self.mask])])
        d = arr.dictionary_encode()
        return d.indices.to_numpy(), d.dictionary

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words of each row joined by one space (rows follow each other without
        one), with each word's start and end in that string."""
        keep = self.mask.copy()
        low = self.low.copy()
        inner = np.ones(len(self), bool)
        last = self.row[1:][self.counts > 0] - 1
        inner[last] = False
        gaps = self.ends[inner]
        keep[gaps] = True
        low[gaps] = 0x20
        size = self.ends - self.starts
        ends = np.cumsum(size + inner) - inner
        return low[keep].tobytes(), ends - size, ends
