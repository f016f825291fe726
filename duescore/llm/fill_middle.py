"""Fill-in-middle transformation with a learned rank index of token boundaries.

A text is cut into tokens (a run of ASCII letters, or any other single character).
The offsets of all token boundaries of a slice of texts are indexed by their rank:
a greedy cone fits straight segments that miss no boundary by more than
``ERROR`` bytes, and the miss of each boundary is stored as one signed byte.  The
offset of the k-th token is then the segment's prediction plus the stored miss, which
is exact; a text of any length costs one byte per boundary and its few segments
beside its own bytes, and its boundaries are found a block at a time.

Hashes of the id pick two cuts and a form: ``psm`` (prefix, suffix, middle), ``spm``
(suffix, prefix, middle) or ``plain``.  One narrow pass, no shuffle.

Defined results: a null text is the empty text; an empty text, one that holds a marker
and a share of the others stay plain, with null counts; a null id hashes as the empty
text.  Repeated rows give repeated results, ties do not arise (the cuts may be equal,
which leaves an empty middle).  Very long texts are treated whole.  An empty table
gives an empty result.  Only the id and the text are read, so further columns of any
name neither clash nor come along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescore.llm.common import slices, text_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes that a segment may miss a boundary by (with rounding, it fits a signed byte).
ERROR = 126
#: Bytes searched for boundaries at a time.
BLOCK_BYTES = 1 << 20
PLAIN_FROM = 90
SPM_BELOW = 20

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = True
LETTER[0x61:0x7B] = True


class RankIndex:
    """Offset of the boundary of any rank, from error-bounded straight segments."""

    def __init__(self) -> None:
        self.size = 0
        self._first: list[int] = []
        self._base: list[int] = []
        self._slope: list[float] = []
        self._miss: list[np.ndarray] = []

    def extend(self, offsets: np.ndarray) -> None:
        """Add rising offsets; segments do not reach from one call into the next."""
        lo = 0
        while lo < len(offsets):
            slope, count = self._cone(offsets, lo)
            here = offsets[lo : lo + count]
            guess = here[0] + np.rint(slope * np.arange(count)).astype(np.int64)
            self._first.append(self.size + lo)
            self._base.append(int(here[0]))
            self._slope.append(slope)
            self._miss.append((here - guess).astype(np.int8))
            lo += count
        self.size += len(offsets)

    @staticmethod
    def _cone(offsets: np.ndarray, lo: int) -> tuple[float, int]:
        """(slope, count) of the longest run from ``lo`` that one line through its first
        point follows within ERROR: the slopes that every point allows narrow as a cone."""
        ahead = 64
        while True:
            rise = offsets[lo + 1 : lo + 1 + ahead] - offsets[lo]
            if not len(rise):
                return 0.0, 1
            step = np.arange(1, len(rise) + 1)
            least = np.maximum.accumulate((rise - ERROR) / step)
            most = np.minimum.accumulate((rise + ERROR) / step)
            closed = least > most
            if closed[-1]:
                held = int(closed.argmax())
            elif len(rise) == ahead:
                ahead *= 8
                continue
            else:
                held = len(rise)
            return float((least[held - 1] + most[held - 1]) / 2), held + 1

    def close(self) -> RankIndex:
        self.first = np.array(self._first, np.int64)
        self.base = np.array(self._base, np.int64)
        self.slope = np.array(self._slope)
        self.miss = np.concatenate(self._miss) if self._miss else np.zeros(0, np.int8)
        return self

    def at(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of these ranks."""
        k = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[k] + np.rint(self.slope[k] * (ranks - self.first[k])).astype(np.int64) + self.miss[ranks]


def boundary_index(data: np.ndarray, rows: np.ndarray) -> tuple[RankIndex, np.ndarray]:
    """(index of all token starts and the end of ``data``, rank at each row offset)."""
    index, rank = RankIndex(), np.zeros(len(rows), np.int64)
    before = False
    for lo in range(0, len(data), BLOCK_BYTES):
        block = data[lo : lo + BLOCK_BYTES]
        hi = lo + len(block)
        letter = LETTER[block]
        inside = letter.copy()
        inside[1:] &= letter[:-1]
        inside[0] &= before
        before = bool(letter[-1])
        inside |= (block & 0xC0) == 0x80
        a, b = np.searchsorted(rows, [lo, hi])
        inside[rows[a:b] - lo] = False
        starts = np.flatnonzero(~inside) + lo
        rank[a:b] = index.size + np.searchsorted(starts, rows[a:b])
        index.extend(starts)
    rank[rows == len(data)] = index.size
    index.extend(np.array([len(data)]))
    return index.close(), rank


def id_hashes(id_col: Column) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of ``1:`` and the id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


OUT = "id bigint, n bigint, form string, output string, prefix_chars bigint, middle_chars bigint"


def transform(batches: Iterator[pa.RecordBatch], plain_from: int, spm_below: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        data, rows = text_buffer(b.column("text"))
        index, rank = boundary_index(data, rows)
        n = np.diff(rank)
        h1, h2, h3, h4 = (b.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
        cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
        at = index.at(rank[:-1] + cuts)
        form, output, prefix_chars, middle_chars = [], [], [], []
        raw = data.tobytes()
        for k in range(len(n)):
            text = raw[rows[k] : rows[k + 1]]
            if not text or h3[k] % 100 >= plain_from or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
                form.append("plain")
                output.append(text)
                prefix_chars.append(None)
                middle_chars.append(None)
                continue
            i, j = at[0, k] - rows[k], at[1, k] - rows[k]
            prefix, middle, suffix = text[:i], text[i:j], text[j:]
            spm = h4[k] % 100 < spm_below
            form.append("spm" if spm else "psm")
            first, second = ((b"<S>", suffix), (b"<P>", prefix)) if spm else ((b"<P>", prefix), (b"<S>", suffix))
            output.append(b"".join((*first, *second, b"<M>", middle)))
            prefix_chars.append(len(prefix.decode()))
            middle_chars.append(len(middle.decode()))
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(n), pa.array(form, pa.string()), pa.array(output, pa.binary()).cast(pa.string()),
             pa.array(prefix_chars, pa.int64()), pa.array(middle_chars, pa.int64())],
            names=["id", "n", "form", "output", "prefix_chars", "middle_chars"],
        )


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """(id, n, form, output, prefix_chars, middle_chars) of every row."""
    key = F.col(id_col).cast("long")
    narrow = docs.select(key.alias("id"), F.col(text_col).cast("string").alias("text"), *id_hashes(key))
    return narrow.mapInArrow(lambda batches: transform(batches, plain_from, spm_below), OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed output was made of.  No text in psm or spm form holds a
    marker, so each marker stands once and cannot overlap the text beside it."""
    head = F.substring_index(output, MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)

    def halves(marker: str) -> tuple[Column, Column]:
        return F.substring_index(head, marker, 1).substr(F.lit(len(PREFIX) + 1), F.length(output)), F.substring_index(head, marker, -1)

    prefix, suffix = halves(SUFFIX)
    late_suffix, late_prefix = halves(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(late_prefix, middle, late_suffix))
        .otherwise(output)
    )
