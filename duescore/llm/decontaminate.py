"""Benchmark decontamination: a generalised suffix automaton over the normalised
benchmark items; training texts stream through it word by word, the longest match
is tracked, and spans whose match is long enough are hit.

Defined results: null and empty texts have no words and are never hit; items
without words match nothing, and an item with a null id is matched but not listed; repeated rows each get their own row; only the id and
text columns of either table are read, very long texts whole; an empty table of documents
gives an empty result, without items nothing is hit.  The automaton is built for one block of the
benchmark at a time (``block_words``), so what is broadcast is bounded whatever the
benchmark's size; the hits of several blocks are united per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescore.llm.common import ALNUM, Words, slices, staged, with_uid

#: Words of a contaminating window, and of benchmark text in one automaton.
WINDOW = 10
BLOCK_WORDS = 200_000
#: Words of an item kept together in one segment (segments overlap by a window).
SEGMENT_WORDS = 4096


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences (words as small integers)."""

    def __init__(self, window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]
        self.items: dict[int, set] = {}
        self.short: dict[int, set] = {}
        self.up: list[int] = []
        self.shortest = window

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        q = nxt[last].get(c)
        if q is not None and length[q] == length[last] + 1:
            return q
        if q is not None:  # an item before it has this prefix in a longer class: split the class
            return self._clone(last, q, c)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def build(self, segments: list[tuple[object, list[bytes], bool]]) -> SuffixAutomaton:
        """``segments``: (item, words, whole); a whole item shorter than the window is
        one window by itself."""
        coded = [(item, [self.vocab.setdefault(w, len(self.vocab)) for w in words], whole) for item, words, whole in segments]
        for _, words, _ in coded:
            last = 0
            for c in words:
                last = self._extend(last, c)
        for item, words, whole in coded:
            if whole and len(words) < self.window:
                s = 0
                for c in words:
                    s = self.next[s][c]
                self.short.setdefault(s, set()).add((len(words), item))
                self.shortest = min(self.shortest, len(words))
            else:
                for _, s in self._matches(words):
                    self.items.setdefault(s, set()).add(item)
        self.up = [-1] * len(self.link)  # the nearest class on the suffix path, itself included, that is a short item
        for s in sorted(range(1, len(self.link)), key=self.len.__getitem__):
            self.up[s] = s if s in self.short else self.up[self.link[s]]
        return self

    def _matches(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(end, class of the last ``window`` words) wherever the longest match is that long."""
        s = n = 0
        for i, c in enumerate(words):
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.len[s]
            if c in self.next[s]:
                s = self.next[s][c]
                n += 1
            if n >= self.window:
                u = s
                while self.len[self.link[u]] >= self.window:
                    u = self.link[u]
                yield i, u

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set]:
        """([(first, last) word of each hit span], items) of one run of known words."""
        nxt, link, length, up, window, short = self.next, self.link, self.len, self.up, self.window, self.short
        spans: list[tuple[int, int]] = []
        items: set = set()
        s = n = 0
        for i, c in enumerate(words):
            t = nxt[s].get(c)
            while t is None and s:
                s = link[s]
                n = length[s]
                t = nxt[s].get(c)
            if t is None:
                n = 0
                continue
            s = t
            n += 1
            if n >= window:
                spans.append((i - window + 1, i))
                u = s
                while length[link[u]] >= window:
                    u = link[u]
                items |= self.items[u]
            v = up[s]
            while v > 0:
                for size, item in short[v]:
                    if size <= n:
                        spans.append((i - size + 1, i))
                        items.add(item)
                v = up[link[v]] if link[v] > 0 else -1
        return spans, items


def benchmark_segments(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Items as (item, words, whole): long items in overlapping segments that hold
    every window, so no row is unbounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            w = Words(b.column(text_col), ALNUM)
            out: list[tuple] = []
            for r, item in enumerate(b.column(id_col).to_pylist()):
                lo, hi = int(w.row[r]), int(w.row[r + 1])
                words = [w.low[a:e].tobytes() for a, e in zip(w.starts[lo:hi], w.ends[lo:hi])]
                step = SEGMENT_WORDS - window + 1
                for at in range(0, max(len(words) - window + 1, 1), step) if words else ():
                    out.append((item, words[at : at + SEGMENT_WORDS], len(words) <= SEGMENT_WORDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate((b.schema.field(id_col).type, pa.list_(pa.binary()), pa.bool_()))],
                names=["item", "words", "whole"],
            )

    kind = benchmark.schema[id_col].dataType.simpleString()
    return benchmark.select(id_col, text_col).mapInArrow(run, f"item {kind}, words array<binary>, whole boolean")


def word_runs(known: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of known words inside rows that are long enough to hold a match."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(known) + 1, bool)
    edge[row] = True
    starts = np.flatnonzero(known & (edge[:-1] | ~np.r_[False, known[:-1]]))
    ends = np.flatnonzero(known & (edge[1:] | ~np.r_[known[1:], False])) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: ``n_words``, ``n_hit``, ``items`` (item ids with
    occurring windows, as strings, sorted), ``spans`` (merged hit spans as word and
    byte positions) and ``clean_text`` (the text without the hit spans; null stays
    null).  Benchmark items are matched in blocks of ``block_words`` words, one block after
    the other; at most one block's automaton is in the driver and the executors."""
    spark = docs.sparkSession
    segments = staged(benchmark_segments(benchmark, window, item_col, item_text_col), "benchmark-segments")
    total = segments.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if blocks > 1:
        rows = staged(with_uid(rows), "decontaminate-rows")
    else:
        rows = rows.withColumn("_uid", F.lit(0).cast("long"))
    key = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    found = None
    for k in range(blocks):
        block = [(r.item, [bytes(x) for x in r.words], r.whole) for r in segments.where(key == k).toLocalIterator()]
        auto = spark.sparkContext.broadcast(SuffixAutomaton(window).build(block))
        one = _scan(rows, auto, with_text=blocks == 1)
        if blocks > 1:  # a block's hits are written and its automaton released before the next one
            one = staged(one if k == 0 else one.where("n_hit > 0"), "block-hits")
            auto.unpersist()
        found = one if found is None else found.unionByName(one)
    if blocks > 1:
        hits = found.groupBy("_uid").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        found = _unite(rows.join(hits, "_uid"))
    return found.drop("_uid").withColumnRenamed("_id", id_col)


SPANS = "array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>"
SPAN_TYPE = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))


def merge(spans: list[tuple]) -> list[tuple]:
    """Spans that overlap or touch as one, each (first, last word, start, stop byte)."""
    out: list[list] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1] + 1:
            if s[1] > out[-1][1]:
                out[-1][1], out[-1][3] = s[1], s[3]
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


def cut(text: bytes, spans: list[tuple]) -> bytes:
    """``text`` without the spans; what stood on both sides is joined by one space."""
    parts, at = [], 0
    for _, _, a, b in spans:
        parts.append(text[at:a].rstrip())
        at = b
    tail = text[at:]
    return b" ".join([p for p in parts if p] + ([tail.lstrip()] if tail.strip() else []))


def _scan(rows: DataFrame, auto, with_text: bool) -> DataFrame:
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: SuffixAutomaton = auto.value
        for b in slices(batches, "_text"):
            w = Words(b.column("_text"), ALNUM)
            codes, distinct = w.coded()
            ids = np.fromiter((a.vocab.get(x, -1) for x in distinct.to_pylist()), np.int64, len(distinct))
            words = ids[codes] if len(codes) else np.zeros(0, np.int64)
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            starts, ends = word_runs(words >= 0, w.row, a.shortest)
            owner = np.searchsorted(w.row, starts, side="right") - 1
            for r, lo, hi in zip(owner.tolist(), starts.tolist(), ends.tolist()):
                hit, which = a.scan(words[lo:hi].tolist())
                if hit:
                    base, at = lo - int(w.row[r]), int(w.offsets[r])
                    spans.setdefault(r, []).extend(
                        (base + x, base + y, int(w.starts[lo + x]) - at, int(w.ends[lo + y]) - at) for x, y in hit
                    )
                    items.setdefault(r, set()).update(which)
            n = b.num_rows
            merged = [merge(spans[r]) if r in spans else [] for r in range(n)]
            hit_words = np.fromiter((sum(s[1] - s[0] + 1 for s in m) for m in merged), np.int64, n)
            arrays = [
                b.column("_uid"), b.column("_id"), pa.array(w.counts.astype(np.int64)), pa.array(hit_words),
                pa.array([sorted(str(x) for x in items[r] if x is not None) if r in items else [] for r in range(n)], pa.list_(pa.string())),
                pa.array([[dict(zip(("first", "last", "start", "stop"), s)) for s in m] for m in merged], SPAN_TYPE),
            ]
            names = ["_uid", "_id", "n_words", "n_hit", "items", "spans"]
            if with_text:
                texts = b.column("_text")
                if spans:
                    texts = texts.to_pylist()
                    for r in spans:
                        texts[r] = cut(texts[r].encode(), merged[r]).decode()
                    texts = pa.array(texts, pa.string())
                arrays.append(texts)
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.select("_uid", "_id", "_text").mapInArrow(
        run, f"_uid bigint, _id {kind}, n_words bigint, n_hit bigint, items array<string>, spans {SPANS}" + ", clean_text string" * with_text
    )


def _unite(rows: DataFrame) -> DataFrame:
    """Merged spans and cleaned text from the spans of all benchmark blocks."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            texts = b.column("_text").to_pylist()
            merged = [merge([tuple(s.values()) for s in x or ()]) for x in b.column("spans").to_pylist()]
            clean = [t if t is None or not m else cut(t.encode(), m).decode() for t, m in zip(texts, merged)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("_uid"), b.column("_id"), b.column("n_words"),
                    pa.array([sum(s[1] - s[0] + 1 for s in m) for m in merged], pa.int64()), b.column("items"),
                    pa.array([[dict(zip(("first", "last", "start", "stop"), s)) for s in m] for m in merged], SPAN_TYPE), pa.array(clean, pa.string()),
                ],
                names=["_uid", "_id", "n_words", "n_hit", "items", "spans", "clean_text"],
            )

    schema = f"_uid bigint, _id {kind}, n_words bigint, n_hit bigint, items array<string>, spans {SPANS}, clean_text string"
    return rows.select("_uid", "_id", "n_words", "items", "spans", "_text").mapInArrow(run, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated spans: a row whose hit words exceed
    ``max_coverage`` of its words is dropped, in others the spans are cut out.  All
    columns of ``docs`` stay; ``n_chars``, if present, follows the cleaned text."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in names.items() if c != text_col]).alias("_row"), F.col(f"`{text_col}`").alias("_t"))
    out = contamination(packed, benchmark, window, "_row", "_t")
    kept = out.where(~(F.col("n_hit") > max_coverage * F.col("n_words")))
    cols = []
    for c, n in names.items():
        if c == text_col:
            cols.append(F.col("clean_text").alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col("n_hit") > 0, F.length("clean_text").cast(docs.schema[c].dataType)).otherwise(F.col(f"_row.{n}")).alias(c))
        else:
            cols.append(F.col(f"_row.{n}").alias(c))
    return kept.select(*cols)


