"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is projected by several random orthonormal maps, each result is shifted
and quantised, and a Hilbert curve through the cells gives one ordering of all
vectors per map.  Each ordering is cut at quantiles of its keys into blocks; a query
is compared with the vectors of its own block and of the blocks on both sides, the
best of each window are kept, the windows of all orderings merge, and the merged
candidates are ranked by their exact distance.  A cell that holds many vectors is
whole in one block, and no block is empty, so both sides of a dense cell see it.

A block is a fixed share of the vectors, because the recall of a window on a curve
follows from the share of the vectors it covers: it behaves alike at every size.  A
block is worked on in chunks of bounded size, and so are its queries.

Defined results: vectors that are null, zero, hold a null or non-finite component or
have another length than most, and rows with a null id, take no part.  Equal vectors
are one node that carries its smallest ids (one more than the neighbours asked for,
so ties at distance zero are exact); rows that repeat an id and a vector count once.
An empty table gives an empty result; with fewer candidates than asked for, all that
are found are returned.  Only id and vector are read, so clashing names do no harm; there
is no text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duescore.llm.common import staged

ORDERINGS = 16
DIMENSIONS = 8
BITS = 4
#: Blocks of an ordering (three of them are a window), and the least rows of one.
BLOCKS = 36
BLOCK_ROWS = 64
#: Vectors and queries compared at a time.
CHUNK_ROWS = 20_000
CHUNK_QUERIES = 5_000
SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer cells (rows, dimensions), by rotating and
    reflecting from the coarsest bit to the finest, then undoing the Gray code."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level & 1)
    return key


class Curves:
    """The orderings: projections, shifts and the spread of the projected vectors."""

    def __init__(self, length: int, orderings: int = ORDERINGS, dimensions: int = DIMENSIONS, bits: int = BITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.dimensions, self.bits, self.orderings = min(dimensions, length), bits, orderings
        maps = [np.linalg.qr(rng.normal(size=(length, self.dimensions)))[0] for _ in range(orderings)]
        self.map = np.concatenate(maps, axis=1)
        self.shift = rng.uniform(-0.5, 0.5, self.map.shape[1])
        self.mean = np.zeros(self.map.shape[1])
        self.spread = np.ones(self.map.shape[1])

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(orderings, rows) keys: five spreads around the mean fill the cells, moved by the shift."""
        with np.errstate(over="ignore", invalid="ignore"):
            z = np.nan_to_num((vectors @ self.map - self.mean) / self.spread)
        cells = np.clip((z + self.shift + 2.5) / 5, 0, 1 - 1e-9) * (1 << self.bits)
        d = self.dimensions
        return np.stack([hilbert_keys(cells[:, k * d : (k + 1) * d].astype(np.int64), self.bits) for k in range(self.orderings)])


def matrix(column: pa.Array, length: int, kind: str) -> np.ndarray:
    """(rows, length) in double precision from packed vectors."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(-1, length).astype(np.float64)


def taking_part(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def vector_nodes(rows: DataFrame, k: int) -> DataFrame:
    """(node, ids, vec): one row per distinct vector with its k + 1 smallest ids.  The
    rank filter keeps k + 1 rows of a vector in each task before the shuffle, so a
    very common vector is no hot key."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("node"), "ids", "v")


def packed_vectors(nodes: DataFrame, kind: str) -> DataFrame:
    """(node, vec, query): the vector's components as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("v")
            flat = np.ascontiguousarray(values.flatten().to_numpy(zero_copy_only=False).astype(kind))
            length = len(flat) // max(len(values), 1)
            raw = flat.reshape(len(values), length) if len(values) else flat.reshape(0, 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([r.tobytes() for r in raw], pa.binary()), b.column("query")], names=["node", "vec", "query"]
            )

    return nodes.select("node", "v", "query").mapInArrow(run, "node bigint, vec binary, query boolean")


def block_bounds(cuts: list[int]) -> np.ndarray:
    """Last keys of all blocks but the last.  A cell that several quantiles fall into
    is one block's end, and what is left of the share behind it joins the next block,
    so no block (but the last) is smaller than the share."""
    bounds, times = np.unique(np.array(cuts, np.int64), return_counts=True)
    rest = np.zeros(len(bounds), bool)
    rest[1:] = (times[:-1] > 1) & (times[1:] == 1)
    return bounds[~rest]


def spread_of(vectors: DataFrame, curves: Curves, length: int, kind: str) -> Curves:
    """Mean and spread of all projected vectors, from sums that tasks add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = matrix(b.column("vec"), length, kind) @ curves.map
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(y.shape[1])), pa.array(np.full(y.shape[1], len(y))), pa.array(y.sum(0)), pa.array((y * y).sum(0))],
                names=["d", "n", "s", "q"],
            )

    sums = vectors.select("vec").mapInArrow(run, "d bigint, n bigint, s double, q double").groupBy("d").agg(*[F.sum(c).alias(c) for c in "nsq"])
    for r in sums.collect():  # one row per projected dimension
        if np.isfinite(r.s) and np.isfinite(r.q):
            curves.mean[r.d] = r.s / r.n
            curves.spread[r.d] = max(r.q / r.n - (r.s / r.n) ** 2, 0.0) ** 0.5 or 1.0
    return curves


def nearest(rows: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", orderings: int = ORDERINGS, blocks: int = BLOCKS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that
    ``queries`` (a condition on the id, column ``id``) picks."""
    element = rows.schema[vector_col].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    part = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & taking_part(F.col("v")))
    lengths = part.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if lengths is None:
        return rows.sparkSession.createDataFrame([], out)
    length = lengths.n
    part = staged(part.where(F.size("v") == length).distinct(), "vectors")
    asked = part.where(queries)
    nodes = staged(vector_nodes(part, k), "vector-nodes")
    query_nodes = staged(nodes.join(asked.select("v", F.col("id").alias("query_id")), "v").select("node", "query_id"), "query-nodes")
    flagged = nodes.join(query_nodes.select("node").distinct().withColumn("query", F.lit(True)), "node", "left").withColumn("query", F.col("query").isNotNull())
    vectors = staged(packed_vectors(flagged, kind), "packed-vectors")
    total, asked_nodes = vectors.agg(F.count("*"), F.count_if("query")).first()
    blocks = max(1, min(blocks, total // BLOCK_ROWS))
    curves = spread_of(vectors, Curves(length, orderings), length, kind)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = curves.keys(matrix(b.column("vec"), length, kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(orderings, dtype=np.int32), key.shape[1])), pa.array(key.ravel())], names=["ordering", "key"]
            )

    at = [i / blocks for i in range(1, blocks)]
    cuts = [np.zeros(0, np.int64)] * orderings
    if at:
        found = vectors.select("vec").mapInArrow(keys, "ordering int, key bigint").groupBy("ordering").agg(F.percentile_approx("key", at, 10_000).alias("cuts"))
        for r in found.collect():  # block bounds: one row per ordering
            cuts[r.ordering] = block_bounds(r.cuts)
    chunks = max(1, -(-total // (blocks * CHUNK_ROWS)))
    query_chunks = max(1, -(-3 * asked_nodes // (blocks * CHUNK_QUERIES)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every vector to its block (a chunk of it, once for each group of queries), every
        query also to the blocks beside it."""
        for b in batches:
            key = curves.keys(matrix(b.column("vec"), length, kind))
            node = b.column("node").to_numpy()
            is_query = np.flatnonzero(b.column("query").to_numpy(zero_copy_only=False))
            for o in range(orderings):
                block = np.searchsorted(cuts[o], key[o], side="left")
                every = np.arange(len(node))
                rows_at = [(every, block, every * 0 + g, node % chunks, False) for g in range(query_chunks)]
                for side in (-1, 0, 1):
                    near = block[is_query] + side
                    inside = is_query[(near >= 0) & (near <= len(cuts[o]))]
                    rows_at += [(inside, block[inside] + side, node[inside] % query_chunks, inside * 0 + c, True) for c in range(chunks)]
                for index, to, group, chunk, query in rows_at:
                    if len(index):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(index), o, np.int32)), pa.array(to.astype(np.int32)), pa.array(group.astype(np.int32)), pa.array(chunk.astype(np.int32)),
                             pa.array(np.full(len(index), not query)), pa.array(node[index]), b.column("vec").take(pa.array(index))],
                            names=["ordering", "block", "group", "chunk", "candidate", "node", "vec"],
                        )

    cell = ["ordering", "block", "group", "chunk"]
    dealt = vectors.mapInArrow(deal, "ordering int, block int, `group` int, chunk int, candidate boolean, node bigint, vec binary")
    dealt = dealt.repartitionByRange(*cell).sortWithinPartitions(*cell, "candidate")
    best = dealt.mapInArrow(lambda batches: windows(batches, length, kind, k), "query bigint, node bigint, score double")
    # Merge the windows of all orderings: each candidate once, the k + 1 best nodes of a query.
    merged = best.groupBy("query", "node").agg(F.min("score").alias("score"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("score", "node"))
    few = staged(merged.withColumn("nth", nth).where(F.col("nth") <= k + 1).select("query", "node", "score"), "nearest-nodes")
    ids = few.join(nodes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = query_nodes.withColumnRenamed("node", "query").join(ids, "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def windows(batches: Iterator[pa.RecordBatch], length: int, kind: str, k: int) -> Iterator[pa.RecordBatch]:
    """The k + 1 best candidates of each query in each cell; rows come cell by cell, the
    queries of a cell before its candidates."""
    cell: tuple | None = None
    asked: list[tuple[np.ndarray, np.ndarray]] = []
    q_node = q_vec = best = None

    def done() -> Iterator[pa.RecordBatch]:
        if best is not None:
            node, score = best
            ok = np.isfinite(score)
            query = np.broadcast_to(q_node[:, None], node.shape)
            yield pa.RecordBatch.from_arrays([pa.array(query[ok]), pa.array(node[ok]), pa.array(score[ok])], names=["query", "node", "score"])

    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(c).to_numpy() for c in ("ordering", "block", "group", "chunk")], 1)
        candidate = b.column("candidate").to_numpy(zero_copy_only=False)
        node, vec = b.column("node").to_numpy(), matrix(b.column("vec"), length, kind)
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1) | (candidate[1:] != candidate[:-1])])
        for lo, hi in zip(new, np.r_[new[1:], b.num_rows]):
            here = tuple(keys[lo])
            if here != cell:
                yield from done()
                cell, asked, best = here, [], None
            if not candidate[lo]:
                asked.append((node[lo:hi], vec[lo:hi]))
                continue
            if not asked:
                continue
            if best is None:
                q_node, q_vec = (np.concatenate(x) for x in zip(*asked))
                best = (np.zeros((len(q_node), 0), np.int64), np.zeros((len(q_node), 0)))
            best = closest(best, q_vec, node[lo:hi], vec[lo:hi], k + 1)
    yield from done()


def closest(best: tuple[np.ndarray, np.ndarray], q: np.ndarray, node: np.ndarray, vec: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of ``best`` and of new candidates for each query: picked by an
    expanded product with some to spare, then measured exactly."""
    out_node, out_score = [], []
    for lo in range(0, len(q), 256):
        part = q[lo : lo + 256]
        rough = (vec * vec).sum(1)[None] - 2 * part @ vec.T
        spare = min(k + 8, len(vec))
        pick = np.argpartition(rough, spare - 1, axis=1)[:, :spare]
        score = np.sqrt(((part[:, None, :] - vec[pick]) ** 2).sum(2))
        ids = np.concatenate([best[0][lo : lo + 256], node[pick]], 1)
        score = np.concatenate([best[1][lo : lo + 256], score], 1)
        order = np.lexsort((ids, score), axis=1)[:, :k]
        out_node.append(np.take_along_axis(ids, order, 1))
        out_score.append(np.take_along_axis(score, order, 1))
    width = min(x.shape[1] for x in out_node)
    return np.concatenate([x[:, :width] for x in out_node]), np.concatenate([x[:, :width] for x in out_score])
