"""Hard-negative mining with spanning-tree bounds between anchors.

Anchors are grouped by their nearest pivot into trees of bounded size, and each tree is
the minimum spanning tree of its anchors.  A task that scans candidates scores them at
a tree's root and goes down level by level: a candidate's score at a child is its score
at the parent plus or minus the edge's length times the candidate's norm.  Only
candidates whose interval overlaps a window that still counts are scored again, so the
result is exact whatever the bounds exclude.

Two scans: the first finds each anchor's best rows of its own label (the positives; the
window is open above and starts at the worst of those kept), the second the best rows
of other labels between two shares of each positive's score.  The trees of at most
about ``BLOCK_ANCHORS`` anchors are broadcast at a time; every such block is one pass
over all rows, written and released before the next.  A task keeps the best rows of
each window, so no row of a hot label is shuffled but those.

Defined results: rows with a null id or label, a null or empty vector, a null or
non-finite component or another vector length than most take no part.  Ties go to the
smaller id, then to the row read first; rows that repeat an id count one by one, and a
repeated anchor has results of its own.  Scores beyond a long are cut to its range.  An
empty table, or one without anchors, gives an empty result.  Only id, label and vector
are read, so further columns of any name do not clash; there is no text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duescore.llm.common import staged, with_uid

#: Anchors of a tree on average, anchors of a pass, and pivots that group anchors.
TREE_ANCHORS = 256
BLOCK_ANCHORS = 8_192
PIVOTS = 256
#: Candidates of a step.
CHUNK_ROWS = 2_048
#: A level is scored as a whole where more than this share of it needs scores.
DENSE = 0.2
NEVER = np.iinfo(np.int64).min


def whole_units(vec: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(vec * scale))


def products(a: np.ndarray, x: np.ndarray, paired: bool = False) -> np.ndarray:
    """Exact integer inner products of whole-valued doubles: of all rows of ``a`` with all
    of ``x``, or row by row."""
    def dot(a: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (a * x).sum(1) if paired else a @ x.T

    if not len(a) or not len(x):
        return np.zeros(len(a) if paired else (len(a), len(x)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(x).max()) * a.shape[1]
    if most < 2.0**53:
        return dot(a, x).astype(np.int64)
    if most < 2.0**62:
        return dot(a.astype(np.int64), x.astype(np.int64))
    whole = np.vectorize(int, otypes=[object])
    exact = dot(whole(a), whole(x))
    return np.clip(exact, NEVER + 1, np.iinfo(np.int64).max).astype(np.int64)


def spanning_tree(vec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge, depth): rows of the minimum spanning tree from its medoid, by
    depth; ``parent`` is a place in that order, and the root's parent is itself."""
    m = len(vec)
    with np.errstate(over="ignore", invalid="ignore"):
        sq = (vec * vec).sum(1)
        dist = np.clip(np.nan_to_num(sq[:, None] + sq - 2 * (vec @ vec.T), nan=1e300, posinf=1e300), 0, 1e300)
    root = int(dist.mean(1).argmin())
    parent, depth = np.full(m, root), np.zeros(m, np.int64)
    near = dist[root].copy()
    near[root] = np.inf
    done = np.zeros(m, bool)
    done[root] = True
    for _ in range(m - 1):
        k = int(near.argmin())
        done[k] = True
        near[k] = np.inf
        depth[k] = depth[parent[k]] + 1
        closer = ~done & (dist[k] < near)
        near[closer] = dist[k][closer]
        parent[closer] = k
    order = np.argsort(depth, kind="stable")
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    with np.errstate(over="ignore", invalid="ignore"):
        edge = np.sqrt(((vec[order] - vec[parent[order]]) ** 2).sum(1))
    return order, place[parent[order]], edge, depth[order]


@dataclass
class Tree:
    """Anchors in the order of their depth."""

    uid: np.ndarray
    id: np.ndarray
    label: np.ndarray
    vec: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    depth: np.ndarray

    def scores(self, x: np.ndarray, wanted: Callable[[slice, np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(score, known) of every anchor and row of ``x``.  ``wanted`` says for a level of
        anchors, from the least and largest scores possible, which are needed."""
        shape = (len(self.uid), len(x))
        score, known = np.zeros(shape, np.int64), np.zeros(shape, bool)
        low, high = np.zeros(shape), np.zeros(shape)
        with np.errstate(over="ignore", invalid="ignore"):
            norm = np.sqrt((x * x).sum(1))
            ends = np.r_[np.flatnonzero(np.diff(self.depth)) + 1, shape[0]]
            lo = 0
            for hi in ends:
                level, up = slice(lo, hi), self.parent[lo:hi]
                lo = hi
                if self.depth[level.start] == 0:
                    need = np.ones((1, shape[1]), bool)
                else:
                    reach = self.edge[level, None] * norm * (1 + 1e-9) + 1
                    low[level] = np.nan_to_num(low[up] - reach, nan=-np.inf)
                    high[level] = np.nan_to_num(high[up] + reach, nan=np.inf)
                    need = wanted(level, low[level], high[level])
                if need.mean() > DENSE:
                    exact, need = products(self.vec[level], x), np.ones_like(need)
                    score[level], known[level] = exact, True
                    low[level] = exact - np.abs(exact) * 1e-15
                    high[level] = exact + np.abs(exact) * 1e-15
                else:
                    a, k = np.nonzero(need)
                    exact = products(self.vec[level][a], x[k], paired=True)
                    score[level][a, k], known[level][a, k] = exact, True
                    low[level][a, k] = exact - np.abs(exact) * 1e-15
                    high[level][a, k] = exact + np.abs(exact) * 1e-15
        return score, known


class Best:
    """The first ``k`` rows of each group by falling score, then id, then row."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.score = np.full((groups, k), NEVER)
        self.id = np.zeros((groups, k), np.int64)
        self.uid = np.zeros((groups, k), np.int64)

    @property
    def last(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, uid: np.ndarray) -> None:
        """Rows ``ids``/``uid`` for all groups; ``allowed`` says which count where."""
        score = np.where(allowed, score, NEVER)
        least = self.last
        if score.shape[1] > self.k:
            least = np.maximum(least, np.partition(score, score.shape[1] - self.k, axis=1)[:, -self.k])
        g, k = np.nonzero(allowed & (score >= least[:, None]))
        if not len(g):
            return
        hit = np.unique(g)
        old_g, old_k = np.nonzero(self.score[hit] > NEVER)
        old_g = hit[old_g]
        g, s = np.r_[old_g, g], np.r_[self.score[old_g, old_k], score[g, k]]
        i, u = np.r_[self.id[old_g, old_k], ids[k]], np.r_[self.uid[old_g, old_k], uid[k]]
        order = np.lexsort((u, i, -s, g))
        g, s, i, u = g[order], s[order], i[order], u[order]
        place = np.arange(len(g)) - np.searchsorted(g, g)
        keep = place < self.k
        at = g[keep], place[keep]
        self.score[at], self.id[at], self.uid[at] = s[keep], i[keep], u[keep]


def chunks(batches: Iterator[pa.RecordBatch], kind: str, length: int, scale: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(uid, id, label, vec) of at most CHUNK_ROWS rows."""
    for b in batches:
        for lo in range(0, b.num_rows, CHUNK_ROWS):
            c = b.slice(lo, CHUNK_ROWS)
            yield c.column("uid").to_numpy(), c.column("id").to_numpy(), c.column("label").to_numpy(), unpacked(c.column("vec"), kind, length, scale)


def unpacked(column: pa.Array, kind: str, length: int, scale: float) -> np.ndarray:
    vec = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, length).astype(np.float64)
    return whole_units(vec, scale)


def scan_positives(rows: Iterator[tuple[np.ndarray, ...]], trees: list[Tree], k: int) -> list[Best]:
    """The best rows of each anchor's own label, the anchor itself left out."""
    best = [Best(len(t.uid), k) for t in trees]
    for uid, ids, label, x in rows:
        for tree, top in zip(trees, best):
            own = (tree.label[:, None] == label) & (tree.uid[:, None] != uid)
            score, known = tree.scores(x, lambda level, low, high: own[level] & (high >= top.last[level, None]))
            top.add(score, own & known, ids, uid)
    return best


def scan_negatives(rows: Iterator[tuple[np.ndarray, ...]], trees: list[Tree], windows: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[Best]]:
    """For each tree and rank of positive, the best rows of other labels with a score in
    the anchor's window (least, most); an empty window has least above most."""
    best = [[Best(len(t.uid), k) for _ in range(least.shape[1])] for t, (least, _) in zip(trees, windows)]
    for uid, ids, label, x in rows:
        for tree, (least, most), tops in zip(trees, windows, best):
            other = tree.label[:, None] != label

            def wanted(level: slice, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                need = np.zeros(low.shape, bool)
                for r, top in enumerate(tops):
                    need |= (high >= np.maximum(least[level, r], top.last[level])[:, None]) & (low <= most[level, r, None])
                return need & other[level]

            score, known = tree.scores(x, wanted)
            for r, top in enumerate(tops):
                top.add(score, other & known & (score >= least[:, r, None]) & (score <= most[:, r, None]), ids, uid)
    return best


def rows_taking_part(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, str, int]:
    """(uid, id, label, vec as bytes), the kind of a component and the vectors' length."""
    element = rows.schema[vector_col].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    v = F.col("v") if kind == "<f4" else F.col("v").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    part = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    part = part.select("id", "label", v.alias("v")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False))
    )
    lengths = part.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    length = lengths.n if lengths else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.ascontiguousarray(b.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind)).reshape(b.num_rows, length)
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("id"), b.column("label"), pa.array([r.tobytes() for r in flat], pa.binary())], names=["uid", "id", "label", "vec"]
            )

    packed = with_uid(part.where(F.size("v") == length), "uid").select("uid", "id", "label", "v").mapInArrow(pack, "uid bigint, id bigint, label bigint, vec binary")
    return staged(packed, "mining-rows"), kind, length


TREES = "block int, uid bigint, id bigint, label bigint, vec binary, tree bigint, place int, parent int, edge double, depth int"


def anchor_trees(anchors: DataFrame, kind: str, length: int, scale: float, total: int) -> tuple[DataFrame, int]:
    """(table of the anchors' spanning trees by block, number of blocks)."""
    pivots = max(1, min(PIVOTS, total // TREE_ANCHORS))
    picked = anchors.orderBy(F.xxhash64("uid"), "uid").limit(pivots).select("vec").toArrow()  # at most PIVOTS rows
    pivot_vec = unpacked(picked.column("vec").combine_chunks(), kind, length, scale)
    with np.errstate(over="ignore"):
        half = (pivot_vec * pivot_vec).sum(1) / 2

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            with np.errstate(over="ignore", invalid="ignore"):
                at = np.nan_to_num(unpacked(b.column("vec"), kind, length, scale) @ pivot_vec.T - half).argmax(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int64))], names=[*b.schema.names, "pivot"])

    near = staged(anchors.mapInArrow(nearest, "uid bigint, id bigint, label bigint, vec binary, pivot bigint"), "anchor-pivots")
    sizes = near.groupBy("pivot").agg(F.ceil(F.count("*") / TREE_ANCHORS).alias("parts"))  # at most PIVOTS rows
    blocks = max(1, -(-total // BLOCK_ANCHORS))
    dealt = near.join(F.broadcast(sizes), "pivot").withColumn("tree", F.col("pivot") + PIVOTS * F.pmod(F.xxhash64("uid"), "parts"))
    dealt = dealt.select("uid", "id", "label", "vec", "tree", F.pmod(F.xxhash64("tree"), F.lit(blocks)).cast("int").alias("block"))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("uid").combine_chunks()
        order, parent, edge, depth = spanning_tree(unpacked(t.column("vec").combine_chunks(), kind, length, scale))
        t = t.take(pa.array(order))
        out = [t.column(c) for c in ("block", "uid", "id", "label", "vec", "tree")]
        out += [pa.array(np.arange(len(order), dtype=np.int32)), pa.array(parent.astype(np.int32)), pa.array(edge), pa.array(depth.astype(np.int32))]
        return pa.table(out, names=[c.split()[0] for c in TREES.split(", ")])

    return staged(dealt.groupBy("tree").applyInArrow(build, TREES), "anchor-trees"), blocks


def unpacked_trees(t: pa.Table, kind: str, length: int, scale: float) -> list[Tree]:
    t = t.sort_by([("tree", "ascending"), ("place", "ascending")]).combine_chunks()
    col = {c: t.column(c).to_numpy() for c in ("uid", "id", "label", "tree", "parent", "edge", "depth")}
    vec = unpacked(t.column("vec").combine_chunks() if t.num_rows else pa.array([], pa.binary()), kind, length, scale)
    at = np.r_[np.flatnonzero(np.diff(col["tree"], prepend=-1)), t.num_rows]
    return [
        Tree(*(col[c][a:b] for c in ("uid", "id", "label")), vec[a:b], *(col[c][a:b] for c in ("parent", "edge", "depth")))
        for a, b in zip(at[:-1], at[1:])
    ]


POSITIVES = "anchor_uid bigint, anchor_id bigint, score bigint, id bigint, uid bigint"
NEGATIVES = "anchor_uid bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, score bigint, id bigint, uid bigint"


def best_rows(tops: Best, fields: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """The kept rows of every group beside the group's fields."""
    g, k = np.nonzero(tops.score > NEVER)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(f[g]) for f in fields), *(pa.array(a[g, k]) for a in (tops.score, tops.id, tops.uid))], names=[*names, "score", "id", "uid"]
    )


def first_rows(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id", "uid"))
    return found.withColumn(name, nth).where(F.col(name) <= k)


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
    scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each
    row that ``anchors`` (a condition on the columns ``id`` and ``label``) picks, and each of
    its positives, the rows of other labels whose score lies between two shares of the
    positive's."""
    spark = rows.sparkSession
    part, kind, length = rows_taking_part(rows, id_col, vector_col, label_col)
    picked = staged(part.where(anchors), "anchors")
    total = picked.count()
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not total:
        return spark.createDataFrame([], out)
    trees, blocks = anchor_trees(picked, kind, length, scale, total)
    done = []
    for block in range(blocks):
        here = spark.sparkContext.broadcast(unpacked_trees(trees.where(F.col("block") == block).toArrow(), kind, length, scale))

        def positive_rows(batches: Iterator[pa.RecordBatch], here=here) -> Iterator[pa.RecordBatch]:
            for tree, top in zip(here.value, scan_positives(chunks(batches, kind, length, scale), here.value, positives)):
                yield best_rows(top, [tree.uid, tree.id], ["anchor_uid", "anchor_id"])

        near = staged(first_rows(staged(part.mapInArrow(positive_rows, POSITIVES), "near-rows"), ["anchor_uid"], positives, "place"), "positives")
        kept = near.select("anchor_uid", "place", "id", "score").toArrow()  # at most `positives` a broadcast anchor
        found = spark.sparkContext.broadcast({c: kept.column(c).to_numpy() for c in kept.column_names})

        def negative_rows(batches: Iterator[pa.RecordBatch], here=here, found=found) -> Iterator[pa.RecordBatch]:
            trees, windows, own = here.value, [], []
            for t in trees:
                ids, score = positives_of(t, found.value, positives)
                own.append((ids, score))
                windows.append(score_windows(score, least_percent, most_percent))
            for t, (ids, score), tops in zip(trees, own, scan_negatives(chunks(batches, kind, length, scale), trees, windows, negatives)):
                for r, top in enumerate(tops):
                    fields = [t.uid, t.id, np.full(len(t.uid), r, np.int32), ids[:, r], score[:, r]]
                    yield best_rows(top, fields, ["anchor_uid", "anchor_id", "place", "positive_id", "positive_score"])

        done.append(staged(first_rows(staged(part.mapInArrow(negative_rows, NEGATIVES), "far-rows"), ["anchor_uid", "place"], negatives, "rank"), "negatives"))
        here.unpersist()
        found.unpersist()
    union = done[0]
    for more in done[1:]:
        union = union.unionByName(more)
    return union.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def positives_of(tree: Tree, kept: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the tree's anchors' positives by rank; NEVER where there are fewer."""
    ids, score = np.zeros((len(tree.uid), k), np.int64), np.full((len(tree.uid), k), NEVER)
    order = np.argsort(tree.uid)
    at = np.minimum(np.searchsorted(tree.uid, kept["anchor_uid"], sorter=order), len(order) - 1)
    g = order[at]
    mine = tree.uid[g] == kept["anchor_uid"]
    where = g[mine], kept["place"][mine] - 1
    ids[where], score[where] = kept["id"][mine], kept["score"][mine]
    return ids, score


def score_windows(positive: np.ndarray, least_percent: int, most_percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole scores s with least% * p <= 100 * s <= most% * p."""
    whole = positive.astype(object)
    low, high = -((-least_percent * whole) // 100), (most_percent * whole) // 100
    none = positive == NEVER
    return np.where(none, 1, low).astype(np.int64), np.where(none, 0, high).astype(np.int64)
