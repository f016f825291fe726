"""Embedding near-dedup by a robust-pruned flat graph over balls of near vectors.

Equal vectors are one node.  Nodes go to the shard of their nearest centre, and in
pieces of bounded size the near ones are gathered into balls so narrow that all their
members link: a dense group is a few balls, whatever its size, and never a list of its
pairs.  Balls are then the vertices of the graph:

* every ball goes to the shards of its nearest centres, so shards overlap; in each shard
  (or part of one) a flat graph is built by inserting growing batches, searching for each
  and keeping neighbours by robust pruning;
* the adjacency lists of a ball from all its shards are united;
* every ball is searched for in its nearest shards over the united lists, greedily from
  the medoid, with a beam that grows while the range still fills it;
* pairs of balls found near enough are verified on the vectors: the smaller ball's
  members come to the larger ball, whose angles to its centre settle most of them
  without looking at members, and every other pair is measured in double precision;
* the recall of links is audited on a bounded sample against all vectors, and the search
  is widened and run again where it falls short.

Links of both ends come from the same pair, so they are symmetric; components are those
of the balls.

Defined results: vectors that are null, empty, zero, hold a null or non-finite component
or have another length than most link with nothing, as do rows with a null id (whose
component is null, and which are kept).  Equal vectors link; repeated rows and ids count
one by one; ties do not arise.  An empty table gives an empty result.  Only id and vector
are read, so further columns of any name do not clash; there is no text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescore.llm.common import staged, with_uid
from duescore.llm.components import connected_components
from duescore.llm.neighbours import taking_part

#: Vectors that centres are fitted on, vectors of a shard on average, and most shards.
SAMPLE_ROWS = 16_384
SHARD_ROWS = 8_192
MAX_SHARDS = 2_048
#: Rows gathered into balls at a time; balls of a graph and searched for in it at a time.
PIECE_ROWS = 4_096
GRAPH_ROWS = 32_768
#: Rows verified at a time, and dealt to one ball; rows of one vector that a task joins.
CELL_ROWS = 50_000
HOT_ROWS = 10_000
#: Neighbours of a ball, beam of the first search, and how much nearer a pruning neighbour is.
DEGREE = 20
BEAM = 32
ALPHA = 1.2
#: Shards that a ball is built into and searched for in, to start with.
OVERLAP = 2
PROBES = 4
#: Vectors audited, and the recall below which the search is widened.
AUDIT_ROWS = 1_024
AUDIT_RECALL = 0.99
#: Room for rounding between angles.
SLACK = 1e-6


def unit(vec: np.ndarray) -> np.ndarray:
    vec = vec / np.abs(vec).max(1, keepdims=True)
    return vec / np.sqrt((vec * vec).sum(1, keepdims=True))


def unpacked(column: pa.Array | pa.ChunkedArray, length: int, kind: str = "<f8") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, length).astype(np.float64)


def packed(vec: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(vec, np.float64)], pa.binary())


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


# --- balls ------------------------------------------------------------------------


def net(vec: np.ndarray, near: float) -> np.ndarray:
    """Rows that lead: every row has a leader with a cosine of at least ``near``."""
    leaders: list[int] = []
    for lo in range(0, len(vec), 256):
        part = vec[lo : lo + 256]
        open_ = np.ones(len(part), bool) if not leaders else (part @ vec[leaders].T).max(1) < near
        same = part @ part.T >= near
        for k in range(len(part)):
            if open_[k]:
                leaders.append(lo + k)
                open_ &= ~same[k]
    return np.array(leaders, np.int64)


def balls(vec: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ball of each row, angle of each row to its ball's centre, centres).  Any two
    members are within half the linking angle of the centre, so they link."""
    half = float(np.arccos(least)) / 2 - SLACK
    near = float(np.cos(half))
    lead = net(vec, near)
    centres = vec[lead].copy()
    count = np.ones(len(lead), np.int64)
    for lo in range(0, len(lead), 512):  # a leader with others around moves to their middle
        around = centres[lo : lo + 512] @ vec.T >= least
        mean = around.astype(float) @ vec
        count[lo : lo + 512] = around.sum(1)
        crowd = count[lo : lo + 512] > 1
        centres[lo : lo + 512][crowd] = unit(mean[crowd])
    order = np.argsort(-count, kind="stable")
    ball = np.full(len(vec), -1)
    cosine = np.ones(len(vec))
    kept: list[np.ndarray] = []

    def take(centre: np.ndarray) -> None:
        free = np.flatnonzero(ball < 0)
        s = vec[free] @ centre
        mine = s >= near
        if mine.any():
            ball[free[mine]], cosine[free[mine]] = len(kept), s[mine]
            kept.append(centre)

    for k in order[count[order] > 1]:
        take(centres[k])
    rest = np.flatnonzero(ball < 0)
    for k in rest[net(vec[rest], near)]:
        take(vec[k])
    return ball, angle(cosine), np.stack(kept) if kept else np.zeros((0, vec.shape[1]))


# --- the graph of a shard -----------------------------------------------------------


def pruned(at: np.ndarray, cand: np.ndarray, vec: np.ndarray) -> np.ndarray:
    """Robust pruning: for each vertex the nearest candidates, leaving out those that a
    kept one is nearer to by the factor ALPHA.  -1 stands for no candidate."""
    out = np.full((len(at), DEGREE), -1, np.int32)
    for lo in range(0, len(at), 1024):
        c = cand[lo : lo + 1024]
        v = vec[c]
        d = np.sqrt(np.maximum(2 - 2 * np.einsum("bcd,bd->bc", v, vec[at[lo : lo + 1024]]), 0))
        between = np.sqrt(np.maximum(2 - 2 * (v @ v.transpose(0, 2, 1)), 0)) * ALPHA
        alive = (c >= 0) & (c != at[lo : lo + 1024, None])
        rows = np.arange(len(c))
        for r in range(DEGREE):
            pick = np.where(alive, d, np.inf).argmin(1)
            ok = alive[rows, pick]
            if not ok.any():
                break
            out[lo : lo + 1024, r] = np.where(ok, c[rows, pick], -1)
            alive &= ~(ok[:, None] & ((between[rows, pick] <= d) | (c == c[rows, pick][:, None])))
    return out


def beam_search(q: np.ndarray, vec: np.ndarray, adjacent: np.ndarray, start: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cosines) of the best ``width`` vertices met by a greedy search of each query:
    the nearest vertex not yet expanded is expanded until the beam holds none."""
    ids = np.full((len(q), width), -1, np.int32)
    cosine = np.full((len(q), width), -np.inf, np.float32)
    fresh = np.zeros((len(q), width), bool)
    ids[:, 0], cosine[:, 0], fresh[:, 0] = start, q @ vec[start], True
    active = np.arange(len(q))
    while len(active):
        pick = np.where(fresh[active], cosine[active], -np.inf).argmax(1)
        going = fresh[active, pick]
        active, pick = active[going], pick[going]
        if not len(active):
            break
        fresh[active, pick] = False
        more = adjacent[ids[active, pick]]
        s = np.einsum("brd,bd->br", vec[more], q[active])
        known = (more < 0) | (more[:, :, None] == ids[active][:, None, :]).any(2)
        s[known] = -np.inf
        worst = cosine[active].min(1)
        better = (s > worst[:, None]).any(1)
        a = active[better]
        if len(a):
            all_ids = np.concatenate([ids[a], more[better]], 1)
            all_cos = np.concatenate([cosine[a], s[better]], 1)
            all_fresh = np.concatenate([fresh[a], s[better] > -np.inf], 1)
            keep = np.argpartition(-all_cos, width - 1, axis=1)[:, :width]
            ids[a], cosine[a] = np.take_along_axis(all_ids, keep, 1), np.take_along_axis(all_cos, keep, 1)
            fresh[a] = np.take_along_axis(all_fresh, keep, 1)
    return np.where(np.isfinite(cosine), ids, -1), cosine


def medoid(vec: np.ndarray) -> int:
    return int((vec @ vec.mean(0)).argmax())


def flat_graph(vec: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """(rows, DEGREE) neighbours of each row.  Batches double in size; each row searches
    the graph so far (and its own batch), and its neighbours take it into their lists."""
    m = len(vec)
    vec = vec.astype(np.float32)
    adjacent = np.full((m, DEGREE), -1, np.int32)
    start = medoid(vec)
    order = np.r_[start, np.delete(np.arange(m), start)]
    lo, size = 1, 1
    while lo < m:
        new = order[lo : lo + size]
        found, _ = beam_search(vec[new], vec, adjacent, start, beam)
        same = vec[new] @ vec[new].T
        np.fill_diagonal(same, -np.inf)
        few = min(8, len(new) - 1)
        mates = new[np.argpartition(-same, few - 1, axis=1)[:, :few]] if few > 0 else np.zeros((len(new), 0), np.int32)
        adjacent[new] = pruned(new, np.concatenate([found, mates.astype(np.int32)], 1), vec)
        a, r = np.nonzero(adjacent[new] >= 0)
        back_links(adjacent, new[a], adjacent[new][a, r], vec)
        lo, size = lo + len(new), min(2 * size, 1024)
    return adjacent


def back_links(adjacent: np.ndarray, source: np.ndarray, target: np.ndarray, vec: np.ndarray) -> None:
    """Add ``source`` to the list of each ``target``, pruning the lists that overflow."""
    fresh = ~(adjacent[target] == source[:, None]).any(1)
    source, target = source[fresh], target[fresh]
    near = np.einsum("ed,ed->e", vec[source], vec[target])
    order = np.lexsort((-near, target))
    source, target = source[order], target[order]
    hit, first = np.unique(target, return_index=True)
    place = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
    few = place < DEGREE  # the nearest of very many
    come = np.full((len(hit), DEGREE), -1, np.int32)
    come[np.searchsorted(hit, target[few]), place[few]] = source[few]
    full = np.concatenate([adjacent[hit], come], 1)
    total = (full >= 0).sum(1)
    some = total <= DEGREE
    left = np.take_along_axis(full, np.argsort(full < 0, axis=1, kind="stable"), 1)[:, :DEGREE]
    adjacent[hit[some]] = left[some]
    if (~some).any():
        adjacent[hit[~some]] = pruned(hit[~some], full[~some], vec)


def range_search(q: np.ndarray, reach: np.ndarray, vec: np.ndarray, radius: np.ndarray, adjacent: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs with an angle of at most ``reach`` of the query and ``radius`` of
    the row.  Where half of the beam is within range it is doubled and the query runs again."""
    exact, vec32, q32 = vec, vec.astype(np.float32), q.astype(np.float32)
    start = medoid(vec32)
    out_q, out_row = [], []
    todo, width = np.arange(len(q)), min(beam, len(vec))
    while len(todo):
        again = []
        step = max(16, 1024 * BEAM // width)
        for lo in range(0, len(todo), step):
            here = todo[lo : lo + step]
            ids, cosine = beam_search(q32[here], vec32, adjacent, start, width)
            inside = (ids >= 0) & (angle(cosine) <= (reach[here, None] + radius[ids]) + 1e-3)
            wide = (inside.sum(1) * 2 > width) & (width < len(vec))
            again.append(here[wide])
            a, k = np.nonzero(inside & ~wide[:, None])
            a, row = here[a], ids[a, k]
            near = angle((q[a] * exact[row]).sum(1)) <= reach[a] + radius[row] + SLACK
            out_q.append(a[near])
            out_row.append(row[near])
        todo, width = np.concatenate(again), min(2 * width, len(vec))
    return np.concatenate(out_q or [np.zeros(0, int)]), np.concatenate(out_row or [np.zeros(0, int)])


# --- verification -----------------------------------------------------------------


def linked(big: np.ndarray, turn: np.ndarray, weight: np.ndarray, centre: np.ndarray, small: np.ndarray, small_weight: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each big member, links of each small one): the weights of the others at a
    cosine of at least ``least``.  A member whose angle to the centre, and the other's, add
    up to less than the linking angle is linked without being looked at."""
    theta = float(np.arccos(least))
    order = np.argsort(turn, kind="stable")
    big, turn, weight = big[order], turn[order], weight[order]
    away = angle(small @ centre)
    sure = np.searchsorted(turn, theta - away - SLACK, side="right")
    total = np.r_[0, np.cumsum(weight)]
    to_small = total[sure]
    gain = np.zeros(len(big) + 1, np.int64)
    np.add.at(gain, sure, small_weight)  # members before `sure` gain: a sum from the end
    to_big = np.cumsum(gain[::-1])[::-1][1:]
    look = np.flatnonzero((sure < len(big)) & (turn[-1] + theta + SLACK >= away))
    for lo in range(0, len(look), 1024):
        at = look[lo : lo + 1024]
        hit = small[at] @ big.T >= least
        hit &= np.arange(len(big)) >= sure[at, None]
        to_small[at] += hit @ weight
        to_big += small_weight[at] @ hit
    back = np.empty(len(big), np.int64)
    back[order] = to_big
    return back, to_small


# --- the operator -----------------------------------------------------------------


class Shards:
    """Centres of the shards, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, count: int, least: float):
        lead = net(sample, least) if len(sample) else np.zeros(0, int)
        self.centres = sample[lead[:count]].copy()
        for _ in range(6 if len(self.centres) > 1 else 0):
            at = (sample @ self.centres.T).argmax(1)
            sums = np.zeros_like(self.centres)
            np.add.at(sums, at, sample)
            full = np.abs(sums).max(1) > 1e-9
            self.centres[full] = unit(sums[full])

    def nearest(self, vec: np.ndarray, count: int) -> np.ndarray:
        """(rows, count) shards, nearest first."""
        count = min(count, len(self.centres))
        cosine = vec @ self.centres.T
        some = np.argpartition(-cosine, count - 1, axis=1)[:, :count]
        return np.take_along_axis(some, np.argsort(-np.take_along_axis(cosine, some, 1), axis=1, kind="stable"), 1)


def routed(df: DataFrame, column: str, shards, length: int, count: int) -> DataFrame:
    """Every row once for each of the ``count`` shards nearest to its vector."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = shards.value.nearest(unpacked(b.column(column), length), count)
                for k in range(at.shape[1]):
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at[:, k].astype(np.int32))], names=[*names, "shard"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}, shard int")


def vector_rows(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(uid, id, v): every row, its vector null if it links with nothing."""
    v = F.col("v")
    all_rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = all_rows.withColumn("v", F.when(F.col("id").isNotNull() & taking_part(v), v))
    lengths = usable.where(v.isNotNull()).groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return with_uid(usable.withColumn("v", F.when(F.size("v") == (lengths.n if lengths else -1), v)), "uid")


def vector_nodes(rows: DataFrame) -> DataFrame:
    """(node, id, copies, vec): one row per distinct vector, its direction packed."""
    distinct = rows.where(F.col("v").isNotNull()).groupBy("v").agg(F.min("uid").alias("node"), F.min("id").alias("id"), F.count("*").alias("copies"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                flat = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([b.column("node"), b.column("id"), b.column("copies"), packed(unit(flat))], names=["node", "id", "copies", "vec"])

    return distinct.select("node", "id", "copies", "v").mapInArrow(pack, "node bigint, id bigint, copies bigint, vec binary")


BALLS = "node bigint, id bigint, copies bigint, vec binary, ball bigint, turn double, centre binary, radius double, size bigint, weight bigint"


def gathered(nodes: DataFrame, shards, length: int, least: float) -> DataFrame:
    """The nodes with their balls; a ball's first member carries centre, radius, size and
    the rows of all its members.  A piece holds about PIECE_ROWS rows, however hot a shard."""
    placed = staged(routed(nodes, "vec", shards, length, 1), "vector-shards")
    parts = placed.groupBy("shard").agg(F.ceil(F.count("*") / PIECE_ROWS).alias("parts"))  # at most MAX_SHARDS rows
    dealt = placed.join(F.broadcast(parts), "shard").withColumn("part", F.pmod(F.xxhash64("node"), "parts")).drop("parts")

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("node").combine_chunks()
        vec, node = unpacked(t.column("vec"), length), t.column("node").to_numpy()
        ball, turn, centres = balls(vec, least)
        size = np.bincount(ball)
        first = np.full(len(centres), len(node))
        np.minimum.at(first, ball, np.arange(len(node)))
        radius = np.zeros(len(centres))
        np.maximum.at(radius, ball, turn)
        alone = size[ball] == 1
        centres[ball[alone]], radius[ball[alone]], turn[alone] = vec[alone], 0.0, 0.0
        weight = np.zeros(len(centres), np.int64)
        np.add.at(weight, ball, t.column("copies").to_numpy())
        lead = first[ball] == np.arange(len(node))
        of_lead = [packed(centres[ball]), pa.array(radius[ball]), pa.array(size[ball]), pa.array(weight[ball])]
        of_lead = [pc.if_else(pa.array(lead), c, pa.scalar(None, c.type)) for c in of_lead]
        cols = [t.column(c) for c in ("node", "id", "copies", "vec")] + [pa.array(node[first[ball]]), pa.array(turn), *of_lead]
        return pa.table(cols, names=[c.split()[0] for c in BALLS.split(", ")])

    return staged(dealt.groupBy("shard", "part").applyInArrow(run, BALLS), "balls")


def ball_graph(members: DataFrame, sizes: DataFrame, length: int, beam: int) -> DataFrame:
    """(ball, neighbours): the lists of the shards' graphs united."""
    dealt = members.join(F.broadcast(sizes), "shard").withColumn("part", F.pmod(F.xxhash64("ball"), "parts"))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("ball").combine_chunks()
        ball = t.column("ball").to_numpy()
        adjacent = flat_graph(unpacked(t.column("centre"), length), beam)
        a, k = np.nonzero(adjacent >= 0)
        return pa.table([pa.array(ball[a]), pa.array(ball[adjacent[a, k]])], names=["ball", "neighbour"])

    edges = dealt.select("shard", "part", "ball", "centre").groupBy("shard", "part").applyInArrow(run, "ball bigint, neighbour bigint")
    return staged(edges.groupBy("ball").agg(F.collect_set("neighbour").alias("neighbours")), "united-graph")


def near_balls(lead: DataFrame, shards, length: int, least: float, overlap: int, probes: int, beam: int) -> DataFrame:
    """(a, b), a < b: pairs of balls that may hold a link, found by search."""
    theta = float(np.arccos(least))
    members = staged(routed(lead, "centre", shards, length, overlap), "shard-members")
    asked = routed(lead, "centre", shards, length, probes)
    sizes = staged(
        members.groupBy("shard").agg(F.ceil(F.count("*") / GRAPH_ROWS).alias("parts"))
        .join(asked.groupBy("shard").agg(F.ceil(F.count("*") / GRAPH_ROWS).alias("groups")), "shard", "left").fillna(1, ["groups"]), "shard-sizes")  # at most MAX_SHARDS rows
    graph = ball_graph(members, sizes, length, beam)
    vertex = members.join(graph, "ball", "left").join(F.broadcast(sizes), "shard")
    cells = vertex.select(
        "shard", F.pmod(F.xxhash64("ball"), "parts").alias("part"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
        F.lit(False).alias("asked"), "ball", "centre", "radius", "neighbours",
    )
    queries = asked.join(F.broadcast(sizes), "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("ball"), "groups").alias("group"),
        F.lit(True).alias("asked"), "ball", "centre", "radius", F.lit(None).cast("array<bigint>").alias("neighbours"),
    )

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("ball").combine_chunks()
        asked = t.column("asked").to_numpy()
        out = [np.zeros(0, np.int64)] * 2
        if asked.any() and not asked.all():
            q, m = t.filter(pa.array(asked)), t.filter(pa.array(~asked))
            ball = m.column("ball").to_numpy()
            lists = m.column("neighbours").combine_chunks()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            row = np.repeat(np.arange(len(ball)), lengths)
            to = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(ball, to), len(ball) - 1)
            here = ball[at] == to  # neighbours in other shards are met there
            row, at = row[here], at[here]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            adjacent = np.full((len(ball), max(1, int(place.max()) + 1 if len(place) else 1)), -1, np.int32)
            adjacent[row, place] = at
            asked_ball = q.column("ball").to_numpy()
            reach = theta + q.column("radius").to_numpy()
            a, b = range_search(unpacked(q.column("centre"), length), reach, unpacked(m.column("centre"), length), m.column("radius").to_numpy(), adjacent, beam)
            a, b = asked_ball[a], ball[b]
            out = [np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]]
        return pa.table([pa.array(x) for x in out], names=["a", "b"])

    found = cells.unionByName(queries).groupBy("shard", "part", "group").applyInArrow(run, "a bigint, b bigint")
    return staged(found.distinct(), "near-balls")


def verified(pairs: DataFrame, balls_: DataFrame, lead: DataFrame, length: int, least: float) -> DataFrame:
    """(a, b, links): links of node ``a`` in other balls (b null), and linked balls a and b."""
    sizes = lead.select("ball", "size")
    both = pairs.join(sizes.select(F.col("ball").alias("a"), F.col("size").alias("size_a")), "a").join(sizes.select(F.col("ball").alias("b"), F.col("size").alias("size_b")), "b")
    larger = F.col("size_a") >= F.col("size_b")
    sided = staged(both.select(F.when(larger, F.col("a")).otherwise(F.col("b")).alias("big"), F.when(larger, F.col("b")).otherwise(F.col("a")).alias("small"), F.least("size_a", "size_b").alias("size")), "ball-pairs")
    salts = staged(sided.groupBy("big").agg(F.ceil(F.sum("size") / CELL_ROWS).alias("salts")), "ball-salts")
    total = sided.agg(F.sum("size")).first()[0] or 0
    cells = max(1, -(-total // CELL_ROWS) * 2)
    vectors = balls_.select(F.col("ball").alias("of"), "node", "copies", "vec", "turn", "centre")
    own = salts.join(vectors, F.col("big") == F.col("of")).select(
        "big", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("small"), "node", "copies", "vec", "turn", "centre"
    )
    come = sided.join(salts, "big").join(vectors, F.col("small") == F.col("of")).select(
        "big", F.pmod(F.xxhash64("node"), "salts").alias("salt"), "small", "node", "copies", "vec", F.lit(None).cast("double").alias("turn"), F.lit(None).cast("binary").alias("centre")
    )

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("big", "ascending"), ("salt", "ascending"), ("small", "ascending"), ("node", "ascending")]).combine_chunks()
        big, salt = t.column("big").to_numpy(), t.column("salt").to_numpy()
        small, node, copies = pc.fill_null(t.column("small"), -1).to_numpy(), t.column("node").to_numpy(), t.column("copies").to_numpy()
        own, vec, turn = small < 0, unpacked(t.column("vec"), length), pc.fill_null(t.column("turn"), 0.0).to_numpy()
        centre = t.column("centre")
        ends = np.r_[np.flatnonzero((big[1:] != big[:-1]) | (salt[1:] != salt[:-1])) + 1, len(big)]
        counts, edges, lo = [], [], 0
        for hi in ends:
            mine, other = np.flatnonzero(own[lo:hi]) + lo, np.flatnonzero(~own[lo:hi]) + lo
            lo = hi
            if not len(mine) or not len(other):
                continue
            middle = vec[mine[0]] if len(mine) == 1 else np.frombuffer(next(c for c in (centre[int(k)].as_py() for k in mine) if c), "<f8")
            to_big, to_small = linked(vec[mine], turn[mine], copies[mine], middle, vec[other], copies[other], least)
            counts += [(node[mine], to_big), (node[other], to_small)]
            hit = np.unique(small[other[to_small > 0]])
            edges.append((np.full(len(hit), big[mine[0]]), hit))
        a = np.concatenate([x for x, _ in counts + edges] or [np.zeros(0, np.int64)])
        n = sum(len(x) for x, _ in counts)
        links = np.concatenate([x for _, x in counts] or [np.zeros(0, np.int64)])
        ball = np.concatenate([x for _, x in edges] or [np.zeros(0, np.int64)])
        none = [None] * n
        return pa.table([pa.array(a.astype(np.int64)), pa.array([*none, *ball.tolist()], pa.int64()), pa.array([*links.tolist(), *[None] * len(ball)], pa.int64())], names=["a", "b", "links"])

    dealt = own.unionByName(come).withColumn("cell", F.pmod(F.xxhash64("big", "salt"), F.lit(cells)))
    return staged(dealt.groupBy("cell").applyInArrow(run, "a bigint, b bigint, links bigint"), "links")


def node_links(balls_: DataFrame, lead: DataFrame, links: DataFrame) -> DataFrame:
    """(node, ball, n_links) of every node: the rest of its ball and what was found outside."""
    outside = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("outside"))
    return balls_.select("node", "ball").join(lead.select("ball", "weight"), "ball").join(outside, "node", "left").select(
        "node", "ball", (F.col("weight") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"))


def audited_recall(nodes: DataFrame, found: DataFrame, length: int, least: float, count: int = AUDIT_ROWS) -> float:
    """Share of the links of ``count`` sampled vectors that was found, against all vectors."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(7)), "node").limit(count).select("node", "vec").toArrow()
    picked, vec = sample.column("node").to_numpy(), unpacked(sample.column("vec"), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(picked), np.int64)
        for b in batches:
            if b.num_rows:
                total += (vec @ unpacked(b.column("vec"), length).T >= least) @ b.column("copies").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(picked), pa.array(total)], names=["node", "true"])

    true = nodes.select("copies", "vec").mapInArrow(run, "node bigint, true bigint").groupBy("node").agg((F.sum("true") - 1).alias("true"))
    both = true.join(found, "node").agg(F.sum("true"), F.sum(F.least("true", "n_links"))).first()
    return both[1] / both[0] if both[0] else 1.0


def embedding_dedup(rows: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    all_rows = staged(vector_rows(rows, id_col, vector_col), "dedup-rows")
    nodes = staged(vector_nodes(all_rows), "vector-nodes")
    total = nodes.count()
    if not total:
        return all_rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    spark = rows.sparkSession
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_ROWS).select("vec").toArrow()
    length = len(sample.column("vec")[0].as_py()) // 8
    shards = spark.sparkContext.broadcast(Shards(unpacked(sample.column("vec"), length), min(MAX_SHARDS, -(-total // SHARD_ROWS)), least))
    count = len(shards.value.centres)
    balls_ = gathered(nodes, shards, length, least)
    lead = balls_.where(F.col("centre").isNotNull()).select("ball", "centre", "radius", "size", "weight")
    overlap, probes, beam = OVERLAP, PROBES, BEAM
    while True:
        links = verified(near_balls(lead, shards, length, least, overlap, probes, beam), balls_, lead, length, least)
        per_node = staged(node_links(balls_, lead, links), "node-links")
        if audited_recall(nodes, per_node, length, least) >= AUDIT_RECALL or (probes >= count and beam >= 8 * BEAM):
            break
        overlap, probes, beam = 2 * overlap, 2 * probes, 2 * beam
    roots = connected_components(links.where("b is not null").select("a", "b"))
    joined = per_node.join(nodes.select("node", "id"), "node").join(roots.select(F.col("node").alias("ball"), "root"), "ball", "left")
    rooted = staged(joined.select("node", "n_links", "id", F.coalesce("root", "ball").alias("root")), "node-roots")
    first = staged(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "component-ids")
    result = staged(rooted.join(first, "root").select("node", "n_links", "component_id"), "node-components")
    return spread(all_rows, result, all_rows.count())


def spread(all_rows: DataFrame, result: DataFrame, total: int) -> DataFrame:
    """The nodes' results on every row.  Vectors that stand alone are met by row number, the
    others by value, and rows of a very common one go to several tasks."""
    part = all_rows.where(F.col("v").isNotNull()).select("uid", "id", F.col("v").alias("vec"))
    many = part.groupBy("vec").agg(F.min("uid").alias("node"), F.count("*").alias("copies")).where("copies > 1")
    many = staged(many.join(result, "node").drop("node"), "common-vectors")
    # At most 1,000 vectors can each hold over a thousandth of the rows.
    hot = many.where(F.col("copies") >= max(HOT_ROWS, -(-total // 1_000))).select(F.col("vec").alias("hot"), F.ceil(F.col("copies") / HOT_ROWS).cast("int").alias("salts"))
    salt = F.coalesce(F.pmod(F.xxhash64("uid"), "salts"), F.lit(0)).cast("int").alias("salt")
    rows = part.join(F.broadcast(hot), F.col("vec") == F.col("hot"), "left").select("uid", "id", "vec", salt)
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    common = many.join(F.broadcast(hot), F.col("vec") == F.col("hot"), "left").select("vec", salts, F.col("n_links").alias("n"), F.col("component_id").alias("c"))
    done = rows.join(common, ["vec", "salt"], "left").select("uid", "id", "n", "c")
    done = done.join(result.withColumnRenamed("node", "uid"), "uid", "left")
    done = done.select("id", F.coalesce("n", "n_links").alias("n_links"), F.coalesce("c", "component_id").alias("component_id"))
    alone = all_rows.where(F.col("v").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
