"""Best-fit packing by bin completion with branch and bound.

What a sequence's filling depends on is only the lengths, and there are at most
``capacity`` different ones, so packing is planned on the histogram of lengths (a
table of a fixed size, whatever the number of documents) and carried out by Spark:

1. documents become token pieces; full pieces need no packing, the rest is counted
   by length;
2. bin completion: around the largest length left, the fillings that no other one
   dominates are enumerated (largest members first, fewest members), pruned by the
   least waste found, and the best is laid out for as many sequences as the counts
   allow; a first dive that always takes the best fit is the incumbent, and other
   branches are tried while a lower bound on the sequences leaves room, pruned by
   the waste that would still beat the incumbent;
3. every piece gets its rank among the pieces of its length (counts by task, prefix
   sums, no sort of all pieces) and looks up the sequence and place of that rank.

Defined results: a null text is an empty one and still has its end id; repeated rows
are packed as often as they occur; an empty table gives an empty result.  A text of any
length is encoded whole and cut into full sequences and one rest; pieces of equal length
are interchangeable, so ties need no order.  Only the id and the text are read, so
clashing names do no harm.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duescore.llm.common import slices, staged
from duescore.llm.tokens import Encoder, vocabulary_path

CAPACITY = 2048
END_ID = 0
#: Steps of the search for fillings of one sequence, and other branches tried.
FILL_STEPS = 1_500
BRANCHES = 6

Filling = tuple[tuple[int, int], ...]  # (length, how many), largest first


def token_pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary: str, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth): pieces of at most ``capacity``
    ids, with the number of the writing task and the piece's rank among its pieces
    of that length."""
    path = vocabulary_path(vocabulary) if "/" not in vocabulary else vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in slices(batches, text_col):
            ids, row = encoder.encode(b.column(text_col))
            ends = row[1:]
            with_end = np.insert(ids, ends, end_id).astype("<u4")
            total = np.diff(row) + 1
            begin = np.concatenate([[0], np.cumsum(total)[:-1]])
            pieces = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            short = total - (pieces - 1) * capacity  # the first piece holds what does not fill one
            length = np.where(piece == 0, short[doc], capacity)
            start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
            at = begin[doc] + start
            raw = memoryview(with_end.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(at.tolist(), (at + length).tolist())]
            order = np.argsort(length, kind="stable")
            sizes, first, count = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(first, count) + np.repeat(seen[sizes], count)
            seen[sizes] += count
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)),
                 pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task, np.int32)), pa.array(nth)],
                names=[id_col, "piece", "start", "length", "ids_crc32", "task", "nth"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint"
    )


def fillings(room: int, sizes: list[int], counts: Counter, want: int) -> list[tuple[int, Filling]]:
    """Up to ``want`` best (waste, filling) of ``room``, largest members first.

    Members are taken in runs of equal lengths, and the search keeps its own stack of at
    most as many runs as different lengths fit.  A filling is left out if another
    member would still fit (that one dominates it) or if its waste cannot get below the
    worst of those kept."""
    best: list[tuple[int, Filling]] = []
    fit = sizes[: bisect_right(sizes, room)]
    below = [0, *accumulate(s * counts[s] for s in fit)]  # what all pieces shorter than each length fill

    def worst() -> int:
        return best[-1][0] if len(best) >= want else room + 1

    def runs(left: int, top: int) -> Iterator[tuple[int, int]]:
        """(place in ``fit``, how many) of the next run, below the place ``top``."""
        for i in range(min(top, bisect_right(fit, left)) - 1, -1, -1):
            if left - below[i + 1] >= worst():
                return
            s = fit[i]
            for n in range(min(left // s, counts[s]), 0, -1):
                # what stays open when all shorter pieces are taken too; one more of this run would fit there
                if left - n * s - below[i] >= (min(s, worst()) if n < counts[s] else worst()):
                    break
                yield i, n

    def keep(waste: int, f: Filling) -> None:
        if all(f != x for _, x in best):
            best.append((waste, f))
            best.sort(key=lambda x: (x[0], sum(n for _, n in x[1])))
            del best[want:]

    members: list[tuple[int, int]] = []
    open_runs = [(room, runs(room, len(fit)))]
    steps, fresh = FILL_STEPS, True  # fresh: no run was tried yet on top of the members
    while open_runs and steps > 0 and worst() > 0:
        left, more = open_runs[-1]
        i, n = next(more, (-1, 0))
        if i < 0:
            used = dict(members)
            if fresh and left < worst() and not any(counts[s] > used.get(s, 0) for s in fit[: bisect_right(fit, left)]):
                keep(left, tuple(members))
            open_runs.pop()
            if members:
                members.pop()
            fresh = False
            continue
        steps -= 1
        s = fit[i]
        rest = left - n * s
        # an exact partner closes the filling at once
        if not rest:
            keep(0, (*members, (s, n)))
        elif rest < s and counts[rest]:
            keep(0, (*members, (s, n), (rest, 1)))
        else:
            members.append((s, n))
            open_runs.append((rest, runs(rest, i)))
            fresh = True
            continue
        fresh = False
    return best or [(room, ())]


def dive(counts: dict[int, int], capacity: int, turns: dict[int, int], allowed: int | None) -> tuple[int, list[tuple[Filling, int]]] | None:
    """One branch: around the largest length left, the filling of the rank that
    ``turns`` gives this step (the best fit where it names none).  None once the waste
    is more than ``allowed``."""
    left = Counter(counts)
    sizes = sorted(s for s in left if left[s])
    out: list[tuple[Filling, int]] = []
    waste = step = 0
    while sizes:
        top = sizes[-1]
        left[top] -= 1
        turn = turns.get(step, 0)
        options = fillings(capacity - top, sizes, left, turn + 1)
        lost, rest = options[min(turn, len(options) - 1)]
        left[top] += 1
        whole = Counter({top: 1})
        whole.update(dict(rest))
        many = min(left[s] // n for s, n in whole.items())
        for s, n in whole.items():
            left[s] -= n * many
            if not left[s]:
                sizes.remove(s)
        out.append((tuple(sorted(whole.items(), reverse=True)), many))
        waste += lost * many
        step += 1
        if allowed is not None and sizes and waste > allowed:
            return None
    return sum(n for _, n in out), out


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, branches: int = BRANCHES) -> list[tuple[Filling, int]]:
    """(filling, number of sequences) for a histogram of lengths."""
    total = sum(s * n for s, n in counts.items())
    big = sum(n for s, n in counts.items() if 2 * s > capacity)
    least = max(-(-total // capacity), big)
    best = dive(counts, capacity, {}, None)
    for k in range(branches):
        if best[0] <= least:
            break
        steps = max(1, len(best[1]))
        turns = {(k // 3) * steps // max(1, branches // 3): 1 + k % 3}
        found = dive(counts, capacity, turns, (best[0] - 1) * capacity - total)
        if found and found[0] < best[0]:
            best = found
    return best[1]


def places(plan: list[tuple[Filling, int]]) -> np.ndarray:
    """Rows (length, first rank, how many per sequence, first sequence, offset), sorted
    by length and rank: ranks of a length go to the fillings in the plan's order."""
    rank: Counter = Counter()
    out = []
    sequence = 0
    for filling, many in plan:
        offset = 0
        for size, n in filling:
            out.append((size, rank[size], n, sequence, offset))
            rank[size] += n * many
            offset += size * n
        sequence += many
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str = "byte_bpe_50k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
    branches: int = BRANCHES,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = staged(token_pieces(docs, capacity, end_id, vocabulary, id_col, text_col), "token-pieces")
    by_task = staged(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    # At most ``capacity`` rows.
    histogram = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    place = places(plan_packing(histogram, capacity, branches))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = place[:, 0] << 48 | place[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            size, first, each, sequence, offset = place[np.searchsorted(keys, length << 48 | rank, side="right") - 1].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(sequence + nth // each), pa.array(offset + nth % each * size)],
                names=[*names, "sequence_id", "offset"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.select(*names, "rank").mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
