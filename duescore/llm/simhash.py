"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at distance d meet in the middle when both emit every variant
within d/2 flips.  The largest distance here is odd (3), half of which is one flip
and a half: one flip on each side closes a distance of two, and the odd bit is
taken by erasing one of three blocks of bits (a pair at distance 3 has a differing
bit in some block; with that block erased at most two remain).  So every distinct
fingerprint emits, for each block, itself with the block erased and every one-flip
neighbour of that: 132 variants instead of the 2,081 of a full two-flip ball.
Variants are shuffled, and fingerprints that share one are verified by their exact
distance before they link.

Defined results: null and empty texts have fingerprint zero and link like any
other; fewer words than a shingle are one shingle; a component's id is its smallest
non-null id (null if it has none).  Repeated rows each get their own row, and an
empty table gives an empty result.  Very long texts are read whole.  Only the
id and text columns are read.  Equal fingerprints are one node, so copies cost
nothing; a variant shared by very many different fingerprints is linked by sorting,
not by pairs, and one fingerprint's rows spread over 132 keys, so no key can hold
more than 1/132 of the variants.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescore.llm.common import NON_SPACE, Words, slices, staged
from duescore.llm.components import connected_components

BLOCKS = 3
SEED = 42
#: Text bytes hashed at a time: every shingle is a Python object for a moment.
SCAN_BYTES = 1 << 20
#: Runs of at most so many fingerprints are compared by one distance matrix.
MATRIX = 512


def shingle_hashes(w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, the offsets of each row's shingles)."""
    joined, starts, ends = w.joined()
    lo, hi = w.row[:-1], w.row[1:]
    n = np.where(hi > lo, np.maximum(hi - lo - shingle + 1, 1), 0)
    row = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(lo - row[:-1], n) + np.arange(row[-1])
    last = np.minimum(first + shingle - 1, np.repeat(hi, n) - 1)
    view = memoryview(joined)
    h = xxhash.xxh64_intdigest
    hashes = [h(view[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist())]
    return np.array(hashes, np.uint64), row


def majority(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Per row the bits set in over half of its hashes; no hash gives zero."""
    n = np.diff(row)
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        counts = np.empty((len(some), 64), np.int64)
        bounds = row[:-1][some]
        step = 1 << 18  # hashes unpacked at a time, whole rows only
        at = 0
        while at < len(some):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + step)))
            end = bounds[to] if to < len(some) else row[-1]
            if end - bounds[at] > 2 * step:  # a very long row: add up in parts
                counts[at] = sum(
                    np.unpackbits(hashes[x : min(x + step, end)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
                    for x in range(bounds[at], end, step)
                )
            else:
                bits = np.unpackbits(hashes[bounds[at] : end].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts[at:to] = np.add.reduceat(bits, bounds[at:to] - bounds[at], axis=0, dtype=np.int32)
            at = to
        set_bits = counts * 2 > n[some][:, None]
        out[some] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """``fp`` (the 64 bits as a long) of every row, with its id and the ``extra`` columns."""
    keep = [id_col, *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, SCAN_BYTES):
            fp = majority(*shingle_hashes(Words(b.column(text_col), NON_SPACE), shingle))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fp.view(np.int64))], names=[*keep, "fp"])

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text_col).mapInArrow(run, f"{types}, fp bigint")


def block_masks(max_bits: int) -> list[int]:
    """The bits erased in each family of variants: none for an even radius."""
    if max_bits % 2 == 0:
        return [0]
    cuts = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    return [((1 << hi) - 1) & ~((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]


def variants(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(block, variant, fp): everything within half the radius of each fingerprint."""
    flips = []
    for j, mask in enumerate(block_masks(max_bits)):
        kept = [b for b in range(64) if not mask >> b & 1]
        for k in range(max_bits // 2 + 1):
            flips += [(j, ~mask & (1 << 64) - 1, sum(1 << b for b in c)) for c in combinations(kept, k)]
    block = np.array([f[0] for f in flips], np.int8)
    keep = np.array([f[1] for f in flips], np.uint64)
    flip = np.array([f[2] for f in flips], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fps), 2048):
                part = fps[at : at + 2048]
                v = (part[:, None] & keep) ^ flip
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(block, len(part))), pa.array(v.ravel().view(np.int64)), pa.array(np.repeat(part, len(flip)).view(np.int64))],
                    names=["block", "variant", "fp"],
                )

    return nodes.select("fp").mapInArrow(run, "block tinyint, variant bigint, fp bigint")


def smallest(labels: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Every label replaced by the smallest among the rows of equal key."""
    order = np.lexsort((labels, key))
    head = np.r_[True, key[order][1:] != key[order][:-1]]
    out = np.empty_like(labels)
    out[order] = labels[order][head][np.cumsum(head) - 1]
    return out


def settle(labels: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Labels of the components in which rows of equal key, for any of the keys, are linked."""
    while True:
        new = labels
        for key in keys:
            new = smallest(new, key)
            new = smallest(new, labels)  # all of one label move together
        if (new == labels).all():
            return labels
        labels = new


def linked(fps: np.ndarray, mask: int, max_bits: int) -> np.ndarray:
    """For fingerprints that share a variant with the bits of ``mask`` erased: the
    position of the first fingerprint of each one's component under links of at most
    ``max_bits`` bits.

    A large run is not compared by pairs.  Outside the mask all are within two flips
    of each other, so those equal in the mask, or equal but for one bit of it, are
    links.  Pairs of more than one bit inside the mask are found under another block,
    save those with all three bits in it: they agree outside, and equal values after
    three bits are erased are links."""
    m = len(fps)
    if m <= MATRIX:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
        labels = np.arange(m)
        while True:
            new = np.where(near, labels[None, :], m).min(1)
            if (new == labels).all():
                return labels
            labels = new
    if not mask:
        return np.zeros(m, np.int64)
    erased = [np.uint64(1 << b) for b in range(64) if mask >> b & 1]
    inside = fps & np.uint64(mask)
    labels = settle(np.arange(m), [inside & ~b for b in erased])
    outside = fps & ~np.uint64(mask)
    values, count = np.unique(outside, return_counts=True)
    for v in values[count > 1] if max_bits == 3 else ():
        at = np.flatnonzero(outside == v)
        if len(at) <= MATRIX:
            sub = linked(fps[at], mask, max_bits)
            key = np.arange(m)
            key[at] = at[sub]
            labels = settle(labels, [key])
        else:
            keys = []
            for c in combinations(erased, 3):
                key = np.arange(m).astype(np.uint64) | np.uint64(1 << 63)
                key[at] = inside[at] & ~(c[0] | c[1] | c[2])
                keys.append(key)
                if len(keys) == 16:
                    labels, keys = settle(labels, keys), []
            labels = settle(labels, keys) if keys else labels
    return labels


def links(shared: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): verified links, for each run of fingerprints with one variant from every
    member to the first of its component."""
    masks = block_masks(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the open run, which may go over batches

        def edges(block: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            new = np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
            starts = np.flatnonzero(new)
            size = np.diff(np.r_[starts, len(key)])
            a, b = [], []
            two = starts[size == 2]
            ok = np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits
            a.append(fp[two + 1][ok])
            b.append(fp[two][ok])
            for s, n in zip(starts[size > 2].tolist(), size[size > 2].tolist()):
                run_fps = np.unique(fp[s : s + n])
                first = linked(run_fps, masks[block[s]], max_bits)
                moved = first != np.arange(len(run_fps))
                a.append(run_fps[moved])
                b.append(run_fps[first[moved]])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                pairs = np.unique(np.stack([a, b], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = [batch.column(c).to_numpy() for c in ("block", "variant", "fp")]
            part[2] = part[2].view(np.uint64)
            ends = np.flatnonzero((part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1]))
            same = held and held[-1][0][-1] == part[0][0] and held[-1][1][-1] == part[1][0]
            if same and not len(ends):
                held.append(tuple(part))
                continue
            cut = int(ends[-1]) + 1 if len(ends) else 0
            held.append(tuple(x[:cut] for x in part))
            whole = [np.concatenate(x) for x in zip(*held)]
            if len(whole[0]):
                yield from edges(*whole)
            held = [tuple(x[cut:] for x in part)]
        if held:
            yield from edges(*[np.concatenate(x) for x in zip(*held)])

    return shared.mapInArrow(run, "a bigint, b bigint").distinct()


def fingerprint_components(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """(node, root) for the fingerprints of ``nodes`` (distinct, column fp) that link to another one."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits from 0 to 3: larger balls need more variants than are worth a shuffle")
    dealt = variants(nodes, max_bits).repartition("block", "variant").sortWithinPartitions("block", "variant")
    return connected_components(links(dealt, max_bits))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, ``extra``, ``fp``, ``fingerprint`` (hex) and ``component_id``."""
    marked = staged(fingerprints(docs, shingle, id_col, text_col, extra), "fingerprints")
    nodes = staged(marked.groupBy("fp").agg(F.min(id_col).alias("low")), "fingerprint-nodes")
    roots = fingerprint_components(nodes, max_bits)
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    named = staged(named, "fingerprint-roots")
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = named.join(low, "root").select("fp", "component_id", "root")
    return marked.join(by_fp, "fp").select(
        id_col, *extra, "fp", "root", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (nulls
    last), and of rows that share id and text any one.  All columns stay.

    A row's key is its id and a hash of its text; the keys that go are joined against
    ``docs``, so the wide rows are neither copied nor sorted more than once."""
    key = F.xxhash64(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), key.alias("key"))
    member = staged(simhash_components(rows, shingle, max_bits, "id", "text", ("key",)).select("id", "key", "fp", "root"), "dedup-members")
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("key").alias("k"))
    # The first row of each fingerprint, then of each component from those; members meet
    # it by their fingerprint, so the documents of a large component stay spread.
    of_fp = member.groupBy("fp", "root").agg(F.min(order).alias("f"))
    first = of_fp.groupBy("root").agg(F.min("f").alias("f"))
    of_fp = staged(of_fp.select("fp", "root").join(first, "root").select("fp", "f"), "dedup-first")
    goes = ~(F.col("id").eqNullSafe(F.col("f.i")) & (F.col("key") == F.col("f.k")))
    gone = member.join(of_fp, "fp").where(goes).select("id", "key").distinct()
    wide = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"), F.col(f"`{id_col}`").alias("wid"), key.alias("wkey"))
    kept = wide.join(gone, wide.wid.eqNullSafe(gone.id) & (wide.wkey == gone.key), "left_anti")
    if not member.groupBy("id", "key").count().where("count > 1").isEmpty():  # repeated rows share their key
        kept = kept.dropDuplicates(["wid", "wkey"])
    return kept.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
