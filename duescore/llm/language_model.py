"""Language-model scores by logistic context mixing.

The model predicts a text word by word and a word bit by bit, every occurrence in the
words before it.  A text is its words (lower-cased) and an end.  Words that occur at least
twice in training (a bounded number, the most frequent) have a Huffman code, as has the
escape that stands for all others.  For every bit of a code three predictors look at the
place in the code tree: alone (the word's plain count), hashed with the word before, and
hashed with the two words before; each holds how often the bit was 0 and 1 there in all
training texts.  Their log odds are combined by weights that a small gate picks (how often
the place and the two contexts were seen), learned online by gradient steps over all
training texts; an adaptive table then refines the mixed probability by what followed such
predictions.  Weights and table are learned from counts without the occurrence that is
being predicted.

A word without a code is the escape and its spelling: the bits of its bytes and of a closing
one, predicted and mixed the same way from the word's last bytes (orders 1 to 4) and all its
bytes so far, learned from all training occurrences of such words.  The spelling stays inside
the word, so it is one number however often the word occurs and is found once per distinct
word.  (A coded word has its code alone; what the escape would give to spelling it is unused.)
At last the words of the text so far take part: a word's probability is mixed with its share
of them, by a weight that grows with their number, so the score adapts to the text as it goes.
The probabilities of all words sum to one at most.

Equal words after equal words have equal bits, and words that begin alike share those of
their beginning: tasks find such bits once and count, learn or add them as often as they occur.

Words and their counts are gathered from all training texts by one shuffle.  Training texts
are then written as codes, in an order of their own; tasks add up the counts of the hashed
contexts of their part in tables of a fixed size, and the tables are added up block by block
by Spark.  Documents are scored in one pass; words without a code are looked up inside the
task if frequent (a bounded number), the rest by a join.

Defined results: a null text is empty and has only its end; a null id counts as held
out; repeated rows are counted and scored each; an empty table gives an empty result;
without training documents all counts are zero.  A very long text is read whole; a very
long word is spelled whole too, with about a gigabyte of a worker's memory for a
megabyte of word.  Only the id and the text are read, so clashing names do no harm.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescore.llm.common import NON_SPACE, SLICE_BYTES, Words, slices, staged

END = b"\n"  # the end of a text as a word; no word holds white space
CLOSE = 0x20
ADD = 0.1
#: log2 of the slots of each predictor: orders 1 to 4 and the whole word so far.
SLOT_BITS = (16, 20, 21, 21, 21)
#: Words with a code, at most, and the bytes that such a word has at most.
CODED, CODE_BYTES = 1 << 16, 64
#: log2 of the slots of the contexts of a code: the word before and the two before.
PAIR_BITS = (20, 21)
#: Tokens whose equal ones (after equal words) are worked on once, with their number.
RUN_TOKENS = 1 << 20
#: Different ones learned from at a time, and looked up at a time (all bits of their codes).
STEP_TOKENS, STEP_LOOKUPS = 1 << 12, 1 << 13
#: Steps down the code tree whose slots lie side by side: 15 nodes in 16 slots.
NEAR_STEPS = 4
ESCAPE, START = 0, -1
#: Slots in one row while tables are added up.
BLOCK_BITS = 14
#: Most frequent words looked up inside the tasks, at most.
HOT_WORDS = 300_000
#: Bytes of words worked on at a time (eight bits and all predictors each).
STEP_BYTES = 20_000
PRIOR = 0.05
RATE = 0.15
GATES = 8 * 4 * 4
CELLS = 33
LIMIT = 12.0
#: Weight of a text's own words after t of them: OWN * t / (t + OWN_FROM).
OWN, OWN_FROM = 0.25, 30.0
SCAN_BYTES = 8 << 20

_FIRST = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])]).astype(np.int64)
SLOTS = int(_FIRST[-1])
PAIR_SLOTS = sum(1 << b for b in PAIR_BITS)
AFTER_ONE = 1 << PAIR_BITS[1]  # the slots after the word before lie behind all others
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def held_out(ids: list) -> np.ndarray:
    """Whether crc32 of the id as text is divisible by 10; a null id is an empty text."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i in ids], bool)


@dataclass
class Bits:
    """All bits of some words: (bytes, 8) arrays."""

    slot: np.ndarray  # (predictors, bytes, 8) place in the table
    bit: np.ndarray
    node: np.ndarray  # bits of the byte so far, after a leading 1
    word: np.ndarray  # (bytes,) which word


def shared(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fresh, owner, word) of every byte of words in order: whether it is new, as the word
    before does not begin alike up to it; the number of the new byte that it is equal to (all
    before it equal too), so that their bits need to be found once; its word."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    word = np.repeat(np.arange(len(words)), size)
    start = np.cumsum(size) - size
    pos = np.arange(len(data)) - start[word]
    last = np.maximum(word - 1, 0)
    same = (word > 0) & (pos < size[last])
    same &= data == data.take(start[last] + pos, mode="clip")
    fresh = pos >= np.minimum.reduceat(np.where(same, len(data), pos), start)[word]
    # The first word that has a place has a new byte there; later ones take the last new one.
    order = np.argsort(pos.astype(np.uint16) if size.max() < 1 << 16 else pos, kind="stable")
    number = np.cumsum(fresh) - 1
    owner = np.empty(len(data), np.int64)
    owner[order] = number[order][np.maximum.accumulate(np.where(fresh[order], np.arange(len(data)), 0))]
    return fresh, owner, word


def bits_of(words: list[bytes], fresh: np.ndarray | None = None) -> Bits:
    """The bits of all bytes of the words, or of the ``fresh`` ones."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    word = np.repeat(np.arange(len(words)), size)
    start = np.cumsum(size) - size
    pos = np.arange(len(data)) - start[word]
    before = []
    for k in range(1, 5):
        prev = np.zeros(len(data), np.uint64)
        prev[k:] = data[:-k] if k < len(data) else 0
        before.append(np.where(pos >= k, prev + np.uint64(1), np.uint64(0)))
    contexts = []
    packed = np.zeros(len(data), np.uint64)
    for k in range(4):
        packed = packed << np.uint64(9) | before[k]
        contexts.append(packed)
    # The whole word so far: a polynomial of its bytes, by prefix sums modulo 2^64.
    powers = np.cumprod(np.full(int(size.max()), np.uint64(0x100000001B3)), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[pos], dtype=np.uint64)])
    contexts.append(sums[:-1] - sums[start][word] + pos.astype(np.uint64) * _MIX)
    if fresh is not None:
        data, word, contexts = data[fresh], word[fresh], [c[fresh] for c in contexts]
    shift = np.arange(8)
    node = (1 << shift) | data[:, None].astype(np.int64) >> (8 - shift)
    bit = (data[:, None] >> (7 - shift)) & 1
    slot = np.empty((len(contexts), len(data), 8), np.int64)
    wide = node.astype(np.uint64)
    for k, c in enumerate(contexts):
        seed = (c + np.uint64(k + 1)) * _MIX
        seed ^= seed >> np.uint64(29)
        h = np.add(seed[:, None], wide, out=slot[k].view(np.uint64))
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h >>= np.uint64(64 - SLOT_BITS[k])
        h += np.uint64(_FIRST[k])
    return Bits(slot, bit, node, word)


def byte_list(words: pa.Array) -> list[bytes]:
    """The words (none null) of a text or binary column, cut from its buffer: far faster than one by one."""
    if not len(words):
        return []
    arr = words.cast(pa.large_binary())
    ends = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1].tolist()
    data = arr.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes() if ends[-1] > ends[0] else b""
    first = ends[0]
    return [data[a - first : b - first] for a, b in zip(ends, ends[1:])]


def word_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """Words in runs of about STEP_BYTES (a longer word is a run of its own)."""
    for b in batches:
        words = byte_list(b.column("word"))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        lo = 0
        while lo < len(words):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + STEP_BYTES, side="right")))
            yield words[lo:hi], b.slice(lo, hi - lo)
            lo = hi


def vocabulary(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, c, c_all): occurrences of every word in training and in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, SCAN_BYTES):
            train = ~held_out(b.column(id_col).to_pylist())
            w = Words(b.column(text_col), NON_SPACE)
            codes, distinct = w.coded()
            weight = np.repeat(train, w.counts)
            c = np.bincount(codes[weight], minlength=len(distinct))
            c_all = np.bincount(codes, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([distinct.cast(pa.binary()), pa.array([END], pa.binary())]).cast(pa.string()), pa.array(np.r_[c, train.sum()].astype(np.int64)), pa.array(np.r_[c_all, b.num_rows].astype(np.int64))],
                names=["word", "c", "c_all"],
            )

    rows = docs.select(id_col, text_col).mapInArrow(run, "word string, c bigint, c_all bigint")
    return rows.groupBy("word").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def huffman(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, node, bit, counts): leaf k's path, up to the root, is at first[k]:first[k + 1] of node and bit;
    counts holds the weights of each node's two sides."""
    n = len(weight)
    order = np.argsort(weight, kind="stable")
    w, pairs = weight[order].tolist(), []
    leaf, inner = 0, n
    for _ in range(n - 1):  # leaves and inner nodes both come by rising weight
        pair = []
        for _ in range(2):
            if leaf < n and (inner >= len(w) or w[leaf] <= w[inner]):
                pair.append(leaf)
                leaf += 1
            else:
                pair.append(inner)
                inner += 1
        pairs.append(pair)
        w.append(w[pair[0]] + w[pair[1]])
    pair = np.array(pairs, np.int64).reshape(-1, 2)
    up, side = np.full(2 * n - 1, -1), np.zeros(2 * n - 1, np.int8)
    up[pair] = np.arange(n, 2 * n - 1)[:, None]
    side[pair[:, 1]] = 1
    leaves, at, parts = order, np.arange(n), []
    while True:
        inside = up[at] >= 0
        leaves, at = leaves[inside], at[inside]
        if not len(at):
            break
        parts.append((leaves, up[at] - n, side[at]))
        at = up[at]
    of, node, bit = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts)) if parts else np.zeros((3, 0), np.int64)
    place = np.argsort(of, kind="stable")
    first = np.r_[0, np.cumsum(np.bincount(of.astype(np.int64), minlength=n))]
    return first, node[place].astype(np.int32), bit[place].astype(np.int8), np.array(w)[pair].astype(np.float32).reshape(-1, 2)


@dataclass
class CodeBits:
    """All bits of the codes of some tokens."""

    slot: tuple[np.ndarray, np.ndarray]  # places in the table: after the word before, after the two before
    at: np.ndarray  # place in the paths
    start: np.ndarray  # (tokens,) where each token's bits begin
    size: np.ndarray


class Code:
    """Codes of frequent words: the escape is leaf 0, word k of ``names`` leaf k + 1."""

    def __init__(self, names: list[bytes], c: np.ndarray, escaped: int):
        self.names = names
        self.first, node, bit, self.counts = huffman(np.r_[escaped, c].astype(np.int64))
        n, bit = self.counts[node], bit.astype(np.int64)
        # Along the paths, the odds of the bit that is there: of the plain counts, and of these
        # without the occurrence that is being predicted; in their lowest bits (so that one look-up
        # finds all) the step of the node's count and whether that bit is a 0.
        sign = (2 * bit - 1).astype(np.float32)
        low = (2 * np.minimum(np.log2(n.sum(1) + 1) / 3, 7).astype(np.int32) + 1 - bit).astype(np.int32)
        without = log_odds(np.maximum(n[:, 0] - (1 - bit), 0), np.maximum(n[:, 1] - bit, 0)).astype(np.float32)
        self.odds, self.odds_without = ((x * sign).view(np.int32) + 8 & ~15 | low for x in (log_odds(n[:, 0], n[:, 1]), without))  # rounded
        # Nodes up to NEAR_STEPS steps apart share all but the last bits of the hash, which say
        # which of them it is, so that their slots are found in one place of the table.
        depth = np.repeat(self.first[1:], np.diff(self.first)) - 1 - np.arange(len(node))  # paths end at the root
        inside, turns = depth % NEAR_STEPS, np.ones(len(node), np.int64)
        for k in range(1, NEAR_STEPS):
            here = np.flatnonzero(inside == k)
            turns[here] = 2 * turns[here + 1] + bit[here + 1]
        wide = (node[np.arange(len(node)) + inside].astype(np.uint64) + np.uint64(1)) * _MIX
        # In one number the node's hashes for both contexts (the second from bit 32).
        self.path = np.zeros(len(node), np.int64)
        for table, bits in enumerate(PAIR_BITS):
            wide = (wide ^ wide >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            self.path |= ((wide >> np.uint64(64 - bits)).astype(np.int64) ^ turns) << 32 * table
        self.path_told = self.path << 1 | bit | bit << 32

    def steps(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray, told: bool) -> tuple[np.ndarray, ...]:
        """(both places in one number, place in the paths, start, size) of the bits of tokens ``ids``
        after the tokens ``one`` and, before that, ``two``; if ``told``, twice the place and the bit."""
        seed = (one + 2).astype(np.uint64) * _MIX
        seed = (seed ^ seed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        top = (seed >> np.uint64(64 - PAIR_BITS[0])).astype(np.int64) | AFTER_ONE
        seed = (seed ^ seed >> np.uint64(31)) + (two + 2).astype(np.uint64)
        seed *= np.uint64(0xD6E8FEB86659FD93)
        seed = (seed ^ seed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        top |= (seed >> np.uint64(64 - PAIR_BITS[1])).astype(np.int64) << 32
        begin = self.first[ids]
        size = self.first[ids + 1] - begin
        ends = np.cumsum(size)
        at = np.repeat(begin - ends + size, size)
        at += np.arange(len(at))
        step = (self.path_told if told else self.path).take(at, mode="clip")
        step ^= np.repeat(top << 1 if told else top, size)
        return step, at, ends - size, size

    def bits(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray, told: bool = False) -> CodeBits:
        step, at, start, size = self.steps(ids, one, two, told)
        far = step >> 32
        step &= 0xFFFFFFFF
        return CodeBits((step, far), at, start, size)


def gates(alone: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The gate and bit, as ``Mixer.signed`` has them, from what the lowest bits of the odds hold."""
    gate = near | far
    gate &= 15
    high = alone << 4
    high &= 15 << 4
    gate |= high
    return gate.astype(np.intp)


def packed(odds: np.ndarray, seen: np.ndarray, first: int) -> np.ndarray:
    """Odds with the step of how often they were seen in the lowest bits, so that one look-up
    finds both; slots from ``first`` on are those after the word before alone."""
    out = odds.view(np.int32) + 8 & ~15  # rounded
    out[:first] |= seen[:first]
    out[first:] |= seen[first:] << 2
    return out


def packed_without(counts: np.ndarray) -> np.ndarray:
    """``packed`` odds of each slot's two bits from counts without one such occurrence."""
    out = np.empty(counts.shape, np.int32)
    for bit in (0, 1):
        n0, n1 = np.maximum(counts[:, 0] - np.float32(1 - bit), 0), np.maximum(counts[:, 1] - np.float32(bit), 0)
        out[:, bit] = packed(log_odds(n0, n1) * np.float32(2 * bit - 1), level(n0 + n1), AFTER_ONE)
    return out.ravel()


def token_stream(words: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, where each row's begin): the words of the rows, an end after each row's."""
    out = np.full(len(words) + len(counts), end, np.int32)
    out[np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)] = words
    return out, np.cumsum(counts + 1) - counts - 1


@dataclass
class Places:
    """Different tokens after different ones: ``ids`` after ``one`` and, before that, ``two``."""

    ids: np.ndarray
    one: np.ndarray
    two: np.ndarray
    often: np.ndarray
    of: np.ndarray | None  # the number of each token's place

    def steps(self, most: int) -> Iterator[tuple[np.ndarray, ...]]:
        for k in range(0, len(self.ids), most):
            yield tuple(x[k : k + most] for x in (self.ids, self.one, self.two, self.often))


def places_of(ids: np.ndarray, begins: np.ndarray, leaves: int, scattered: bool = False, found: bool = False) -> Iterator[tuple[int, Places]]:
    """(place, different tokens) in runs of RUN_TOKENS, by the token before, the token and the one
    before both, or ``scattered``; with the place of each token if to be ``found``."""
    one, two = np.full((2, len(ids)), START, np.int32)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[begins] = two[begins] = START
    second = begins + 1
    two[second[second < len(ids)]] = START
    span = np.uint64(leaves + 2)
    for k in range(0, len(ids), RUN_TOKENS):
        some = slice(k, k + RUN_TOKENS)
        key = (one[some] + 2).astype(np.uint64) * span + ids[some].astype(np.uint64)
        if found:
            yield k, found_places(key, ids[some], one[some], two[some], int(span))
            continue
        key = key * span + (two[some] + 2).astype(np.uint64)
        if scattered:
            key *= _MIX  # odd, so it can be undone
        key, often = np.unique(key, return_counts=True)
        if scattered:
            key *= _UNMIX
        pair, last = np.divmod(key, span)
        first, middle = np.divmod(pair, span)
        yield k, Places(middle.astype(np.int64), first.astype(np.int64) - 2, last.astype(np.int64) - 2, often, None)


def found_places(key: np.ndarray, ids: np.ndarray, one: np.ndarray, two: np.ndarray, span: int) -> Places:
    """The places by ``key`` (token before and token), each token's too.  Sorted are numbers that
    end with the token's own, which is far faster than an order; what room they have left holds a
    hash of the token before both, so a place may, rarely, be worked on twice."""
    left = 64 - (RUN_TOKENS - 1).bit_length()
    room = left - (span * span).bit_length()
    hashed = (two + 2).astype(np.uint64) * _MIX >> np.uint64(64 - room)
    order = (key << np.uint64(room) | hashed) << np.uint64(64 - left) | np.arange(len(key), dtype=np.uint64)
    order.sort()
    order = (order & np.uint64((1 << 64 - left) - 1)).astype(np.intp)
    ids, one, two = ids[order], one[order], two[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    start = np.flatnonzero(new)
    of = np.empty(len(ids), np.intp)
    of[order] = np.cumsum(new) - 1
    ids, one, two = (x[start].astype(np.int64) for x in (ids, one, two))
    return Places(ids, one, two, np.diff(np.r_[start, len(order)]), of)


def coded_runs_of(batches: Iterator[pa.RecordBatch], leaves: int, scattered: bool = False) -> Iterator[Places]:
    """``places_of`` the codes of some training texts."""
    for b in batches:
        rows = [np.frombuffer(x.as_buffer(), np.int32) for x in b.column("codes")]
        if rows:
            size = np.fromiter(map(len, rows), np.int64, len(rows))
            for _, p in places_of(np.concatenate(rows), np.cumsum(size) - size, leaves, scattered):
                yield p


def training_codes(docs: DataFrame, id_col: str, text_col: str, code, key: str) -> DataFrame:
    """The codes of each training text and its end, in an order of its own, so that what is
    learned online depends on training texts alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places(key, "code", code.value.names)
        for b in slices(batches, text_col, SCAN_BYTES):
            train = ~held_out(b.column(id_col).to_pylist())
            w = Words(b.column(text_col), NON_SPACE)
            codes, distinct = w.coded()
            leaf = np.fromiter((at.get(x, -1) + 1 for x in byte_list(distinct)), np.int32, len(distinct))
            ids, begins = token_stream(leaf[codes], w.counts, at.get(END, -1) + 1)
            rows = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(np.r_[begins, len(ids)] * 4), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b.column(id_col).filter(pa.array(train)), rows.filter(pa.array(train)).cast(pa.binary())], names=["id", "codes"])

    rows = docs.select(id_col, text_col).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, codes binary")
    order = F.xxhash64("id", "codes")  # copies of a text go to many tasks
    return rows.repartition(order).sortWithinPartitions(order).select("codes")


def context_counts(rows: DataFrame, places_of, slots: int) -> np.ndarray:
    """(slots, 2) how often each context slot saw a 0 and a 1: ``places_of`` gives runs of
    (2 * slot + bit, how often) of some batches.  ``slots`` are whole blocks."""
    step = 1 << BLOCK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for at, weight in places_of(batches):
            table = np.zeros(2 * slots, np.float32) if table is None else table
            np.add.at(table, at, weight)
        if table is not None:
            for k in range(0, 2 * slots, 2 * step):
                part = table[k : k + 2 * step]
                if part.any():
                    part = part.astype(np.uint8 if part.max() < 256 else np.uint16 if part.max() < 65536 else np.float32)
                    yield pa.RecordBatch.from_arrays([pa.array([k // (2 * step)], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["block", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "part"])
        for b in batches:
            for block, part in zip(b.column("block").to_pylist(), b.column("part")):
                part = part.as_buffer()
                part = np.frombuffer(part, {1: np.uint8, 2: np.uint16, 4: np.float32}[part.size // (2 * step)])
                if block == now:
                    total += part
                    continue
                if now is not None:
                    yield row()
                now, total = block, part.astype(np.float32)
        if now is not None:
            yield row()

    schema = "block int, part binary"
    parts = rows.mapInArrow(count, schema).repartition("block").sortWithinPartitions("block")
    table = np.zeros(2 * slots, np.float32)
    for r in staged(parts.mapInArrow(add, schema), "context-counts").toLocalIterator():  # a table of a fixed size
        part = np.frombuffer(r.part, np.float32)
        table[r.block * 2 * step :][: len(part)] = part
    return table.reshape(slots, 2)


def spelled_places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for some, b in word_steps(batches):
        fresh, owner, word = shared(some)
        bits = bits_of(some, fresh)
        weight = np.repeat(np.bincount(owner, b.column("c").to_numpy()[word]).astype(np.float32), 8)
        for slot in bits.slot:
            yield 2 * slot.ravel() + bits.bit.ravel(), weight


def coded_places(code):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.float32]]:
        c = code.value
        for p in coded_runs_of(batches, len(c.first) - 1):
            # The first table once for each token after the one before.
            pair = np.flatnonzero(np.r_[True, (p.ids[1:] != p.ids[:-1]) | (p.one[1:] != p.one[:-1])])
            pairs = Places(p.ids[pair], p.one[pair], p.two[pair], np.add.reduceat(p.often, pair), None)
            for table, q in enumerate((pairs, p)):
                for ids, one, two, often in q.steps(STEP_LOOKUPS):
                    step, _, _, size = c.steps(ids, one, two, told=True)
                    if table:
                        step >>= 32
                    else:
                        step &= 0xFFFFFFFF
                    yield step, np.repeat(often.astype(np.float32), size)

    return run


def log_odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(PRIOR)) / (n0 + np.float32(PRIOR)))


def level(n: np.ndarray) -> np.ndarray:
    """How often a context was seen, in four steps."""
    return (n > 0.5).astype(np.int8) + (n > 3.5) + (n > 31.5)


def gate_of(node: np.ndarray, seen3: np.ndarray, seen: np.ndarray) -> np.ndarray:
    place = np.arange(0, 128, 16, dtype=np.int32)[None, :]
    return place + level(seen3) * np.int8(4) + level(seen)


class Mixer:
    """Gated weights and the table that refines the mixed probability."""

    def __init__(self, weights: np.ndarray | None = None, cells: np.ndarray | None = None, n: int = len(SLOT_BITS), nodes: int = 256):
        self.weights = np.full((GATES, n), 0.35) if weights is None else weights
        self._narrow()
        centre = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, CELLS)))
        fresh = np.stack([np.broadcast_to(1 - centre, (nodes, CELLS)), np.broadcast_to(centre, (nodes, CELLS))], 2) * 4
        self.cells = fresh.copy() if cells is None else cells  # (node, cell, bit) counts

    def _narrow(self) -> None:
        self.columns, self._refined, self._signed = np.ascontiguousarray(self.weights.T, np.float32), None, None

    def mixed(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        gate = gate.astype(np.intp, copy=False)
        out = np.zeros(gate.shape, np.float32)
        for column, x in zip(self.columns, odds):
            weighed = column.take(gate, mode="clip")
            weighed *= x
            out += weighed
        return np.clip(out, -LIMIT, LIMIT, out=out)

    def cell_of(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        cell = np.rint((x + np.float32(LIMIT)) * np.float32((CELLS - 1) / (2 * LIMIT))).astype(np.intp)
        cell += node.astype(np.intp, copy=False) * CELLS
        return cell

    def probability(self, odds: np.ndarray, gate: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Of a 1 bit: the mean of the mixed probability and its refinement."""
        x = self.mixed(odds, gate)
        if self._refined is None:
            cells = self.cells.reshape(-1, 2)
            self._refined = (cells[:, 1] / cells.sum(1)).astype(np.float32)
        return (1 / (1 + np.exp(-x)) + self._refined.take(self.cell_of(x, node), mode="clip")) / 2

    def learn(self, odds: np.ndarray, gate: np.ndarray, node: np.ndarray, bit: np.ndarray, refine: bool, often: np.ndarray | None = None) -> None:
        """One online step over some bits (that occur ``often``, or once): a damped Newton
        step for each gate's weights."""
        x = self.mixed(odds, gate)
        p = 1 / (1 + np.exp(-x))
        miss, slope, flat = (bit - p).ravel(), (p * (1 - p)).ravel(), gate.ravel().astype(np.intp, copy=False)
        if often is not None:
            often = np.broadcast_to(often, bit.shape).ravel()
            miss, slope = miss * often, slope * often
        for k, o in enumerate(odds):
            o = o.ravel()
            steep = slope * o
            up = np.bincount(flat, miss * o, GATES)
            down = np.bincount(flat, steep * o, GATES)
            self.weights[:, k] += np.clip(RATE * up / (down + 1.0), -0.3, 0.3)
        self._narrow()
        if refine:
            cell = (self.cell_of(x, node) * 2 + bit).ravel()
            self.cells += np.bincount(cell, often, self.cells.size).reshape(self.cells.shape)


    # Of codes: odds are those of the bit that is there (``signed``), and gates are by place in the
    # code tree, whether that bit is a 0, and contexts, so that nothing is done by bit.

    def signed(self, odds, gate: np.ndarray, turned: np.ndarray | None = None) -> np.ndarray:
        """The mixed odds of the bit that is there; with ``turned`` (its sign bit says so) all but
        the first odds are a 1 bit's."""
        if self._signed is None:
            self._signed = np.repeat(self.columns.reshape(len(self.columns), -1, 1, 16), 2, 2).reshape(len(self.columns), -1)
        alone, near, far = (column.take(gate, mode="clip") for column in self._signed)
        near *= odds[1]
        far *= odds[2]
        near += far
        if turned is not None:
            near.view(np.int32)[...] ^= turned
        alone *= odds[0]
        out = np.add(near, alone, out=near)
        return np.clip(out, -LIMIT, LIMIT, out=out)

    def signed_cell(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        x = x * np.float32((CELLS - 1) / (2 * LIMIT))
        x += np.float32(CELLS / 2)
        cell = gate * CELLS
        cell += x.astype(np.intp)
        return cell

    def signed_cells(self) -> np.ndarray:
        """The refined probability of the bit that is there, by ``signed_cell``."""
        part = self.cells / self.cells.sum(2, keepdims=True)
        return np.stack([part[:, :, 1].reshape(-1, 16, CELLS), part[:, ::-1, 0].reshape(-1, 16, CELLS)], 1).astype(np.float32).ravel()

    def learn_signed(self, odds, gate: np.ndarray, node: np.ndarray, bit: np.ndarray, refine: bool, often: np.ndarray) -> None:
        """``learn`` of codes' bits."""
        x = self.signed(odds, gate)
        e = np.exp(-x)
        p = 1 / (1 + e)
        e *= p
        e *= often  # what the bit's probability misses
        p *= e
        for k, o in enumerate(odds):
            weighed = e * o
            up = np.bincount(gate, weighed, 2 * GATES)
            np.multiply(p, o, out=weighed)
            weighed *= o
            down = np.bincount(gate, weighed, 2 * GATES)
            up, down = (v.reshape(-1, 2, 16).sum(1).ravel() for v in (up, down))
            self.weights[:, k] += np.clip(RATE * up / (down + 1.0), -0.3, 0.3)
        self._narrow()
        if refine:
            seen = np.bincount(self.signed_cell(x, gate), often, self.cells.size).reshape(-1, 2, 16, CELLS)
            self.cells[:, :, 1] += seen[:, 0].reshape(-1, CELLS)
            self.cells[:, :, 0] += seen[:, 1, :, ::-1].reshape(-1, CELLS)


def spelled_runs(batches: Iterator[pa.RecordBatch], counts: np.ndarray):
    """(odds, gate, node, bit, how often) of runs of words, from counts without the word itself."""
    for some, b in word_steps(batches):
        fresh, owner, word = shared(some)
        bits = bits_of(some, fresh)
        n = counts.view(np.complex64).ravel().take(bits.slot, mode="clip").view(np.float32).reshape(*bits.slot.shape, 2)
        one = bits.bit.astype(np.float32)
        n0, n1 = np.maximum(n[..., 0] - (1 - one), 0), np.maximum(n[..., 1] - one, 0)
        gate = gate_of(bits.node, (n0[2] + n1[2]), (n0[4] + n1[4]))
        yield log_odds(n0, n1), gate, bits.node, bits.bit, np.bincount(owner, b.column("c").to_numpy()[word])[:, None].astype(np.float32)


def coded_runs(code):
    def run(batches: Iterator[pa.RecordBatch], told: np.ndarray):
        """(odds, gate, gate, gate, how often) of runs of tokens, from what is ``told`` by counts without
        the token itself; odds and gates as in ``signed``."""
        c = code.value
        for p in coded_runs_of(batches, len(c.first) - 1, scattered=True):
            for ids, one, two, often in p.steps(STEP_TOKENS):
                bits = c.bits(ids, one, two, told=True)
                odds = [c.odds_without.take(bits.at, mode="clip"), *(told.take(slot, mode="clip") for slot in bits.slot)]
                gate = gates(*odds)
                yield [x.view(np.float32) for x in odds], gate, gate, gate, np.repeat(often.astype(np.float32), bits.size)

    return run


def learned_mixer(rows: DataFrame, table, runs, predictors: int = len(SLOT_BITS), nodes: int = 256, learn=Mixer.learn) -> Mixer:
    """The mixer from all rows: tasks learn online, their weights are averaged
    by the bits that they saw and their refinement counts added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, total, steps = Mixer(n=predictors, nodes=nodes), 0, 0
        fresh = mixer.cells.copy()
        for odds, gate, node, bit, often in runs(batches, table.value):
            learn(mixer, odds, gate, node, bit, refine=steps >= 4, often=often)
            total += bit.size // often.size * float(often.sum(dtype=float))
            steps += 1
        if steps:
            cells = (mixer.cells - fresh).ravel()
            some = np.flatnonzero(cells)
            n = mixer.weights.size
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[np.zeros(n, np.int64), np.ones(len(some), np.int64)]), pa.array(np.r_[np.arange(n), some]), pa.array(np.r_[mixer.weights.ravel() * total, cells[some]]), pa.array(np.r_[np.full(n, float(total)), np.zeros(len(some))])],
                names=["kind", "at", "v", "n"],
            )

    sums = rows.mapInArrow(run, "kind bigint, at bigint, v double, n double").groupBy("kind", "at").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    out = Mixer(n=predictors, nodes=nodes)
    for r in sums.collect():  # weights and refinement cells, a fixed number
        if r.kind:
            out.cells.reshape(-1)[r["at"]] += r.v
        elif r.n:
            out.weights.reshape(-1)[r["at"]] = r.v / r.n
    out._narrow()
    return out


def bit_logs(mixer: Mixer, odds, gate: np.ndarray, node: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each bit."""
    p = mixer.probability(odds, gate, node)
    return np.log(np.maximum(np.where(bit == 1, p, 1 - p), np.float32(1e-12)))


def scored_words(words: DataFrame, table, mixer: Mixer) -> DataFrame:
    """``words`` with ``logp``, the log10 probability of each one's spelling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        all_odds, seen = log_odds(counts[:, 0], counts[:, 1]), counts.sum(1)
        for some, b in word_steps(batches):
            fresh, owner, word = shared(some)
            bits = bits_of(some, fresh)
            gate = gate_of(bits.node, seen.take(bits.slot[2], mode="clip"), seen.take(bits.slot[4], mode="clip"))
            logs = bit_logs(mixer, all_odds.take(bits.slot, mode="clip"), gate, bits.node, bits.bit)
            logp = np.bincount(word, logs.sum(1, dtype=float)[owner], len(some)) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("word", "c", "c_all")), pa.array(logp)], names=["word", "c", "c_all", "logp"])

    return words.select("word", "c", "c_all").sortWithinPartitions("word").mapInArrow(run, "word string, c bigint, c_all bigint, logp double")


def code_logs(code: Code, mixer: Mixer, odds: np.ndarray, seen: np.ndarray, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """log10 of the probability of each token's code after the tokens before it in its row."""
    return packed_logs(code, mixer, mixer.signed_cells(), packed(odds, seen, AFTER_ONE), ids, begins)


def packed_logs(code: Code, mixer: Mixer, cells: np.ndarray, table: np.ndarray, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """``code_logs`` from the mixer's ``signed_cells`` and ``packed`` odds."""
    out = np.zeros(len(ids))
    for k, p in places_of(ids, begins, len(code.first) - 1, found=True):
        told = []
        for some, one, two, _ in p.steps(STEP_LOOKUPS):
            bits = code.bits(some, one, two)
            if not len(bits.at):  # every code has bits, or none
                told.append(np.zeros(len(some)))
                continue
            odds = [code.odds.take(bits.at, mode="clip"), *(table.take(slot, mode="clip") for slot in bits.slot)]
            gate = gates(*odds)
            x = mixer.signed([x.view(np.float32) for x in odds], gate, odds[0] << 31)
            refined = cells.take(mixer.signed_cell(x, gate), mode="clip")
            np.negative(x, out=x)
            np.exp(x, out=x)
            x += 1
            np.reciprocal(x, out=x)
            x += refined  # twice the mean
            np.log(x, out=x)
            told.append(np.add.reduceat(x, bits.start, dtype=float) - np.log(2) * bits.size)
        out[k : k + RUN_TOKENS] = np.concatenate(told)[p.of]
    return out / np.log(10)


def least_count(words: DataFrame, most: int, column: str = "c_all") -> int:
    """The smallest number of occurrences that no more than ``most`` words have or
    exceed, by a histogram of powers of two and of its last step."""
    step = F.floor(F.log2(column))
    left, floor = most, None
    for r in sorted(words.groupBy(step.alias("b")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.b):
        if r.n > left:
            floor = r.b
            break
        left -= r.n
    if floor is None:
        return 0
    lo, hi = 1 << floor, 2 << floor
    while hi - lo > 1:  # at most 256 counts a round
        width = max(1, (hi - lo) // 256)
        inside = words.where((F.col(column) >= lo) & (F.col(column) < hi))
        counts = inside.groupBy(F.floor((F.col(column) - lo) / width).alias("b")).agg(F.count("*").alias("n")).collect()
        bound = lo
        for r in sorted(counts, key=lambda r: -r.b):
            if r.n > left:
                bound = lo + (r.b + 1) * width
                lo, hi = lo + r.b * width, min(hi, bound)
                break
            left -= r.n
        else:
            return lo
    return hi


def frequent(words: DataFrame, most: int) -> DataFrame:
    """The words of at least ``least_count`` occurrences."""
    return words.where(F.col("c_all") >= least_count(words, most))


def earlier(row: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """How often each word stood in its row before."""
    if not len(row):
        return np.zeros(0, np.int64)
    place, code = len(row).bit_length(), int(codes.max()).bit_length()
    key = row.astype(np.int64) << code | codes
    if int(row.max()).bit_length() + code + place < 64:  # sorted with the place at the end, far faster than an order
        key <<= place
        key |= np.arange(len(row))
        key.sort()
        order = key & ((1 << place) - 1)
        key >>= place
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    start = np.flatnonzero(new)
    out = np.empty(len(row), np.int64)
    out[order] = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
    return out


def row_runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """The rows in runs of about ``most`` bytes (a longer one is a run of its own)."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log10(10^a + 10^b)."""
    return np.logaddexp2(a / np.log10(2), b / np.log10(2)) * np.log10(2)


_PLACES: dict[tuple[str, str], dict[bytes, int]] = {}


def places(key: str, kind: str, names: list[bytes]) -> dict[bytes, int]:
    """The place of each word of a run's list; workers keep the lists of one run at a time."""
    if (key, kind) not in _PLACES:
        for old in [k for k in _PLACES if k[0] != key]:
            _PLACES.pop(old, None)
        _PLACES[key, kind] = {w: k for k, w in enumerate(names)}
    return _PLACES[key, kind]


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probabilities) and bits_per_byte."""
    spark = docs.sparkSession
    key = uuid.uuid4().hex  # of this run
    counted = staged(vocabulary(docs, id_col, text_col), "vocabulary")
    total, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    bottom = total + ADD * (distinct + 1)

    # Codes of the frequent training words, and the texts as codes.
    short = (F.col("c") > 1) & (F.octet_length("word") <= CODE_BYTES)
    coded = short & (F.col("c") >= least_count(counted.where(short), CODED, "c"))
    listed = counted.where(coded).select("word", "c").toArrow()  # at most CODED short rows
    listed = listed.sort_by([("c", "descending"), ("word", "ascending")])
    own_count = listed["c"].to_numpy()
    code = spark.sparkContext.broadcast(Code(listed["word"].cast(pa.binary()).to_pylist(), own_count, total - int(own_count.sum())))
    stream = staged(training_codes(docs, id_col, text_col, code, key), "training-codes")
    counts = context_counts(stream, coded_places(code), PAIR_SLOTS)
    table = spark.sparkContext.broadcast(packed_without(counts))
    code_mixer = learned_mixer(stream, table, coded_runs(code), 1 + len(PAIR_BITS), GATES, Mixer.learn_signed)
    table.unpersist()
    pairs = spark.sparkContext.broadcast((code_mixer.signed_cells(), packed(log_odds(counts[:, 0], counts[:, 1]), level(counts.sum(1)), AFTER_ONE)))
    del counts, table

    # Spelling of all words, learned from the training words without a code.
    # In an order of its own, so that what is learned online depends on training words alone.
    train = staged(counted.where(F.col("c") > 0).where(~coded).select("word", "c").repartition("word").sortWithinPartitions("word"), "training-words")
    table = spark.sparkContext.broadcast(context_counts(train, spelled_places, SLOTS))
    mixer = learned_mixer(train, table, spelled_runs)
    words = staged(scored_words(counted, table, mixer), "scored-words")
    table.unpersist()  # the scores are written; no later task needs it
    few = frequent(words, hot_words).select("word", "c", "logp").toArrow()  # at most hot_words rows
    end = words.where(F.col("word") == END.decode()).select("c", "logp").first()
    few_words, leaf_of = few["word"].cast(pa.binary()).to_pylist(), {w: k + 1 for k, w in enumerate(code.value.names)}
    few_leaves = np.fromiter((leaf_of.get(w, ESCAPE) for w in few_words), np.int32, len(few_words))
    hot = spark.sparkContext.broadcast((few_words, few["c"].to_numpy(), few["logp"].to_numpy(), few_leaves))
    del few_words, leaf_of, few_leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, c, logp, leaves = hot.value
        at, leaf_at = places(key, "hot", names), places(key, "code", code.value.names)
        base = np.log10((c + ADD) / bottom)
        for b in slices(batches, "text", SCAN_BYTES):
            w = Words(b.column("text"), NON_SPACE)
            all_codes, distinct_words = w.coded()
            listed = byte_list(distinct_words)
            place = np.fromiter((at.get(x, -1) for x in listed), np.int64, len(listed))
            leaf = np.r_[leaves, np.int32(ESCAPE)][place]  # of the hot words; the others are looked up
            for k in np.flatnonzero(place < 0).tolist():
                leaf[k] = leaf_at.get(listed[k], -1) + 1
            del listed
            all_ids, all_begins = token_stream(leaf[all_codes], w.counts, leaf_at.get(END, -1) + 1)
            all_log = packed_logs(code.value, code_mixer, *pairs.value, all_ids, all_begins)
            all_begins = np.r_[all_begins, len(all_ids)]
            for lo, hi in row_runs(w.offsets, SLICE_BYTES):
                part, counts = b.slice(lo, hi - lo), w.counts[lo:hi]
                some, tokens = slice(w.row[lo], w.row[hi]), slice(all_begins[lo], all_begins[hi])
                codes, ids, coded_log = all_codes[some], all_ids[tokens], all_log[tokens]
                ends_at = all_begins[lo + 1 : hi + 1] - all_begins[lo] - 1
                end_log = coded_log[ends_at] + np.where(ids[ends_at] == ESCAPE, end.logp, 0.0)
                inside = np.ones(len(ids), bool)
                inside[ends_at] = False
                coded_log, escaped = coded_log[inside], ids[inside] == ESCAPE
                row = np.repeat(np.arange(part.num_rows), counts)
                t = np.arange(len(row)) - (w.row[lo:hi] - w.row[lo])[row]
                before = earlier(row, codes)
                own = OWN * t / (t + OWN_FROM)
                first, again = np.log10(1 - own), np.full(len(row), -np.inf)
                rep = before > 0
                again[rep] = np.log10(own[rep] * before[rep] / t[rep])
                # A coded word's own probability joins the second part, the first is its spelling's.
                again = np.where(escaped, again, log_sum(coded_log + first, again))
                first = np.where(escaped, coded_log + first, -np.inf)
                of = place[codes] if len(codes) else np.zeros(0, np.int64)
                ok = of >= 0
                hot_of = of[ok]
                told = log_sum(logp[hot_of] + first[ok], again[ok]) if len(c) else np.zeros(0)
                sums = [np.bincount(row[ok], v, part.num_rows) for v in (base[hot_of], told, (c[hot_of] > 0).astype(float))]
                # Other words, each occurrence with the parts of its mixture, to the join.
                other = distinct_words.take(pa.array(codes[~ok])).cast(pa.string())
                bounds = pa.array(np.searchsorted(row[~ok], np.arange(part.num_rows + 1)).astype(np.int32))
                names_at, first_at, again_at = (pa.ListArray.from_arrays(bounds, x) for x in (other, pa.array(first[~ok]), pa.array(again[~ok])))
                own_end = np.log10(1 - OWN * counts / (counts + OWN_FROM))
                length = np.bincount(row, (w.ends[some] - w.starts[some] + 1).astype(float), part.num_rows) + 2
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("id"), pa.array(held_out(part.column("id").to_pylist())), pa.array(counts.astype(np.int64) + 1),
                     pa.array(sums[2].astype(np.int64) + int(end.c > 0)), pa.array(sums[0] + np.log10((end.c + ADD) / bottom)), pa.array(sums[1] + end_log + own_end), pa.array(length), names_at, first_at, again_at],
                    names=["uid", "id", "held_out", "n_tokens", "known", "base", "model", "bytes", "words", "first", "again"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    part = staged(
        rows.mapInArrow(
            run,
            f"uid bigint, id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, model double, bytes double, words array<string>, first array<double>, again array<double>",
        ),
        "document-parts",
    )
    rest = part.where(F.size("words") > 0).select("uid", F.explode(F.arrays_zip("words", "first", "again")).alias("x"))
    rest = rest.select("uid", F.col("x.words").alias("word"), F.col("x.first").alias("first"), F.col("x.again").alias("again"))
    told = F.col("logp") + F.col("first")
    more = F.log10(1 + F.pow(F.lit(10.0), -F.abs(told - F.col("again"))))
    sums = rest.join(words.select("word", "c", "logp"), "word").groupBy("uid").agg(
        F.count_if(F.col("c") > 0).alias("known2"),
        F.sum(F.log10((F.col("c") + ADD) / bottom)).alias("base2"),
        F.sum(F.greatest(told, "again") + more).alias("model2"),
    )
    both = part.drop("words", "first", "again").join(sums, "uid", "left")

    def plus(a: str, b: str) -> Column:
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return both.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", plus("known", "known2").cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        plus("base", "base2").alias("base_score"), plus("model", "model2").alias("score"),
        (-plus("model", "model2") * float(np.log2(10)) / F.col("bytes")).alias("bits_per_byte"),
    )
