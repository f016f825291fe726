"""Quality classifier by importance resampling.

Hashed n-gram generative models of target text (documents labelled good) and of raw
text (labelled junk, labelled toxic) give every document a log importance weight:
the sum of the log ratios of its n-grams, one sum per kind of raw text, the smaller
one counts.  Documents are then sampled without replacement by Gumbel top-k on the
weights, at temperature one: a document is drawn with a chance in proportion to its
importance weight.  The size of the sample is a share of all rows, or by default the
number of documents whose weight reaches the threshold (as many as the models take for
target text), so that clean documents are kept and only the border is left to chance.

An n-gram is a word or a run of punctuation (lower-cased), hashed to a bucket; a
word that repeats its predecessor is one n-gram of its own.  A bucket enters a ratio
only if its continuation counts (how many different predecessors it has in each
model, which copies of one text do not raise) differ by more than chance; in all
others both models share one estimate and the ratio is zero.  New predecessors get
rarer the more text there is, so the side with more documents counts those that a
draw of as many documents as the other side has would show on average, scaled back.

The models are fitted on a bounded sample of labelled rows, at most ``fit_docs`` of
each class for each ratio, whatever the other side has; scoring, the number k and
the cut cover all documents.

Defined results: null and empty texts have weight zero; a document with repeated
labels counts as its worst; without both sides of a ratio that ratio is zero; rows
that tie at the k-th place are all kept.  The noise depends on the id alone, so a
rerun draws the same sample.  Long texts are read whole; repeated rows are drawn
together, as their noise and weight agree; an empty table gives an empty result.
``classified`` reads the id and the text alone, ``resampled`` works on renamed columns, so
further columns of any name do not clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescore.llm.common import LOWER, slices, staged, text_buffer

BUCKET_BITS = 20
#: Labelled documents of each class and ratio that the models are fitted on, at most.
FIT_DOCS = 5_000
#: Standard deviations by which a bucket's continuation counts must differ.
SIGNIFICANT = 3.5
THRESHOLD = -5.0
SEED = 4

_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 2
_CLASS[0x30:0x3A] = 1
_CLASS[0x41:0x5B] = 1
_CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 1


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, predecessor's hash) of every n-gram; bucket 0 is the repeated word."""
    data, offsets = text_buffer(texts)
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    kind = _CLASS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]] | edge[:-1])
    ends = np.r_[starts[1:], len(data)]
    words = kind[starts] > 0
    starts, ends = starts[words], ends[words]
    cuts = np.r_[0, np.cumsum(ends - starts)]
    arr = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(LOWER[data][kind > 0])])
    coded = arr.dictionary_encode()
    h = np.array([xxhash.xxh64_intdigest(x) for x in coded.dictionary.to_pylist()], np.uint64)[coded.indices.to_numpy()]
    at = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    first = np.zeros(len(starts), bool)
    first[at[:-1][np.diff(at) > 0]] = True
    before = np.r_[np.zeros(1, np.uint64), h[:-1]][: len(h)]
    before[first] = 0
    repeat = ~first & (before == h)
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + 1
    before = (before >> np.uint64(48)).astype(np.int64)
    return np.r_[row, row[repeat]], np.r_[bucket, np.zeros(repeat.sum(), np.int64)], np.r_[before, before[repeat]]


def labelled_sample(labels: DataFrame, fit_docs: int, id_col: str) -> DataFrame:
    """(id, side): the documents of each ratio's two sides, by the order of a hash.  Sides
    0 and 1 are good and junk, 2 and 3 good and toxic; at most 4 * ``fit_docs`` rows."""
    one = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    kind = F.when(F.col("t") == 1, "toxic").when(F.col("q") == 0, "junk").when((F.col("q") == 1) & F.coalesce(F.col("t") == 0, F.lit(True)), "good")
    one = staged(one.select(F.col(id_col).alias("id"), kind.alias("kind")).where("kind is not null"), "labels")
    n = {r.kind: r.n for r in one.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    sides = []
    for side, (bad, name) in enumerate((("junk", "good"), ("junk", "junk"), ("toxic", "good"), ("toxic", "toxic"))):
        k = min(fit_docs, n.get(name, 0)) if n.get(bad) and n.get("good") else 0
        sides.append(one.where(F.col("kind") == name).orderBy(F.xxhash64("id"), "id").limit(k).select("id", F.lit(side).cast("tinyint").alias("side")))
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return staged(out, "label-sample")


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """(2, buckets) log ratios of target to junk and to toxic text."""
    sample = labelled_sample(labels, fit_docs, id_col)
    # The sample has at most 4 * fit_docs rows of nine bytes, so it is broadcast.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id").select("side", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            row, bucket, before = ngrams(b.column("text"))
            side = b.column("side").to_numpy().astype(np.int64)[row]
            in_row, n = np.unique(((side << BUCKET_BITS + 1 | bucket) << 16 | before) << 24 | row, return_counts=True)
            key, at, d = np.unique(in_row >> 24, return_index=True, return_counts=True)
            n = np.add.reduceat(n, at) if len(at) else n
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(d)], names=["key", "n", "d"])

    pairs = rows.mapInArrow(run, "key bigint, n bigint, d bigint").groupBy("key").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    side = F.shiftright("key", 17 + BUCKET_BITS)
    bucket = F.shiftright("key", 16).bitwiseAND(F.lit((1 << BUCKET_BITS + 1) - 1))
    size = {r.side: r.n for r in sample.groupBy("side").agg(F.count("*").alias("n")).collect()}
    drawn = [min(1.0, size.get(s ^ 1, 0) / size[s]) if size.get(s) else 1.0 for s in range(4)]
    # The chance that a draw of this share of the side's documents shows the predecessor.
    seen = [(1 - F.pow(F.lit(1 - r), F.col("d"))) / r if r else F.lit(0.0) for r in drawn]
    one = pairs.select(side.alias("side"), bucket.alias("bucket"), "n", "d").groupBy("bucket").agg(
        *[F.sum(F.when(F.col("side") == s, seen[s]).otherwise(0.0)).alias(f"c{s}") for s in range(4)],
        *[F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)).alias(f"n{s}") for s in range(4)],
    )
    one = staged(one, "ngram-counts")
    total = one.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in one.columns if c != "bucket"]).first()
    ratios = np.zeros((2, (1 << BUCKET_BITS) + 1))
    for k, (a, b) in enumerate(((0, 1), (2, 3))):
        if not (total[f"c{a}"] and total[f"c{b}"]):
            continue
        share = total[f"c{a}"] / (total[f"c{a}"] + total[f"c{b}"])
        both = F.col(f"c{a}") + F.col(f"c{b}")
        apart = F.abs(F.col(f"c{a}") - both * share) > SIGNIFICANT * F.sqrt(both * (share * (1 - share))) + 1
        # Only buckets that differ; there are at most 2^BUCKET_BITS + 1.
        for r in one.where(apart).select("bucket", f"n{a}", f"n{b}").toLocalIterator():
            ratios[k, r[0]] = np.log((r[1] + 0.5) / total[f"n{a}"]) - np.log((r[2] + 0.5) / total[f"n{b}"])
    return ratios


def log_weights(texts: Column, ratios: np.ndarray) -> Column:
    """Struct (junk, toxic) of the log importance weights against each raw model."""
    used = np.flatnonzero(ratios.any(0))
    values = ratios[:, used]

    @F.arrow_udf("junk double, toxic double")
    def weights(text: pa.Array) -> pa.Array:
        table = np.zeros((2, (1 << BUCKET_BITS) + 1), np.float32)
        table[:, used] = values
        sums = []
        for b in slices(iter([pa.RecordBatch.from_arrays([text], names=["text"])])):
            row, bucket, _ = ngrams(b.column("text"))
            sums.append([np.bincount(row, t[bucket], b.num_rows) for t in table])
        junk, toxic = (np.concatenate([s[k] for s in sums]) if sums else np.zeros(0) for k in range(2))
        return pa.StructArray.from_arrays([pa.array(junk), pa.array(toxic)], names=["junk", "toxic"])

    return weights(texts)


def gumbel_key(weight: Column, ident: Column, seed: int = SEED) -> Column:
    """The log weight plus Gumbel noise drawn from the id's hash: its k largest values are a
    sample of k rows without replacement, in proportion to the weights."""
    u = (F.shiftrightunsigned(F.xxhash64(ident, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return weight - F.log(-F.log(u))


def kth_largest(values: DataFrame, k: int, bins: int = 1024, few: int = 10_000) -> float:
    """The k-th largest of the one column of ``values``, by narrowing histograms: what
    the driver gets is ``bins`` counts a round and at last at most ``few`` values."""
    c = values.columns[0]
    lo, hi, n = values.agg(F.min(c), F.max(c), F.count(c)).first()
    if not n or k <= 0:
        return float("inf")
    if k >= n:
        return lo
    above = 0
    while lo < hi:
        width = (hi - lo) / bins
        inside = values.where((F.col(c) >= lo) & (F.col(c) <= hi))
        step = F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1))
        counts = {r.b: r for r in inside.groupBy(step.alias("b")).agg(F.count("*").alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).collect()}
        for b in sorted(counts, reverse=True):
            if above + counts[b].n >= k:
                break
            above += counts[b].n
        lo, hi = counts[b].lo, counts[b].hi
        if counts[b].n <= few:
            last = sorted((r[0] for r in values.where((F.col(c) >= lo) & (F.col(c) <= hi)).collect()), reverse=True)
            return last[k - above - 1]
    return lo


def weighed(docs: DataFrame, ratios: np.ndarray, id_col: str, text_col: str, seed: int = SEED) -> DataFrame:
    """``docs`` with ``_w``, the struct of weights, and ``_key``, the sampling key."""
    w = docs.withColumn("_w", log_weights(F.col(text_col), ratios))
    return w.withColumn("_key", gumbel_key(F.least("_w.junk", "_w.toxic"), F.col(id_col), seed))


def sampling_cut(scored: DataFrame, threshold: float = THRESHOLD, share: float | None = None) -> float:
    """The sampling key that the k best rows reach: k is ``share`` of all rows, or the number
    of rows with a weight of at least ``threshold``."""
    enough = F.least("_w.junk", "_w.toxic") >= threshold
    k = scored.where(enough).count() if share is None else round(share * scored.count())
    return kth_largest(scored.select("_key"), k)


def classified(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", share: float | None = None, seed: int = SEED) -> DataFrame:
    """One row per document: id, log weights, sampling key and ``keep``."""
    ratios = fit(docs, labels, fit_docs, id_col, text_col)
    scored = staged(weighed(docs.select(id_col, text_col), ratios, id_col, text_col, seed).drop(text_col), "weights")
    cut = sampling_cut(scored, threshold, share)
    return scored.select(
        id_col,
        F.col("_w.junk").alias("log_weight_junk"),
        F.col("_w.toxic").alias("log_weight_toxic"),
        F.least("_w.junk", "_w.toxic").alias("log_weight"),
        F.col("_key").alias("sampling_key"),
        (F.col("_key") >= cut).alias("keep"),
    )


def resampled(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", share: float | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` without the documents that the sample leaves out; all columns stay.  The
    texts are weighed a second time rather than shuffled to their decisions."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    ratios = fit(docs, labels, fit_docs, id_col, text_col)
    ident, text = names[id_col], names[text_col]
    cut = sampling_cut(staged(weighed(plain.select(ident, text), ratios, ident, text, seed).drop(text), "weights"), threshold, share)
    return weighed(plain, ratios, ident, text, seed).where(F.col("_key") >= cut).select(*[F.col(n).alias(c) for c, n in names.items()])
