"""Sharding along a Hilbert curve, in DataFrame functions only.

Metadata columns are quantised to equally filled steps, the steps' bits are merged
to an index on a Hilbert curve, rows are ranked along the curve and cut into runs.
Neighbours on the curve are alike in every dimension, so each shard covers a small
box and a filter on any of the dimensions prunes shards by their ranges.

Defined results: null text has no bytes, a null dimension falls into the first
step, ties on the curve are ordered by id and then by row; repeated rows each get
their own slot; an empty table gives an empty result.  Nothing is collected but the
cut points and the row count.  A cell of the curve that holds very many rows is
split into buckets by a hash of the row, so that no task ranks more than about
``bucket_rows`` rows of a cell.  A very long text counts with all its bytes; only id, text
and the named dimensions are read, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from duescore.llm.common import staged

BITS = 4
BUCKET_ROWS = 50_000


def curve_tables(n: int) -> tuple[list[int], list[int], list[int]]:
    """Turns of the Hilbert curve in n dimensions, indexed by value * n + direction:
    the rank of a corner, the change of entry corner, and the next direction."""
    full = (1 << n) - 1
    gray = [i ^ i >> 1 for i in range(1 << n)]

    def right(x: int, k: int) -> int:
        return (x >> k | x << n - k) & full

    def ones(i: int) -> int:
        return (~i & i + 1).bit_length() - 1

    def entry(i: int) -> int:
        return gray[2 * ((i - 1) // 2)] if i else 0

    def turn(i: int) -> int:
        return 0 if i == 0 else ones(i - 1) % n if i % 2 == 0 else ones(i) % n

    pairs = [(v, d) for v in range(1 << n) for d in range(n)]
    return (
        [gray.index(right(v, (d + 1) % n)) for v, d in pairs],
        [right(entry(v), (n - (d + 1)) % n) for v, d in pairs],
        [(d + turn(v) + 1) % n for v, d in pairs],
    )


def hilbert_index(dims: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of the cell whose coordinates are ``dims`` (0 to 2^bits - 1)."""
    n = len(dims)
    rank, enter, turn = (F.array(*map(F.lit, t)) for t in curve_tables(n))

    def corner(level: int) -> Column:
        out = F.lit(0)
        for i, d in enumerate(dims):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(d.cast("int"), level).bitwiseAND(F.lit(1)), i))
        return out

    def step(at: Column, value: Column) -> Column:
        w = F.get(rank, value.bitwiseXOR(at["e"]) * n + at["d"])
        return F.struct(
            (at["h"] * (1 << n) + w).alias("h"),
            at["e"].bitwiseXOR(F.get(enter, w * n + at["d"])).alias("e"),
            F.get(turn, w * n + at["d"]).alias("d"),
        )

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.array(*[corner(b) for b in reversed(range(bits))]), start, step, lambda x: x["h"])


def common_start(a: str, b: str) -> str:
    """The longest common start of two texts in hex, in whole bytes."""
    n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[: n // 2 * 2]


def text_cuts(df: DataFrame, column: str, steps: int) -> list[str]:
    """Texts in hex that cut the column's values, in the order of their bytes, into about
    equally filled steps; whole values count, however long a start they share.

    Starts that hold more than a step's share are opened at the next byte where
    their values differ, so the driver gets at most 257 counts for each of fewer than
    ``steps`` starts a round."""
    values = df.where(F.col(column).isNotNull()).select(F.hex(F.col(column).cast("binary")).alias("h"))
    counted = [F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")]
    total, lo, hi = values.agg(*counted).first()
    filled: dict[str, int] = {}
    opened = [common_start(lo, hi)] if total and lo != hi else []
    while opened:
        child = F.coalesce(*[F.when(F.startswith("h", F.lit(p)), F.substring("h", 1, len(p) + 2)) for p in opened])
        rows = values.select(child.alias("start"), "h").where("start is not null").groupBy("start").agg(*counted).collect()
        opened = []
        for r in rows:
            if r.n * steps > total and r.lo != r.hi:
                opened.append(common_start(r.lo, r.hi))
            else:
                filled[r.start] = r.n
    cuts, before = [], 0
    for start in sorted(filled):
        if before * steps >= total * (len(cuts) + 1) or (before and filled[start] * steps > total):
            cuts.append(start)
        before += filled[start]
    return cuts


def quantised(df: DataFrame, dims: list[str], bits: int) -> list[Column]:
    """Step of each dimension: numbers are cut at their quantiles (a mergeable sketch),
    texts by counts of whole values."""
    at = [k / (1 << bits) for k in range(1, 1 << bits)]
    texts = [c for c in dims if isinstance(df.schema[c].dataType, StringType)]
    numbers = [c for c in dims if c not in texts]
    cuts = df.agg(*[F.percentile_approx(c, at, 10_000).alias(c) for c in numbers]).first() if numbers else {}
    out = []
    for c in dims:
        if c in texts:
            above = [F.hex(F.col(c).cast("binary")) >= p for p in text_cuts(df, c, 1 << bits)[: (1 << bits) - 1]]
        else:
            above = [F.col(c) > p for p in sorted(set(cuts[c] or []))]
        step = sum((F.when(x, 1).otherwise(0) for x in above), F.lit(0)) if above else F.lit(0)
        out.append(F.coalesce(step, F.lit(0)))
    return out


def hilbert_shards(rows: DataFrame, dims: list[str], order: list[str], shards: int, bits: int = BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``curve`` (cell index), ``shard`` (counts at most one apart) and
    ``slot`` (gapless from 0).  ``rows`` should be narrow and cheap to read twice; its
    ``order`` columns settle ties and should tell rows apart."""
    cells = rows.withColumn("curve", hilbert_index(quantised(rows, dims, bits), bits))
    count = cells.groupBy("curve").agg(F.count("*").alias("n"))
    # At most 2^(bits * dimensions) cells, so this window and broadcast have a fixed bound.
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    count = count.select(
        "curve", F.ceil(F.col("n") / bucket_rows).alias("buckets"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_from")
    )
    dealt = cells.join(F.broadcast(count), "curve").withColumn("bucket", F.pmod(F.xxhash64(*order), F.col("buckets")))
    inner = Window.partitionBy("curve").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = dealt.groupBy("curve", "bucket", "cell_from").agg(F.count("*").alias("n")).select(
        "curve", "bucket", (F.col("cell_from") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("start")
    )
    total = rows.count()
    place = F.col("start") + F.row_number().over(Window.partitionBy("curve", "bucket").orderBy(*order)) - 1
    ranked = dealt.drop("cell_from", "buckets").join(start, ["curve", "bucket"]).withColumn("place", place.cast("long"))
    return ranked.withColumn("shard", F.expr(f"cast((place * {shards}) div {max(total, 1)} as int)")).withColumn(
        "slot", F.col("place") - F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    ).drop("start", "place", "bucket")


def document_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every document along the curve of size, language, source and id."""
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 8
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        F.log2(size).alias("_size"),
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        F.col(id_col).cast("double").alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = hilbert_shards(staged(narrow, "shard-rows"), ["_size", "_lang", "_source", "_id"], ["doc_id", "text_crc32", "_row"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def shard_ranges(placed: DataFrame, dims: list[str]) -> DataFrame:
    """One row per shard with the least and largest value of each dimension, for pruning."""
    return placed.groupBy("shard").agg(
        F.count("*").alias("rows"), *[f(c).alias(f"{name}_{c}") for c in dims for name, f in (("min", F.min), ("max", F.max))]
    )
