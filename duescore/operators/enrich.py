"""Joins that attach facts about the person to portfolio rows.

Grain rule: every helper that enriches ``left`` keeps its row count, because
the right side is first reduced to one row per join key (``distinct`` or
``groupBy``).  Both reductions are hash aggregates with a map-side partial
step, so a hot key (one person with a third of all events) is collapsed before
the shuffle, and the join that follows has a unique right side.  A single join
directly over two shuffles lets AQE split a hot key on the left; where the
right side is itself an aggregate (no plain shuffle to split),
``salted_left_join`` spreads hot keys with salts chosen from a bounded broadcast.
Nothing else is broadcast by hint: AQE broadcasts a side only after measuring
it below the configured threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import at_or_before, on_or_after


def _cond(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    cond = None
    for lk, rk in zip(left_keys, right_keys, strict=True):
        term = left[lk] == right[rk]
        cond = term if cond is None else cond & term
    return cond


# -- filters (F5-F8) ----------------------------------------------------------

def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Tag equality, e.g. creditor or document type."""
    return df.filter(F.col(column) == F.lit(value))


def filter_not_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Status exclusion; a null status is dropped too."""
    return df.filter(F.col(column) != F.lit(value))


def exclude_containing(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose text holds none of ``values`` as a substring; null text is dropped.

    The file rule used this to drop control records by type; record types are
    compared after trimming instead (``strip_control_records``, Q20).
    """
    cond = None
    for v in values:
        term = ~F.col(column).contains(F.lit(v))
        cond = term if cond is None else cond & term
    return df.filter(cond)


def asof_cutoff(df: DataFrame, ts_column: str, day: str, inclusive_day: bool = False) -> DataFrame:
    """Keep events up to the file date."""
    return df.filter(at_or_before(ts_column, day, inclusive_day))


def since_date(df: DataFrame, column: str, day: str) -> DataFrame:
    """Lower bound on a date or ISO date text."""
    return df.filter(on_or_after(column, day))


# -- joins (JN1-JN8) ----------------------------------------------------------

def inner_join_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner equi-join on a shared key (JN1)."""
    return left.join(right, on=key, how="inner")


def left_join_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                   right_keys: Sequence[str], drop_right: bool = True) -> DataFrame:
    """Left equi-join on differently named keys; the right keys are dropped (JN2, JN3)."""
    out = left.join(right, _cond(left, right, left_keys, right_keys), "left")
    if drop_right:
        for rk in right_keys:
            out = out.drop(right[rk])
    return out


def exists_flag(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                name: str) -> DataFrame:
    """``name`` is true when ``right`` has a row with the same keys (JN4, W3).

    The right side is reduced to its distinct keys first, so the left row count
    never changes.
    """
    marks = right.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(right_keys)]).distinct() \
        .withColumn("__hit", F.lit(True))
    cond = None
    for i, lk in enumerate(left_keys):
        term = left[lk] == marks[f"__k{i}"]
        cond = term if cond is None else cond & term
    out = left.join(marks, cond, "left")
    return out.withColumn(name, F.coalesce(F.col("__hit"), F.lit(False))) \
        .drop("__hit", *[f"__k{i}" for i in range(len(right_keys))])


def anti_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a match in ``right`` (JN5), written as ``left_anti``."""
    return left.join(right, _cond(left, right, left_keys, right_keys), "left_anti")


def exists_same_creditor(rows: DataFrame, creditor_debts: DataFrame, name: str,
                         person: str = "_id", row_contract: str = "CONTA",
                         debt_contract: str = "contract") -> DataFrame:
    """Flag persons holding a debt at the creditor that is not among their rows (JN6).

    Debts absent from the rows come from an anti join on (person, contract);
    the flag is then set per person (distinct persons first, Q4).
    """
    present = rows.select(F.col(person).alias("__p"), F.col(row_contract).alias("__c"))
    missing = creditor_debts.select(person, debt_contract) \
        .join(present, (F.col(person) == F.col("__p")) & (F.col(debt_contract) == F.col("__c")), "left_anti")
    return exists_flag(rows, missing, [person], [person], name)


def earliest_per_group(df: DataFrame, keys: Sequence[str], order_column: str) -> DataFrame:
    """Rows holding the group minimum of ``order_column``; ties are all kept (JN7, A2).

    ``rank() = 1``: Spark keeps only each task's first rows of a group before the
    shuffle, so the input is read once and a hot group arrives as its ties (which the
    window spills if they are many).  Rows with a null key or ``order_column`` never match.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, order_column)])
    place = F.rank().over(Window.partitionBy(*keys).orderBy(order_column))
    return df.filter(known).withColumn("__place", place).filter(F.col("__place") == 1).drop("__place")


def count_per_key(events: DataFrame, key: str, out_key: str, name: str) -> DataFrame:
    """Number of rows per key (A1)."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias(name)).withColumnRenamed(key, out_key)


def count_asof(left: DataFrame, events: DataFrame, event_key: str, left_key: str, name: str,
               creditor: str | None = None, ts_column: str | None = None, day: str | None = None,
               inclusive_day: bool = False, creditor_column: str = "creditor") -> DataFrame:
    """Left join of the number of events per key up to a date; no events gives 0 (JN8)."""
    ev = events
    if creditor is not None:
        ev = filter_equals(ev, creditor_column, creditor)
    if ts_column is not None and day is not None:
        ev = asof_cutoff(ev, ts_column, day, inclusive_day)
    counts = ev.groupBy(event_key).agg(F.count(F.lit(1)).alias(name)).withColumnRenamed(event_key, "__key")
    out = left.join(counts, left[left_key] == counts["__key"], "left").drop("__key")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


# -- first, latest, distinct (A8, A9, W1, W2) ----------------------------------

def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows."""
    return df.distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str],
                  latest: bool = False) -> DataFrame:
    """One row per key, chosen by a total order, then by the columns.

    ``row_number() = 1``: each task keeps one row of a key before the shuffle, so a hot
    key never reaches one task with its rows.  Nulls come first in ascending order,
    so ``latest=True`` never prefers a null date.
    """
    by = [*order, *[F.col(c) for c in columns]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[o.desc() if latest else o.asc() for o in by]))
    return df.withColumn("__place", place).filter(F.col("__place") == 1).select(*keys, *[F.col(c) for c in columns])


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """Row count as a one-row DataFrame (A10), without a driver action."""
    return df.agg(F.count(F.lit(1)).alias(name))


def hot_keys(counts: DataFrame, keys: Sequence[str], count_column: str, min_rows: int, top_k: int) -> DataFrame:
    """Keys holding at least ``max(min_rows, ceil(total / top_k))`` rows, with the number of
    salts that spreads each over tasks of about that many rows.

    At most ``top_k`` keys can hold a ``top_k``-th of all rows, so the result has a
    proven size bound and is safe to broadcast without leaving out any larger key.
    """
    total = counts.select(F.coalesce(F.sum(count_column), F.lit(0))).scalar()
    least = F.greatest(F.lit(min_rows).cast("bigint"), F.ceil(total / F.lit(top_k)).cast("bigint"))
    return counts.filter(F.col(count_column) >= least) \
        .select(*keys, F.ceil(F.col(count_column) / least).cast("int").alias("__salts"))


def _null_safe(a: DataFrame, b: DataFrame, ak: Sequence[str], bk: Sequence[str]) -> Column:
    c = None
    for x, y in zip(ak, bk, strict=True):
        t = a[x].eqNullSafe(b[y])
        c = t if c is None else c & t
    return c


def salted_left_join(left: DataFrame, facts: DataFrame, left_keys: Sequence[str], fact_keys: Sequence[str],
                     hot: DataFrame) -> DataFrame:
    """Left join to a table with one row per key, with hot keys salted (null-safe key equality).

    ``hot`` (a ``hot_keys`` result: keys plus ``__salts``, of bounded size) is
    broadcast.  A row of a hot key gets salt
    ``xxhash64(row) mod __salts`` (deterministic, so a recomputed partition
    gets the same salts), other rows salt 0; the fact row of a hot key is
    repeated once per salt.  The join on (keys, salt) then spreads a key holding
    a third of the rows over ``__salts`` tasks, reads ``left`` once, and equals
    ``left.join(facts, keys, "left")``.
    """
    names = [f"__h{i}" for i in range(len(fact_keys))]
    hb = F.broadcast(hot.select(*[F.col(k).alias(n) for k, n in zip(fact_keys, names)], "__salts"))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    marked = left.join(hb, _null_safe(left, hb, left_keys, names), "left")
    marked = marked.withColumn("__salt", F.when(F.col("__salts").isNull(), F.lit(0))
                               .otherwise(F.pmod(row_hash, F.col("__salts")).cast("int"))).drop(*names, "__salts")
    spread = facts.join(hb, _null_safe(facts, hb, fact_keys, names), "left")
    spread = spread.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))) \
        .drop(*names, "__salts").withColumnRenamed("__salt", "__fsalt")
    cond = _null_safe(marked, spread, left_keys, fact_keys) & (marked["__salt"] == spread["__fsalt"])
    return marked.join(spread, cond, "left").drop("__salt", "__fsalt", *fact_keys)
