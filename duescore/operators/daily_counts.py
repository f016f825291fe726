"""Activity counts as mergeable daily partials (JN8, A1).

The as-of count of a file day sums all activity up to it.  Instead of reading the whole
history on every run, each day's events are counted once per key into a state table
partitioned by day; a run adds or replaces its day, and the as-of count sums the state.
A day's events at midnight are counted apart, because the file rule's cutoff is the
midnight that begins the file day (Q5).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_literal
from ..sources.sinks import write_table
from ..sources.snapshots import day_slice

STATE_DAY = "day"


def day_partials(events: DataFrame, key: str, ts_column: str, creditor_column: str = "creditor") -> DataFrame:
    """(key, creditor, day, at_midnight, n): events per key, creditor and day."""
    ts = F.col(ts_column).cast("timestamp")
    day = F.to_date(ts)
    return events.where(ts.isNotNull()).groupBy(F.col(key).alias("key"), F.col(creditor_column).alias("creditor"), day.alias(STATE_DAY)).agg(
        F.count_if(ts == day.cast("timestamp")).alias("at_midnight"), F.count(F.lit(1)).alias("n"))


def store_day(events: DataFrame, root: str, day: str, key: str, ts_column: str, creditor_column: str = "creditor") -> None:
    """Count one day of the events and replace that day of the state; only that day is read.

    A day without events is replaced by an empty one, so a corrected day loses what
    it held."""
    one = day_slice(events, ts_column, day)
    partials = day_partials(one, key, ts_column, creditor_column).drop(STATE_DAY)
    write_table(partials, os.path.join(root, f"{STATE_DAY}={day}"))


def store_history(events: DataFrame, root: str, key: str, ts_column: str, creditor_column: str = "creditor") -> None:
    """The state of all days in one pass, for the first run."""
    partials = day_partials(events, key, ts_column, creditor_column)
    write_table(partials.repartition(STATE_DAY), root, [STATE_DAY])


def read_state(spark: SparkSession, root: str, key_type: str = "string", creditor_type: str = "string") -> DataFrame:
    return spark.read.schema(f"key {key_type}, creditor {creditor_type}, at_midnight bigint, n bigint, {STATE_DAY} date").parquet(root)


def count_from_state(left: DataFrame, state: DataFrame, left_key: str, name: str, day: str, creditor: str | None = None,
                     inclusive_day: bool = False) -> DataFrame:
    """``count_asof`` from the state: days after the file day are pruned, the file day itself
    counts its midnight only (or all of it); no activity gives 0."""
    last = day_literal(day)
    rows = state.where(F.col(STATE_DAY) <= last)
    if creditor is not None:
        rows = rows.where(F.col("creditor") == F.lit(creditor))
    part = F.col("n") if inclusive_day else F.when(F.col(STATE_DAY) < last, F.col("n")).otherwise(F.col("at_midnight"))
    counts = rows.groupBy(F.col("key").alias("__key")).agg(F.sum(part).alias(name))
    out = left.join(counts, left[left_key] == counts["__key"], "left").drop("__key")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))
