"""Dated snapshot tables and pruned scans.

Snapshots are stored as ``<root>/<table>/snapshot_date=<yyyy-MM-dd>/``; an
equality filter on the partition column prunes every other day at planning
time, so a run reads one day, not the history.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import folder_exists

SNAPSHOT_COLUMN = "snapshot_date"


def snapshot_slice(df: DataFrame, day: str, column: str = SNAPSHOT_COLUMN) -> DataFrame:
    """One dated snapshot of a table."""
    return df.filter(F.col(column) == F.to_date(F.lit(day)))


def day_slice(df: DataFrame, column: str, day: str) -> DataFrame:
    """One day of a timestamped table as a half-open range, which the scan can push down."""
    start = F.lit(day).cast(df.schema[column].dataType)
    return df.filter((F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 DAY")))


class WrongFormat(ValueError):
    """A folder does not hold the format it is said to hold."""


def read_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A table as it is now (S7).  A folder with a transaction log is never read as plain
    files: those include rows that the log has removed.  Other formats than Parquet need
    their package in the session."""
    logged = folder_exists(spark, os.path.join(path, "_delta_log"))
    if format == "delta" and not logged:
        raise WrongFormat(f"{path} has no transaction log; it is not a delta table")
    if format != "delta" and logged:
        raise WrongFormat(f"{path} has a transaction log; read it with the format 'delta', not {format!r}")
    try:
        return spark.read.format(format).load(path)
    except Exception as missing:  # Spark names an unknown format by a Java error without a Python class
        if "DATA_SOURCE_NOT_FOUND" in str(missing):
            raise WrongFormat(f"{path}: the session has no package for the format {format!r}") from missing
        raise


def read_snapshot(spark: SparkSession, root: str, table: str, day: str,
                  columns: Sequence[str] | None = None, format: str = "parquet") -> DataFrame:
    """Scan ``root/table`` pruned to one ``snapshot_date`` partition and to the needed columns."""
    df = snapshot_slice(read_table(spark, os.path.join(root, table), format), day)
    return df.select(*columns) if columns else df


def scan_pruned(df: DataFrame, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Projection (and optional filter) right at the scan: only these columns are read."""
    out = df.select(*columns)
    return out.filter(condition) if condition is not None else out


def read_pruned(spark: SparkSession, path: str, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    return scan_pruned(spark.read.parquet(path), columns, condition)
