"""Writers: feature base, scores, second destination, provenance.

Outputs are partitioned Parquet written by the executors in parallel.  A
single delimited file is produced only on request for small results (the
published scores, one row per person); the feature base is never forced into
one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def provenance(df: DataFrame, **values) -> DataFrame:
    """Constant provenance columns: file name, file date, provider, run date...."""
    cols = {}
    for k, v in values.items():
        if isinstance(v, _dt.date):
            cols[k] = F.to_date(F.lit(v.isoformat()))
        else:
            cols[k] = F.lit(v)
    return df.withColumns(cols)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a stage table as Parquet (S10); rewrites only the partitions present."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def export_delimited(df: DataFrame, path: str, sep: str = ";", single_file: bool = False,
                     mode: str = "overwrite") -> None:
    """Delimited export with a header (S10, S11).  ``single_file`` only for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def publish(df: DataFrame, spark: SparkSession, primary: str, secondary: str, sep: str = ";",
            single_file: bool = False) -> DataFrame:
    """Write the scores, then copy them to a second destination.

    The copy reads the written files back, so the scoring plan runs once and an
    executor lost during the copy re-reads files instead of recomputing scores.
    The copy is written in parallel; ``single_file`` is for small results only.
    """
    write_table(df, primary)
    written = spark.read.parquet(primary)
    export_delimited(written, secondary, sep=sep, single_file=single_file)
    return written
