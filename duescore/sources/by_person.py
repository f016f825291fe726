"""Snapshots stored by person (S6, JN1).

A snapshot day of a table is written once as a bucketed table: rows with one person id
are in one bucket, sorted by it.  Tables with the same number of buckets then join and
aggregate by the person without a shuffle, which pays off where one day's profile, debts
and activity are joined for several portfolios.  The files carry their bucket in their
names, so another session (or another catalog) attaches a written day by its folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of all tables: about this many tasks read a day, and a bucket of 100 TB is 10 GB.
BUCKETS = 10_000


def _name(table: str, day: str) -> str:
    return f"{table.lower().replace('/', '_')}_{day.replace('-', '')}"


def day_path(root: str, table: str, day: str) -> str:
    return os.path.join(root, f"{table}_by_person", f"snapshot_day={day}")


def store_by_person(df: DataFrame, root: str, table: str, day: str, key: str = "_id", buckets: int = BUCKETS) -> DataFrame:
    """Write one day bucketed by the person and return it as a table.  Rows go to their
    bucket before the write, so there is one file per bucket."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{_name(table, day)}`")
    rows = df.repartition(buckets, F.col(key))
    rows.write.format("parquet").mode("overwrite").option("path", day_path(root, table, day)) \
        .bucketBy(buckets, key).sortBy(key).saveAsTable(_name(table, day))
    return spark.table(_name(table, day))


def attach_by_person(spark: SparkSession, root: str, table: str, day: str, schema: str, key: str = "_id", buckets: int = BUCKETS) -> DataFrame:
    """A day written by ``store_by_person``, in a session that does not know it; no data is read."""
    name = _name(table, day)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(f"CREATE TABLE `{name}` ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
              f"LOCATION '{day_path(root, table, day)}'")
    return spark.table(name)
