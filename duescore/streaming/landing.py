"""New portfolio files as a Structured Streaming source.

The file rule lists a landing folder, takes the greatest name and deletes what
it processed.  A file-source stream does this with exactly-once bookkeeping:
the checkpoint remembers which files were processed, ``maxFilesPerTrigger=1``
gives one file per micro-batch (one file is one day), and
``trigger(availableNow=True)`` processes whatever has landed and stops, so the
job can run on a schedule.  The stream says which file is next; the batch then
reads that file by its own header names, so columns are never taken by position.
Rows never pass through the driver, only the file's name does.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import scan_delimited


def landed_files(spark: SparkSession, landing_dir: str, pattern: str = "*.csv") -> DataFrame:
    """Paths of newly landed files, one file per micro-batch."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", 1).option("pathGlobFilter", pattern)
            .load(landing_dir).select(F.col("_metadata.file_path").alias("file_path")))


def portfolio_batch(spark: SparkSession, files: DataFrame, columns, sep: str = ",") -> tuple[DataFrame, str] | None:
    """(rows, file name) of the one file of a micro-batch, read by its header names; None
    if it has no line.  More than one file is refused."""
    paths = [r[0] for r in files.distinct().limit(2).collect()]
    if len(paths) > 1:
        raise ValueError(f"a batch holds one file, this one {paths}")
    return (scan_delimited(spark, paths[0], columns, sep), os.path.basename(paths[0])) if paths else None


def run_landed_files(spark: SparkSession, landing_dir: str, columns, checkpoint_dir: str,
                     handle: Callable[[DataFrame, str, int], None], sep: str = ",", pattern: str = "*.csv") -> StreamingQuery:
    """Call ``handle(rows, file_name, batch_id)`` once per landed file, then stop.

    ``handle`` must be idempotent for a batch id (write with overwrite of that
    file's partition) so a batch replayed after a failure gives the same output.
    """

    def per_batch(files: DataFrame, batch_id: int) -> None:
        found = portfolio_batch(spark, files, columns, sep)
        if found:
            handle(*found, batch_id)

    return (landed_files(spark, landing_dir, pattern).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
