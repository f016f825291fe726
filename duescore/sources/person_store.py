"""The person store as a data source.

The store is a folder of documents in files by ranges of the id, with one small index
that names each file's least and largest id.  Reading it as ``person_store`` gives one
partition per file; filters on the id (equality, ``IN``, bounds) are pushed down: files
whose range cannot hold a wanted id are not opened, and inside a file the reader skips
what does not match.  Files are opened through Arrow's file systems (a shared folder, HDFS
and the common object stores), in the task that reads them.  The look-up by a portfolio's documents stays one semi join.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)

from .commits import _put_text, _read_text

INDEX = "_ranges"
FORMAT = "person_store"
_OPERATORS = {EqualTo: "==", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def write_store(persons: DataFrame, path: str, key: str = "document", files: int = 200) -> None:
    """Write the documents by ranges of ``key`` and then their index, under a fresh folder.

    Ranges are cut by a sample of the keys; documents without a key cannot be looked up
    and are left out.  The index has one line per file and is all that the driver gets."""
    spark = persons.sparkSession
    folder = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    rows = persons.where(F.col(key).isNotNull()).repartitionByRange(files, F.col(key)).sortWithinPartitions(key)
    rows.write.parquet(folder)
    ranges = spark.read.schema(persons.schema).parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("least"), F.max(key).alias("most")).orderBy("least").collect()
    lines = [json.dumps({"file": r["file"], "least": r["least"], "most": r["most"]}) for r in ranges]
    head = json.dumps({"key": key, "schema": persons.schema.json()})
    _put_text(spark, f"{path.rstrip('/')}/{INDEX}", "\n".join([head, *lines]))


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a store."""
    head, *lines = _read_text(spark, f"{path.rstrip('/')}/{INDEX}").split("\n")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PersonStore)
    about = json.loads(head)
    schema = persons_schema(about["schema"])
    return spark.read.format(FORMAT).schema(schema).options(key=about["key"], ranges="\n".join(lines)).load()


def persons_schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))


@dataclass
class FileRange(InputPartition):
    file: str


class PersonStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("a person store is opened with open_store, which knows its schema")

    def reader(self, schema) -> DataSourceReader:
        return StoreReader(schema, self.options["key"], [json.loads(r) for r in self.options["ranges"].split("\n") if r])


class StoreReader(DataSourceReader):
    def __init__(self, schema, key: str, ranges: list[dict]):
        self.schema, self.key, self.ranges = schema, key, ranges
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes the conditions on the key; Spark applies all others itself."""
        for f in filters:
            if type(f) in _OPERATORS and f.attribute == (self.key,):
                self.tests.append((_OPERATORS[type(f)], sorted(set(f.value) - {None}) if isinstance(f, In) else f.value))
            else:
                yield f

    def partitions(self) -> list[FileRange]:
        return [FileRange(r["file"]) for r in self.ranges if all(self._may_hold(r, op, v) for op, v in self.tests)]

    @staticmethod
    def _may_hold(r: dict, op: str, value) -> bool:
        least, most = r["least"], r["most"]
        if op == "in":
            return any(least <= v <= most for v in value)
        return {"==": least <= value <= most, ">": most > value, ">=": most >= value, "<": least < value, "<=": least <= value}[op]

    def read(self, partition: FileRange | None) -> Iterator:
        if not isinstance(partition, FileRange):  # no file can hold a wanted key
            return
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        system, file = fs.FileSystem.from_uri(partition.file)
        column, test = pc.field(self.key), None
        for op, value in self.tests:
            one = column.isin(value) if op == "in" else {"==": column == value, ">": column > value, ">=": column >= value, "<": column < value, "<=": column <= value}[op]
            test = one if test is None else test & one
        schema = to_arrow_schema(self.schema)
        for batch in ds.dataset(file, filesystem=system, format="parquet").to_batches(filter=test, batch_size=10_000):
            if batch.num_rows:
                yield from table_of(batch, schema)


def table_of(batch, schema):
    """The batch with the types that Spark expects."""
    import pyarrow as pa

    return pa.Table.from_batches([batch]).select(schema.names).cast(schema).to_batches()
