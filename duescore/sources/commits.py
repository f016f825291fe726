"""Runs whose outputs become visible together.

A run writes each output to a folder of its own, under any number of roots, and counts
what it produced.  ``commit`` reads every output back, compares the counts and then
writes one small manifest; readers resolve the newest manifest of a slot (a file day,
say), so they see all outputs of one run or all of the one before, whenever a run
stops.  A rerun of a slot is a new run with a new manifest.  Folders that no manifest
names are left-overs of failed runs; ``sweep`` removes them and runs gone out of date.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_commits"


@dataclass(frozen=True)
class Output:
    """Where one output of a run lies."""

    path: str
    rows: int
    format: str
    options: dict


@dataclass(frozen=True)
class Commit:
    slot: str
    version: int
    run_id: str
    outputs: dict[str, Output]


class AuditError(RuntimeError):
    """What can be read back is not what was written."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put_text(spark: SparkSession, path: str, text: str) -> None:
    """The file appears whole or not at all, and never replaces another."""
    p, fs = _fs(spark, path)
    draft, _ = _fs(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        raise RuntimeError(f"{path} was committed by another run")


def _checked(name: str, what: str) -> str:
    if not re.fullmatch(r"[\w.=@+-]+", name):
        raise ValueError(f"{what} {name!r} is not a plain folder name")
    return name


class Run:
    """One run of a slot under ``root``; nothing that it writes is seen before ``commit``."""

    def __init__(self, spark: SparkSession, root: str, slot: str, run_id: str | None = None):
        self.spark, self.root, self.slot = spark, root.rstrip("/"), _checked(slot, "slot")
        self.run_id = _checked(run_id or uuid.uuid4().hex, "run")
        self.outputs: dict[str, Output] = {}

    def write(self, name: str, df: DataFrame, root: str | None = None, format: str = "parquet", single_file: bool = False, **options) -> DataFrame:
        """Write one output and return it as read back.  ``root`` is another destination than
        the run's own; a delimited output takes ``header`` and ``sep``."""
        path = f"{(root or self.root).rstrip('/')}/{_checked(name, 'output')}/{self.slot}/{self.run_id}"
        options = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        (rows.coalesce(1) if single_file else rows).write.format(format).options(**options).mode("errorifexists").save(path)
        self.outputs[name] = Output(path, seen.get["rows"], format, options)
        return read_output(self.spark, self.outputs[name], df)

    def commit(self) -> Commit:
        for name, out in self.outputs.items():
            back = read_output(self.spark, out).count()
            if back != out.rows:
                raise AuditError(f"{name}: {out.rows} rows written, {back} read back from {out.path}")
        last = newest(self.spark, self.root, self.slot)
        done = Commit(self.slot, last.version + 1 if last else 1, self.run_id, dict(self.outputs))
        _put_text(self.spark, _manifest(self.root, self.slot, done.version), json.dumps(asdict(done), sort_keys=True))
        return done


def _manifest(root: str, slot: str, version: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{slot}/{version:09d}.json"


def versions(spark: SparkSession, root: str, slot: str) -> list[int]:
    found = [re.fullmatch(r"(\d{9})\.json", n) for n in _names(spark, f"{root.rstrip('/')}/{MANIFESTS}/{slot}")]
    return sorted(int(m.group(1)) for m in found if m)


def committed(spark: SparkSession, root: str, slot: str, version: int) -> Commit:
    raw = json.loads(_read_text(spark, _manifest(root, slot, version)))
    return Commit(raw["slot"], raw["version"], raw["run_id"], {k: Output(**o) for k, o in raw["outputs"].items()})


def newest(spark: SparkSession, root: str, slot: str) -> Commit | None:
    """The commit that readers of a slot see; None before the first."""
    found = versions(spark, root, slot)
    return committed(spark, root, slot, found[-1]) if found else None


def read_output(spark: SparkSession, out: Output, like: DataFrame | None = None) -> DataFrame:
    reader = spark.read.format(out.format).options(**out.options)
    if like is not None and out.format == "parquet":
        reader = reader.schema(like.schema)
    return reader.load(out.path)


def read_committed(spark: SparkSession, root: str, slot: str, name: str) -> DataFrame:
    """One output of the newest commit of a slot."""
    found = newest(spark, root, slot)
    if found is None:
        raise FileNotFoundError(f"nothing committed for {slot} under {root}")
    return read_output(spark, found.outputs[name])


def sweep(spark: SparkSession, root: str, slot: str, names: list[str], keep: int = 2, roots: list[str] | None = None) -> list[str]:
    """Remove the run folders of a slot that none of the last ``keep`` commits names, and
    their manifests; no run of the slot may be under way.  Returns what was removed."""
    found = versions(spark, root, slot)
    kept = {o.path for v in found[-keep:] for o in committed(spark, root, slot, v).outputs.values()} if keep else set()
    gone = []
    for base in [root, *(roots or [])]:
        for name in names:
            folder = f"{base.rstrip('/')}/{name}/{slot}"
            gone += [f"{folder}/{run}" for run in _names(spark, folder) if f"{folder}/{run}" not in kept]
    for path in gone + [_manifest(root, slot, v) for v in (found[:-keep] if keep else found)]:
        p, fs = _fs(spark, path)
        fs.delete(p, True)
    return gone
