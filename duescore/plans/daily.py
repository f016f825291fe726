"""One day's run as Spark jobs: landing folder -> feature base (stage table) -> scores -> publish.

The file rule hands data between steps through single CSV files on one
machine; here each step reads and writes partitioned Parquet under ``out_root``.
The file x profile join and the feature base are written stage tables: they cut
the lineage, so a lost executor during scoring re-reads them instead of
recomputing the joins, and their readers read only the columns they need.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import FeatureGroups
from ..operators.score import Scorer
from ..sources.files import day_of_name, header_date, newest_file, scan_delimited, scan_fixed_schema
from ..sources.commits import Run, read_committed
from ..sources.sinks import publish, write_table
from ..sources.snapshots import read_snapshot, read_table
from ..spec import CARD_FILE_RENAMES, CARD_PAYMENT_COLUMNS, COMPANY_FILE_FIELDS, PortfolioSpec
from .base import Sources
from .card import build_card_base
from .company import build_company_base
from .publish import propensity_scores

CARD_FILE_COLUMNS = ("CPF", "CONTA", *CARD_FILE_RENAMES, *CARD_PAYMENT_COLUMNS)


@dataclass(frozen=True)
class Layout:
    """Where the day's inputs live: dated snapshots under ``root`` plus undated tables.
    Each job names the tables that it uses; debts are kept by person type."""

    root: str
    snapshot_tables: dict = field(default_factory=lambda: {
        "info": "Info", "debts": "Debts/CPF", "simulation": "Simulation", "authentication": "Authentication",
        "deals": "Deals", "installments": "Installments"})
    undated_tables: dict = field(default_factory=lambda: {"interactions": "interactions"})
    #: Source format of a role's table where it is not Parquet, e.g. ``{"interactions": "delta"}``.
    formats: dict = field(default_factory=dict)


def company_layout(root: str, persons: str = "persons", campaigns: str = "campaigns") -> Layout:
    """The tables of the company job."""
    return Layout(root, {"info": "Info", "debts": "Debts/CNPJ", "simulation": "Simulation",
                         "authentication": "Authentication"}, {"persons": persons, "campaigns": campaigns})


def load_sources(spark: SparkSession, layout: Layout, snapshot_day: str) -> Sources:
    """Each snapshot pruned to one ``snapshot_date`` partition (S6); undated tables as they are."""
    tables = {role: read_snapshot(spark, layout.root, name, snapshot_day, format=layout.formats.get(role, "parquet")).drop("snapshot_date")
              for role, name in layout.snapshot_tables.items()}
    for role, name in layout.undated_tables.items():
        tables[role] = read_table(spark, os.path.join(layout.root, name), layout.formats.get(role, "parquet"))
    return Sources(**tables)


def stage_at(spark: SparkSession, path: str) -> Callable[[DataFrame], DataFrame]:
    """Writes a table as Parquet at ``path`` and reads it back."""
    def stage(df: DataFrame) -> DataFrame:
        write_table(df, path)
        return spark.read.schema(df.schema).parquet(path)
    return stage


def _score_and_publish(spark: SparkSession, base: DataFrame, spec: PortfolioSpec, groups: FeatureGroups, scorer: Scorer,
                       file_day: str, as_of: str, created_at: str, out_root: str, export_root: str | None,
                       run_id: str | None = None) -> DataFrame:
    if run_id is not None:
        return score_run(spark, base, spec, groups, scorer, file_day, as_of, created_at, out_root, export_root, run_id)
    base_root = os.path.join(out_root, "feature_base")
    write_table(base.withColumn("file_date", F.to_date(F.lit(file_day))), base_root, partition_by=["file_date"])
    staged = spark.read.parquet(base_root).filter(F.col("file_date") == F.to_date(F.lit(file_day))).drop("file_date")
    scores = propensity_scores(staged, spec, groups, scorer, as_of, file_day, created_at)
    primary = os.path.join(out_root, "scores", f"file_date={file_day}")
    secondary = os.path.join(export_root or os.path.join(out_root, "export"), f"{spec.provider}_{created_at}")
    return publish(scores, spark, primary, secondary)


def score_run(spark: SparkSession, base: DataFrame, spec: PortfolioSpec, groups: FeatureGroups, scorer: Scorer, file_day: str,
              as_of: str, created_at: str, out_root: str, export_root: str | None, run_id: str) -> DataFrame:
    """Base, scores and export of one run, made visible together by one commit (S10, S11);
    readers use ``read_committed(spark, out_root, "file_date=<day>", "scores")``."""
    run = Run(spark, out_root, f"file_date={file_day}", run_id)
    written = run.write("feature_base", base)
    scores = run.write("scores", propensity_scores(written, spec, groups, scorer, as_of, file_day, created_at))
    run.write("export", scores, root=export_root, format="csv", header=True, sep=";")
    run.commit()
    return read_committed(spark, out_root, run.slot, "scores")


def run_card_day(spark: SparkSession, portfolio: DataFrame, layout: Layout, spec: PortfolioSpec, snapshot_day: str,
                 file_day: str, groups: FeatureGroups, scorer: Scorer, as_of: str, created_at: str, out_root: str,
                 export_root: str | None = None, outcome_grain: str = "person", run_id: str | None = None) -> DataFrame:
    """Build, stage, score and publish one card portfolio file; returns the written scores.

    With a ``run_id`` the outputs go to folders of the run and become visible by one commit."""
    stage = stage_at(spark, os.path.join(out_root, "joined", f"file_date={file_day}"))
    base = build_card_base(portfolio, load_sources(spark, layout, snapshot_day), spec, file_day, stage, outcome_grain)
    return _score_and_publish(spark, base, spec, groups, scorer, file_day, as_of, created_at, out_root, export_root, run_id)


def read_card_file(spark: SparkSession, path: str) -> DataFrame:
    """The card portfolio file: ',' separated, header, every column as text (S3).  Columns
    without a use are left out, so they cannot clash with those of the base."""
    return scan_delimited(spark, path, CARD_FILE_COLUMNS, sep=",").select(*[F.col(f"`{c}`") for c in CARD_FILE_COLUMNS])


def run_card_landing(spark: SparkSession, landing: str, layout: Layout, spec: PortfolioSpec, snapshot_day: str,
                     groups: FeatureGroups, scorer: Scorer, as_of: str, created_at: str, out_root: str,
                     pattern: str = "integracao", stamp_regex: str = r"_(\d{12})\.csv$",
                     date_regex: str = r"_(\d{8})\d{4}\.csv$", **kw) -> DataFrame:
    """The newest card file of a landing folder, its date from its name (S1, S2), to published scores."""
    path = newest_file(spark, landing, pattern, stamp_regex)
    if path is None:
        raise FileNotFoundError(f"no file with {pattern!r} and a stamp in {landing}")
    file_day = day_of_name(os.path.basename(path), date_regex, "%Y%m%d")
    return run_card_day(spark, read_card_file(spark, path), layout, spec, snapshot_day, file_day, groups, scorer, as_of,
                        created_at, out_root, **kw)


def run_company_day(spark: SparkSession, file_path: str, layout: Layout, spec: PortfolioSpec, snapshot_day: str,
                    file_day: str, creditor_id: str, groups: FeatureGroups, scorer: Scorer, as_of: str, created_at: str,
                    out_root: str, export_root: str | None = None, run_id: str | None = None) -> DataFrame:
    """Parse, stage, score and publish one bank portfolio file; returns the written scores.

    The file is read with its fixed field list (S4), once; the nested person store
    and the enriched campaigns are plain tables of the layout.
    """
    stage = stage_at(spark, os.path.join(out_root, "joined", f"file_date={file_day}"))
    parsed = scan_fixed_schema(spark, file_path, COMPANY_FILE_FIELDS)
    base = build_company_base(parsed, load_sources(spark, layout, snapshot_day), spec, os.path.basename(file_path),
                              creditor_id, file_day, as_of, stage=stage)
    return _score_and_publish(spark, base, spec, groups, scorer, file_day, as_of, created_at, out_root, export_root, run_id)


def run_company_landing(spark: SparkSession, landing: str, layout: Layout, spec: PortfolioSpec, snapshot_day: str,
                        creditor_id: str, groups: FeatureGroups, scorer: Scorer, as_of: str, created_at: str,
                        out_root: str, pattern: str = "portfolio", stamp_regex: str = r"_(\d{8})\.txt$", **kw) -> DataFrame:
    """The newest bank file of a landing folder, its date from its header record (S1, S5), to published scores."""
    path = newest_file(spark, landing, pattern, stamp_regex)
    if path is None:
        raise FileNotFoundError(f"no file with {pattern!r} and a stamp in {landing}")
    day = header_date(scan_fixed_schema(spark, path, COMPANY_FILE_FIELDS)).first()[0]
    if day is None:
        raise ValueError(f"no header record with a date in {path}")
    return run_company_day(spark, path, layout, spec, snapshot_day, day.isoformat(), creditor_id, groups, scorer, as_of,
                           created_at, out_root, **kw)
