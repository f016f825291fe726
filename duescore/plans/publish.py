"""Score and publish (C3): base -> features -> probability -> band -> one row per person."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.features import FeatureGroups, feature_vector
from ..operators.score import Scorer, score_rollup, with_band
from ..spec import PortfolioSpec


def score_base(base: DataFrame, spec: PortfolioSpec, groups: FeatureGroups, scorer: Scorer, as_of: str) -> DataFrame:
    """Pre-output rows: Chave, P_1, GH."""
    feats = feature_vector(base, spec.file_document, scorer.features, groups, as_of)
    return with_band(scorer.apply(feats, spec.file_document), spec.band_edges)


def propensity_scores(base: DataFrame, spec: PortfolioSpec, groups: FeatureGroups, scorer: Scorer, as_of: str,
                      file_day: str, created_at: str) -> DataFrame:
    """Published scores: Document, Score, ScoreValue, ScoreAvg, Provider, Date, CreatedAt."""
    pre = score_base(base, spec, groups, scorer, as_of)
    return score_rollup(pre, spec.document_width, spec.provider, file_day, created_at)
