"""Composite pipelines: card base (C1), company base (C2), score and publish."""

from .base import Sources, build_base, debt_base, profile_flags  # noqa: F401
from .card import build_card_base, clean_card_file, open_items  # noqa: F401
from .company import build_company_base, company_base_rows  # noqa: F401
from .publish import propensity_scores, score_base  # noqa: F401
