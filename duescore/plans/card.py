"""Card-payments feature base (C1): one row per (person, contract) of the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_day_prefix
from ..functions.text import coerce_numeric
from ..operators.contact import activation_label, interaction_days_raw, latest_deal, pivot_channel_day
from ..operators.outcomes import deal_rows, deal_summary, fan_out, installment_rows, nested_outcomes, outcome_columns
from ..spec import (ACTIVATED, AUTH_COUNT, CARD_FILE_RENAMES, CARD_PAYMENT_COLUMNS, DEAL_DATE, DEAL_FLAG, FIRST_TOUCH,
                    INSTALLMENT_COUNT, NOT_ACTIVATED, PAYMENT_DATE, PAYMENT_FLAG, PortfolioSpec)
from .base import Sources, auth_rows, build_base, combine_facts, is_kind, tagged


def open_items(raw: DataFrame, paid_column: str = "DATA PAGAMENTO",
               drop: tuple[str, ...] = CARD_PAYMENT_COLUMNS) -> DataFrame:
    """Keep rows without a payment date and drop the payment columns (F1)."""
    return raw.filter(F.col(paid_column).isNull()).drop(*drop)


def clean_card_file(raw: DataFrame) -> DataFrame:
    """Open items, cleaned names (F1, F2) and typed values."""
    df = open_items(raw).withColumnsRenamed(CARD_FILE_RENAMES)
    return df.withColumns({
        "DIAS_ATRASO": F.col("DIAS_ATRASO").try_cast("int"),
        "DATA_DIVIDA": parse_day_prefix("DATA_DIVIDA"),
        "DATA_ULTIMA_FATURA": parse_day_prefix("DATA_ULTIMA_FATURA"),
        "VALOR_ULTIMA_FATURA": coerce_numeric("VALOR_ULTIMA_FATURA"),
    })


def activation_aggs(spec: PortfolioSpec, kind: str = "day") -> list[Column]:
    """Per person: first contact and channel sums by label; null for persons without contacts (Q12)."""
    any_day = F.count_if(is_kind(kind)) > 0
    aggs = [F.min("DT_INTERACAO").alias(FIRST_TOUCH)]
    for label in (ACTIVATED, NOT_ACTIVATED):
        for src, tgt in spec.channels:
            total = F.coalesce(F.sum(F.when(F.col("ATIVACAO") == F.lit(label), F.col(src))), F.lit(0).cast("bigint"))
            aggs.append(F.when(any_day, total).alias(f"ACION_{tgt}_QTD_{label}"))
    return aggs


OUTCOME_GRAINS = ("person", "deal")


def build_card_base(raw_file: DataFrame, src: Sources, spec: PortfolioSpec, file_day: str,
                    stage=None, outcome_grain: str = "person") -> DataFrame:
    """The card feature base.

    ``outcome_grain`` ``person`` gives one row per file row with the outcome of
    the person's latest deal; ``deal`` gives one row per file row, deal and
    installment, as the file rule does (JN9, JN10); these come nested, with the facts, in
    the one join of the wide rows.
    """
    if outcome_grain not in OUTCOME_GRAINS:
        raise ValueError(f"outcome_grain is one of {OUTCOME_GRAINS}")
    doc = spec.file_document
    channels = [c for c, _ in spec.channels]
    deals = deal_rows(src.deals, spec.creditor, spec.outcome_since, spec.excluded_deal_status, doc,
                      spec.outcome_until)
    inst = installment_rows(src.installments, spec.creditor, spec.outcome_since, spec.outcome_until)
    days = interaction_days_raw(src.interactions, spec.excluded_interaction_status)
    labelled = activation_label(pivot_channel_day(days, channels), latest_deal(deals, doc, spec.reopening_status), channels,
                                deal_document=doc)
    parts = [auth_rows(src, spec, file_day),
             tagged(labelled, "document", "day", "DT_INTERACAO", "ATIVACAO", *channels)]
    aggs = [F.count_if(is_kind("auth")).alias(AUTH_COUNT)]
    defaults = {AUTH_COUNT: 0}
    if outcome_grain == "person":
        outcome = outcome_columns(deal_summary(deals, inst, doc, spec.reopening_status), doc)
        parts.append(tagged(outcome, doc, "deal", DEAL_DATE, PAYMENT_DATE, INSTALLMENT_COUNT, PAYMENT_FLAG, "has_payment"))
        # One outcome row per person, so each of these is that row's value.
        aggs += [F.max(DEAL_DATE).alias(DEAL_DATE), F.bool_or(is_kind("deal")).alias(DEAL_FLAG),
                 F.max(PAYMENT_DATE).alias(PAYMENT_DATE), F.max(INSTALLMENT_COUNT).alias(INSTALLMENT_COUNT),
                 F.bool_or(PAYMENT_FLAG).alias(PAYMENT_FLAG), F.bool_or("has_payment").alias("has_payment")]
        defaults |= {DEAL_FLAG: False, PAYMENT_FLAG: False, "has_payment": False, INSTALLMENT_COUNT: 0}
    aggs += activation_aggs(spec)
    outcomes = nested_outcomes(deals, inst, doc, spec.hot_rows, spec.hot_top_k) if outcome_grain == "deal" else None
    arq = build_base(clean_card_file(raw_file), src, spec, file_day,
                     lambda documents: combine_facts(parts, aggs, documents), defaults, stage, outcomes)
    if outcome_grain == "deal":
        arq = fan_out(arq)
    if spec.fill_zero:
        arq = arq.fillna(0, subset=[f"ACION_{t}_QTD_{lb}" for lb in (ACTIVATED, NOT_ACTIVATED) for _, t in spec.channels])
    return arq
