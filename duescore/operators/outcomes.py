"""Deals and installments: the outcome variables of the card base (JN9, JN10, JN13, Q7, Q31)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fallback_day, on_or_after
from ..spec import DEAL_DATE, DEAL_FLAG, INSTALLMENT_COUNT, PAYMENT_DATE, PAYMENT_FLAG
from .contact import REOPENING_STATUS, latest_deal
from .enrich import hot_keys

OUTCOMES = "outcomes"


def deal_rows(deals: DataFrame, creditor: str, since: str, excluded_status: str = "error",
              document_alias: str = "CPF", until: str | None = None) -> DataFrame:
    """The creditor's deals since a date, without the excluded status.

    ``until`` optionally cuts deals after a date too (Q8: the file rule does not).
    """
    d = deals.filter((F.col("creditor") == F.lit(creditor)) & (F.col("status") != F.lit(excluded_status))
                     & on_or_after("createdAt", since))
    if until is not None:
        d = d.filter(F.col("createdAt") <= F.lit(until))
    return d.select(F.col("document").alias(document_alias), F.col("createdAt").alias(DEAL_DATE),
                    "dealID", "status", F.lit(True).alias(DEAL_FLAG))


def installment_rows(installments: DataFrame, creditor: str, since: str, until: str | None = None) -> DataFrame:
    """Installments by deal with the paid date, else the due date, as day text (X20, Q8 ``until``)."""
    i = installments.withColumn(PAYMENT_DATE, fallback_day("paidAt", "dueAt"))
    i = i.filter(on_or_after(PAYMENT_DATE, since) & (F.col("creditor") == F.lit(creditor)))
    if until is not None:
        i = i.filter(F.col(PAYMENT_DATE) <= F.lit(until))
    return i.select(PAYMENT_DATE, "dealID", INSTALLMENT_COUNT,
                    F.col("paidAt").isNotNull().alias("has_paid_date"))


def deal_outcome(rows: DataFrame, deals: DataFrame, key: str = "CPF") -> DataFrame:
    """1:N left join of deals; rows without a deal get the flag false (JN9)."""
    out = rows.join(deals, on=key, how="left")
    return out.withColumn(DEAL_FLAG, F.coalesce(F.col(DEAL_FLAG), F.lit(False)))


def payment_outcome(rows: DataFrame, installments: DataFrame) -> DataFrame:
    """1:N left join of installments by deal (JN10).

    ``PAGTO`` is true for any installment in range, paid or not, as in the file
    rule (Q7); ``has_payment`` is true only for a paid one.
    """
    out = rows.join(installments, on="dealID", how="left")
    return out.withColumn(PAYMENT_FLAG, F.col(PAYMENT_DATE).isNotNull()) \
        .withColumn("has_payment", F.coalesce(F.col("has_paid_date"), F.lit(False))) \
        .withColumn(INSTALLMENT_COUNT, F.coalesce(F.col(INSTALLMENT_COUNT), F.lit(0))) \
        .drop("has_paid_date")


def inner_join_deals(deals: DataFrame, payments: DataFrame) -> DataFrame:
    """Inner join of deals to payments on the deal id (JN13)."""
    return deals.join(payments, on="dealID", how="inner")


def deal_summary(deals: DataFrame, installments: DataFrame, key: str = "CPF",
                 reopening_status: Sequence[str] = REOPENING_STATUS) -> DataFrame:
    """Each person's latest deal (date, then largest id) with its own installments.

    The latest deal comes from a hash aggregate over the deals alone; installments are
    reduced per deal and meet one deal per person, so neither a person nor a deal
    holding a large share of the rows reaches a join with them.  It is one real deal: its
    date, id and whether it reopens contacts (which labels interaction days, W2), its
    last payment date, installment count and flags.
    """
    per_deal = installments.groupBy("dealID").agg(
        F.max(F.try_to_date(F.col(PAYMENT_DATE), "yyyy-MM-dd")).alias(PAYMENT_DATE),
        F.max(INSTALLMENT_COUNT).alias(INSTALLMENT_COUNT),
        F.max("has_paid_date").alias("has_payment"),
    )
    return latest_deal(deals, key, reopening_status).join(per_deal, on="dealID", how="left")


def outcome_columns(summary: DataFrame, key: str = "CPF") -> DataFrame:
    """Outcome variables of the latest deal: deal date and flag, payment date, count, flags."""
    return summary.select(key, F.lit(True).alias(DEAL_FLAG), DEAL_DATE, PAYMENT_DATE, INSTALLMENT_COUNT,
                          F.col(PAYMENT_DATE).isNotNull().alias(PAYMENT_FLAG),
                          F.coalesce(F.col("has_payment"), F.lit(False)).alias("has_payment"))


def nested_outcomes(deals: DataFrame, installments: DataFrame, key: str, min_rows: int, top_k: int) -> DataFrame:
    """(key, outcomes): every deal of a person with its installments, as arrays of rows
    (JN9, JN10), so that the portfolio is joined once and fans out after that join.

    A person's rows are one array, but where they reach ``max(min_rows, total / top_k)``
    they are dealt over arrays of about that many rows each: the key then has several
    rows here, and no array grows with the largest person.
    """
    rows = deals.filter(F.col(key).isNotNull()).join(installments, on="dealID", how="left")
    hot = hot_keys(rows.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n")), ["__k"], "__n", min_rows, top_k)
    dealt = rows.join(F.broadcast(hot), F.col(key) == F.col("__k"), "left")
    part = F.coalesce(F.pmod(F.xxhash64("dealID", PAYMENT_DATE, INSTALLMENT_COUNT), F.col("__salts")), F.lit(0))
    row = F.struct(DEAL_DATE, DEAL_FLAG, PAYMENT_DATE, INSTALLMENT_COUNT, "has_paid_date")
    return dealt.groupBy(key, part.alias("__part")).agg(F.collect_list(row).alias(OUTCOMES)).drop("__part")


def fan_out(rows: DataFrame) -> DataFrame:
    """One row per deal and installment from ``OUTCOMES``; rows without a deal stay once."""
    out = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != OUTCOMES], F.inline_outer(OUTCOMES))
    return out.withColumns({
        DEAL_FLAG: F.coalesce(F.col(DEAL_FLAG), F.lit(False)), PAYMENT_FLAG: F.col(PAYMENT_DATE).isNotNull(),
        "has_payment": F.coalesce(F.col("has_paid_date"), F.lit(False)), INSTALLMENT_COUNT: F.coalesce(F.col(INSTALLMENT_COUNT), F.lit(0)),
    }).drop("has_paid_date")


def outcome_per_person(deals: DataFrame, installments: DataFrame, key: str = "CPF") -> DataFrame:
    """One row per person with the outcome variables of the latest deal."""
    return outcome_columns(deal_summary(deals, installments, key), key)
