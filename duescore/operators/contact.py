"""Contact activity: interaction days, activation labels, channel counts.

Pivots always get their value list, so column names never depend on the data
(Q11) and no job runs to discover the values; they are written as conditional
aggregates, one aggregation each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_day_prefix
from ..functions.text import has_marker
from ..spec import ACTIVATED, DEAL_DATE, NOT_ACTIVATED
from .latest import latest_by_number

REOPENING = "reopening"


def interaction_days_raw(interactions: DataFrame, excluded_status: str = "not_received",
                         document: str = "document", sent_at: str = "sentAt", kind: str = "type",
                         day_name: str = "DT_INTERACAO") -> DataFrame:
    """Received interactions as (document, day, type); the day is read from the ISO text."""
    return interactions.filter(F.col("status") != F.lit(excluded_status)) \
        .select(F.col(document).alias("document"), parse_day_prefix(sent_at).alias(day_name),
                F.col(kind).alias("type"))


def pivot_channel_day(days: DataFrame, channels: Sequence[str], day: str = "DT_INTERACAO") -> DataFrame:
    """Interactions per (document, day), one column per channel; null when none (A5).

    A pivot with a known value list written as conditional sums: the same
    columns as ``pivot(type, values).sum``, but one aggregation and one
    shuffle (Spark's pivot aggregates by (keys, type) first, then pivots).
    """
    return days.groupBy("document", day).agg(
        *[F.sum(F.when(F.col("type") == F.lit(v), F.lit(1))).alias(v) for v in channels])


REOPENING_STATUS = ("expired", "broken")


def latest_deal(deals: DataFrame, document: str = "CPF", reopening_status: Sequence[str] = REOPENING_STATUS) -> DataFrame:
    """The latest deal per person: newest date, then the largest deal id (W2), and whether
    its status lets contacts count as activation again.

    The day label only ever looks at this one deal, so interaction days join a
    single row per person instead of every (day, deal) pair.
    """
    return latest_by_number(deals, document, DEAL_DATE, "dealID", F.col("status").isin(list(reopening_status)), REOPENING)


def activation_label(day_counts: DataFrame, latest: DataFrame, channels: Sequence[str],
                     day: str = "DT_INTERACAO", deal_document: str = "CPF") -> DataFrame:
    """Label each interaction day by the person's latest deal (A7, JN11, F11, F12).

    ``latest`` holds one row per person (``latest_deal``).  ATIVACAO when the
    day is on or before that deal, after it with the deal expired or broken, or
    when there is no deal; otherwise NAO_ATIVADO.  Missing channel counts are 0.
    """
    last = latest.select(F.col(deal_document).alias("__doc"), DEAL_DATE, REOPENING)
    j = day_counts.join(last, day_counts["document"] == last["__doc"], "left").drop("__doc")
    d, a = F.col(day), F.col(DEAL_DATE)
    cond = (d <= a) | ((d > a) & F.col(REOPENING)) | a.isNull()
    label = F.when(cond, F.lit(ACTIVATED)).otherwise(F.lit(NOT_ACTIVATED))
    return j.select("document", day, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in channels],
                    label.alias("ATIVACAO"))


def pivot_activation(labelled: DataFrame, channels: Sequence[tuple[str, str]], fill_zero: bool = True) -> DataFrame:
    """Per person: channel sums by activation label, ``ACION_{CH}_QTD_{LABEL}``.

    The two-measure pivot over the labels, as conditional sums in one aggregation.
    """
    aggs = []
    for label in (ACTIVATED, NOT_ACTIVATED):
        for src, tgt in channels:
            c = F.sum(F.when(F.col("ATIVACAO") == F.lit(label), F.col(src)))
            if fill_zero:
                c = F.coalesce(c, F.lit(0).cast("bigint"))
            aggs.append(c.alias(f"ACION_{tgt}_QTD_{label}"))
    return labelled.groupBy("document").agg(*aggs)


def channel_counts(campaigns: DataFrame, channels: Sequence[tuple[str, str]], marker: str,
                   document: str = "document", kind: str = "type", name: str = "campaign_name") -> DataFrame:
    """Per person, interactions per channel split by the campaign marker.

    A name holding the marker is a non-activation; every other name, the empty
    one included, counts as activation (Q29).  One hash aggregate, one pass.
    """
    marked = has_marker(name, marker)
    aggs = []
    for value, tgt in channels:
        is_type = F.col(kind) == F.lit(value)
        aggs.append(F.count_if(~marked & is_type).alias(f"ACION_{tgt}_QTD_{ACTIVATED}"))
        aggs.append(F.count_if(marked & is_type).alias(f"ACION_{tgt}_QTD_{NOT_ACTIVATED}"))
    return campaigns.groupBy(F.col(document).alias("document")).agg(*aggs)


def first_touch(days: DataFrame, day: str, name: str = "FIRST_TOUCH") -> DataFrame:
    """First contact date per person (W1); null dates are skipped."""
    return days.groupBy("document").agg(F.min(day).alias(name))
