"""Shared part of both feature bases: profile, debts, person facts.

The shuffles, for a portfolio of F rows, profiles P, debts D and events E:

* the creditor's debts only (the filter reaches the scan): flags, ``distinct``, the earliest per
  person by a window that keeps each task's first rows before the shuffle;
* profile x creditor debts: inner join on the person id;
* file x base: the file's rows are made distinct first, then left-joined on
  (contract, document); the flags are derived after the join;
* the keys (person, document, contract) that everything else needs come from a
  narrow branch of the same inputs, or from the staged join (``stage``), where
  the file and the profile are scanned once;
* facts keyed by the person id (simulations, other creditors, missing
  contracts) are ONE aggregation over a union of tagged rows, kept to the
  file's persons by a ``left_semi``; facts keyed by the document likewise;
* both fact tables are attached to the narrow (person id, document) pairs of
  the file, and the wide rows join that pair table ONCE; pairs holding a large
  share of the rows are salted (salt counts from a broadcast of proven size).

So the wide portfolio rows are shuffled once after the file x base join, and
a key holding a third of the rows never lands in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import slot_tag_flags, slot_values, state_slots, tag_flag, tag_flags
from ..operators.enrich import (asof_cutoff, earliest_per_group, filter_equals, hot_keys, inner_join_key,
                                left_join_keys, salted_left_join)
from ..spec import (DEBT_FLAG_PREFIX, DOMAIN_SUFFIX, EMAIL_PREFIX, OTHER_CREDITOR_FLAG,
                    PHONE_PREFIX, SAME_CREDITOR_FLAG, SIMULATION_COUNT, STATE_PREFIX, PortfolioSpec)


@dataclass
class Sources:
    """The day's input tables (already sliced to one snapshot)."""

    info: DataFrame
    debts: DataFrame
    simulation: DataFrame
    authentication: DataFrame
    deals: DataFrame | None = None
    installments: DataFrame | None = None
    interactions: DataFrame | None = None
    campaigns: DataFrame | None = None
    persons: DataFrame | None = None


PROFILE_ARRAYS = ("tag_telefone", "tag_email", "domain", "state")


def profile_flags(info: DataFrame, spec: PortfolioSpec) -> DataFrame:
    """Contact profile arrays to flags in one projection (N1, N2, N3); other columns are kept."""
    email_cols = []
    for i in range(spec.email_slots):
        slot = F.get(F.col("tag_email"), F.lit(i))
        email_cols += [tag_flag(slot, t, spec.none_tag).alias(f"{EMAIL_PREFIX}{i + 1}_{t}")
                       for t in spec.contact_tags]
        email_cols.append(F.get(F.col("domain"), F.lit(i)).alias(f"{EMAIL_PREFIX}{i + 1}_{DOMAIN_SUFFIX}"))
    return info.select(
        *[c for c in info.columns if c not in PROFILE_ARRAYS],
        *slot_tag_flags("tag_telefone", spec.phone_slots, spec.contact_tags, PHONE_PREFIX, spec.none_tag),
        *email_cols,
        *state_slots("state", spec.state_slots, spec.state_placeholder, STATE_PREFIX),
    )


def phone_flags(info: DataFrame, spec: PortfolioSpec) -> DataFrame:
    return info.select("_id", *slot_tag_flags("tag_telefone", spec.phone_slots, spec.contact_tags,
                                              PHONE_PREFIX, spec.none_tag))


def email_flags(info: DataFrame, spec: PortfolioSpec) -> DataFrame:
    flags = slot_tag_flags("tag_email", spec.email_slots, spec.contact_tags, EMAIL_PREFIX, spec.none_tag)
    domains = slot_values("domain", spec.email_slots, EMAIL_PREFIX, DOMAIN_SUFFIX)
    n = len(spec.contact_tags)      # each slot's flags, then its domain
    return info.select("_id", *[c for i, d in enumerate(domains) for c in (*flags[i * n:(i + 1) * n], d)])


def debt_base(debts: DataFrame, spec: PortfolioSpec, keys: tuple[str, ...] = ("_id", "creditor")) -> DataFrame:
    """Debt flags, distinct rows, earliest debt per (person, creditor) with ties (N4, A8, JN7).

    Repeated rows collapse map-side before the window meets a group's ties."""
    cols = [c for c in debts.columns if c != "tag_divida"]
    flagged = debts.select(*cols, *tag_flags("tag_divida", spec.debt_tags, DEBT_FLAG_PREFIX, spec.none_tag))
    return earliest_per_group(flagged.distinct(), keys, "INICIO_DIVIDA")


def creditor_debts(debts: DataFrame, spec: PortfolioSpec) -> DataFrame:
    """The creditor's debts: flags, distinct, earliest per (person, creditor) with ties (N4, A8, JN7).

    The creditor filter is applied before the distinct and the group minimum
    (the creditor is a grouping key, so the result is the same as filtering
    afterwards), so only the creditor's share of the debt snapshot is shuffled,
    by the person alone.
    """
    return debt_base(filter_equals(debts, "creditor", spec.creditor), spec, ("_id",))


def other_creditor_persons(debts: DataFrame, spec: PortfolioSpec) -> DataFrame:
    """Persons with a debt at another creditor (JN4, W3).

    Only existence is used; a group keeps an earliest row exactly when it has a
    dated debt, so a narrow scan of (person, creditor, date) is enough.  The persons
    are made distinct at once: what is only joined to the debts (their tags) is not read.
    """
    return debts.filter((F.col("creditor") != F.lit(spec.creditor)) & F.col("INICIO_DIVIDA").isNotNull()) \
        .select("_id").distinct()


def creditor_contracts(debts: DataFrame, spec: PortfolioSpec) -> DataFrame:
    """(person, contract) of ``creditor_debts``, from a narrow scan without tags and flags."""
    own = filter_equals(debts, "creditor", spec.creditor).select("_id", "contract", "INICIO_DIVIDA")
    return earliest_per_group(own.distinct(), ("_id",), "INICIO_DIVIDA").select("_id", "contract")


def combine_facts(parts: list[DataFrame], aggs: list[Column], wanted: DataFrame | None = None) -> DataFrame:
    """Facts from several sources, one row per key, in ONE aggregation.

    Each part carries ``__key``, a ``__kind`` tag and its own columns; the
    union is kept to the keys in ``wanted`` (one column) and reduced by a single
    partial-aggregated ``groupBy``, and the result joins the portfolio once.  A
    small ``wanted`` is broadcast by AQE, so events of other keys never leave
    their task; else a hot key of the semi join is what AQE's skew split handles.
    """
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if wanted is not None:
        keys = wanted.toDF("__wanted").filter(F.col("__wanted").isNotNull()).distinct()
        u = u.join(keys, F.col("__key") == F.col("__wanted"), "left_semi")
    return u.groupBy("__key").agg(*aggs)


def tagged(df: DataFrame, key: str, kind: str, *cols: Column | str) -> DataFrame:
    return df.select(F.col(key).alias("__key"), F.lit(kind).alias("__kind"), *cols)


def is_kind(kind: str) -> Column:
    return F.col("__kind") == F.lit(kind)


def auth_rows(src: Sources, spec: PortfolioSpec, file_day: str) -> DataFrame:
    """Authentications of the creditor up to the file date, tagged by document."""
    auth = src.authentication.select("tokenData.document", "tokenData.creditor", "createdAt")
    auth = asof_cutoff(filter_equals(auth, "creditor", spec.creditor), "createdAt", file_day, spec.inclusive_day)
    return tagged(auth, "document", "auth")


def person_facts(keys: DataFrame, src: Sources, spec: PortfolioSpec, file_day: str) -> DataFrame:
    """Facts keyed by the person id: simulations up to the file date, debts at other creditors,
    creditor debts missing from the file (JN4-JN6, JN8), as one aggregation.

    ``keys`` holds (person id, document, contract) of every file row."""
    contract = spec.file_contract
    present = keys.select(F.col("_id").alias("__p"), F.col(contract).alias("__c")).filter(F.col("__p").isNotNull())
    missing = creditor_contracts(src.debts, spec).join(
        present, (F.col("_id") == F.col("__p")) & (F.col("contract") == F.col("__c")), "left_anti")
    sims = asof_cutoff(filter_equals(src.simulation, "creditor", spec.creditor), "createdAt", file_day,
                       spec.inclusive_day)
    return combine_facts(
        [tagged(sims, "personID", "sim"),
         tagged(other_creditor_persons(src.debts, spec), "_id", "other"),
         tagged(missing, "_id", "missing")],
        [F.bool_or(is_kind("other")).alias(OTHER_CREDITOR_FLAG),
         F.bool_or(is_kind("missing")).alias(SAME_CREDITOR_FLAG),
         F.count_if(is_kind("sim")).alias(SIMULATION_COUNT)],
        keys.select("_id"))


def build_base(rows: DataFrame, src: Sources, spec: PortfolioSpec, file_day: str,
               document_facts: Callable[[DataFrame], DataFrame], defaults: dict,
               stage: Callable[[DataFrame], DataFrame] | None = None,
               outcomes: DataFrame | None = None) -> DataFrame:
    """Portfolio rows + profile + debt flags + all facts, with ONE join of the wide rows.

    Facts keyed by the person id and facts keyed by the document are first
    attached to the narrow table of (person id, document) pairs of the file
    (one row per pair, with its row count); the wide rows then join that table
    once, on both keys.  Pairs holding at least ``spec.hot_rows`` rows and a
    ``spec.hot_top_k``-th of all rows are salted over tasks of that many rows.

    ``document_facts`` gets the file's documents (one column) and returns one row
    per ``__key``.  The profile holds one row per person, so distinct file rows
    and distinct debts make the result distinct.  A batch run passes ``stage``,
    which writes the file x profile join as a Parquet table and reads it back:
    the join is computed once and its narrow readers read only their columns.
    ``outcomes`` (the document and an array column, possibly several rows per document)
    comes along with the facts.
    """
    doc, contract = spec.file_document, spec.file_contract
    info = filter_equals(src.info, "documentType", spec.document_type) \
        .select("_id", "document", "documentType", *PROFILE_ARRAYS)
    own = creditor_debts(src.debts.drop("document"), spec)
    base = inner_join_key(info, own, "_id")
    # The rows shuffled to the join carry the compact profile arrays; the 84
    # fixed-width flags are derived from the joined rows.
    joined = left_join_keys(rows.distinct(), base, [contract, doc], ["contract", "document"]).drop("creditor")
    if stage is not None:
        joined = stage(joined)
        keys = joined.select("_id", doc, contract)
    else:
        people = inner_join_key(info.select("_id", "document"), own.select("_id", "contract"), "_id")
        keys = left_join_keys(rows.select(doc, contract), people, [contract, doc], ["contract", "document"]) \
            .select("_id", doc, contract)
    arq = profile_flags(joined, spec)
    known = F.col("_id").isNotNull()     # rows without a person have no flags
    flags = [c for c in arq.columns if c not in joined.columns]
    # The profile's columns before the debts', as the file rule joins them.
    debt_columns = [c for c in own.columns if c in arq.columns and c not in rows.columns and c != "_id"]
    head = [c for c in arq.columns if c not in flags and c not in debt_columns]
    arq = arq.select(*[F.col(f"`{c}`") for c in head], *[F.when(known, F.col(f"`{c}`")).alias(c) for c in flags],
                     *[F.col(f"`{c}`") for c in debt_columns])

    idf = person_facts(keys, src, spec, file_day)
    facts = document_facts(keys.select(doc))
    pairs = keys.groupBy(F.col("_id").alias("__id"), F.col(doc).alias("__doc")).agg(F.count(F.lit(1)).alias("__n"))
    pair_facts = pairs.join(idf, F.col("__id") == idf["__key"], "left").drop("__key") \
        .join(facts, F.col("__doc") == facts["__key"], "left").drop("__key")
    if outcomes is not None:
        nested = outcomes.withColumnRenamed(doc, "__key")
        pair_facts = pair_facts.join(nested, F.col("__doc") == nested["__key"], "left").drop("__key")
    hot = hot_keys(pairs, ["__id", "__doc"], "__n", spec.hot_rows, spec.hot_top_k)
    out = salted_left_join(arq, pair_facts.drop("__n"), ["_id", doc], ["__id", "__doc"], hot)
    defaults = {SIMULATION_COUNT: 0, OTHER_CREDITOR_FLAG: False, SAME_CREDITOR_FLAG: False, **defaults}
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}).drop("_id")
