"""Nested person documents: look-up, debt filter, explode, rank (S8, N5-N8, JN12, X16).

The person store is a table of ``document, info struct, debts array<struct>``.
The batched id look-up of the file rule (10,000 ids per request) becomes one
``left_semi`` join: Spark shuffles or broadcasts by measured size and the
document list never passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import one_hot_fixed, single_rank
from ..functions.dates import age_years


def semi_join_lookup(persons: DataFrame, wanted: DataFrame, person_document: str = "document",
                     wanted_document: str = "document") -> DataFrame:
    """Persons whose document appears in ``wanted``."""
    keys = wanted.select(F.col(wanted_document).alias("__doc"))
    return persons.join(keys, persons[person_document] == keys["__doc"], "left_semi")


def filter_nested(debts: Column, creditor: str, field: str = "creditor") -> Column:
    """Keep the debts of one creditor; a missing list is empty."""
    return F.filter(F.coalesce(debts, F.array()), lambda d: d[field] == F.lit(creditor))


def person_projection(persons: DataFrame, creditor: str, as_of: str) -> DataFrame:
    """The person-store projection: id, document, gender, age band, creditor debts."""
    as_of_ts = F.to_timestamp(F.lit(as_of))
    return persons.select(
        "_id", "document",
        F.coalesce(F.col("info.gender"), F.lit("")).alias("genero"),
        age_years(as_of_ts, F.col("info.birthDate")).alias("faixa_etaria"),
        filter_nested(F.col("debts"), creditor).alias("debts"),
    )


def explode_debts(persons: DataFrame, fields: Sequence[str] = ("contract", "createdAt", "tags"),
                  keep: Sequence[str] = ("document",)) -> DataFrame:
    """One row per debt; persons with no debt keep one row of nulls."""
    e = persons.select(*keep, F.explode_outer("debts").alias("__d"))
    return e.select(*keep, *[F.col(f"__d.{f}").alias(f) for f in fields])


def rank_columns(df: DataFrame, tags: str, ranks: Sequence[str]) -> DataFrame:
    """Single rank per debt plus one boolean column per listed rank."""
    rank = single_rank(tags, tuple(ranks[:-1]), ranks[-1])
    r = df.withColumn("__rank", rank)
    return r.select(*[c for c in df.columns if c != tags], *one_hot_fixed(F.col("__rank"), tuple(ranks)))


def merge_composite_key(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                        right_keys: Sequence[str]) -> DataFrame:
    """Left join on (document, contract) written as two key columns, no text key (JN12).

    Null keys never match (Q18).
    """
    cond = None
    for lk, rk in zip(left_keys, right_keys, strict=True):
        term = left[lk] == right[rk]
        cond = term if cond is None else cond & term
    out = left.join(right, cond, "left")
    for rk in right_keys:
        out = out.drop(right[rk])
    return out


def zip_explode(df: DataFrame, keep: Sequence[str], arrays: Sequence[str], inner: str,
                inner_alias: str) -> DataFrame:
    """Zip parallel arrays, explode, then explode one inner array."""
    z = df.select(*keep, F.explode(F.arrays_zip(*[F.col(a) for a in arrays])).alias("__z"))
    cols = [F.col(f"__z.{a}").alias(a) for a in arrays if a != inner]
    return z.select(*keep, *cols, F.explode(F.col(f"__z.{inner}")).alias(inner_alias))
