"""The latest deal per person by a hash aggregate.

``max`` of a struct with text in it cannot be updated in place, so Spark sorts the rows
to aggregate them.  Here day, deal id and the one fact that is needed of the deal are
packed into one fixed-width number whose order is that of (day, id), and the maximum of
numbers is a hash aggregate with a map-side partial step.  The winning row is unpacked
from the maximum itself, so nothing is joined back.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .enrich import first_per_key

#: Bytes of an id that fit beside the day; a 24-digit lower-case hex id has 12 bytes as well.
ID_BYTES = 12
#: The number's decimal digits: 7 for the day, 15 for each half of the id, 1 for the fact.
_HALF_DIGITS = 15
_ALL_DIGITS = 38
#: Days are counted from here, so that every date from year 1 on is positive (no date is 0).
_DAY_ZERO = 800_000
_HEX = "0123456789abcdef"


def _times(x: Column, power: int) -> Column:
    return (x.cast("decimal(38,0)") * F.lit(Decimal(10 ** power))).cast("decimal(38,0)")


def id_kind(c: Column) -> Column:
    """How an id is packed: 1 as its hex digits, 0 as its bytes, null not at all (longer
    than fits, empty, null or with a zero byte)."""
    digits = (F.octet_length(c) == 2 * ID_BYTES) & (F.translate(c, _HEX, "") == "")
    bytes_ = F.octet_length(c).between(1, ID_BYTES) & ~F.contains(c, F.lit("\x00"))
    return F.when(digits, F.lit(1)).when(bytes_, F.lit(0))


def packed_key(day: Column, ident: Column, fact: Column) -> Column:
    """(day, id, fact) as one number in their order; an id that does not fit counts as none."""
    kind = id_kind(ident)
    digits = F.when(kind == 1, ident).when(kind == 0, F.rpad(F.lower(F.hex(ident.cast("binary"))), 2 * ID_BYTES, "0")).otherwise(F.lit("0" * 2 * ID_BYTES))
    high, low = (F.conv(F.substring(digits, k, ID_BYTES), 16, 10).cast("bigint") for k in (1, ID_BYTES + 1))
    days = F.coalesce(F.unix_date(day) + F.lit(_DAY_ZERO), F.lit(0))
    whole = _times(days, 2 * _HALF_DIGITS + 1) + _times(high, _HALF_DIGITS + 1) + _times(low, 1) + fact.cast("int")
    return whole.cast("decimal(38,0)")


def _digits(key: Column, start: int, count: int) -> Column:
    return F.substring(F.lpad(key.cast("string"), _ALL_DIGITS, "0"), start, count).cast("bigint")


def unpacked_day(key: Column) -> Column:
    days = _digits(key, 1, _ALL_DIGITS - 2 * _HALF_DIGITS - 1)
    return F.when(days > 0, F.date_from_unix_date((days - F.lit(_DAY_ZERO)).cast("int")))


def unpacked_id(key: Column, kind: Column) -> Column:
    halves = (_digits(key, _ALL_DIGITS - n * _HALF_DIGITS, _HALF_DIGITS) for n in (2, 1))
    digits = F.concat(*[F.lpad(F.lower(F.hex(h)), ID_BYTES, "0") for h in halves])
    return F.when(kind == 1, digits).when(kind == 0, F.rtrim(F.unhex(digits).cast("string"), F.lit("\x00")))


def unpacked_fact(key: Column) -> Column:
    return _digits(key, _ALL_DIGITS, 1) == 1


def latest_by_number(df: DataFrame, key: str, day: str, ident: str, fact: Column, fact_name: str) -> DataFrame:
    """(key, day, id, fact) of each key's row with the newest day, then the largest id text.

    ``day`` is a date, ``fact`` a boolean.  Rows that agree in day and id count as one row
    whose fact is true if any is.  Ids that cannot be packed are grouped by their
    text beside the others, so the result is exact for any id; a last step takes the first of what is left of a key
    (one row, or two where both kinds of ids occur, and one for each such id).
    A row without a day comes after all others.
    """
    kind = id_kind(F.col(ident))
    rows = df.select(F.col(key).alias("__key"), kind.alias("__kind"), F.when(kind.isNull(), F.col(ident)).alias("__wide"),
                     packed_key(F.col(day), F.col(ident), F.coalesce(fact, F.lit(False))).alias("__row"))
    best = rows.groupBy("__key", "__kind", "__wide").agg(F.max("__row").alias("__row"))
    r = F.col("__row")
    named = best.select(F.col("__key").alias(key), unpacked_day(r).alias(day), F.coalesce("__wide", unpacked_id(r, F.col("__kind"))).alias(ident),
                        unpacked_fact(r).alias(fact_name))
    return first_per_key(named, [key], [F.col(day), F.col(ident), F.col(fact_name)], [day, ident, fact_name], latest=True)
