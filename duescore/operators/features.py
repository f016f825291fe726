"""Model features from the feature base.

The model's feature list drives one ``select``: each name is resolved at plan
time to an expression over the base (numeric, one-hot, date part, flag) or to
a typed null when the base has no such data (E6).  Names therefore never come
from the data (Q11, Q14) and no ``distinct`` job runs to find categories.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_part_columns, elapsed_years
from ..functions.text import bool_to_int, coerce_numeric

DATE_PARTS = ("ano", "mes", "dia", "delta")


def one_hot_values(c: str, values: Sequence[str]) -> list[Column]:
    """``{c}_{value}`` as 0/1 for each value; a null category is all 0."""
    return [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in values]


def one_hot_drop_first(c: str, values: Sequence[str]) -> list[Column]:
    """As ``one_hot_values`` without the smallest value."""
    return one_hot_values(c, sorted(values)[1:])


def date_features(df: DataFrame, columns: Sequence[str], as_of: str) -> DataFrame:
    """Year, month, day and elapsed years of each date column, in one projection."""
    parts = {}
    for c in columns:
        parts.update(date_part_columns(c, as_of))
    return df.select(*df.columns, *[v.alias(k) for k, v in parts.items()])


@dataclass(frozen=True)
class FeatureGroups:
    """How base columns become model inputs."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    dates: tuple[str, ...]
    binary_prefixes: tuple[str, ...] = ("Telefone", "Skip", "Divida", "Email", "rank", "sem_skip")
    one_hot_prefixes: tuple[str, ...] = ("Email",)   # text columns among these are one-hot encoded


def resolve_feature(name: str, columns: Sequence[str], types: dict[str, str], groups: FeatureGroups,
                    as_of: str) -> Column:
    """The expression for one model feature name (E2-E6, X10, X22); always double."""
    col, kind = F.col(f"`{name}`"), types.get(name)
    if name in columns and name in groups.numeric:
        return coerce_numeric(col) if kind == "string" else col.cast("double")
    m = re.fullmatch(r"(ano|mes|dia|delta)_(.+)", name)
    if m and m.group(2) in groups.dates and m.group(2) in columns:
        d = F.col(f"`{m.group(2)}`")
        part = m.group(1)
        if part == "delta":
            return elapsed_years(d, as_of)
        return {"ano": F.year, "mes": F.month, "dia": F.dayofmonth}[part](d).cast("double")
    if name in columns and kind == "boolean":
        return col.cast("double")
    if name in columns and any(name.startswith(p) for p in groups.binary_prefixes):
        return bool_to_int(col).cast("double")
    for c in (*groups.categorical, *[x for x in columns if types.get(x) == "string"
                                     and any(x.startswith(p) for p in groups.one_hot_prefixes)]):
        if c in columns and name.startswith(c + "_"):
            return F.coalesce((as_category(c, types.get(c)) == F.lit(name[len(c) + 1:])).cast("double"), F.lit(0.0))
    return F.lit(None).cast("double")


def as_category(c: str, kind: str | None) -> Column:
    """A category as the text that feature names carry; a boolean is ``True`` or ``False``."""
    col = F.col(f"`{c}`")
    if kind == "boolean":
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    return col if kind == "string" else col.cast("string")


def feature_vector(df: DataFrame, id_column: str, feature_names: Sequence[str], groups: FeatureGroups,
                   as_of: str, distinct: bool = True) -> DataFrame:
    """Id plus the model's features in the model's order."""
    types = dict(df.dtypes)
    cols = df.columns
    exprs = [resolve_feature(n, cols, types, groups, as_of).cast("double").alias(n) for n in feature_names]
    out = df.select(F.col(id_column).cast("string").alias(id_column), *exprs)
    return out.distinct() if distinct else out
