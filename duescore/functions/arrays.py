"""Array and nested column expressions.

Each helper returns a list of aliased columns so that a caller adds all of
them in ONE ``select`` (a projection per column would re-analyse the plan once
per column).  Out-of-range slots read as null through ``get``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


def tag_flag(arr: Column, tag: str, none_tag: str) -> Column:
    """One flag of a tag array.

    For a listed tag: true when the array holds it, false otherwise (also for a
    missing array).  For ``none_tag``: true when the membership test is null,
    i.e. the array is missing or holds a null without a hit (Q9); an array with
    only unlisted tags gives all flags false.
    """
    hit = F.array_contains(arr, F.lit(tag))
    if tag == none_tag:
        return hit.isNull()
    return F.coalesce(hit, F.lit(False))


def slot_tag_flags(c: ColumnOrName, slots: int, tags: tuple[str, ...], prefix: str,
                   none_tag: str = "sem_tags") -> list[Column]:
    """Slot x tag flags of an ``array<array<string>>``: ``{prefix}{slot}_{tag}``."""
    arr = _c(c)
    out = []
    for i in range(slots):
        slot = F.get(arr, F.lit(i))
        for tag in tags:
            out.append(tag_flag(slot, tag, none_tag).alias(f"{prefix}{i + 1}_{tag}"))
    return out


def slot_values(c: ColumnOrName, slots: int, prefix: str, suffix: str | None = None) -> list[Column]:
    """The first ``slots`` elements of an array as columns (N2 domains)."""
    arr = _c(c)
    name = (lambda i: f"{prefix}{i + 1}_{suffix}") if suffix else (lambda i: f"{prefix}{i + 1}")
    return [F.get(arr, F.lit(i)).alias(name(i)) for i in range(slots)]


def state_slots(c: ColumnOrName, slots: int, placeholder: str, prefix: str = "UF") -> list[Column]:
    """State slots without the placeholder, in upper case."""
    arr = _c(c)
    return [F.upper(F.nullif(F.get(arr, F.lit(i)), F.lit(placeholder))).alias(f"{prefix}{i + 1}")
            for i in range(slots)]


def tag_flags(c: ColumnOrName, tags: tuple[str, ...], prefix: str, none_tag: str = "sem_tags") -> list[Column]:
    """Flags of a flat tag array: ``{prefix}{tag}``."""
    arr = _c(c)
    return [tag_flag(arr, t, none_tag).alias(f"{prefix}{t}") for t in tags]


def single_rank(c: ColumnOrName, ranks: tuple[str, ...], none_value: str) -> Column:
    """One rank per tag array: the smallest listed rank present, else ``none_value``."""
    listed = F.array(*[F.lit(r) for r in ranks])
    return F.coalesce(F.array_min(F.array_intersect(_c(c), listed)), F.lit(none_value))


def one_hot_fixed(c: ColumnOrName, values: tuple[str, ...]) -> list[Column]:
    """One boolean column per listed value; a missing category is all false."""
    x = _c(c)
    return [F.coalesce(x == F.lit(v), F.lit(False)).alias(v) for v in values]
