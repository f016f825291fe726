"""Text column expressions: documents, amounts, flags, keys.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen.  Parsing never raises under ANSI mode: ``try_cast`` / ``get`` return
null for bad input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slice_text(c: ColumnOrName, start: int, length: int) -> Column:
    """1-based substring, ``length`` characters from ``start``.

    A Python slice ``s[0:10]`` is ``slice_text(s, 1, 10)``; always start at 1,
    position 0 means different things in different engines.
    """
    return F.substring(_c(c), start, length)


def pad_document(c: ColumnOrName, width: int) -> Column:
    """Left-pad a document with zeros to ``width``; longer input is cut."""
    return F.lpad(_c(c).cast("string"), width, "0")


def document_fits(c: ColumnOrName, width: int) -> Column:
    """True when padding to ``width`` keeps every character (Q17)."""
    return F.length(_c(c).cast("string")) <= F.lit(width)


def clean_document(c: ColumnOrName) -> Column:
    """Strip the punctuation of a formatted document: ``.``, ``-``, ``,``, ``/``."""
    return F.regexp_replace(_c(c), r"[.,\-/]", "")


def parse_signed_decimal(c: ColumnOrName, strict_sign: bool = False) -> Column:
    """Decimal-comma text such as ``+000123,45`` to double.

    ``strict_sign=True`` keeps the file rule: only the part after a ``+`` is
    read, so unsigned and negative amounts become null.  The default accepts a
    leading ``+``, ``-`` or no sign.  Thousands points are not removed, so
    ``1.234,56`` is null in both modes.
    """
    c = _c(c)
    if strict_sign:
        body = F.get(F.split(c, r"\+"), F.lit(1))
    else:
        body = F.regexp_replace(F.trim(c), r"^\+", "")
    return F.regexp_replace(body, ",", ".").try_cast("double")


def coerce_numeric(c: ColumnOrName) -> Column:
    """Text to double, first comma read as the decimal point; bad text is null."""
    c = _c(c).cast("string")
    return F.regexp_replace(c, r"^([^,]*),", "$1.").try_cast("double")


def yes_no_flag(c: ColumnOrName, yes: str = "S", no: str = "N") -> Column:
    """``S``/``N`` to true/false; anything else is null (X11)."""
    c = _c(c)
    return F.when(c == yes, F.lit(True)).when(c == no, F.lit(False))


def concat_key(*cols: ColumnOrName, sep: str = ":") -> Column:
    """Join texts with a separator; null parts are skipped."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def has_marker(c: ColumnOrName, marker: str) -> Column:
    """Text (or the ';'-joined elements of an array of texts) LIKE '%marker%' (F10, X5).

    A missing name joins to the empty text, so it never holds the marker (Q29).
    """
    return F.concat_ws(";", _c(c)).like(f"%{marker}%")


def bool_to_int(c: ColumnOrName) -> Column:
    """Boolean, or the texts ``true``/``false``, to 1/0."""
    c = _c(c)
    return c.cast("string").try_cast("boolean").cast("int")
