"""Column expressions: text, dates, arrays."""

from .arrays import (one_hot_fixed, single_rank, slot_tag_flags, slot_values, state_slots,  # noqa: F401
                     tag_flag, tag_flags)
from .dates import (age_years, at_or_before, date_part_columns, day_literal, elapsed_years,  # noqa: F401
                    fallback_day, format_date, on_or_after, parse_date, parse_day_prefix)
from .text import (bool_to_int, clean_document, coerce_numeric, concat_key, document_fits,  # noqa: F401
                   pad_document, parse_signed_decimal, slice_text, yes_no_flag)
