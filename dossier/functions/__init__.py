"""Column -> Column rules."""

from .dates import (cert_status, date_range_label, date_range_label_plain, extract_year, month_label,
                    parse_date, swap_dates, tenure_months, year_range_label, year_range_label_open)
from .numbers import to_bool, to_double, to_int_or_zero
from .text import (classify_vendor, clean_text, coalesce_alias, degree_line, digits_to_int, fill_blank_id,
                   json_field, mask_person, natural_key, normalize_encoding, normalize_name, session_hash,
                   split_date_range, strip, strip_suffix, title_case)

__all__ = [n for n in dir() if not n.startswith("_")]
