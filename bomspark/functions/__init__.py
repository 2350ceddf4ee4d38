from .periods import (half_of_month, month_from_name, period_of, period_parts,
                      year_from_name, year_from_text)
from .text import (blank_to_null, clean_field, concat_key, count_char,
                   digits_only, java_trim, split_part_first, strip_bom, strip_quotes,
                   url_decode_path, year_int)

__all__ = [
    "blank_to_null", "clean_field", "concat_key", "count_char", "digits_only",
    "half_of_month", "java_trim", "month_from_name", "period_of", "period_parts",
    "split_part_first", "strip_bom", "strip_quotes", "url_decode_path",
    "year_from_name", "year_from_text", "year_int",
]
