"""Scalar column expressions used by the ingest and key-building stages.

All are built-in Spark expressions (codegen'd, JVM-side); no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim() removes every char <= U+0020 at both ends; Spark's
# one-argument trim() removes only spaces, so the whole range is passed as
# the set of characters to strip (a plain scan of both ends, no regex).
_JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))
_BOM = "\ufeff"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Trim leading/trailing chars <= U+0020 (Java ``String.trim``)."""
    return F.btrim(_c(c), F.lit(_JAVA_TRIM_CHARS))


def strip_quotes(c: Column | str) -> Column:
    """Remove every double quote (the landing parser drops them, ``""`` too)."""
    return F.replace(_c(c), F.lit('"'), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    """Empty after trimming -> NULL: empty and NULL are the same between stages."""
    return F.nullif(java_trim(c), F.lit(""))


def clean_field(c: Column | str) -> Column:
    """The landing normalizers' field rule: drop quotes, trim, empty -> NULL."""
    return blank_to_null(strip_quotes(c))


def strip_bom(c: Column | str) -> Column:
    return F.replace(_c(c), F.lit(_BOM), F.lit(""))


def split_part_first(c: Column | str, delimiter: str = "_") -> Column:
    """``SPLIT_PART(s, delimiter, 1)``: text before the first delimiter.

    No delimiter -> whole string, leading delimiter -> '', NULL -> NULL.
    """
    return F.split_part(_c(c), F.lit(delimiter), F.lit(1))


def concat_key(a: Column | str, b: Column | str, sep: str = "_") -> Column:
    """``a || sep || b``, NULL if either side is NULL (not ``concat_ws``)."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def year_int(c: Column | str, to: str = "int") -> Column:
    """Lenient text -> INTEGER (DuckDB ``CAST(x AS INTEGER)`` rules): trims,
    rounds ``'2020.6'`` -> 2021, accepts ``'2020.0'``; non-numeric text ->
    NULL instead of an error.  ``to="bigint"`` for counts."""
    return F.round(_c(c).try_cast("double")).try_cast(to)


def count_char(c: Column | str, ch: str) -> Column:
    """Occurrences of a single character in a string column."""
    col = _c(c)
    return F.length(col) - F.length(F.replace(col, F.lit(ch), F.lit("")))


def digits_only(c: Column | str) -> Column:
    """Drop every non-digit character (``replaceAll("\\D", "")``)."""
    return F.regexp_replace(_c(c), r"\D", "")


def base_name(c: Column | str) -> Column:
    """a file name without its extension, the text from the last dot on; a dot in
    front does not begin one."""
    return F.regexp_replace(_c(c), r"(?s)(.)\.[^.]*$", "$1")


def url_decode_path(c: Column | str) -> Column:
    """``_metadata.file_name`` / ``file_path`` are percent-encoded; decode them."""
    return F.try_url_decode(_c(c))
