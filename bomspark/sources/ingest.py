"""Landing normalizers C1-C3: mixed pipe/comma files -> typed tables.

Each reads a whole folder (or list of paths) as described in ``landing``.
Where a table's columns are found in a file's header is stated as data, ranked
matches per column, and resolved by Spark for the whole file table:

=============  ==========================  ==================  ==============
table          column resolution           missing column      empty rows
=============  ==========================  ==================  ==============
option-child   synonyms, last match wins   file skipped        kept
config         exact (case-insensitive)    file skipped        kept
option         rename map, exact, any-case NULL column         dropped
=============  ==========================  ==================  ==============

The half-year period of an option file comes from its name (F6-F9); when the
name has no year, from the first data row (in file order) holding one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.periods import (has_year, month_from_name, period_of, year_from_name,
                                 year_from_text)
from .landing import (CSV_GLOB, Drop, Paths, base_of, clean, file_rows, landing_files,
                      list_drop, not_broadcast, split_lines)


# ------------------------------------------------------------------ resolution

@dataclass(frozen=True)
class Match:
    """Header names that stand for a column; with ``any_case`` they are compared
    in lower case.  Of several matches the last one counts, or the first."""

    names: tuple[str, ...]
    any_case: bool = False
    first: bool = False

    def position(self, header: Column) -> Column:
        """0-based position in an array of header names, or NULL."""
        def hit(name: Column, i: Column) -> Column:
            return F.when((F.lower(name) if self.any_case else name).isin(*self.names), i)
        return F.try_element_at(F.array_compact(F.transform(header, hit)),
                                F.lit(1 if self.first else -1))


Rules = dict[str, tuple[Match, ...]]

CHILD_COLUMNS: Rules = {
    S.OPTION_NUMBER: (Match(tuple(S.CHILD_OPTION_SYNONYMS), any_case=True),),
    S.CHILD: (Match((S.CHILD_PART_HEADER,), any_case=True),),
}
CONFIG_COLUMNS: Rules = {out: (Match((name,), any_case=True),)
                         for name, out in S.CONFIG_HEADERS.items()}
_OLD_NAMES = {new: old for old, new in S.OPTION_RENAMES.items()}
OPTION_COLUMNS: Rules = {
    c: (*([Match((_OLD_NAMES[c],))] if c in _OLD_NAMES else []), Match((c,)),
        Match((c.lower(),), any_case=True, first=True))
    for c in S.OPTION_KEEP}


def located(rules: Rules) -> Callable[[DataFrame], DataFrame]:
    """Adds each column's position to a file table (``at_<column>``, NULL if absent)."""
    at = {f"at_{c}": F.coalesce(*[m.position(F.col("names")) for m in ranked])
          for c, ranked in rules.items()}
    return lambda files: files.withColumns(at)


def _present(rules: Rules, every: bool) -> Column:
    tests = [F.col(f"at_{c}").isNotNull() for c in rules]
    return reduce((lambda a, b: a & b) if every else (lambda a, b: a | b), tests)


def _rows(drop: Drop, files: DataFrame, rules: Rules, keep: list[str] = [],
          skip_blank: bool = False) -> DataFrame:
    """The rules' columns and the ``keep`` columns of the file table, with each row's file
    and position."""
    at = [f"at_{c}" for c in rules]
    table = files.select("file", "header_at", "delimiter", *at, *keep)
    return not_broadcast(split_lines(drop, table, skip_blank).select(
        *[clean(F.get("_f", F.col(a))).alias(c) for a, c in zip(at, rules)],
        *keep, "file", "at"))


# ------------------------------------------------------------------ P3: skipped files

class Ingested(NamedTuple):
    """Rows of a drop and, beside them, its files that gave none: (file_name, reason)."""

    rows: DataFrame
    rejected: DataFrame


def rejected_files(drop: Drop, files: DataFrame, rules: Rules, every: bool,
                   empty: bool = True) -> DataFrame:
    """(file_name, reason) of the files that an ingest skips: they lack columns that it
    needs (``every`` one, or any of them), or with ``empty`` have no line at all."""
    lacking = F.concat_ws(", ", *[F.when(F.col(f"at_{c}").isNull(), F.lit(c)) for c in rules])
    skipped = files.where(~_present(rules, every)).select(
        "file_name", F.concat(F.lit("no column for: "), lacking).alias("reason"))
    if not empty:
        return skipped
    bare = file_rows(drop).join(files.select("file"), "file", "left_anti").select(
        base_of("path").alias("file_name"), F.lit("empty file").alias("reason"))
    return skipped.unionByName(bare)


# ------------------------------------------------------------------ C1

def ingest_option_child(spark: SparkSession, paths: Paths, with_source: bool = False,
                        glob: str = CSV_GLOB) -> DataFrame:
    """(Option_Number, Child_Part_Number) from every file that has both
    columns; all rows kept (duplicates too), blanks become NULL and blank
    lines are empty records."""
    return child_ingest(spark, paths, with_source, glob).rows


def child_ingest(spark: SparkSession, paths: Paths, with_source: bool = False,
                 glob: str = CSV_GLOB) -> Ingested:
    """C1 with the files it skipped: those without both columns, and empty ones."""
    drop = list_drop(spark, paths, glob)
    files = child_files(spark, drop)
    source = ["path"] if with_source else []
    rows = _rows(drop, files.where(_present(CHILD_COLUMNS, every=True)), CHILD_COLUMNS, source)
    return Ingested(rows.select(*CHILD_COLUMNS, *[F.col(c).alias(f"_{c}") for c in source]),
                    rejected_files(drop, files, CHILD_COLUMNS, every=True))


def child_files(spark: SparkSession, paths: Paths, glob: str = CSV_GLOB) -> DataFrame:
    return landing_files(spark, paths, pipe_on_tie=True, glob=glob,
                         located=located(CHILD_COLUMNS))


# ------------------------------------------------------------------ C2

def ingest_bom_config(spark: SparkSession, paths: Paths, with_source: bool = False,
                      glob: str = CSV_GLOB) -> DataFrame:
    """(Engine_serial, design_config_2, build_year) as text from every
    file whose header, its first line that is not blank, has the three
    required columns."""
    return config_ingest(spark, paths, with_source, glob).rows


def config_ingest(spark: SparkSession, paths: Paths, with_source: bool = False,
                  glob: str = CSV_GLOB) -> Ingested:
    """C2 with the files it skipped: those without all columns.  An empty file is read,
    and has no rows."""
    drop = list_drop(spark, paths, glob)
    files = config_files(spark, drop)
    source = ["path"] if with_source else []
    rows = _rows(drop, files.where(_present(CONFIG_COLUMNS, every=True)), CONFIG_COLUMNS, source,
                 skip_blank=True)                                                  # P6
    return Ingested(rows.select(S.ENGINE_SERIAL, S.DESIGN_CONFIG, S.BUILD_YEAR,
                                *[F.col(c).alias(f"_{c}") for c in source]),
                    rejected_files(drop, files, CONFIG_COLUMNS, every=True, empty=False))


def config_files(spark: SparkSession, paths: Paths, glob: str = CSV_GLOB) -> DataFrame:
    return landing_files(spark, paths, glob=glob, skip_blank=True,
                         located=located(CONFIG_COLUMNS))


# ------------------------------------------------------------------ C3

def _option_rows(drop: Drop, files: DataFrame, keep: list[str] = []) -> DataFrame:
    """Rows of the files with any kept column; P5: less those without a value."""
    files = files.where(_present(OPTION_COLUMNS, every=False))
    return _rows(drop, files, OPTION_COLUMNS, keep).na.drop(how="all", subset=S.OPTION_KEEP)


def option_files(spark: SparkSession, paths: Paths, glob: str = CSV_GLOB) -> DataFrame:
    return landing_files(spark, paths, glob=glob, located=located(OPTION_COLUMNS))


def file_periods(spark: SparkSession, files: DataFrame, source: Paths,
                 glob: str = CSV_GLOB) -> DataFrame:
    """(file, file_name, year, month, period) per file of ``source``, the drop that
    ``files`` was made from: F6/F7 on the name, F8 from data.  Only files whose
    name lacks a year are read for the latter, to find their first row, in file
    order, whose build_year_2 holds a year."""
    nameless = list_drop(spark, source, glob).only(lambda name: not has_year(name))
    year, month = year_from_name("file_name"), month_from_name("file_name")
    named = files.select("file", "file_name")
    if nameless.files:
        rows = _option_rows(nameless, files)
        data_year = (rows.select("file", "at", year_from_text("build_year_2").alias("_dy"))
                     .where(F.col("_dy").isNotNull())
                     .groupBy("file").agg(F.min_by("_dy", "at").alias("_dy")))
        named = named.join(data_year, "file", "left")
        year = F.coalesce(year, F.col("_dy"))
    return named.withColumns({"year": year, "month": month}).select(
        "file", "file_name", "year", "month",
        period_of(F.col("year"), F.col("month")).alias("period"))


def ingest_bom_option(spark: SparkSession, paths: Paths, with_source: bool = False,
                      glob: str = CSV_GLOB, with_period: bool = True) -> DataFrame:
    """The five kept option columns plus the half-year ``period`` of the
    file each row came from (``YYYY_01`` = Jan-Jun, ``YYYY_02`` = Jul-Dec).

    The periods join the file table, which is written again with them, so the
    lines meet one table with one row per file; ``with_period=False`` gives
    the same rows without the period, which is then not computed at all."""
    drop = list_drop(spark, paths, glob)
    files = option_files(spark, drop)
    source = ["file_name"] if with_source else []
    if with_period:
        from ..sinks import checkpoint_table
        periods = file_periods(spark, files, drop).select("file", "period")
        files = checkpoint_table(files.join(periods, "file"), "option-files")
    keep = ["period"] * with_period + source
    return _option_rows(drop, files, keep).select(*S.OPTION_KEEP, *keep)


def ingest_counts(df: DataFrame, by: str | list[str]) -> DataFrame:
    """A5: records per file or per period group."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("records"))
