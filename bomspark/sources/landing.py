"""Landing-folder readers (S1-S6): file listing, per-file delimiter
detection, lines of all dialects from one scan, lenient and typed CSV reads.

How a mixed folder is read
--------------------------
1. *Header pass* - tasks read the first line of every listed file (a bounded
   number of bytes) and Spark derives delimiter and column names from it.
   The result, one row per file, is written once as a table.
2. *Line scan* (``lines``) - the drop is read once, as lines with their positions,
   whatever its files' dialects and names.
3. The lines are joined with the file table on the file's number (broadcast if
   Spark's size check of that table allows it, otherwise a join in which
   AQE splits a file holding most lines), which leaves out each file's header by
   its position, and split by their file's rule, once each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import count_char, java_trim
from ..operators.joins import splittable
from ..sinks import checkpoint_table
from .lines import (CSV_GLOB, Drop, Paths, bytes_setting, file_rows, first_lines, lines,
                    list_drop)

#: A line never holds a line break, so it can stand for an unquoted delimiter.
_BREAK = "\n"


def base_of(path: Column | str) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def quote_split(line: Column, delimiter: Column) -> Column:
    """S3: fields of a line.  A double quote anywhere switches quoting and is
    dropped; a delimiter inside quotes belongs to its field."""
    plain = F.replace(line, delimiter, F.lit(_BREAK))
    quoted = F.array_join(F.transform(F.split(line, '"', -1), lambda part, i: F.when(
        i % 2 == 0, F.replace(part, delimiter, F.lit(_BREAK))).otherwise(part)), "")
    return F.split(F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain), _BREAK, -1)


def delimiter_of(header: Column, pipe_on_tie: bool = False) -> Column:
    """S2: '|' when the first line has more pipes than commas (or as many,
    for option-child files), else ','."""
    pipes, commas = count_char(header, "|"), count_char(header, ",")
    cond = (pipes >= commas) if pipe_on_tie else (pipes > commas)
    return F.when(cond, F.lit("|")).otherwise(F.lit(","))


def list_files(spark: SparkSession, paths: Paths, glob: str = CSV_GLOB) -> DataFrame:
    """Regular ``*.csv`` files (any case); content is never read."""
    return file_rows(list_drop(spark, paths, glob)).drop("file")


def landing_files(spark: SparkSession, paths: Paths, pipe_on_tie: bool = False,
                  glob: str = CSV_GLOB, skip_blank: bool = False,
                  located: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The file table: (file, path, file_name, header, header_at, delimiter, names), one
    row per non-empty file, written once, with what ``located`` adds.  Names are
    trimmed as Java trims."""
    delimiter = delimiter_of(F.col("header"), pipe_on_tie)
    files = (first_lines(list_drop(spark, paths, glob), skip_blank)
             .select("file", "path", base_of("path").alias("file_name"), "header", "header_at",
                     delimiter.alias("delimiter"))
             .withColumn("names", F.transform(
                 quote_split(F.col("header"), F.col("delimiter")), java_trim)))
    return checkpoint_table(located(files) if located else files, "landing-files")


def detect_delimiters(spark: SparkSession, paths: Paths, pipe_on_tie: bool = False,
                      glob: str = CSV_GLOB) -> DataFrame:
    """S2 as a DataFrame: (path, file_name, header, delimiter), one row per file."""
    return landing_files(spark, paths, pipe_on_tie, glob).select(
        "path", "file_name", "header", "delimiter")


def computed_once(column: Column) -> Column:
    """The column, made to depend on the partition's number: Catalyst neither copies
    such a column into what uses it nor pushes a filter on it below it."""
    return F.when(F.spark_partition_id() >= 0, column)


#: Bytes that a file's row takes in a join, besides its header's names and its path.
_FILE_ROW = 160
_NAMES = 512


def _beside_lines(drop: Drop, files: DataFrame) -> DataFrame:
    """The file table as the other side of a join with the drop's lines.

    Spark takes the size of what Python reads for that of the listing, so the way of
    the join is chosen here: the table is broadcast if as many rows as the drop
    has files are below Spark's threshold, else both sides are sorted and AQE splits
    a file that holds most lines."""
    limit = bytes_setting(files.sparkSession, "spark.sql.autoBroadcastJoinThreshold")
    each = _FILE_ROW + _NAMES * ("names" in files.columns)
    path = "path" in files.columns or "file_name" in files.columns
    if sum(each + len(f.path) * path for f in drop.files) <= limit:
        return F.broadcast(files)
    return splittable(files).hint("merge")


def not_broadcast(rows: DataFrame) -> DataFrame:
    """A drop's rows as a side of later joins.  Their size is unknown until they are read,
    and Spark would take them for as small as the listing and broadcast them whole, by way
    of the driver; so joins with them are sort-merge joins."""
    return rows.hint("merge")


def split_lines(drop: Drop, files: DataFrame, skip_blank: bool = False) -> DataFrame:
    """The drop's lines behind the headers of ``files`` (file, header_at, delimiter, ...)
    with their ``_f`` fields; lines of other files are left out."""
    own = lines(drop)
    if skip_blank:
        own = own.where(java_trim("value") != "")
    regex = F.when(F.col("delimiter") == "|", r"\|").otherwise(",").alias("delimiter")
    files = files.select(*[regex if c == "delimiter" else c for c in files.columns])
    joined = own.join(_beside_lines(drop, files), "file").where("at > header_at")
    return joined.withColumn("_f", computed_once(F.split("value", F.col("delimiter"), -1))).drop(
        "delimiter", "header_at", "value")


def clean(field: Column) -> Column:
    """A field of ``_f``: quoted delimiters back in place, trimmed as Java trims, blank to
    NULL.  Batches without quotes and control characters need no more than a plain trim."""
    whole = java_trim(F.translate(field, "\n\r", "|,"))
    return F.nullif(F.when(F.col("plain"), F.trim(field)).otherwise(whole), F.lit(""))


def raw_rows(drop: Drop, files: DataFrame) -> DataFrame:
    """(fields) of every line behind its file's header, as many as the line has, without
    quotes but otherwise as they are."""
    rows = split_lines(drop, files.select("file", "header_at", "delimiter"))
    return rows.select(F.transform("_f", lambda f: F.translate(f, "\n\r", "|,")).alias("fields"))


def read_delimited(spark: SparkSession, folder: Paths, lower_names: bool = True,
                   glob: str = CSV_GLOB) -> DataFrame:
    """S3/S4 on a whole folder: every file with its own delimiter, columns
    named by each file's (trimmed, lower-cased) header, aligned by name;
    values are text with quotes removed, trimmed, blank -> NULL."""
    drop = list_drop(spark, folder, glob)
    files = landing_files(spark, drop, skip_blank=True)
    if lower_names:
        files = files.withColumn("names", F.transform("names", F.lower))
    files = files.withColumn("names", F.transform("names", lambda n, i: F.when(
        n == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(n)))
    # the result's columns: as many rows as there are distinct column names
    columns = [r["n"] for r in files.select(F.posexplode("names").alias("i", "n"))
               .groupBy("n").agg(F.min("i").alias("i")).orderBy("i", "n").collect()]
    if not columns:
        raise ValueError("no readable files")
    rows = split_lines(drop, files.select("file", "header_at", "delimiter", "names", "path"),
                       skip_blank=True)

    def field(name: str) -> Column:       # duplicate names: last one wins
        behind = F.array_position(F.reverse("names"), F.lit(name))
        return F.when(behind > 0, F.get("_f", F.size("names") - behind.cast("int")))
    return not_broadcast(rows.select(*[clean(field(n)).alias(n) for n in columns],
                                     F.col("path").alias("_path"), F.col("at").alias("_pos")))


def read_typed_csv(spark: SparkSession, paths: Paths, schema: T.StructType,
                   header: bool = True, sep: str = ",") -> DataFrame:
    """A list of CSV files as one table with stated types."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("quote", '"').option("escape", '"').csv(paths))


def read_lenient_csv(spark: SparkSession, paths: Paths, columns: list[str],
                     sep: str = ",") -> DataFrame:
    """All-VARCHAR lenient read (DuckDB ``all_varchar, ignore_errors``):
    rows with fewer fields than the header are dropped, longer rows are
    truncated to the header's width.  Uses PERMISSIVE mode with a corrupt
    record column and drops only the short rows, so ``count()`` is exact."""
    bad = "_corrupt"
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns]
                          + [T.StructField(bad, T.StringType(), True)])
    df = (spark.read.schema(schema).option("header", True).option("sep", sep)
          .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", bad)
          .csv(paths if isinstance(paths, list) else [paths]))
    # a corrupt record is either short or long; long rows keep their first
    # fields, short rows are the ones whose last column is absent.
    short = F.col(bad).isNotNull() & (F.size(F.split(F.col(bad), _split_re(sep))) < len(columns))
    # The filter must reference every data column: with CSV column pruning a
    # plan needing only the corrupt-record column (e.g. count()) parses no
    # field, so no row would ever be flagged.  length(...) >= 0 is always true
    # but not foldable, which keeps all fields parsed.
    parsed = F.length(F.concat_ws("\u0001", *[F.col(c) for c in columns])) >= 0
    return df.where(~short & parsed).drop(bad)


def _split_re(sep: str) -> str:
    # delimiter outside double quotes
    return f'\\{sep}(?=(?:[^"]*"[^"]*")*[^"]*$)' if sep == "|" else f'{sep}(?=(?:[^"]*"[^"]*")*[^"]*$)'
