"""Sinks K1-K7: CSV and Parquet writers, appends, partitioned and
year-ordered exports, empty-schema outputs.

All outputs are directories written by the executors in parallel; nothing
is funnelled through the driver or a single task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """K1: header line, RFC quoting of the delimiter, quotes and newlines;
    NULL is written as an empty field, blanks as they are."""
    (df.write.mode(mode).option("header", True).option("sep", sep)
     .option("quote", '"').option("escape", '"').option("nullValue", "").option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def rebalanced_for(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows grouped for a partitioned write: a rebalance on the partition
    columns sends each value to its own tasks, and AQE splits a value that
    holds a large share of the rows into advisory-size pieces and merges
    small ones.  Without it every input task writes one file per value it
    meets (tasks x values small files); a plain ``repartition`` on the
    columns would instead write a hot value from one task."""
    return df.hint("rebalance", *partition_by)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """K2/K4: ZSTD Parquet; with ``partition_by`` the rows are rebalanced on
    those columns and only the partitions present in ``df`` are replaced
    (dynamic partition overwrite)."""
    if partition_by:
        df = rebalanced_for(df, partition_by)
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def table_exists(spark: SparkSession, path: str) -> bool:
    """Does the folder (or file) hold any data file?"""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return False
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return any(n[:1] not in ("_", ".") for n in names)


def table_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType | None:
    """Schema of an existing table, or None if there is none (metadata only).
    A table that is there but cannot be read is an error."""
    if not table_exists(spark, path):
        return None
    reader = spark.read.format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path).schema


def append_table(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K3: append when the existing table has the same columns, otherwise
    replace it. Rows are never de-duplicated (UNION ALL semantics).
    Returns the mode used."""
    existing = table_schema(spark, path, fmt)
    same = existing is not None and [f.name for f in existing] == df.columns
    mode = "append" if same else "overwrite"
    if fmt == "csv":
        write_csv(df, path, mode)
    else:
        w = df.write.mode(mode)
        (w.option("compression", "zstd") if fmt == "parquet" else w).format(fmt).save(path)
    return mode


def export_year_ordered(df: DataFrame, path: str, year_col: str = "build_year",
                        then: list[str] | None = None, partitions: int | None = None,
                        observe: str | None = None):
    """K5/O1: export ordered by year, newest first, NULL years last.

    Range partitioning on the year gives part files that are ordered among
    themselves; sorting within each part completes a global order without
    funnelling rows through one task.  One path for every size (the
    reference switched to per-year chunks above 100 M rows).  With
    ``observe`` the written row count is returned as an ``Observation``."""
    then = list(then or [])
    order = [F.col(year_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in then]
    # The remaining columns break ties: a year (or year and count) holding a
    # third of all rows still gets range bounds inside it, so it is written by
    # many tasks, not one; the order stays "year descending" throughout.
    order += [F.col(c).asc_nulls_last() for c in df.columns if c not in [year_col] + then]
    # Without an explicit count the range exchange starts from
    # spark.sql.shuffle.partitions (sized for the cluster's largest shuffle)
    # and AQE merges neighbouring ranges up to the advisory partition size,
    # which keeps the order: part sizes follow the data, not the core count.
    ranged = (df.repartitionByRange(partitions, *order) if partitions
              else df.repartitionByRange(*order))
    ordered = ranged.sortWithinPartitions(*order)
    obs = None
    if observe:
        # observed above the range exchange: the bound-sampling job that
        # range partitioning runs does not count rows twice
        from pyspark.sql import Observation
        obs = Observation(observe)
        ordered = ordered.observe(obs, F.count(F.lit(1)).alias("rows"))
    ordered.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return obs


# ------------------------------------------------------------------ K5: years, verified

def export_by_year(df: DataFrame, path: str, year_col: str = "build_year") -> None:
    """K5: one partition folder per year, each of which can be verified and replaced
    alone; rows without a year have one too."""
    write_parquet(df, path, partition_by=[year_col])


def _per_year(df: DataFrame, year_col: str, columns: list[str]) -> DataFrame:
    """Rows of each year and a sum over their contents that ignores their order."""
    content = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return df.groupBy(F.col(year_col).alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), content.alias("content"))


def verify_years(expected: DataFrame, path: str, year_col: str = "build_year") -> DataFrame:
    """A7 per year: (year, expected_rows, actual_rows, match) of a year-wise export.

    A year matches if its rows are as many and their contents add up alike, so a year
    with other rows of the same number is found too.  Part files that cannot be
    read count as missing; a year on one side only has no rows on the other."""
    spark = expected.sparkSession
    columns = sorted(expected.columns)
    stored = (spark.read.option("ignoreCorruptFiles", True).schema(expected.schema).parquet(path)
              if table_exists(spark, path) else expected.where(F.lit(False)))
    want = _per_year(expected, year_col, columns)
    got = _per_year(stored, year_col, columns).select(
        F.col("year").alias("_year"), F.col("rows").alias("_rows"), F.col("content").alias("_content"))
    either = want.join(got, F.col("year").eqNullSafe(F.col("_year")), "full")
    return either.select(
        F.coalesce("year", "_year").alias("year"),
        F.coalesce("rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("_rows", F.lit(0)).alias("actual_rows"),
        (F.col("rows").eqNullSafe(F.col("_rows"))
         & F.col("content").eqNullSafe(F.col("_content"))).alias("match"))


def repair_years(df: DataFrame, path: str, year_col: str = "build_year") -> DataFrame:
    """Verify a year-wise export and write the years that fail once more, only those
    (dynamic partition overwrite); years that should not be there are removed.
    Returns the verification from before."""
    spark = df.sparkSession
    found = checkpoint_table(verify_years(df, path, year_col), "verified-years")
    bad = found.where("not match")
    again = df.join(bad.where("expected_rows > 0").select(F.col("year").alias("_year")),
                    F.col(year_col).eqNullSafe(F.col("_year")), "left_semi")
    write_parquet(again, path, partition_by=[year_col])
    fs, _ = _file_system(spark, path)
    for r in bad.where("expected_rows = 0").collect():       # one row per surplus year
        name = "__HIVE_DEFAULT_PARTITION__" if r["year"] is None else r["year"]
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{year_col}={name}"), True)
    return found


# ------------------------------------------------------------------ K3: CSV tables

def append_csv(df: DataFrame, path: str, short_rows: str = "drop", check_header: bool = True,
               pipe_on_tie: bool = False) -> str:
    """K3 on CSV tables, which hold what others wrote too: append ``df`` to the table at
    ``path`` by the landing rules, and return what was done, "append", "rewrite" or
    "overwrite".

    The existing rows are read by their raw fields.  If a file's header is not
    ``df``'s columns (and ``check_header``), the table is replaced by ``df``.  Rows with
    fewer fields than columns are dropped, or padded with empty ones if
    ``short_rows`` is "pad"; further fields are left out.  Only a table with such
    rows is written anew, beside itself, and then put in its own place; else files
    are added to it.  Rows are never de-duplicated."""
    from ..sources.landing import landing_files, list_drop, quote_split, raw_rows

    spark = df.sparkSession
    if short_rows not in ("drop", "pad"):
        raise ValueError(f"short_rows is 'drop' or 'pad', not {short_rows!r}")
    if not table_exists(spark, path):
        write_csv(df, path)
        return "overwrite"
    drop = list_drop(spark, path)
    files = landing_files(spark, drop, pipe_on_tie=pipe_on_tie)
    if check_header:
        names = F.slice(quote_split(F.col("header"), F.col("delimiter")), 1,
                        len(df.columns) if short_rows == "pad" else 1 << 20)
        if not files.where(names != F.array(*map(F.lit, df.columns))).isEmpty():
            write_csv(df, path)
            return "overwrite"
    rows = raw_rows(drop, files)
    if rows.where(F.size("fields") != len(df.columns)).isEmpty():
        write_csv(df, path, "append")
        return "append"
    kept = rows if short_rows == "pad" else rows.where(F.size("fields") >= len(df.columns))
    old = kept.select(*[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(df.columns)])
    fs, at = _file_system(spark, path)
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    write_csv(old.unionByName(df.select(*[F.col(c).cast("string") for c in df.columns])), beside)
    fs.delete(at, True)
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(beside), at)
    return "rewrite"


def csv_to_parquet(spark: SparkSession, csv_paths: list[str] | str, schema: T.StructType,
                   out: str) -> DataFrame:
    """K7: typed CSV scan of a file list -> ZSTD Parquet; returns the Parquet scan."""
    paths = csv_paths if isinstance(csv_paths, list) else [csv_paths]
    df = (spark.read.schema(schema).option("header", True).option("quote", '"')
          .option("escape", '"').csv(paths))
    write_parquet(df, out)
    return spark.read.parquet(out)


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a ZSTD Parquet table in the shared checkpoint folder
    and return a scan of it.

    Used for a stage consumed by several branches: the branches then read
    the table instead of each recomputing (scan + join + shuffle) the whole
    upstream plan, and the lineage is cut, so a lost executor costs a re-read
    of the table, not a recomputation from the raw inputs."""
    from ..session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
