"""Write rows as named landing files (``BOM_ESN_Option_199501010000.csv`` ...).

Spark's writers choose their own file names, but the landing contract keys
on names (the period comes from them), so files are written by the tasks
themselves: rows are hash-partitioned by target file and sorted, and each
task streams its files out with pandas, one file open at a time.  A file
belongs to exactly one task and is rewritten whole on a retry, so a lost
executor never leaves a half-appended file.  Used to build landing drops
from the driver's tables; the folder lives under the shared checkpoint dir.

Rows are shuffled as they are and spelled as fields behind the sort, and the
tasks grow with the rows, so that none sorts more than it holds in memory.
"""

from __future__ import annotations

import csv
import io
import sys
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The task-side writer is shipped by value with the pickled function, so
# executors need no copy of this package on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _open(folder: str, name: str):
    import pyarrow.fs as pafs
    if folder.startswith("/") or folder.startswith("file:"):
        import os
        root = folder[5:] if folder.startswith("file:") else folder
        root = root[2:] if root.startswith("//") else root
        os.makedirs(root, exist_ok=True)
        return open(os.path.join(root, name), "wb")
    fs, root = pafs.FileSystem.from_uri(folder)
    return fs.open_output_stream(f"{root.rstrip('/')}/{name}")


#: Rows that a task writes, about; fewer where there are idle cores.
TASK_ROWS = 2_000_000


def writing_tasks(spark: SparkSession, rows: int) -> int:
    return max(1, spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


class Layout(NamedTuple):
    """How files of a kind are spelled: which of the columns, under which header."""

    columns: list[str]
    header: list[str]
    delimiter: str


def write_layouts(df: DataFrame, folder: str, file_col: str, layout_col: str, layouts: list[Layout],
                  fields: dict[str, Column], order_by: list[str], partitions: int) -> DataFrame:
    """Write files of several layouts in one pass; ``layout_col`` is the number of a file's
    layout.  ``fields`` are computed from ``df``'s columns when the rows are in place:
    the shuffle carries only what they are made of.  Rows without a file are left
    out.  Returns (file, rows) per file written (an action)."""
    kept = [c for c in df.columns if c not in (file_col, layout_col)]
    names = list(fields)
    placed = (df.where(F.col(file_col).isNotNull())
              .select(F.col(file_col).alias("_file"), F.col(layout_col).alias("_layout"), *kept)
              .repartition(partitions, "_file")
              .sortWithinPartitions("_file", *order_by)
              .select("_file", "_layout", *[c.cast("string").alias(f"_v{i}")
                                            for i, c in enumerate(fields.values())]))
    chosen = [([f"_v{names.index(c)}" for c in own.columns], own.header, own.delimiter)
              for own in layouts]

    def write(batches):
        current, fh, count, done = None, None, 0, []
        for pdf in batches:
            for name, part in pdf.groupby("_file", sort=False):
                columns, header, delim = chosen[part["_layout"].iloc[0]]
                if name != current:
                    if fh is not None:
                        fh.close()
                        done.append((current, count))
                    current, count, fh = name, 0, _open(folder, name)
                    fh.write((_quote_line(header, delim) + "\n").encode("utf-8"))
                fh.write(_text(part[columns], delim).encode("utf-8"))
                count += len(part)
        if fh is not None:
            fh.close()
            done.append((current, count))
        yield pd.DataFrame(done, columns=["file", "rows"])

    return placed.mapInPandas(write, "file string, rows long")


def write_few_files(df: DataFrame, folder: str, file_col: str, columns: list[str]) -> DataFrame:
    """Write ``columns`` as comma files, few but large ones, in no order: a task keeps all
    its files open and sorts nothing.  Rows without a file are left out.  Returns
    (file, rows) per file written (an action)."""
    n = writing_tasks(df.sparkSession, 0)
    prepared = (df.where(F.col(file_col).isNotNull())
                .select(F.col(file_col).alias("_file"), *[
                    F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)])
                .repartition(n, "_file"))
    value_cols = [f"_v{i}" for i in range(len(columns))]

    def write(batches):
        opened, counts = {}, {}
        try:
            for pdf in batches:
                for name, part in pdf.groupby("_file", sort=False):
                    if name not in opened:
                        opened[name], counts[name] = _open(folder, name), 0
                        opened[name].write((_quote_line(columns, ",") + "\n").encode("utf-8"))
                    opened[name].write(_text(part[value_cols], ",").encode("utf-8"))
                    counts[name] += len(part)
        finally:
            for fh in opened.values():
                fh.close()
        yield pd.DataFrame(list(counts.items()), columns=["file", "rows"])

    return prepared.mapInPandas(write, "file string, rows long")


def write_landing_files(df: DataFrame, folder: str, file_col: str, columns: list[str],
                        header: list[str] | None = None, header_col: str | None = None,
                        delimiter_col: str | None = None,
                        delimiter: str = "|", order_by: list[str] | None = None,
                        short_trailing: bool = False, partitions: int | None = None) -> DataFrame:
    """Write ``columns`` of ``df`` under ``header`` into one file per
    ``file_col`` value; returns (file, rows) per file written (an action).

    The header line is ``header`` joined by the file's delimiter, or the
    text of ``header_col`` (per file); ``delimiter_col`` picks the delimiter
    per file; ``short_trailing`` drops trailing empty fields (a short row)."""
    order_by = order_by or []
    n = partitions or max(1, df.sparkSession.sparkContext.defaultParallelism)
    dcol = F.col(delimiter_col) if delimiter_col else F.lit(delimiter)
    hcol = F.col(header_col) if header_col else F.lit(None).cast("string")
    prepared = (df.select(F.col(file_col).alias("_file"), dcol.alias("_delim"),
                          hcol.alias("_header"),
                          *[F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)],
                          *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)])
                .repartition(n, "_file")
                .sortWithinPartitions("_file", *[f"_o{i}" for i in range(len(order_by))]))
    value_cols = [f"_v{i}" for i in range(len(columns))]

    def write(batches):
        current, fh, count = None, None, 0
        done = []
        for pdf in batches:
            for name, part in pdf.groupby("_file", sort=False):
                if name != current:
                    if fh is not None:
                        fh.close()
                        done.append((current, count))
                    current, count = name, 0
                    delim = part["_delim"].iloc[0]
                    fh = _open(folder, name)
                    line = (part["_header"].iloc[0] if header is None
                            else _quote_line(header, delim))
                    fh.write((line + "\n").encode("utf-8"))
                delim = part["_delim"].iloc[0]
                text = _text(part[value_cols], delim)
                if short_trailing:
                    text = "\n".join(line.rstrip(delim) for line in text.split("\n"))
                fh.write(text.encode("utf-8"))
                count += len(part)
        if fh is not None:
            fh.close()
            done.append((current, count))
        yield pd.DataFrame(done, columns=["file", "rows"])

    return prepared.mapInPandas(write, "file string, rows long")


def _text(fields: pd.DataFrame, delim: str) -> str:
    buf = io.StringIO()
    fields.to_csv(buf, sep=delim, header=False, index=False, quoting=csv.QUOTE_MINIMAL,
                  quotechar='"', doublequote=True, lineterminator="\n", na_rep="")
    return buf.getvalue()


def _quote_line(fields: list[str], delim: str) -> str:
    buf = io.StringIO()
    csv.writer(buf, delimiter=delim, quotechar='"', lineterminator="").writerow(fields)
    return buf.getvalue()
