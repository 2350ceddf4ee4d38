"""Shared pieces: word splitting, shared-folder tables, Arrow batch helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII blanks that separate words; a word is a run of anything else.
#: ``bytes.split()`` without arguments splits on exactly these bytes.
BLANKS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text as an array, in order (null text: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared checkpoint folder
    and read back: lineage is cut there, so a lost executor costs a re-read,
    and several consumers share one computation."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def single_threaded_tasks(spark: SparkSession) -> None:
    """Python workers started from now on use one thread each for linear algebra:
    Spark runs a task per core, and small matrices only lose by more threads.
    A setting made by the user stays."""
    spark.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A text column's values as UTF-8 bytes, without decoding them."""
    col = batch.column(batch.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(kind).to_pylist()


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
