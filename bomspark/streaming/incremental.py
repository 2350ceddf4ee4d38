"""Exactly-once ingestion of daily landing drops.

The reference re-read the whole landing folder on every run and appended to
its previous output, so a re-run duplicated rows.  Here a *ledger table* holds
the path of every file that was ingested, with its batch.  A run lists the folder,
takes the files that an anti-join with the ledger leaves, oldest first, in
batches of a bounded number of files, and for each batch

1. runs the batch normalizer (mixed delimiters, header synonyms...) on just those
   paths and writes the rows into the table's ``batch_id`` partition,
   replacing what is there, and
2. writes the paths into the ledger under the same ``batch_id``.

A batch that fails before 2 is not in the ledger, so the next run gives its
number again, and its rows replace what it left.  The ledger grows in the
shared folder, one short row per file; the driver keeps nothing between runs, and
no age limit drops late files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import checkpoint_table, table_exists
from ..sources.landing import CSV_GLOB, list_files

LEDGER = T.StructType([T.StructField("path", T.StringType()),
                       T.StructField("modificationTime", T.TimestampType()),
                       T.StructField("batch_id", T.LongType())])

Normalizer = Callable[[SparkSession, list[str]], DataFrame]


def _into_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """``df`` as the whole of one batch of a table."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("batch_id").parquet(path))


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """(path, modificationTime, batch_id) of every file ingested so far."""
    if not table_exists(spark, ledger_dir):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger_dir)


def new_files(spark: SparkSession, landing_dir: str, ledger_dir: str,
              glob: str = CSV_GLOB) -> DataFrame:
    """(path, modificationTime) of the landing files that the ledger lacks."""
    return (list_files(spark, landing_dir, glob).select("path", "modificationTime")
            .join(read_ledger(spark, ledger_dir).select("path"), "path", "left_anti"))


def incremental_ingest(spark: SparkSession, landing_dir: str, table_dir: str,
                       ledger_dir: str, normalizer: Normalizer,
                       max_files_per_trigger: int = 1000, glob: str = CSV_GLOB) -> int:
    """Ingest every landing file not in the ledger; returns the number of batches
    that ran.  Rows land in ``table_dir`` partitioned by ``batch_id``."""
    pending = checkpoint_table(new_files(spark, landing_dir, ledger_dir, glob), "new-files")
    last = read_ledger(spark, ledger_dir).agg(F.max("batch_id")).collect()[0][0]
    first = batch_id = 0 if last is None else last + 1
    while True:
        # at most max_files_per_trigger rows: a batch's paths, which its readers need
        batch = (pending.join(read_ledger(spark, ledger_dir).select("path"), "path", "left_anti")
                 .orderBy("modificationTime", "path").limit(max_files_per_trigger).collect())
        if not batch:
            return batch_id - first
        _into_batch(normalizer(spark, [r["path"] for r in batch]), table_dir, batch_id)
        taken = spark.createDataFrame([(r["path"], r["modificationTime"]) for r in batch],
                                      "path string, modificationTime timestamp").coalesce(1)
        _into_batch(taken, ledger_dir, batch_id)
        batch_id += 1


def read_ingested(spark: SparkSession, table_dir: str, schema: T.StructType) -> DataFrame:
    """The ingested table (all batches), or an empty frame before the first run."""
    if not table_exists(spark, table_dir):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(table_dir)
