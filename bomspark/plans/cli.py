"""Run the whole report from landing folders.

spark-submit ... bomspark/plans/cli.py (or python -m bomspark.plans.cli) --option DIR --config DIR --child DIR --out DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..sources.ingest import ingest_bom_config, ingest_bom_option, ingest_option_child
from .workflow import run_workflow, write_outputs


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--option", required=True, help="option landing folder")
    ap.add_argument("--config", required=True, help="config landing folder")
    ap.add_argument("--child", required=True, help="option-child landing folder")
    ap.add_argument("--out", required=True, help="output folder")
    args = ap.parse_args(argv)
    # master, memory and shuffle partitions are the submitter's
    spark = SparkSession.builder.appName("bomspark-report").getOrCreate()
    result = run_workflow(ingest_bom_option(spark, args.option, with_period=False),
                          ingest_bom_config(spark, args.config),
                          ingest_option_child(spark, args.child))
    write_outputs(result, args.out).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
