"""Run steps of the pipeline: python -m quotewell STEP [STEP ...] --folder F [--raw FILE]."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quotewell.config import TreeParams
from quotewell.plans.steps import STEPS, Workspace
from quotewell.sources.tables import write_table


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quotewell", description=__doc__)
    parser.add_argument("steps", nargs="+", choices=[*STEPS, "all"])
    parser.add_argument("--folder", required=True, help="folder of the stage tables")
    parser.add_argument("--raw", help="raw quote CSV, for the steps clean and gaps")
    parser.add_argument("--references", help="Parquet table of reference prices, instead of the "
                        "configured ones, for the steps features and verify")
    parser.add_argument("--trees", type=int, default=TreeParams().n_trees)
    parser.add_argument("--reports", choices=["parquet", "csv"], default="parquet")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("quotewell").getOrCreate()
    workspace = Workspace(
        spark, options.folder, options.raw, trees=TreeParams(n_trees=options.trees),
        references_path=options.references,
    )
    for step in STEPS if "all" in options.steps else options.steps:
        for name, report in STEPS[step](workspace).items():
            path = workspace.path(f"reports/{step}/{name}")
            write_table(report, path, options.reports)
            print(f"{step} / {name}")
            written = spark.read.format(options.reports).option("header", "true").load(path)
            written.show(30, truncate=False)


if __name__ == "__main__":
    main()
