"""``python -m keelson build FOLDER OUT`` and ``python -m keelson query OUT WORD``; ``@file`` reads arguments from a file, one a line."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import retrieval as R
from .operators.settings import Settings
from .plans.build import build
from .sources import feedback, graph_store


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="keelson", fromfile_prefix_chars="@")
    todo = parser.add_subparsers(dest="command", required=True)
    make = todo.add_parser("build", help="relations and assets of a folder of CSV, TSV and XLSX files")
    make.add_argument("folder")
    make.add_argument("out")
    make.add_argument("--feedback", help="table of confirmed and rejected relations")
    make.add_argument("--settings", help="file of thresholds, lines of name: value")
    ask = todo.add_parser("query", help="tables with a word in their name, and their relations")
    ask.add_argument("out")
    ask.add_argument("word")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("keelson").getOrCreate()
    if args.command == "build":
        said = feedback.said(spark, args.feedback) if args.feedback else None
        catalog, assets = build(spark, args.folder, args.out, said, Settings.read(spark, args.settings) if args.settings else Settings())
        catalog.errors.show(truncate=False)
        assets.show(len(assets.columns) * 20, truncate=False)
    else:
        part = lambda name: graph_store.load(spark, str(Path(args.out) / "graph"), name)
        R.query_columns(part("tables"), part("columns"), args.word).orderBy("table").show(1000, truncate=False)
        R.query_table(part("tables"), part("relations"), args.word).orderBy("table", "direction", "confidence").show(1000, truncate=False)


if __name__ == "__main__":
    main()
