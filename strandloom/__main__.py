"""python -m strandloom match --ConfigFileName FILE [--StartPoint N] [--Setting VALUE ...], or prepare [--rev] [--sz] FILE."""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession

from .plans import pipeline
from .plans.config import MatchConfig


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strandloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    prepare = commands.add_parser("prepare")
    prepare.add_argument("--rev", action="store_true")
    prepare.add_argument("--sz", action="store_true", help="write snappy-framed text in place of Parquet")
    prepare.add_argument("file")
    match = commands.add_parser("match")
    match.add_argument("--ConfigFileName", default="")
    match.add_argument("--StartPoint", type=int, default=0)
    match.add_argument("--compat", action="store_true")
    for f in fields(MatchConfig):
        match.add_argument(f"--{f.name}", type=str if f.name == "Windows" else type(f.default), default=None)
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName("strandloom").getOrCreate()
    if given.command == "prepare":
        print(*pipeline.prepare(spark, given.file, given.rev, given.sz))
        return
    flags = {f.name: getattr(given, f.name) for f in fields(MatchConfig)}
    config = MatchConfig.load(given.ConfigFileName, **flags) if given.ConfigFileName else MatchConfig().overridden(**flags)
    run = pipeline.match_files(spark, config, given.StartPoint, given.compat)
    for row in run.metrics().collect():
        print(row["metric"], row["value"])
    print("All done")


if __name__ == "__main__":
    main()
