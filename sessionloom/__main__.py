"""python -m sessionloom distill|refine --out DIR [--root DIR] [--only TEXT] [--max N] [--no-chain] [--repo-bound] SOURCE=PATH ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import engine
from .sources.discovery import Root


def main() -> None:
    parser = argparse.ArgumentParser(prog="sessionloom")
    parser.add_argument("command", choices=["distill", "refine"])
    parser.add_argument("logs", nargs="+", help="source=path, as in claude=/home/me/logs")
    parser.add_argument("--out", default="traces")
    parser.add_argument("--root")
    parser.add_argument("--only")
    parser.add_argument("--repo-bound", action="store_true")
    parser.add_argument("--no-chain", action="store_true", help="one trace for each session")
    parser.add_argument("--max", type=int, help="sessions at most, by their start")
    parser.add_argument("--chain-gap", type=int, default=45, help="minutes")
    parser.add_argument("--window-tokens", type=int, default=40_000)
    parser.add_argument("--turn-tokens", type=int, default=8_000)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("sessionloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    options = engine.Options(args.turn_tokens, args.window_tokens, loose_ms=args.chain_gap * 60_000, only=args.only, root=args.root, repo_bound=args.repo_bound, chain=not args.no_chain, most=args.max)
    tables = engine.distill(spark, [Root(*x.split("=", 1)) for x in args.logs], options)
    if args.command == "refine":
        tables |= engine.refine(tables["entries"], options)
    engine.write(tables, args.out)
    engine.write_markdown(tables["chain_traces"], f"{args.out}/markdown")


if __name__ == "__main__":
    main()
