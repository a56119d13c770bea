"""Command line of the batch pipeline (R2): exit code 0, 1 (a stage failed), 2 (bad arguments), 130 (interrupted)."""

from __future__ import annotations

import argparse
import logging
import sys

from ..scope import Scope
from .pipeline import Inputs, Pipeline, StageFailed


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m terracover", description="Territorial coverage pipeline.")
    p.add_argument("--ufs", default="BR", help="BR, a region's name, or states by comma")
    p.add_argument("--branches", required=True)
    p.add_argument("--posts", required=True)
    p.add_argument("--boundaries", required=True, nargs="+")
    p.add_argument("--addresses", required=True, help="ZIP files or folders of them, by comma")
    p.add_argument("--names", nargs="*", default=[])
    p.add_argument("--population", nargs="*", default=[])
    p.add_argument("--out", required=True)
    p.add_argument("--reuse", action="store_true", help="skip stages whose inputs and outputs are unchanged")
    p.add_argument("-v", "--verbose", action="store_true")
    return p


def causes(e: BaseException):
    while e is not None:
        yield e
        e = e.__cause__ or e.__context__


def advice(e: BaseException) -> str:
    """What the reader can do about the first cause that is known."""
    for c in causes(e):
        if isinstance(c, FileNotFoundError):
            return "a source file is missing; check the paths"
        if isinstance(c, KeyError):
            return "a source has not the expected columns; its layout may have changed"
        if isinstance(c, ValueError):
            return "a source or an intermediate table failed a check"
        if isinstance(c, OSError):
            return "a file could not be read or written"
    return "run again with -v for the whole trace"


def main(argv: list[str] | None = None, spark=None) -> int:
    try:
        args = parser().parse_args(argv)
        scope = Scope.parse(args.ufs)
    except SystemExit as e:
        return int(e.code or 0)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, format="%(message)s")
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("terracover").getOrCreate()
    try:
        inputs = Inputs(args.branches, args.posts, args.boundaries, args.addresses, args.names, args.population)
        for title, seconds in Pipeline(spark, scope, inputs, args.out).run(args.reuse):
            print(f"{title}: {seconds:.1f} s")
        return 0
    except KeyboardInterrupt:
        return 130
    except StageFailed as e:
        print(f"{e}\n{advice(e)}", file=sys.stderr)
        return 1
