"""Command line: version, convert, inspect, batch."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import __version__
from .operators import batch
from .plans import books
from .plans import convert as conversion
from .session import drop_scratch, session
from .sources import package


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioframe")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    look = sub.add_parser("inspect", help="paragraph styles of a package by use")
    look.add_argument("package")
    look.add_argument("--top", type=int, default=0, help="only the N most used; 0 for all")
    one = sub.add_parser("convert", help="one package into chapters")
    one.add_argument("package")
    one.add_argument("--output", "-o", default="out")
    one.add_argument("--title", "-t", help="the book's title; by default the file's name")
    one.add_argument("--links", help="folder of linked files; by default Links beside the package")
    one.add_argument("--pdf", help="the book's PDF; by default the largest beside the package")
    many = sub.add_parser("batch", help="all books of a folder in one job")
    many.add_argument("--input", "-i", default="Input", help="folder with a subfolder a book")
    many.add_argument("--output", "-o", default="Output")
    many.add_argument("--done", default="FEITOS", help="folder that finished books move to")
    many.add_argument("--errors", default="ERROS", help="folder that failed books move to")
    many.add_argument("--workers", "-w", type=int, help="tasks that read packages; by default as Spark deals files out")
    for p in (one, many):
        p.add_argument("--config", "-c", "--overlay", dest="overlay", help="YAML over the default style rules")
        p.add_argument("--inkscape", "--inkscape-path", dest="inkscape", help="the vector converter")
        p.add_argument("--pages", help="Parquet of (book_id, page_idx, text) instead of PDF files; book_id is the package's stem")
        p.add_argument("--cache", help="folder of converted equations, read before and added to after")
        p.add_argument("--units", type=int, default=4)
        p.add_argument("--per-unit", type=int, default=4)
    for p in (look, one, many):
        p.add_argument("--verbose", "-v", action="store_true")
    return top


def _inspect(spark: SparkSession, args: argparse.Namespace) -> int:
    every = conversion.inspect_styles(package.packages(spark, args.package))
    shown = every.limit(args.top) if args.top else every
    for r in shown.select("style", "n").toLocalIterator():
        print(f"{r['n']:6d}  {r['style']}")
    print(f"{every.count()} styles")
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "version":
        print(__version__)
        return 0
    spark = session()
    spark.sparkContext.setLogLevel("INFO" if args.verbose else "ERROR")
    if args.command == "inspect":
        return _inspect(spark, args)
    options = conversion.Options(units=args.units, per_unit=args.per_unit)
    settings = books.Settings(args.overlay, args.inkscape, args.cache, getattr(args, "workers", None), options)
    pages = spark.read.parquet(args.pages) if args.pages else None
    try:
        if args.command == "convert":
            slug = books.convert_package(spark, args.package, args.output, settings, args.title, args.links, args.pdf, pages)
            print(f"{args.output}/{slug}")
            return 0
        results = books.convert_folder(spark, args.input, args.output, args.done, args.errors, settings, pages)
        for r in results.orderBy("status", "dir").toLocalIterator():
            print(f"{r['status']:8s} {r['dir'].rpartition('/')[2]}  {r['message'] or ''}".rstrip())
        totals = batch.totals(results).first()
        print(totals.asDict())
        return 1 if totals["error"] else 0
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    sys.exit(main())
