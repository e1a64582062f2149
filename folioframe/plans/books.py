"""Whole conversions: one package, or a folder of books as one job.

What is read and written are folders that all machines see. Books of a folder
are converted by one plan; a book that fails is a row of the results and leaves
no output, and the others go on.
"""

from __future__ import annotations

import shutil
import tempfile
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import latex
from ..functions.text import slugify, title_from_stem
from ..operators import assets, batch
from ..sources import package, pdf
from ..sources.rules import rules
from . import convert

STEM = r"([^/]+)\.[^./]*$"
FILES = "path string, modificationTime timestamp, length bigint, content binary"
RESULTS = "dir string, slug string, package string, status string, message string"


@dataclass(frozen=True)
class Settings:
    """``cache`` is a folder of converted equations (sha1, latex), read before and added to after; ``workers`` how many tasks read packages."""

    overlay: Any = None
    inkscape: str | None = None
    cache: str | None = None
    workers: int | None = None
    options: convert.Options = convert.Options()


def _svg(program: str | None) -> convert.Converter:
    """A vector by the programs of the machine that runs the task."""

    def made(name: str, content: bytes) -> tuple[str, bytes] | None:
        with tempfile.TemporaryDirectory() as d:
            source = Path(d) / name
            source.write_bytes(content)
            out = assets.to_svg(source, source, program)
            return (out.name, out.read_bytes()) if out else None

    return made


def _files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, length, content, dir) of files that match; none, where nothing does."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    matched = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
    if not matched:
        return spark.createDataFrame([], FILES + ", dir string")
    return spark.read.format("binaryFile").load(pattern).withColumn("dir", F.regexp_extract("path", "(.*)/[^/]+$", 1))


def _bare(path: str | Path) -> str:
    """A local path as it is, whatever its scheme."""
    text = str(path)
    return text.removeprefix("file://") if text.startswith("file://") else text.removeprefix("file:")


def _cached(spark: SparkSession, settings: Settings) -> DataFrame | None:
    if settings.cache is None:
        return None
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(settings.cache)
    known = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema("sha1 string, latex string").parquet(settings.cache) if known else None


def _write(book: convert.Book, settings: Settings, cache: DataFrame | None, root: str, titles: DataFrame) -> None:
    convert.write_chapters(book, root)
    if book.outputs is not None:
        convert.write_assets(book, root)
    convert.write_reports(book, rules(settings.overlay), root, titles)
    if settings.cache is not None and book.equations is not None:
        latex.extend_cache(book.equations, cache, settings.cache)


def _options(settings: Settings) -> convert.Options:
    from dataclasses import replace

    return replace(settings.options, overlay=settings.overlay)


def convert_package(
    spark: SparkSession, path: str | Path, output: str | Path, settings: Settings = Settings(), title: str | None = None,
    links: str | Path | None = None, pdf_path: str | Path | None = None, pages: DataFrame | None = None,
) -> str:
    """Convert one package into ``output``/<slug>, the slug being that of its title; returns the slug.

    The title is the file's stem unless given, links are in ``Links`` beside the
    package, and the page text comes from the largest PDF beside it, from
    ``pdf_path``, or from ``pages`` (book_id, page_idx, text) by its stem.
    """
    path, stem = Path(_bare(path)), Path(_bare(path)).stem
    named = spark.createDataFrame([(title or stem,)], "title string")
    named = named.select(title_from_stem(F.col("title")).alias("title")) if title is None else named
    first = named.select("title", slugify(F.col("title")).alias("slug")).first()
    slug, book = first["slug"], F.lit(first["slug"]).alias("book_id")
    pkgs = package.packages(spark, str(path), f"*{path.suffix}").select(book, "path", "content")
    folder = str(links) if links is not None else f"{path.parent}/Links"
    files = _files(spark, f"{_bare(folder)}/*").select(book, F.element_at(F.split("path", "/"), -1).alias("basename"), "content")
    if pages is not None:
        pages = pages.filter(F.col("book_id").cast("string") == stem).select(book, F.col("page_idx").cast("int").alias("page_idx"), "text")
    else:
        found = _files(spark, _bare(pdf_path) if pdf_path else f"{path.parent}/*.pdf")
        best = pdf.largest_sibling(found, []).first()["path"] if not found.isEmpty() else None
        if best is None:
            raise FileNotFoundError(f"no PDF beside {path.name}")
        pages = pdf.pages(found.filter(F.col("path") == best).select(book, "content"))
    cache = _cached(spark, settings)
    made = convert.plan(spark, pkgs, pages, files, _options(settings), cache, _svg(settings.inkscape))
    titles = spark.createDataFrame([(slug, first["title"])], "book_id string, title string")
    _write(made, settings, cache, str(output), titles)
    return slug


def tasks_of(spark: SparkSession, source: str) -> DataFrame:
    """(dir, package, slug, packages, status) of the packages in immediate subfolders; contents are not read for it."""
    listed = _files(spark, f"{_bare(source)}/*/*.idml")
    stem = title_from_stem(F.regexp_extract("path", STEM, 1))
    return batch.discover(listed.select("dir", F.col("path").alias("package"), slugify(stem).alias("slug")))


def convert_folder(
    spark: SparkSession, source: str | Path, output: str | Path, done: str | Path, errors: str | Path,
    settings: Settings = Settings(), pages: DataFrame | None = None,
) -> DataFrame:
    """Convert all books of a folder in one plan: (dir, slug, package, status, message), a row a book.

    Books with an output, or a folder among the done or the failed, are skipped.
    ``pages`` (book_id, page_idx, text) knows books by their packages' stem;
    without it the largest PDF of each folder is read. Folders are moved by the
    driver when all is written, one by one as results stream in.
    """
    found = tasks_of(spark, str(source)).filter("status = 'task'").drop("status", "packages")
    known = [(p.parent.parent.name, "output") for p in Path(_bare(output)).glob("*/unidade_1/capitulo_1.md")]
    for kind, folder in (("done", done), ("error", errors)):
        known += [(p.name, kind) for p in Path(_bare(folder)).glob("*/")] if Path(_bare(folder)).is_dir() else []
    before = batch.processed(found, spark.createDataFrame(known, "name string, kind string"))
    todo = convert.written(batch.pending(found, before, "dir"), "tasks")
    skipped = batch.skipped(found, before, "dir").select("dir", "slug", "package", F.lit("skipped").alias("status"), F.col("reason").alias("message"))
    own = todo.select("dir", "slug", "package")

    read = _files(spark, f"{_bare(source)}/*/*.idml").join(own.select("package", "slug"), F.col("path") == F.col("package"))
    pkgs = read.select(F.col("slug").alias("book_id"), "path", "content")
    pkgs = pkgs.repartition(settings.workers) if settings.workers else pkgs
    links = _files(spark, f"{_bare(source)}/*/Links/*").withColumn("book_dir", F.regexp_extract("dir", "(.*)/[^/]+$", 1))
    files = links.join(own.select(F.col("dir").alias("d"), "slug"), F.col("book_dir") == F.col("d"))
    files = files.select(F.col("slug").alias("book_id"), F.element_at(F.split("path", "/"), -1).alias("basename"), "content")
    if pages is not None:
        stems = own.select(F.regexp_extract("package", STEM, 1).alias("stem"), "slug")
        pages = pages.join(stems, F.col("book_id").cast("string") == F.col("stem"))
        pages = pages.select(F.col("slug").alias("book_id"), F.col("page_idx").cast("int").alias("page_idx"), "text")
    else:
        pdfs = _files(spark, f"{_bare(source)}/*/*.pdf")
        best = pdf.largest_sibling(pdfs, ["dir"]).select(F.col("path").alias("best"))
        texts = pdfs.join(best, F.col("path") == F.col("best")).join(own.select("dir", "slug"), "dir")
        pages = convert.written(pdf.pages(texts.select(F.col("slug").alias("book_id"), "content")), "pages")

    cache = _cached(spark, settings)
    made = convert.plan(spark, pkgs, pages, files, _options(settings), cache, _svg(settings.inkscape), strict=False)
    title = title_from_stem(F.regexp_extract("package", STEM, 1))
    _write(made, settings, cache, str(output), own.select(F.col("slug").alias("book_id"), title.alias("title")))
    failed = made.problems.withColumnRenamed("book_id", "slug")
    status = F.when(F.col("problem").isNull(), "done").otherwise("error")
    tried = own.join(failed, "slug", "left").select("dir", "slug", "package", status.alias("status"), F.col("problem").alias("message"))
    results = convert.written(tried.unionByName(skipped), "results")
    for r in results.filter("status <> 'skipped'").toLocalIterator():
        at = Path(_bare(output)) / r["slug"]
        if r["status"] == "error":
            shutil.rmtree(at, ignore_errors=True)
        name = Path(r["package"]).name
        batch.finalize(Path(_bare(r["dir"])), r["slug"], r["status"], r["message"], Path(done), Path(errors), name, at / "_report.json")
    return results
