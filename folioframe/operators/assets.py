"""Assets: requests against files, deduplication by content, names, paths."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import RASTER, extension
from ..session import on_workers
from ..sources.files import write_files  # noqa: F401
from .sequence import ranked

VECTORS = (".ai", ".eps")


def distinct_in_order(requests: DataFrame, key: str = "basename", order: str = "ord", by: tuple[str, ...] = ()) -> DataFrame:
    """First appearance of every key."""
    return requests.groupBy(*by, key).agg(F.min(order).alias(order))


def present(requests: DataFrame, files: DataFrame, on: list[str]) -> DataFrame:
    return requests.join(files, on, "left_semi")


def missing(requests: DataFrame, files: DataFrame, on: list[str]) -> DataFrame:
    return requests.join(files, on, "left_anti")


def content_aliases(files: DataFrame, order: str = "ord", by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``sha1`` and ``first_name``, the first basename with the same content.

    An aggregate joined back, not a window: copies of one file are combined
    before they are shuffled.
    """
    digested = files.withColumn("sha1", F.sha1(F.col("content")))
    first = digested.groupBy(*by, "sha1").agg(F.min_by("basename", order).alias("first_name"))
    return digested.join(first, [*by, "sha1"])


def distinct_names(files: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``target``: the first use of a name keeps it, the nth repeat gets ``_n`` before the extension."""
    ext = F.regexp_extract("basename", r"[^.](\.[^.]*)$", 1)
    stem = F.expr("substring(basename, 1, length(basename) - length(_ext))")
    repeat = F.concat(stem, F.lit("_"), F.col("_k").cast("string"), F.col("_ext"))
    return ranked(files, keys, order, "_k").withColumn("_ext", ext).withColumn("target", F.when(F.col("_k") == 0,
        F.col("basename")).otherwise(repeat)).drop("_k", "_ext")


def plan_rasters(requests: DataFrame, files: DataFrame, folder: str = "assets/img") -> DataFrame:
    """(book_id, basename, status, rel_path): skipped (no raster), missing, copied or alias."""
    wanted = distinct_in_order(requests, by=("book_id",))
    raster = extension(F.col("basename")).isin(*RASTER)
    have = content_aliases(present(files.join(wanted, ["book_id", "basename"]), wanted, ["book_id", "basename"]), by=("book_id",))
    joined = wanted.join(have.select("book_id", "basename", "first_name"), ["book_id", "basename"], "left")
    status = F.when(~raster, "skipped").when(F.col("first_name").isNull(), "missing").when(F.col("first_name") == F.col("basename"),
        "copied").otherwise("alias")
    return joined.select("book_id", "basename", "ord", status.alias("status"), F.when(raster & F.col("first_name").isNotNull(),
        F.concat(F.lit(f"{folder}/"), "first_name")).alias("rel_path"))


def merged_paths(rasters: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed union in which vectors win."""
    both = rasters.select(*keys, "rel_path", F.lit(0).alias("p")).unionByName(vectors.select(*keys, "rel_path",
        F.lit(1).alias("p"))).filter("rel_path is not null")
    return both.groupBy(*keys).agg(F.max_by("rel_path", "p").alias("rel_path"))


def rewritten(images: DataFrame, paths: DataFrame, on: list[str], src: str = "src", depth: int = 2) -> DataFrame:
    """``src`` through the path table, then ``../`` per level unless it is a URL, absolute or relative upwards already."""
    found = images.join(paths.withColumnRenamed("rel_path", "_rel"), on, "left").withColumn("_to", F.coalesce("_rel", src))
    fixed = F.col("_to").rlike(r"^(https?://|data:|/|\.\./)")
    return found.withColumn(src, F.when(fixed, F.col("_to")).otherwise(F.concat(F.lit("../" * depth), F.col("_to")))).drop("_rel", "_to")


class BinaryNotFoundError(FileNotFoundError):
    """A program that is not on this machine."""


def run(cmd: list[str], *, timeout: float = 60.0, cwd: Path | None = None) -> tuple[int, str, str]:
    """(code, out, err); a non-zero code or a timeout, code 124, does not raise."""
    if shutil.which(cmd[0]) is None and not Path(cmd[0]).exists():
        raise BinaryNotFoundError(cmd[0])
    try:
        done = subprocess.run(cmd, capture_output=True, text=True, timeout=timeout, cwd=cwd, check=False)
    except subprocess.TimeoutExpired:
        return 124, "", f"no end after {timeout} s"
    return done.returncode, done.stdout, done.stderr


def _usual_places() -> Iterator[Path]:
    """Where installers put the converter on Windows."""
    for base in (Path.home(), Path("C:/Program Files"), Path("C:/Program Files (x86)")):
        for below in ("Inkscape/bin", "Inkscape/PFiles64/Inkscape/bin", "Inkscape"):
            yield base / below / "inkscape.exe"


def inkscape(explicit: str | None = None) -> str | None:
    """The converter: the path given (and no other, if it is missing), the environment's, that on PATH, or a usual place."""
    if explicit is not None:
        return explicit if Path(explicit).exists() else None
    places = [os.environ.get("FOLIOFRAME_INKSCAPE_PATH"), shutil.which("inkscape"), *map(str, _usual_places())]
    return next((p for p in places if p and Path(p).exists()), None)


def to_svg(source: Path, target: Path, program: str | None = None) -> Path | None:
    """Vector first, within 60 s; else a raster of 300 dpi cut to the drawing, within 30 s; None if neither works."""
    if (found := inkscape(program)) is not None:
        svg = target.with_suffix(".svg")
        code, *_ = run([found, str(source), "--export-type=svg", f"--export-filename={svg}"], timeout=60)
        if code == 0 and svg.exists():
            return svg
    for name in filter(shutil.which, ("gs", "gswin64c")):
        png = target.with_suffix(".png")
        options = ["-sDEVICE=png16m", "-r300", "-dEPSCrop", "-dNOPAUSE", "-dBATCH", "-dQUIET"]
        code, *_ = run([name, *options, f"-sOutputFile={png}", str(source)], timeout=30)
        if code == 0 and png.exists():
            return png
    return None


def convert_vectors(files: DataFrame, convert: Callable[[str, bytes], tuple[str, bytes] | None]) -> DataFrame:
    """(book_id, basename, status, out_name, out): ``convert`` is called where the file is, never raises, and None is a failure."""

    on_workers(files.sparkSession)

    def each(batches: Iterator) -> Iterator:
        import pandas as pd

        for b in batches:
            rows = []
            for book, name, content in zip(b["book_id"], b["basename"], b["content"], strict=True):
                try:
                    made = convert(name, bytes(content))
                except Exception:  # a converter's failure is a row, not the job's
                    made = None
                rows.append((book, name, "converted" if made else "failed", made[0] if made else None, made[1] if made else None))
            yield pd.DataFrame(rows, columns=["book_id", "basename", "status", "out_name", "out"])

    wanted = files.filter(extension(F.col("basename")).isin(*VECTORS)).select("book_id", "basename", "content")
    return wanted.mapInPandas(each, "book_id string, basename string, status string, out_name string, out binary")
