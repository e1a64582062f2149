"""The batch queue: what to do, what was done, and how it went."""

from __future__ import annotations

import json
import shutil
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def discover(packages: DataFrame) -> DataFrame:
    """(dir, package, slug, packages, status) from (dir, package, slug).

    Of a directory the first package by name counts, of a slug the first
    directory by name; the others have status ``slug_taken``.
    """
    first = packages.groupBy("dir").agg(F.min(F.struct("package", "slug")).alias("first"), F.count("*").alias("packages"))
    first = first.select("dir", F.col("first.package").alias("package"), F.col("first.slug").alias("slug"), "packages")
    n = F.row_number().over(Window.partitionBy("slug").orderBy("dir"))
    return first.withColumn("status", F.when(n == 1, "task").otherwise("slug_taken"))


def processed(tasks: DataFrame, found: DataFrame) -> DataFrame:
    """(kind, key) for ``skipped`` and ``pending``: what of ``found`` (kind, name) is one of the tasks (dir, slug).

    Outputs are known by slug, folders of done and failed books by the name of
    the task's directory; key is the directory.
    """
    named = tasks.select("dir", "slug", F.element_at(F.split("dir", "/"), -1).alias("folder"))
    outputs = found.filter("kind = 'output'").join(named, F.col("name") == F.col("slug"))
    folders = found.filter("kind <> 'output'").join(named, F.col("name") == F.col("folder"))
    return outputs.unionByName(folders).select("kind", F.col("dir").alias("key"))


def skipped(tasks: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Tasks that ``done`` (kind, key) knows, with the first reason in the order output, done, error."""
    rank = F.when(F.col("kind") == "output", 0).when(F.col("kind") == "done", 1).otherwise(2)
    reasons = done.groupBy(F.col("key").alias("_k")).agg(F.min_by("kind", rank).alias("reason"))
    return tasks.join(reasons, F.col(key) == F.col("_k")).drop("_k")


def pending(tasks: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    return tasks.join(done.select(F.col("key").alias("_k")), F.col(key) == F.col("_k"), "left_anti")


def totals(results: DataFrame) -> DataFrame:
    """One row: results by status."""
    return results.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("done", "error", "skipped")], F.count("*").alias("total"))


def success_rate(results: DataFrame, threshold: float = 0.95) -> DataFrame:
    """ok over ok and failed, skips apart; nothing tried is a rate of 0."""
    ok, failed = F.count_if(F.col("status") == "ok"), F.count_if(F.col("status") == "failed")
    rate = F.when(ok + failed > 0, ok / (ok + failed)).otherwise(F.lit(0.0))
    return results.agg(ok.alias("ok"), failed.alias("failed"), rate.alias("rate"), (rate >= threshold).alias("passed"))


def finalize(
    book_dir: Path, slug: str, status: str, message: str | None, done_dir: Path, errors_dir: Path, package: str = "", report: Path | None = None
) -> bool:
    """Move a finished book's folder to where its status belongs, on the driver alone.

    A converted book's report goes with it; a failed one gets a JSON beside it.
    A target that exists already leaves the book where it is.
    """
    target = (done_dir if status == "done" else errors_dir) / book_dir.name
    if target.exists():
        return False
    target.parent.mkdir(parents=True, exist_ok=True)
    shutil.move(str(book_dir), str(target))
    if status == "done":
        if report is not None and report.exists():
            shutil.copy2(report, target / "_report.json")
    else:
        note = {"book": book_dir.name, "package": package, "slug": slug, "error": message, "timestamp": datetime.now(UTC).isoformat()}
        (target / "_batch_error.json").write_text(json.dumps(note, ensure_ascii=False, indent=2), encoding="utf-8")
    return True
