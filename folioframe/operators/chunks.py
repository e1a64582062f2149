"""Markdown split into chapters at their anchors."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.offsets import positions
from ..session import made_rows

POSITIONS = "book_id string, unit_index int, chap_index int, start int, chunk_end int"
CHAPTERS = "book_id string, unit_index int, chap_index int, text string"


class ChapterSplitError(ValueError):
    """A chapter that is not found, or is empty."""


def _wanted(markdown: DataFrame, anchors: DataFrame, sentinels: DataFrame | None) -> DataFrame:
    """(book_id, markdown, wanted, sentinel): a book's text with its chapters in order."""
    chapter = F.struct("unit_index", "chap_index", "title", "start_anchor")
    wanted = anchors.groupBy("book_id").agg(F.array_sort(F.collect_list(chapter)).alias("wanted"))
    rows = markdown.select("book_id", "markdown").join(wanted, "book_id")
    if sentinels is None:
        return rows.withColumn("sentinel", F.lit(None).cast("string"))
    return rows.join(sentinels.select("book_id", "sentinel"), "book_id", "left")


def _found(markdown: str, wanted: list[dict], sentinel: str | None, snap_to_line: bool) -> Iterator[tuple[int, int, int, int]]:
    """(unit_index, chap_index, start, chunk_end) of a book's chapters; -1 for what is not found."""
    found, end = positions(markdown, [(w["title"], w["start_anchor"] or "") for w in wanted], sentinel, snap_to_line)
    known, k = [p for p in found if p >= 0], 0
    for w, p in zip(wanted, found, strict=True):
        k += p >= 0
        yield w["unit_index"], w["chap_index"], p, (known[k] if k < len(known) else end) if p >= 0 else -1


def chapter_positions(markdown: DataFrame, anchors: DataFrame, sentinels: DataFrame | None = None, snap_to_line: bool = False) -> DataFrame:
    """(book_id, unit_index, chap_index, start, chunk_end): one search a book, as each starts where the last ended.

    A book is one row of text and a few anchors: that bounds what a worker holds.
    """

    def search(book, markdown, wanted, sentinel):
        return ((book, *at) for at in _found(markdown, wanted, sentinel, snap_to_line))

    return made_rows(_wanted(markdown, anchors, sentinels), search, POSITIONS)


def split(markdown: DataFrame, anchors: DataFrame, sentinels: DataFrame | None = None, strict: bool = True, snap_to_line: bool = False) -> DataFrame:
    """(book_id, unit_index, chap_index, text); a chapter missing or empty is an error, or under ``strict=False`` a row of null.

    Texts are cut where they are searched, so that they are made and moved once.
    """

    def cut(book, markdown, wanted, sentinel):
        for unit, chapter, start, end in _found(markdown, wanted, sentinel, snap_to_line):
            yield book, unit, chapter, (markdown[start:end].strip() or None) if start >= 0 else None

    rows = made_rows(_wanted(markdown, anchors, sentinels), cut, CHAPTERS)
    if strict and (bad := rows.filter("text is null").limit(3).collect()):
        raise ChapterSplitError("; ".join(f"{r['book_id']} {r['unit_index']}.{r['chap_index']}: not found or empty" for r in bad))
    return rows


def first_heading(wanted: DataFrame, headings: DataFrame, keys: list[str], title: str = "title", cursor: str = "cursor") -> DataFrame:
    """``wanted`` with ``pos``, the first heading (keys, pos, form) at or after its cursor whose search form begins with its title.

    A range join on the keys: every wanted row meets the headings of its book
    only, and the least position wins. Rows without a match have null.
    """
    rows = wanted.withColumn("_row", F.monotonically_increasing_id())
    own = headings.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("pos").alias("_pos"), F.col("form").alias("_form"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    met = rows.join(own, [*same, F.col("_pos") >= F.col(cursor), F.startswith("_form", F.col(title))], "left")
    return met.groupBy("_row", *wanted.columns).agg(F.min("_pos").alias("pos")).drop("_row")
