"""Page anchors: page offset by vote, running headers, the first words of chapter pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import candidate_page_numbers, first_words, normalize_search, page_lines, significant_words, strip_header, words

SCANNED, LEAST_PRINTED, LEAST_VOTES, STORED, SEARCHED = 40, 5, 5, 12, 8


class PdfAnchorError(ValueError):
    """Pages that give no anchor."""


def offset_votes(pages: DataFrame) -> DataFrame:
    """(book_id, off, votes, first_vote): every candidate number of the first pages votes for page index minus number."""
    numbers = F.posexplode(candidate_page_numbers(F.coalesce("text", F.lit("")))).alias("pos", "num")
    rows = pages.filter(F.col("page_idx") < SCANNED).select("book_id", "page_idx", numbers)
    rows = rows.withColumn("off", F.col("page_idx") - F.col("num")).filter((F.col("num") >= LEAST_PRINTED) & F.col("off").between(-20, 5))
    return rows.groupBy("book_id", "off").agg(F.count("*").alias("votes"), F.min(F.struct("page_idx", "pos")).alias("first_vote"))


def voted_offset(pages: DataFrame) -> DataFrame:
    """(book_id, off, votes): most votes, ties to the first vote seen. Few rows a book: the window is bounded by the offsets."""
    w = Window.partitionBy("book_id").orderBy(F.desc("votes"), "first_vote")
    return offset_votes(pages).withColumn("r", F.row_number().over(w)).filter("r = 1").select("book_id", "off", "votes")


def title_offset(pages: DataFrame, manifest: DataFrame) -> DataFrame:
    """(book_id, title_off): first of the scanned pages that contains the first chapter's title, whatever its offset."""
    first = manifest.filter("unit_index = 1 and chap_index = 1").select("book_id", "start_page", normalize_search(F.col("title")).alias("needle"))
    scanned = pages.filter(F.col("page_idx") < SCANNED).join(first, "book_id")
    found = scanned.filter((F.col("needle") != "") & F.contains(normalize_search(F.coalesce("text", F.lit(""))), F.col("needle")))
    return found.groupBy("book_id").agg(F.min_by(F.col("page_idx") - F.col("start_page"), "page_idx").alias("title_off"))


def offsets(pages: DataFrame, manifest: DataFrame) -> DataFrame:
    """(book_id, off): the vote with enough votes, else the title's page, else the best vote."""
    books = manifest.select("book_id").distinct()
    joined = books.join(voted_offset(pages), "book_id", "left").join(title_offset(pages, manifest), "book_id", "left")
    off = F.when(F.col("votes") >= LEAST_VOTES, F.col("off")).otherwise(F.coalesce("title_off", "off"))
    return joined.select("book_id", off.alias("off"))


def running_headers(pages: DataFrame, least: int = 5, share: float = 0.3) -> DataFrame:
    """(book_id, header, n): words of the line most often among a book's first three lines, if on enough pages."""
    totals = pages.groupBy("book_id").agg(F.count("*").alias("pages"))
    top = F.slice(page_lines(F.coalesce("text", F.lit(""))), 1, 3)
    lines = pages.select("book_id", "page_idx", F.posexplode(top).alias("pos", "line"))
    bare = F.filter(words(normalize_search(F.col("line"))), lambda w: ~w.rlike("^[0-9]+$"))
    lines = lines.withColumn("words", bare).filter(F.size("words").between(1, 8)).withColumn("line", F.array_join("words", " "))
    counts = lines.groupBy("book_id", "line").agg(F.count("*").alias("n"), F.min(F.struct("page_idx", "pos")).alias("first_seen"))
    best = counts.groupBy("book_id").agg(F.min_by(F.struct("line", "n"), F.struct(-F.col("n"), "first_seen")).alias("best"))
    enough = F.greatest(F.lit(least), F.floor(F.col("pages") * F.lit(share)))
    kept = best.join(totals, "book_id").filter(F.col("best.n") >= enough)
    return kept.select("book_id", F.split("best.line", " ").alias("header"), F.col("best.n").alias("n"))


def _opening(rows: DataFrame, pages: DataFrame, headers: DataFrame) -> DataFrame:
    """Adds ``opening`` to rows with (book_id, pdf_page_index): the first words of that page without the running header; null off the book."""
    text = pages.select(F.col("book_id").alias("b"), F.col("page_idx").alias("i"), F.coalesce("text", F.lit("")).alias("page_text"))
    rows = rows.join(text, (F.col("book_id") == F.col("b")) & (F.col("pdf_page_index") == F.col("i")), "left")
    rows = rows.join(headers.select("book_id", "header"), "book_id", "left")
    raw = words(significant_words(F.col("page_text"), 2 * STORED))
    bare = F.slice(strip_header(raw, F.coalesce("header", F.array().cast("array<string>"))), 1, STORED)
    return rows.withColumn("opening", F.when(F.col("page_text").isNotNull(), bare)).drop("b", "i", "header", "page_text")


def anchors(pages: DataFrame, manifest: DataFrame, strict: bool = True) -> DataFrame:
    """The manifest with ``off``, ``pdf_page_index`` and ``start_anchor``, the first words of each chapter's page.

    ``problem`` says what keeps a chapter from having an anchor; under ``strict``
    the first such chapters are an error.
    """
    rows = manifest.join(offsets(pages, manifest), "book_id", "left").withColumn("pdf_page_index", F.col("start_page") + F.col("off"))
    rows = _opening(rows, pages, running_headers(pages))
    problem = (
        F.when(F.col("off").isNull(), "no page offset")
        .when(F.col("opening").isNull(), "page out of range")
        .when(F.size("opening") == 0, "page without words")
        .when(F.size("opening") < SEARCHED, "anchor too short")
    )
    rows = rows.withColumn("start_anchor", F.array_join("opening", " ")).withColumn("problem", problem).drop("opening")
    if strict and (bad := rows.filter("problem is not null").limit(3).collect()):
        raise PdfAnchorError("; ".join(f"{r['book_id']} {r['unit_index']}.{r['chap_index']}: {r['problem']}" for r in bad))
    return rows


def sentinels(pages: DataFrame, manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(book_id, sentinel): how the references' page opens, for books that have one within their pages; ``found`` are the anchors."""
    off = found.groupBy("book_id").agg(F.min("off").alias("off"))
    at = manifest.filter("refs_page is not null").groupBy("book_id").agg(F.min("refs_page").alias("refs_page")).join(off, "book_id")
    rows = at.select("book_id", (F.col("refs_page") + F.col("off")).alias("pdf_page_index"))
    opened = _opening(rows, pages, running_headers(pages)).filter(F.size("opening") > 0)
    return opened.select("book_id", F.array_join("opening", " ").alias("sentinel"))


def search_key(anchor: F.Column) -> F.Column:
    return first_words(anchor, SEARCHED)
