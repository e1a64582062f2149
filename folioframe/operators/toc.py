"""Tables of contents: unit sessions, entries, numbering, validation."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import toc_title, toc_tokens
from .sequence import not_increasing, numbered, running

# Styles of a table of contents, and titles of the references.
UNIT_STYLE = "Sumario:SUMARIO UNIDADE"
ENTRY_STYLES = ("Sumario:SUMARIO", "Sumario:Item 1")
REFERENCE_TITLES = ("REFERENCIAS", "REFERÊNCIAS")


class TocParseError(ValueError):
    """A table of contents that does not have the expected shape."""


def unit_groups(entries: DataFrame, is_unit: str = "is_unit", keys: tuple[str, ...] = ("book_id",), order: str = "ord") -> DataFrame:
    """(keys, unit_index, payload): rows before the first unit header are ignored, the rest of a unit is joined by tabs."""
    ks = list(keys)
    grouped = entries.withColumn("unit_index", running(F.col(is_unit), ks, [order])).filter("unit_index > 0")
    texts = F.array_sort(F.collect_list(F.when(~F.col(is_unit), F.struct(F.col(order).alias("o"), F.col("text").alias("t")))))
    payload = F.array_join(F.transform(texts, lambda x: x["t"]), "\t")
    return grouped.groupBy(*ks, "unit_index").agg(F.coalesce(payload, F.lit("")).alias("payload"))


def chapters(units: DataFrame, keys: tuple[str, ...] = ("book_id",)) -> DataFrame:
    """(keys, unit_index, pos, title, start_page, is_reference, chap_index): chapters are numbered within their unit, references not."""
    ks = list(keys)
    rows = units.select(*ks, "unit_index", F.posexplode(toc_tokens(F.col("payload"))).alias("pos", "entry"))
    titled = toc_title(F.col("entry.title")).alias("title"), F.col("entry.page").alias("start_page")
    rows = rows.select(*ks, "unit_index", "pos", *titled).filter("title <> ''")
    rows = rows.withColumn("is_reference", F.upper("title").isin(*REFERENCE_TITLES))
    return numbered(rows, [*ks, "unit_index", "is_reference"], ["pos"], "n").withColumn("chap_index", F.when(~F.col("is_reference"),
        F.col("n"))).drop("n")


def violations(rows: DataFrame, units: int = 4, per_unit: int = 4, keys: tuple[str, ...] = ("book_id",)) -> DataFrame:
    """(keys, problem): unit count, chapters a unit, pages that do not grow, references not behind the last chapter."""
    ks = list(keys)
    said = lambda pattern, *cols: F.format_string(pattern, *cols).alias("problem")
    body = rows.filter(~F.col("is_reference"))
    sizes = rows.groupBy(*ks, "unit_index").agg(F.count_if(~F.col("is_reference")).alias("n"))
    wrong_units = sizes.groupBy(*ks).agg(F.count("*").alias("n")).filter(F.col("n") != units)
    wrong_sizes = sizes.filter(F.col("n") != per_unit)
    falling = not_increasing(body, ks, ["unit_index", "pos"], "start_page")
    last = body.groupBy(*ks).agg(F.max("start_page").alias("last_page"))
    refs = rows.filter("is_reference").groupBy(*ks).agg(F.max("start_page").alias("refs_page"))
    found = [
        wrong_units.select(*ks, said("%d units", "n")),
        wrong_sizes.select(*ks, said("unit %d has %d chapters", "unit_index", "n")),
        falling.select(*ks, said("page %d does not follow page %d", "start_page", "previous")),
        refs.join(last, ks).filter("refs_page <= last_page").select(*ks, said("references on page %d", "refs_page")),
    ]
    return functools.reduce(DataFrame.unionAll, found)


def manifest(entries: DataFrame, units: int = 4, per_unit: int = 4, strict: bool = True) -> DataFrame:
    """Chapters of every book, in order; ``refs_page`` is null without references.

    A book whose contents have not the expected shape is an error, or under
    ``strict=False`` left out; ``violations`` of the same rows says why.
    """
    rows = chapters(unit_groups(entries))
    bad = violations(rows, units, per_unit)
    if strict:
        found = bad.limit(5).collect()
        if found or rows.isEmpty():
            raise TocParseError("; ".join(f"{r['book_id']}: {r['problem']}" for r in found) or "no table of contents")
    else:
        rows = rows.join(bad.select("book_id").distinct(), "book_id", "left_anti")
    refs = F.max(F.when(F.col("is_reference"), F.col("start_page"))).over(Window.partitionBy("book_id"))
    kept = rows.withColumn("refs_page", refs).filter(~F.col("is_reference"))
    return kept.select("book_id", "unit_index", "chap_index", "title", "start_page", "refs_page")
