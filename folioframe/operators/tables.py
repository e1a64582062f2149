"""Tables: cells to a grid, and the grid to GFM or HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import md_wrap, rstrip, strip

BLOCK = "struct<kind:string,inlines:array<struct<kind:string,text:string>>,src:string,alt:string,latex:string>"
CELL = f"struct<row_span:int,col_span:int,blocks:array<{BLOCK}>>"


def grid(cells: DataFrame, keys: list[str], cell_name_order: str = "row:col") -> DataFrame:
    """(keys, rows, header_rows): cells placed by name; malformed names and places outside go, holes close up, so rows may be ragged.

    Input columns: ``name``, ``row_span``, ``col_span``, ``blocks``, and the table's
    ``header_rows``, ``body_rows`` and ``columns``.
    """
    parts = F.split("name", ":")
    ok = F.col("name").rlike(r"^\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*$")
    first, second = (F.when(ok, F.trim(parts[i]).cast("int")) for i in (0, 1))
    row, col = (first, second) if cell_name_order == "row:col" else (second, first)
    placed = cells.withColumn("_r", row).withColumn("_c", col)
    placed = placed.filter(F.col("_r").between(0, F.col("header_rows") + F.col("body_rows") - 1) & F.col("_c").between(0, F.col("columns") - 1))
    rows = placed.groupBy(*keys, "header_rows", "body_rows",
        "_r").agg(F.array_sort(F.collect_list(F.struct("_c", "row_span", "col_span", "blocks"))).alias("cells"))
    tables = rows.groupBy(*keys, "header_rows", "body_rows").agg(F.map_from_entries(F.collect_list(F.struct("_r", "cells"))).alias("by_row"))
    all_rows = cells.select(*keys, "header_rows", "body_rows").distinct().join(tables, [*keys, "header_rows", "body_rows"], "left")
    empty = F.array().cast(f"array<{CELL}>")
    strip = lambda cs: F.transform(cs, lambda c: F.struct(c["row_span"].alias("row_span"), c["col_span"].alias("col_span"),
        c["blocks"].alias("blocks")))
    total = F.col("header_rows") + F.col("body_rows")
    made = F.when(total > 0, F.transform(F.sequence(F.lit(0), total - 1), lambda r: F.coalesce(strip(F.element_at("by_row", r)),
        empty))).otherwise(F.array().cast(f"array<array<{CELL}>>"))
    return all_rows.select(*keys, made.alias("rows"), "header_rows")


def plain_inlines(inlines: Column) -> Column:
    """Text of inlines for a cell: wrapped, not escaped, breaks as spaces."""
    one = lambda i: F.when(i["kind"] == "line_break", F.lit(" ")).when(F.coalesce(i["text"], F.lit("")) == "",
        F.lit("")).when(i["kind"] == "equation_inline", F.concat(F.lit("$"), i["text"], F.lit("$"))).otherwise(md_wrap(i["text"], i["kind"]))
    return F.array_join(F.transform(inlines, one), "")


def needs_html(rows: Column) -> Column:
    block_cell = lambda c: (F.size(c["blocks"]) > 1) | ((F.size(c["blocks"]) == 1) & c["blocks"][0]["kind"].isin("image",
        "equation_display", "table"))
    return F.exists(rows, lambda r: F.exists(r, lambda c: (c["col_span"] > 1) | (c["row_span"] > 1) | block_cell(c)))


def gfm(rows: Column, header_rows: Column) -> Column:
    """Rows padded to the widest; a blank header where there is none."""
    width = F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))

    def cell(c: Column) -> Column:
        text = F.when((F.size(c["blocks"]) > 0) & (c["blocks"][0]["kind"] == "paragraph"), plain_inlines(c["blocks"][0]["inlines"])).otherwise("")
        return strip(F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))

    def line(texts: Column) -> Column:
        padded = F.concat(texts, F.array_repeat(F.lit(""), (width - F.size(texts)).cast("int")))
        return rstrip(F.concat(F.lit("| "), F.array_join(F.transform(padded, lambda t: F.concat(t, F.lit(" | "))), "")))

    lines = F.transform(rows, lambda r: line(F.transform(r, cell)))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit(" --- "), width.cast("int")), "|"), F.lit("|"))
    blank = F.array(line(F.array().cast("array<string>")))
    head = F.when(header_rows > 0, F.slice(lines, F.lit(1), F.greatest(header_rows, F.lit(1)))).otherwise(blank)
    body = F.slice(lines, header_rows + 1, F.greatest(F.size(lines), F.lit(1)))
    return F.when(width == 0, F.lit("")).otherwise(F.array_join(F.concat(head, F.array(rule), body), "\n"))


def html(rows: Column, header_rows: Column) -> Column:
    def content(b: Column) -> Column:
        return (
            F.when(b["kind"] == "paragraph", plain_inlines(b["inlines"]))
            .when(b["kind"] == "image", F.concat(F.lit('<img src="'), b["src"], F.lit('" alt="'), b["alt"], F.lit('" />')))
            .when(b["kind"] == "equation_display", F.concat(F.lit("$$"), b["latex"], F.lit("$$")))
            .otherwise("")
        )

    def cell(c: Column, tag: Column) -> Column:
        span = lambda name, n: F.when(n > 1, F.concat(F.lit(f' {name}="'), n.cast("string"), F.lit('"'))).otherwise("")
        inner = F.array_join(F.filter(F.transform(c["blocks"], content), lambda t: t != ""), "<br />")
        return F.concat(F.lit("    <"), tag, span("rowspan", c["row_span"]), span("colspan", c["col_span"]), F.lit(">"), inner, F.lit("</"),
            tag, F.lit(">"))

    def row(r: Column, k: Column) -> Column:
        tag = F.when(k < header_rows, F.lit("th")).otherwise(F.lit("td"))
        return F.array_join(F.concat(F.array(F.lit("  <tr>")), F.transform(r, lambda c: cell(c, tag)), F.array(F.lit("  </tr>"))), "\n")

    return F.array_join(F.concat(F.array(F.lit("<table>")), F.transform(rows, row), F.array(F.lit("</table>"))), "\n")


def render_table(rows: Column, header_rows: Column) -> Column:
    return F.when(needs_html(rows), html(rows, header_rows)).otherwise(gfm(rows, header_rows))
