"""Blocks to Markdown with higher-order functions over nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse_newlines, heading, list_marker, md_escape, md_wrap, rstrip, slugify, strip
from .sequence import ranked

INLINE = "struct<kind:string,text:string>"


def render_inlines(inlines: Column) -> Column:
    """Inlines as text: runs escaped and wrapped, breaks as two blanks and a newline, equations raw in dollars with a space before where needed."""

    def add(acc: Column, x: Column) -> Column:
        glued = (acc == "") | F.right(acc, F.lit(1)).isin(" ", "\n", "(", "[", "{")
        text = F.coalesce(x["text"], F.lit(""))
        equation = F.concat(F.when(glued, F.lit("")).otherwise(F.lit(" ")), F.lit("$"), text, F.lit("$"))
        run = F.when(text == "", F.lit("")).otherwise(md_wrap(md_escape(text), x["kind"]))
        return F.concat(acc, F.when(x["kind"] == "line_break", F.lit("  \n")).when(x["kind"] == "equation_inline", equation).otherwise(run))

    return F.aggregate(F.coalesce(inlines, F.array().cast(f"array<{INLINE}>")), F.lit(""), add)


def flat_text(inlines: Column) -> Column:
    return F.array_join(F.transform(inlines, lambda i: F.when(i["kind"] == "line_break",
        F.lit("\n")).otherwise(F.coalesce(i["text"], F.lit("")))), "")


def without_trailing_breaks(inlines: Column) -> Column:
    last = F.array_max(F.transform(inlines, lambda i, k: F.when(i["kind"] != "line_break", k + 1).otherwise(0)))
    return F.slice(inlines, F.lit(1), F.coalesce(last, F.lit(0)))


# Callout tags by variant.
TAGS = {"note": "NOTE", "tip": "TIP", "warning": "WARNING", "important": "IMPORTANT", "caution": "CAUTION"}


def render_callout(variant: Column, title: Column, children: Column) -> Column:
    """``children`` are rendered texts; each of their lines gets the quote mark, an empty one the mark alone."""
    tag = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TAGS.items() for x in kv]), variant), F.lit("NOTE"))
    lines = F.flatten(F.transform(children, lambda c: F.split(c, "\n", -1)))
    body = F.transform(lines, lambda x: F.when(x == "", F.lit(">")).otherwise(F.concat(F.lit("> "), x)))
    head = F.array(F.concat(F.lit("> [!"), tag, F.lit("]")))
    named = F.array(F.concat(F.lit("> **"), title, F.lit("**")))
    titled = F.when(F.coalesce(title, F.lit("")) != "", named).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(head, titled, body), "\n")


def render_item(level: Column, base: Column, ordered: Column, marker: Column, n: Column, text: Column) -> Column:
    indent = F.repeat(F.lit("  "), (base + F.greatest(level, F.lit(1)) - 1).cast("int"))
    return rstrip(F.concat(indent, list_marker(ordered, marker, n), F.lit(" "), text))


def render_block(kind: Column, text: Column, *, level: Column, language: Column, src: Column, alt: Column, role: Column) -> Column:
    """All kinds that need no neighbours; ``text`` is rendered inlines, plain code, or LaTeX."""
    around = lambda left, x, right: F.concat(F.lit(left), x, F.lit(right))
    front = kind == "front_matter"
    return (
        F.when(kind == "heading", heading(level, text))
        .when(kind == "blockquote", F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> "))))
        .when(kind == "code_block", F.concat(F.lit("```"), language, F.lit("\n"), text, F.lit("\n```")))
        .when(kind == "image", F.concat(F.lit("!["), alt, F.lit("]("), src, F.lit(")")))
        .when(kind == "equation_display", F.when(strip(text) == "", F.lit("")).otherwise(around("$$\n", strip(text), "\n$$")))
        .when(kind == "caption", around("*", text, "*"))
        .when(front & (strip(text) == ""), F.lit(""))
        .when(front & (role == "title"), around("**", text, "**"))
        .when(front & role.isin("authors", "imprint", "cover_page", "unit_title"), around("*", text, "*"))
        .when(front, text)
        .otherwise(rstrip(text))
    )


def joined_blocks(blocks: DataFrame, keys: list[str], order: list[str], text: str = "md", name: str = "markdown") -> DataFrame:
    """(keys, name): texts in order with a blank line between, empty ones skipped."""
    kept = blocks.filter(F.coalesce(text, F.lit("")) != "")
    ordered = F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.col(text).alias("_md"))))
    return kept.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["_md"]), "\n\n").alias(name))


def assemble(blocks: DataFrame, keys: list[str], order: list[str], text: str = "md", name: str = "markdown") -> DataFrame:
    """Blocks of a document in order, a blank line between, empty ones skipped, a newline at the end."""
    ended = collapse_newlines(F.concat(F.col(name), F.lit("\n")))
    return joined_blocks(blocks, keys, order, text, name).withColumn(name, ended)


def document(blocks: DataFrame, keys: list[str], order: list[str], titles: DataFrame | None = None) -> DataFrame:
    """(keys, markdown) of whole documents.

    Without ``titles`` (keys, title) that is the body alone. With them it is the
    title, the front matter, the table of contents, the body and the references.
    Columns: ``section`` (body, front_matter or reference), ``kind``, ``level``,
    ``plain`` (a heading's text) and ``md``.
    """
    if titles is None:
        return assemble(blocks.filter("section = 'body'"), keys, order)
    out = titles.select(*keys, F.col("title").alias("_title"))
    for section in ("body", "front_matter", "reference"):
        part = joined_blocks(blocks.filter(F.col("section") == section), keys, order, name=f"_{section}")
        out = out.join(part, keys, "left")
    headings = blocks.filter("section = 'body' and kind = 'heading'").withColumn("title", F.replace("plain", F.lit("\n"), F.lit(" ")))
    out = out.join(render_toc(toc_entries(headings, keys, order), keys), keys, "left")
    parts = [
        F.concat(F.lit("# "), "_title", F.lit("\n")),
        F.concat(rstrip(F.col("_front_matter")), F.lit("\n")),
        F.concat(F.lit("## Sumário\n\n"), "toc", F.lit("\n")),
        F.col("_body"),
        F.concat(F.lit("## Referências\n\n"), "_reference", F.lit("\n")),
    ]
    return out.select(*keys, collapse_newlines(F.concat(F.concat_ws("\n", *parts), F.lit("\n"))).alias("markdown"))


def toc_entries(headings: DataFrame, keys: list[str], order: list[str], max_level: int = 2) -> DataFrame:
    """(keys, n, level, title, slug): headings up to a level; a slug's second use gets ``-1``, and so on."""
    rows = headings.withColumn("title", strip(F.col("title"))).filter((F.col("level") <= max_level) & (F.col("title") != ""))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    unnamed = F.concat(F.lit("heading-"), F.col("n").cast("string"))
    rows = rows.withColumn("base", F.coalesce(F.nullif(slugify(F.col("title")), F.lit("")), unnamed))
    return disambiguated(rows, [*keys, "base"], "n", "base", "slug").select(*keys, "n", "level", "title", "slug")


def disambiguated(rows: DataFrame, keys: list[str], order: str, base: str, name: str, sep: str = "-") -> DataFrame:
    """The first use of a name is bare, the nth repeat gets ``-n``; a name may be a large share of all rows."""
    found = ranked(rows, keys, order, "_k")
    repeat = F.concat(F.col(base), F.lit(sep), F.col("_k").cast("string"))
    return found.withColumn(name, F.when(F.col("_k") == 0, F.col(base)).otherwise(repeat)).drop("_k")


def render_toc(entries: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, toc): a line an entry; the heading above them is the document's."""
    indent = F.repeat(F.lit("  "), F.col("level") - 1)
    line = F.concat(indent, F.lit("- ["), F.col("title"), F.lit("](#"), F.col("slug"), F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct("n", "line")))
    return entries.withColumn("line", line).groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("toc"))
