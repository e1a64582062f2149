"""Books from packages to chapters: one plan over any number of books, from archives to text and report.

Stages are DataFrames that callers can query. Order is explicit everywhere:
story, paragraph, item. What is read more than once (parsed packages, resolved
paragraphs, converted vectors, rendered blocks) is written to the shared folder, so that a lost
executor costs no second parse; ``session.drop_scratch`` removes it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import __version__
from ..functions import equations as eq
from ..functions import latex
from ..functions import text as X
from ..operators import anchors as anchor_ops
from ..operators import assets, chunks, order, render, sequence, styles, tables, toc
from ..session import written
from ..sources import package
from ..sources.files import write_files
from ..sources.rules import rules as load_rules

INLINES = f"array<{render.INLINE}>"
DISPLAY = "array<struct<kind:string,src:string,alt:string,latex:string,table_no:int>>"
KNOWN = "map<string,struct<status:string,latex:string>>"
PARA = ["book_id", "story_ord", "para_ord"]
PLACE = ["story_ord", "para_ord", "sub_ord"]
#: What an EPS file is that holds no equation: an image.
NO_EQUATION = ("no_marker", "mtef_only", "no_block", "no_math")
#: Kinds of blocks; any other kind is a paragraph.
KINDS = ("heading", "list", "admonition", "admonition_title", "blockquote", "code_block", "caption", "front_matter", "reference_entry")

Converter = Callable[[str, bytes], tuple[str, bytes] | None]


class PackageError(ValueError):
    """An archive that cannot be read."""


@dataclass(frozen=True)
class Options:
    """``keep_all_sublists`` keeps every run of attached items, not an item's last alone; the others are named by what they change."""

    overlay: Any = None
    follow_links: bool = False
    cell_name_order: str = "row:col"
    snap_to_line: bool = False
    include_masters: bool = False
    keep_all_sublists: bool = False
    units: int = 4
    per_unit: int = 4


@dataclass
class Book:
    """The tables of a conversion, each keyed by book_id; ``problems`` names the books that failed, and why."""

    paragraphs: DataFrame
    blocks: DataFrame
    markdown: DataFrame
    manifest: DataFrame | None = None
    anchors: DataFrame | None = None
    chapters: DataFrame | None = None
    equations: DataFrame | None = None
    requests: DataFrame | None = None
    assets: DataFrame | None = None
    outputs: DataFrame | None = None
    problems: DataFrame | None = None
    options: Options = Options()


def inlines_of(runs: Column) -> Column:
    """Runs as inlines: text cleaned and classified, empty runs gone, trailing breaks cut."""

    def inline(r: Column) -> Column:
        kind = F.when(r["kind"] == "line_break", "line_break").otherwise(X.inline_kind(r["font"], r["position"]))
        return F.struct(kind.alias("kind"), F.when(r["kind"] == "text", X.clean_content(r["text"])).alias("text"))

    made = F.transform(runs, inline)
    return render.without_trailing_breaks(F.filter(made, lambda i: (i["kind"] == "line_break") | (i["text"] != "")))


def anchored(links: Column) -> Column:
    """First usable link of every anchored object: (kind, basename); objects without one go."""

    def first(uris: Column) -> Column:
        named = F.transform(F.transform(uris, X.uri_basename), lambda n: F.struct(X.link_kind(n).alias("kind"), n.alias("basename")))
        return F.get(F.filter(named, lambda a: (a["kind"] != "other") & (a["basename"] != "")), F.lit(0))

    return F.filter(F.transform(links, first), lambda a: a.isNotNull())


def outcome(found: Column, known: Column) -> Column:
    """What an anchored object becomes: an image, an equation with LaTeX, or nothing; ``known`` maps basenames to (status, latex)."""

    def one(a: Column) -> Column:
        e = F.try_element_at(known, a["basename"])
        image = (a["kind"] != "equation_eps") | e["status"].isin(*NO_EQUATION)
        kind = F.when(image, "image").when(e["latex"].isNotNull(), "equation")
        return F.struct(kind.alias("kind"), a["basename"].alias("basename"), e["latex"].alias("latex"))

    return F.filter(F.transform(found, one), lambda a: a["kind"].isNotNull())


def has_text(inlines: Column) -> Column:
    return F.exists(inlines, lambda i: (i["kind"] != "line_break") & (X.strip(F.coalesce(i["text"], F.lit(""))) != ""))


def with_equations(inlines: Column, anchors: Column) -> Column:
    """Equations join a paragraph that has text, at its end."""
    inline = lambda a: F.struct(F.lit("equation_inline").alias("kind"), a["latex"].alias("text"))
    own = F.transform(F.filter(anchors, lambda a: a["kind"] == "equation"), inline)
    return F.when(has_text(inlines), F.concat(inlines, own)).otherwise(inlines)


def display_of(inlines: Column, anchors: Column, n_tables: Column) -> Column:
    """Blocks behind a paragraph: images, equations where there is no text, tables."""
    texted, none = has_text(inlines), F.lit(None).cast("string")
    shown = F.filter(anchors, lambda a: (a["kind"] == "image") | ~texted)

    def block(a: Column) -> Column:
        kind = F.when(a["kind"] == "image", "image").otherwise("equation_display")
        stem = F.regexp_replace(a["basename"], r"(?<=[^.])\.[^.]*$", "")
        number = F.lit(None).cast("int").alias("table_no")
        return F.struct(kind.alias("kind"), a["basename"].alias("src"), stem.alias("alt"), a["latex"].alias("latex"), number)

    def table(k: Column) -> Column:
        blank = [none.alias(c) for c in ("src", "alt", "latex")]
        return F.struct(F.lit("table").alias("kind"), *blank, k.cast("int").alias("table_no"))

    of_tables = F.when(n_tables > 0, F.transform(F.sequence(F.lit(0), n_tables - 1), table)).otherwise(F.array().cast(DISPLAY))
    return F.concat(F.transform(shown, block), of_tables)


def read_equations(files: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """(book_id, basename, status, mathml, sha1, latex, latex_error) of EPS files (book_id, basename, content), one row a name."""
    eps = files.filter(X.extension(F.col("basename")) == ".eps")
    eps = eps.select("book_id", "basename", eq.eps_text(F.col("content")).alias("text")).dropDuplicates(["book_id", "basename"])
    return latex.converted(written(eq.extract(eps).drop("text"), "extracted"), cache)


def cell_links(found_in: Column) -> Column:
    """Links of all paragraphs in all cells of a paragraph's tables."""
    of_cell = lambda c: F.flatten(F.transform(c["paras"], lambda p: p["links"]))
    return F.flatten(F.transform(found_in, lambda t: F.flatten(F.transform(t["cells"], of_cell))))


def resolved_paragraphs(parts: DataFrame, placed: DataFrame, rules: dict[str, Any], equations: DataFrame | None, o: Options) -> DataFrame:
    """Paragraphs in reading order with their rule, inlines and display blocks.

    ``known`` holds a paragraph's own equations alone: references are exploded,
    joined by book and name, and gathered again.
    """
    spark = parts.sparkSession
    at = placed.select("book_id", "story_id", "story_ord")
    rows = package.paragraphs(parts, o.follow_links).join(at, ["book_id", "story_id"]).withColumn("style", X.style_name(F.col("style")))
    rows = styles.apply_rules(rows, styles.rules_table(spark, rules["paragraph_styles"]))
    if rules.get("defaults", {}).get("unknown_paragraph_style") == "drop":  # dropped after the audit has counted it
        rows = rows.withColumn("kind", F.when(F.col("mapped"), F.col("kind")).otherwise("drop"))
    rows = rows.withColumn("base", inlines_of(F.col("runs"))).withColumn("found", anchored(F.col("links")))
    rows = rows.withColumn("cell_found", anchored(cell_links(F.col("tables"))))
    if equations is not None:  # read twice below: the stories are parsed once
        rows = written(rows, "parsed")
    none = F.create_map().cast(KNOWN)
    if equations is None:
        rows = rows.withColumn("known", none)
    else:
        eps = F.filter(F.concat("found", "cell_found"), lambda a: a["kind"] == "equation_eps")
        names = rows.select(*PARA, F.explode(F.array_distinct(F.transform(eps, lambda a: a["basename"]))).alias("basename"))
        named = names.join(equations.select("book_id", "basename", "status", "latex"), ["book_id", "basename"])
        entry = F.struct("basename", F.struct("status", "latex"))
        own = named.groupBy(*PARA).agg(F.map_from_entries(F.collect_list(entry)).alias("known"))
        rows = rows.join(own, PARA, "left").withColumn("known", F.coalesce("known", none))
    rows = rows.withColumn("anchors", outcome(F.col("found"), F.col("known")))
    rows = rows.withColumn("inlines", with_equations(F.col("base"), F.col("anchors")))
    rows = rows.withColumn("display", display_of(F.col("base"), F.col("anchors"), F.size("tables")))
    return rows.withColumn("plain", X.strip(render.flat_text(F.col("inlines")))).drop("runs", "links", "base")


def table_blocks(paragraphs: DataFrame, o: Options) -> DataFrame:
    """(book_id, story_ord, para_ord, table_no, md) of every table."""
    keys = [*PARA, "table_no"]
    rows = paragraphs.select(*PARA, "known", F.posexplode("tables").alias("table_no", "t"))
    size = [F.col(f"t.{c}").alias(c) for c in ("header_rows", "body_rows", "columns")]
    cells = rows.select(*keys, "known", *size, F.explode("t.cells").alias("c"))
    none = F.lit(None).cast("string")

    def blocks(para: Column) -> Column:
        base, found = inlines_of(para["runs"]), outcome(anchored(para["links"]), F.col("known"))
        text = with_equations(base, found)
        blank = [none.alias(c) for c in ("src", "alt", "latex")]
        written_out = F.array(F.struct(F.lit("paragraph").alias("kind"), text.alias("inlines"), *blank))
        own = F.when(F.size(text) > 0, written_out).otherwise(F.array().cast(f"array<{tables.BLOCK}>"))
        bare = F.array().cast(INLINES).alias("inlines")
        shown = lambda d: F.struct(d["kind"].alias("kind"), bare, *[d[c].alias(c) for c in ("src", "alt", "latex")])
        return F.concat(own, F.transform(display_of(base, found, F.lit(0)), shown))

    spans = [F.col(f"c.{c}").alias(c) for c in ("name", "row_span", "col_span")]
    named = cells.select(*keys, "header_rows", "body_rows", "columns", *spans, F.flatten(F.transform("c.paras", blocks)).alias("blocks"))
    made = tables.grid(named, keys, o.cell_name_order)
    return made.select(*keys, tables.render_table(F.col("rows"), F.col("header_rows")).alias("md"))


def typed_items(paragraphs: DataFrame) -> DataFrame:
    """One row an item, by what it is to the runs of lists and callouts: blank and dropped paragraphs are gone."""
    shown = paragraphs.filter(((F.col("plain") != "") | (F.size("display") > 0)) & (F.col("kind") != "drop"))
    shown = shown.withColumn("kind", F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise("paragraph"))
    kind = F.col("kind")
    items = F.when(kind == "list", sequence.split_by_break(F.col("inlines"))).otherwise(F.array("inlines"))
    rows = shown.withColumn("n_items", F.size(items)).select("*", F.posexplode(items).alias("item_ord", "item"))
    short = {"list": "list", "admonition": "adm", "admonition_title": "title"}
    rows = rows.withColumn("type", functools.reduce(lambda c, kv: c.when(kind == kv[0], kv[1]), short.items(), F.when(F.lit(False),
        "")).otherwise("other"))
    marker = F.concat_ws("|", F.col("ordered").cast("string"), "marker")
    rows = rows.withColumn("run_key", F.when(F.col("type") == "list", marker).when(F.col("type") == "adm", F.col("variant")))
    last = F.col("item_ord") == F.col("n_items") - 1
    return rows.withColumn("closes", (F.size("display") > 0) & last).withColumn("text", F.col("plain")).withColumn("rule_title", F.col("title"))


def numbered_items(runs: DataFrame, keys: list[str], ordering: list[str], keep_all: bool = False) -> DataFrame:
    """List items with ``n``, their number in their list, and ``line``.

    Items that are not attached count on in their block; attached ones belong to
    the item before, and count in runs of one marker, of which an item keeps its
    last, or all under ``keep_all``.
    """
    block = [*keys, "block_no"]
    within = lambda *more: Window.partitionBy(*block, *more).orderBy(*ordering)
    attached = F.col("attached")
    rows = runs.filter("type = 'list'").withColumn("parent", F.count_if(~attached).over(within()))
    marker = F.when(attached, F.col("run_key"))
    rows = rows.withColumn("_new", attached & ~F.col("run_key").eqNullSafe(F.lag(marker).over(within("parent"))))
    rows = rows.withColumn("sub_run", F.when(attached, F.count_if("_new").over(within("parent"))))
    family = Window.partitionBy(*block, "parent")
    rows = rows.withColumn("_last", F.max("sub_run").over(family)).withColumn("parent_level", F.max(F.when(~attached, F.col("level"))).over(family))
    if not keep_all:
        rows = rows.filter(~attached | (F.col("sub_run") == F.col("_last")))
    rows = rows.withColumn("n", F.when(attached, F.count_if(attached).over(within("parent", "sub_run"))).otherwise(F.col("parent")))
    base = F.when(attached, F.greatest(F.col("parent_level"), F.lit(1))).otherwise(0)
    line = render.render_item(F.col("level"), base, F.col("ordered"), F.col("marker"), F.col("n"), F.col("rendered"))
    return rows.withColumn("line", line).drop("_new", "_last")


BLOCKS = ["book_id", "section", *PLACE, "kind", "md", "src", "alt", "level", "plain"]


def to_blocks(paragraphs: DataFrame, o: Options) -> DataFrame:
    """(book_id, section, place, kind, md, src, …): all blocks, rendered, in order; images keep their source for the path join."""
    keys, ordering = ["book_id", "story_ord"], ["para_ord", "item_ord"]
    runs = sequence.block_runs(typed_items(paragraphs), keys, ordering).withColumn("rendered", render.render_inlines(F.col("item")))
    none, no_int = F.lit(None).cast("string"), F.lit(None).cast("int")

    def gathered(rows: DataFrame, kind: str, md: Column, *more: Column) -> DataFrame:
        """A block a run, where the run's first item stands."""
        lines = F.transform(F.array_sort(F.collect_list(F.struct(*ordering, "line"))), lambda x: x["line"]).alias("lines")
        made = rows.groupBy(*keys, "block_no").agg(F.min("para_ord").alias("para_ord"), lines, *more)
        fixed = {"section": F.lit("body"), "sub_ord": F.lit(0), "kind": F.lit(kind), "md": md, "src": none, "alt": none, "level": no_int,
            "plain": none}
        return made.withColumns(fixed).select(*BLOCKS)

    items = numbered_items(runs, keys, ordering, o.keep_all_sublists)
    blocks = gathered(items, "list", F.array_join("lines", "\n"))
    called = runs.filter("type = 'adm'").withColumn("line", X.rstrip(F.col("rendered")))
    callout = render.render_callout(F.col("variant"), F.col("title"), F.col("lines"))
    blocks = blocks.unionByName(gathered(called, "admonition", callout, F.first("variant").alias("variant"), F.first("adm_title").alias("title")))

    text = F.when(F.col("kind") == "code_block", F.col("plain")).otherwise(F.col("rendered"))
    parts = {"level": F.coalesce("level", F.lit(1)), "language": F.coalesce("language", F.lit("")), "role": F.coalesce("role", F.lit("info"))}
    md = render.render_block(F.col("kind"), text, src=none, alt=none, **parts)
    section = F.when(F.col("kind") == "front_matter", "front_matter").when(F.col("kind") == "reference_entry", "reference").otherwise("body")
    others = runs.filter("type = 'other'").filter((F.col("kind") != "paragraph") | (F.col("plain") != ""))
    others = others.withColumns({"section": section, "md": md, "sub_ord": F.lit(0), "src": none, "alt": none})
    blocks = blocks.unionByName(others.select(*BLOCKS))

    shown = paragraphs.filter("kind <> 'drop'").select(*PARA, F.posexplode("display").alias("k", "d")).select("*", "d.*")
    drawn = table_blocks(paragraphs.filter("kind <> 'drop'"), o).withColumnRenamed("md", "table_md")
    shown = shown.join(drawn, [*PARA, "table_no"], "left")
    shown_md = render.render_block(
        F.col("kind"), F.coalesce("latex", F.lit("")), level=F.lit(1), language=F.lit(""), src=F.col("src"), alt=F.col("alt"), role=F.lit("")
    )
    shown = shown.withColumn("md", F.when(F.col("kind") == "table", F.col("table_md")).otherwise(shown_md))
    extra = {"section": F.lit("body"), "sub_ord": F.col("k") + 1, "level": no_int, "plain": none}
    return blocks.unionByName(shown.withColumns(extra).select(*BLOCKS))


def references(paragraphs: DataFrame) -> DataFrame:
    """(book_id, place, basename, kind, status): every anchored object of every paragraph and cell, dropped paragraphs' too."""
    rows = paragraphs.select(*PARA, "known", F.posexplode(F.concat("found", "cell_found")).alias("k", "a"))
    status = F.try_element_at(F.col("known"), F.col("a.basename"))["status"]
    return rows.select(*PARA, "k", F.col("a.basename").alias("basename"), F.col("a.kind").alias("kind"), status.alias("status"))


def asset_requests(paragraphs: DataFrame) -> DataFrame:
    """(book_id, basename, class, ord): images asked for, raster or vector, by where they are asked for first."""
    rows = references(paragraphs)
    vector = (F.col("kind") == "image_vector") | F.col("status").isin(*NO_EQUATION)
    rows = rows.withColumn("class", F.when(F.col("kind") == "image_raster", "raster").when(vector, "vector")).filter("class is not null")
    return rows.groupBy("book_id", "basename", "class").agg(F.min(F.struct("story_ord", "para_ord", "k")).alias("ord"))


def toc_entries(parts: DataFrame, placed: DataFrame) -> DataFrame:
    """(book_id, ord, is_unit, text): paragraphs of the contents' styles, anywhere in a story, in reading order."""
    rows = package.all_paragraphs(parts).withColumn("style", X.style_name(F.col("style")))
    rows = rows.filter(F.col("style").isin(toc.UNIT_STYLE, *toc.ENTRY_STYLES)).join(placed.select("book_id", "story_id", "story_ord"),
        ["book_id", "story_id"])
    text = X.strip(F.regexp_replace("text", "[  ]+", " "))
    rows = rows.withColumn("text", text).filter("text <> ''")
    ordinal = F.col("story_ord").cast("long") * 1_000_000 + F.col("ord")
    return rows.select("book_id", ordinal.alias("ord"), (F.col("style") == toc.UNIT_STYLE).alias("is_unit"), "text")


def plan_assets(requests: DataFrame, files: DataFrame, vector_converter: Converter | None = None) -> tuple[DataFrame, DataFrame]:
    """(book_id, basename, class, status, rel_path, ord) of every request, and (book_id, rel_path, content) of what is to be written.

    Rasters are copied, or alias the first file with the same content; vectors
    go through the converter, which by default is unavailable. Contents of
    rasters are read again where they are written, not kept in between.
    """
    names = ["book_id", "basename"]
    rasters = written(assets.plan_rasters(requests.filter("class = 'raster'"), files).withColumn("class", F.lit("raster")), "rasters")
    wanted = requests.filter("class = 'vector'").select(*names, "ord")
    made = assets.convert_vectors(files.join(wanted, names, "left_semi"), vector_converter or (lambda name, data: None))
    made = written(made.withColumnRenamed("status", "made"), "vectors")
    path = F.when(F.col("made") == "converted", F.concat(F.lit("assets/vector/"), "out_name"))
    status = F.coalesce("made", F.lit("missing"))
    vectors = wanted.join(made, names, "left").withColumns({"status": status, "rel_path": path, "class": F.lit("vector")})
    columns = [*names, "class", "status", "rel_path", "ord"]
    copied = files.join(rasters.filter("status = 'copied'").select(*names, "rel_path"), names).select("book_id", "rel_path", "content")
    drawn = made.filter("made = 'converted'").select("book_id", F.concat(F.lit("assets/vector/"), "out_name").alias("rel_path"),
        F.col("out").alias("content"))
    return rasters.select(*columns).unionByName(vectors.select(*columns)), copied.unionByName(drawn.dropDuplicates(["book_id", "rel_path"]))


def with_paths(blocks: DataFrame, found: DataFrame | None) -> DataFrame:
    """Image blocks with the paths their files have in the output, seen from a chapter's folder; vectors win over rasters of one name."""
    images = blocks.filter("kind = 'image'")
    if found is None:
        paths = images.select("book_id", "src", F.lit(None).cast("string").alias("rel_path")).limit(0)
    else:
        by_class = [found.filter(F.col("class") == c).select("book_id", F.col("basename").alias("src"), "rel_path") for c in ("raster", "vector")]
        paths = assets.merged_paths(*by_class, ["book_id", "src"])
    images = assets.rewritten(images, paths, ["book_id", "src"])
    images = images.withColumn("md", F.concat(F.lit("!["), "alt", F.lit("]("), "src", F.lit(")")))
    return blocks.filter("kind <> 'image'").unionByName(images.select(*blocks.columns))


def plan(
    spark: SparkSession, pkgs: DataFrame, pages: DataFrame | None = None, files: DataFrame | None = None, o: Options = Options(),
    cache: DataFrame | None = None, vector_converter: Converter | None = None, strict: bool = True,
) -> Book:
    """All tables of a conversion.

    ``pages`` (book_id, page_idx, text) is the page text, ``files`` (book_id,
    basename, content) what links point at. Under ``strict`` the first bad book
    is an error; otherwise bad books are rows of ``problems``, with the stage
    that stopped them, and the others go on.
    """
    rules = load_rules(o.overlay)
    parts = written(package.members(pkgs), "members")
    bad = [_problem(package.broken(parts), 0)]
    if strict and (first := package.broken(parts).first()):
        raise PackageError(f"{first['book_id']}: {first['problem']}")
    parts = parts.filter("error is null")
    placed = written(order.reading_order(package.frames(parts), o.include_masters), "order")
    equations = written(read_equations(files, cache), "equations") if files is not None else None
    paragraphs = written(resolved_paragraphs(parts, placed, rules, equations, o), "paragraphs")
    requests = written(asset_requests(paragraphs), "requests")
    found, outputs = plan_assets(requests, files, vector_converter) if files is not None else (None, None)
    found = written(found, "assets") if found is not None else None
    blocks = written(with_paths(to_blocks(paragraphs, o), found), "blocks")
    markdown = render.document(blocks, ["book_id"], PLACE)
    book = Book(paragraphs, blocks, markdown, equations=equations, requests=requests, assets=found, outputs=outputs, options=o)
    if pages is not None:
        bad += _add_chapters(book, parts, placed, pages, o, strict)
    least = functools.reduce(DataFrame.unionByName, bad).groupBy("book_id").agg(F.min(F.struct("stage", "problem")).alias("p"))
    book.problems = least.select("book_id", "p.problem") if strict else written(least.select("book_id", "p.problem"), "problems")
    return book


def _problem(rows: DataFrame, stage: int) -> DataFrame:
    return rows.select("book_id", F.lit(stage).alias("stage"), "problem")


def _add_chapters(book: Book, parts: DataFrame, placed: DataFrame, pages: DataFrame, o: Options, strict: bool) -> list[DataFrame]:
    """Contents, anchors and chapters of a book's tables; what stopped books is returned by stage."""
    entries = written(toc_entries(parts, placed), "contents")
    listed = toc.chapters(toc.unit_groups(entries))
    book.manifest = written(toc.manifest(entries, o.units, o.per_unit, strict), "manifest")
    if strict:
        book.anchors = anchor_ops.anchors(pages, book.manifest).drop("problem")
        ends = anchor_ops.sentinels(pages, book.manifest, book.anchors)
        book.chapters = chunks.split(book.markdown, book.anchors, ends, snap_to_line=o.snap_to_line)
        return []
    every = parts.select("book_id").distinct()
    bad = [_problem(toc.violations(listed, o.units, o.per_unit), 1)]
    without = every.join(listed.select("book_id").distinct(), "book_id", "left_anti").withColumn("problem", F.lit("no table of contents"))
    anchors = written(anchor_ops.anchors(pages, book.manifest, strict=False), "anchors")
    where = F.format_string("chapter %d.%d: %s", "unit_index", "chap_index", "problem")
    bad += [_problem(without, 1), _problem(anchors.filter("problem is not null").withColumn("problem", where), 2)]
    book.anchors = anchors.join(anchors.filter("problem is not null").select("book_id").distinct(), "book_id", "left_anti").drop("problem")
    ends = written(anchor_ops.sentinels(pages, book.manifest, book.anchors), "ends")
    book.chapters = written(chunks.split(book.markdown, book.anchors, ends, strict=False, snap_to_line=o.snap_to_line), "chapters")
    lost = F.format_string("chapter %d.%d not found or empty", "unit_index", "chap_index")
    return [*bad, _problem(book.chapters.filter("text is null").withColumn("problem", lost), 3)]


def whole(rows: DataFrame, book: Book) -> DataFrame:
    """Rows of the books that have no problem."""
    return rows.join(book.problems.select("book_id"), "book_id", "left_anti") if book.problems is not None else rows


def documents(book: Book, titles: DataFrame) -> DataFrame:
    """(book_id, markdown): whole documents with title, front matter, contents, body and references; ``titles`` is (book_id, title)."""
    return render.document(book.blocks, ["book_id"], PLACE, titles)


def inspect_styles(pkgs: DataFrame, top: int = 0) -> DataFrame:
    """(style, n, first_pos): paragraph styles by use, in cells too."""
    parts = package.members(pkgs).filter("error is null")
    rows = package.all_paragraphs(parts).select(X.style_name(F.col("style")).alias("style"), F.struct("book_id", "pos", "ord").alias("ord"))
    return styles.most_used(rows, top)


def _counts(rows: DataFrame, name: str, key: str, n: str) -> DataFrame:
    """(book_id, name): a map from key to count, of counts that are not zero."""
    entries = F.array_sort(F.collect_list(F.struct(key, F.col(n).cast("long"))))
    return rows.filter(F.col(n) > 0).groupBy("book_id").agg(F.map_from_entries(entries).alias(name))


def _in_order(value: Column, *at: str) -> Column:
    """Values that are not null, as an array in order."""
    return F.transform(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*at, value.alias("v"))))), lambda x: x["v"])


def report_rows(book: Book, rules: dict[str, Any], titles: DataFrame | None = None) -> DataFrame:
    """One row a book with a column a field of its report; maps and lists are empty, numbers 0, where there is nothing."""
    spark = book.paragraphs.sparkSession
    seen = book.paragraphs.groupBy("book_id", "style").agg(F.count("*").alias("n"), F.count_if(~F.col("mapped")).alias("u"))
    chars = book.paragraphs.select("book_id", F.explode("char_styles").alias("style")).withColumn("style", X.style_name(F.col("style")))
    char_rules = styles.rules_table(spark, rules.get("character_styles", {}))
    chars = styles.seen_and_unmapped(chars, char_rules, silent_prefix="$ID/", by=("book_id",))
    kinds = book.blocks.groupBy("book_id", "section", "kind").count()
    sections = {"body_blocks": "body", "front_matter_blocks": "front_matter", "reference_entries": "reference"}
    by_section = [F.sum(F.when(F.col("section") == s, F.col("count")).otherwise(0)).alias(name) for name, s in sections.items()]
    tables_ = [
        _counts(seen, "seen_paragraph_styles", "style", "n"), _counts(seen, "unmapped_paragraph_styles", "style", "u"),
        _counts(chars, "seen_character_styles", "style", "seen"), _counts(chars, "unmapped_character_styles", "style", "unmapped"),
        _counts(kinds.filter("section = 'body'"), "block_counts", "kind", "count"), kinds.groupBy("book_id").agg(*by_section),
    ]
    if book.equations is not None:
        eps = references(book.paragraphs).filter("kind = 'equation_eps'")
        used = eps.join(book.equations.select("book_id", "basename", "sha1", "latex"), ["book_id", "basename"], "left")
        failed = (F.col("status").isNull() | (F.col("status") == "ok")) & F.col("latex").isNull()
        places = ("story_ord", "para_ord", "k")
        tables_.append(used.groupBy("book_id").agg(
            F.count("latex").alias("equations_total"), _in_order(F.when(failed, F.col("basename")), *places).alias("equations_failed"),
            (F.count("latex") - F.count_distinct(F.when(F.col("latex").isNotNull(), F.col("sha1")))).alias("equation_cache_hits"),
            F.count_distinct(F.when(F.col("latex").isNotNull(), F.col("sha1"))).alias("equation_cache_misses"),
        ))
    if book.assets is not None:
        status, vector, name = F.col("status"), F.col("class") == "vector", F.col("basename")
        tables_.append(book.assets.groupBy("book_id").agg(
            _in_order(F.when(status == "missing", name), "class", "ord").alias("missing_assets"), F.count("rel_path").alias("copied_assets"),
            _in_order(F.when(vector & (status == "converted"), name), "ord").alias("vector_converted"),
            _in_order(F.when(vector & (status == "failed"), name), "ord").alias("vector_failed"),
        ))
    if book.chapters is not None:
        o = book.options
        per_unit = [F.count_if(F.col("unit_index") == u) for u in range(1, o.units + 1)]
        tables_.append(book.chapters.groupBy("book_id").agg(
            F.count_distinct("unit_index").alias("units_emitted"), F.array(*per_unit).alias("chapters_emitted_per_unit"),
                F.count("*").alias("anchors_matched")
        ))
        tables_.append(book.anchors.groupBy("book_id").agg(F.min("off").alias("pdf_offset_detected")))
        tables_.append(book.manifest.groupBy("book_id").agg(_in_order(F.col("title"), "unit_index", "chap_index").alias("manifest_chapter_titles")))
    out = titles if titles is not None else book.paragraphs.select("book_id").distinct().withColumn("title", F.col("book_id"))
    out = out.select("book_id", F.col("title").alias("book_title"), F.col("book_id").alias("book_slug"), F.lit(__version__).alias("tool_version"))
    out = functools.reduce(lambda a, b: a.join(b, "book_id", "left"), tables_, out)
    none = {"map": "map()", "array": "array()", "bigint": "0L"}
    filled = []
    for f in out.schema.fields:
        kind = f.dataType.simpleString()
        empty = none.get(kind.split("<")[0])
        keep = empty is None or f.name == "pdf_offset_detected"
        filled.append(F.col(f.name) if keep else F.coalesce(f.name, F.expr(empty).cast(f.dataType)).alias(f.name))
    return out.select(*filled)


def reports(book: Book, rules: dict[str, Any], titles: DataFrame | None = None) -> DataFrame:
    """(book_id, report): the report of every book as JSON, keys in order, made where the rows are."""
    rows = report_rows(book, rules, titles)

    @F.udf("string", useArrow=True)
    def laid_out(compact):
        return report_json(json.loads(compact))

    fields = F.struct(*[F.col(c) for c in rows.columns if c != "book_id"])
    return rows.select("book_id", laid_out(F.to_json(fields, {"ignoreNullFields": "false"})).alias("report"))


def report_json(report: dict[str, Any]) -> str:
    return json.dumps(report, sort_keys=True, indent=2, ensure_ascii=False)


def write_assets(book: Book, root: str) -> None:
    """Copied and converted assets under ``root``/<book>, written where the rows are."""
    path = F.concat("book_id", F.lit("/"), "rel_path")
    write_files(whole(book.outputs, book).select(path.alias("path"), "content"), root)


def write_chapters(book: Book, root: str) -> None:
    """``<book>/unidade_<u>/capitulo_<c>.md`` under ``root``, written where the rows are."""
    unit, chapter = F.col("unit_index").cast("string"), F.col("chap_index").cast("string")
    path = F.concat("book_id", F.lit("/unidade_"), unit, F.lit("/capitulo_"), chapter, F.lit(".md"))
    write_files(whole(book.chapters, book).select(path.alias("path"), F.concat("text", F.lit("\n")).cast("binary").alias("content")), root)


def write_reports(book: Book, rules: dict[str, Any], root: str, titles: DataFrame | None = None) -> None:
    """``<book>/_report.json`` under ``root``, written where the rows are."""
    made = whole(reports(book, rules, titles), book)
    write_files(made.select(F.concat("book_id", F.lit("/_report.json")).alias("path"), F.col("report").cast("binary").alias("content")), root)
