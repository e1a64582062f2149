"""Packages: archives of XML to tables of members, frames, paragraphs and style names.

Archives arrive as ``binaryFile`` rows and are parsed where they are, one at a
time, and handed on in small pieces. XML is read by a Python worker because Spark's XML functions
group children by tag and so lose the order of text and breaks.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import style_name
from ..operators.styles import small
from ..session import made_rows, on_workers

RUN = "struct<kind:string,text:string,font:string,position:string>"
PARA = f"struct<runs:array<{RUN}>,links:array<array<string>>>"
TABLE = f"struct<header_rows:int,body_rows:int,columns:int,cells:array<struct<name:string,row_span:int,col_span:int,paras:array<{PARA}>>>>"
PARAGRAPHS = (
    f"book_id string, story_id string, para_ord int, style string, runs array<{RUN}>, links array<array<string>>, "
    f"char_styles array<string>, tables array<{TABLE}>"
)
FRAMES = "book_id string, self_id string, parent_story string, prev_id string, next_id string, spread_index int, order_in_spread int, is_master boolean"

MEMBERS = "book_id string, member string, pos int, xml string, error string"
#: Members that are parsed, by the start of their names.
PARSED = ("Spreads/", "MasterSpreads/", "Stories/")

SPREAD = re.compile(r'src="(Spreads/Spread_[^"]+\.xml)"')
MASTER = re.compile(r'src="(MasterSpreads/MasterSpread_[^"]+\.xml)"')


def packages(spark: SparkSession, path: str | list[str], pattern: str = "*.idml") -> DataFrame:
    """(book_id, path, content): book_id is the file's stem. Only package files are listed and read.

    Where several files have one stem, each of them gets a hash of its path
    behind it, so that book_id names one package. The stems are counted from the
    listing alone; contents are not read for it.
    """
    on_workers(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1)
    files = files.select(stem.alias("book_id"), "path", "content")
    repeated = files.groupBy("book_id").count().filter("count > 1").select(F.col("book_id").alias("repeated"))
    if repeated.isEmpty():
        return files
    own = F.concat_ws("-", "book_id", F.substring(F.sha1(F.col("path").cast("binary")), 1, 8))
    named = files.join(small(repeated), F.col("book_id") == F.col("repeated"), "left")
    return named.select(F.when(F.col("repeated").isNotNull(), own).otherwise(F.col("book_id")).alias("book_id"), "path", "content")


def members(pkgs: DataFrame) -> DataFrame:
    """(book_id, member, pos, xml, error): the XML members of each archive, in the archive's order.

    An archive that cannot be read, or a member that is no XML, makes one row of
    its book, with ``error`` and nothing else: what parses here parses later.
    """

    def contents(content: bytes) -> list[tuple[str, str]]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            found = [(n, z.read(n).decode("utf-8")) for n in z.namelist() if n.endswith(".xml")]
        for name, xml in found:
            if name.startswith(PARSED):
                try:
                    ET.fromstring(xml)
                except ET.ParseError as e:
                    raise ValueError(f"{name}: {e}") from e
        return found

    def unzip(book: str, content: bytes) -> list[tuple]:
        try:
            return [(book, name, i, xml, None) for i, (name, xml) in enumerate(contents(content))]
        except Exception as e:  # a broken archive is a row, not the job's end
            return [(book, None, None, None, f"{type(e).__name__}: {e}")]

    return made_rows(pkgs.select("book_id", "content"), unzip, MEMBERS)


def broken(parts: DataFrame) -> DataFrame:
    """(book_id, problem) of the archives that could not be read."""
    return parts.filter("error is not null").select("book_id", F.col("error").alias("problem"))


def spreads(parts: DataFrame) -> DataFrame:
    """(book_id, member, spread_index, is_master): order of the design map, masters numbered on after the spreads."""
    maps = parts.filter("member = 'designmap.xml'")
    pages = maps.select("book_id", F.posexplode(F.regexp_extract_all("xml", F.lit(SPREAD.pattern), F.lit(1))).alias("i", "member"),
        F.lit(False).alias("is_master"))
    count = F.size(F.regexp_extract_all("xml", F.lit(SPREAD.pattern), F.lit(1)))
    masters = maps.select("book_id", count.alias("n"), F.posexplode(F.regexp_extract_all("xml", F.lit(MASTER.pattern), F.lit(1))).alias("k",
        "member"))
    masters = masters.select("book_id", (F.col("n") + F.col("k")).alias("i"), "member", F.lit(True).alias("is_master"))
    return pages.unionByName(masters).withColumnRenamed("i", "spread_index")


def frames(parts: DataFrame) -> DataFrame:
    """All text frames of spreads and masters, ordered within their spread; missing pointers are ``n``."""
    rows = spreads(parts).join(parts.select("book_id", "member", "xml"), ["book_id", "member"])

    def parse(book: str, spread_index: int, is_master: bool, xml: str) -> Iterator[tuple]:
        for k, el in enumerate(ET.fromstring(xml).iter("TextFrame")):
            at = (el.get("PreviousTextFrame") or "n", el.get("NextTextFrame") or "n")
            yield book, el.get("Self") or "", el.get("ParentStory") or "", *at, spread_index, k, is_master

    return made_rows(rows.select("book_id", "spread_index", "is_master", "xml"), parse, FRAMES)


def style_names(parts: DataFrame, tag: str = "ParagraphStyle") -> DataFrame:
    """(book_id, name): names a package defines, prefix cut and decoded."""
    found = parts.filter("member = 'Resources/Styles.xml'").select("book_id", F.explode(F.expr(f"xpath(xml, '//{tag}/@Self')")).alias("raw"))
    return found.select("book_id", style_name(F.col("raw")).alias("name"))


def _units(psr: ET.Element, follow_links: bool) -> Iterator[ET.Element]:
    """Character ranges of a paragraph: direct ones, and under hyperlinks if they are followed."""
    for child in psr:
        if child.tag == "CharacterStyleRange":
            yield child
        elif follow_links and child.tag in ("HyperlinkTextSource", "HyperlinkTextDestination"):
            inner = [c for c in child if c.tag == "CharacterStyleRange"]
            yield from inner or [child]


def _nodes(csr: ET.Element, follow_links: bool) -> Iterator[ET.Element]:
    for child in csr:
        if follow_links and child.tag in ("HyperlinkTextSource", "HyperlinkTextDestination"):
            yield from child
        else:
            yield child


def _paragraph(psr: ET.Element, follow_links: bool) -> tuple[list, list, list, list]:
    runs, links, styles, tables = [], [], [], []
    for csr in _units(psr, follow_links):
        styles.append(csr.get("AppliedCharacterStyle") or "")
        font, position = csr.get("FontStyle"), csr.get("Position")
        for el in _nodes(csr, follow_links):
            if el.tag == "Content":
                runs.append({"kind": "text", "text": el.text or "", "font": font, "position": position})
            elif el.tag == "Br":
                runs.append({"kind": "line_break", "text": None, "font": None, "position": None})
            elif el.tag in ("Rectangle", "Group"):
                links.append([u for a in el.iter("Link") if (u := a.get("LinkResourceURI"))])
            elif el.tag == "Table":
                cells = []
                for c in el.findall("Cell"):
                    paras = []
                    for p in c.findall("ParagraphStyleRange"):
                        cell_runs, cell_links, cell_styles, _ = _paragraph(p, follow_links)
                        styles += cell_styles
                        paras.append({"runs": cell_runs, "links": cell_links})
                    cells.append({"name": c.get("Name") or "0:0", "row_span": int(c.get("RowSpan", "1")),
                        "col_span": int(c.get("ColumnSpan", "1")), "paras": paras})
                tables.append({"header_rows": int(el.get("HeaderRowCount", "0")), "body_rows": int(el.get("BodyRowCount", "0")),
                    "columns": int(el.get("ColumnCount", "0")), "cells": cells})
    return runs, links, styles, tables


def paragraphs(parts: DataFrame, follow_links: bool = False) -> DataFrame:
    """Top-level paragraphs of every story, with their runs, anchored links, character styles and tables."""
    stories = parts.filter(F.startswith("member", F.lit("Stories/Story_"))).select("book_id", F.regexp_extract("member",
        r"^Stories/Story_(.*)\.xml$", 1).alias("story_id"), "xml")

    def parse(book: str, story_id: str, xml: str) -> Iterator[tuple]:
        root = ET.fromstring(xml)
        story = root if root.tag == "Story" else root.find(".//Story")
        for k, psr in enumerate(story.findall("ParagraphStyleRange") if story is not None else []):
            runs, links, styles, tables = _paragraph(psr, follow_links)
            yield book, story_id, k, psr.get("AppliedParagraphStyle") or "", runs, links, styles, tables

    return made_rows(stories, parse, PARAGRAPHS)


def all_paragraphs(parts: DataFrame) -> DataFrame:
    """(book_id, story_id, pos, ord, style, text) of every paragraph anywhere, those in cells and hyperlinks too."""
    stories = parts.filter(F.startswith("member", F.lit("Stories/Story_"))).select("book_id", "pos", F.regexp_extract("member",
        r"^Stories/Story_(.*)\.xml$", 1).alias("story_id"), "xml")

    def parse(book: str, pos: int, story_id: str, xml: str) -> Iterator[tuple]:
        for k, psr in enumerate(ET.fromstring(xml).iter("ParagraphStyleRange")):
            yield book, story_id, pos, k, psr.get("AppliedParagraphStyle") or "", "".join(c.text or "" for c in psr.iter("Content"))

    return made_rows(stories, parse, "book_id string, story_id string, pos int, ord int, style string, text string")


def links(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(dir, basename, length, content) of linked files; columns that a query does not need are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+/[^/]+$", 1).alias("dir"), F.element_at(F.split("path", "/"),
        -1).alias("basename"), "length", "content")
