"""Queries that begin with archives: packages made of conversations, parsed, converted and written, against SQL on the conversations."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import order
from ..session import scratch_path, written
from ..sources import package, pdf
from ..sources.files import write_files
from ..sources.rules import rules
from . import convert, samples
from .registry import query, t

OVERLAY = {"paragraph_styles": samples.RULES, "character_styles": {"Bold": {}, "Regular": {}}}
OPTIONS = convert.Options(overlay=OVERLAY, units=1, per_unit=2)


@functools.cache
def _packages(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(samples.packages(spark, sf_dir), "packages")


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All packages, made once a session."""
    return _packages(spark.sparkContext.applicationId, spark, sf_dir)


@functools.cache
def _parts(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(package.members(packages(spark, sf_dir)), "parts")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of all packages, parsed once a session."""
    return _parts(spark.sparkContext.applicationId, spark, sf_dir)


@functools.cache
def _book(app: str, spark: SparkSession, sf_dir: str) -> convert.Book:
    pkgs = packages(spark, sf_dir)
    books = pkgs.select("book_id")
    return convert.plan(spark, pkgs, samples.page_text(books), samples.files(spark, books), OPTIONS, vector_converter=samples.drawn, strict=False)


def book(spark: SparkSession, sf_dir: str) -> convert.Book:
    """All books converted by one plan, once a session."""
    return _book(spark.sparkContext.applicationId, spark, sf_dir)


# --- what the packages hold, in SQL

_CONVS = """v AS (SELECT DISTINCT conv_id, conv_id // 10 AS book FROM conversations),
k AS (SELECT *, (row_number() OVER (PARTITION BY book ORDER BY conv_id) - 1) % 3 AS s FROM v)"""
_FRAMES = f"""{_CONVS},
x AS (SELECT book, 'fi' AS self_id, 'intro' AS parent_story, 'n' AS prev_id, 0 AS s, 0 AS g, 0 AS c FROM (SELECT DISTINCT book FROM k)
  UNION ALL SELECT book, 'ft', 'toc', 'n', 0, 1, 0 FROM (SELECT DISTINCT book FROM k) UNION ALL SELECT book, 'ff', 'fim', 'n', 2, 4, 0
  FROM (SELECT DISTINCT book FROM k)
  UNION ALL SELECT book, 'f' || conv_id || 'b', 's' || conv_id, 'f' || conv_id || 'a', (s + 1) % 3, 2, conv_id FROM k
  UNION ALL SELECT book, 'f' || conv_id || 'a', 's' || conv_id, 'n', s, 3, conv_id FROM k),
f AS (SELECT CAST(book AS VARCHAR) AS book_id, self_id, parent_story, prev_id, CAST(s AS INT) AS spread_index,
  CAST(row_number() OVER (PARTITION BY book, s ORDER BY g, c) - 1 AS INT) AS order_in_spread, false AS is_master FROM x)"""
_ORDER = f"""{_FRAMES}, o AS (SELECT book_id, parent_story AS story_id, self_id AS first_frame_id,
  row_number() OVER (PARTITION BY book_id ORDER BY spread_index, order_in_spread) - 1 AS story_ord FROM f WHERE prev_id = 'n')"""
_ESCAPED = "replace(replace(replace(text, '\\', '\\\\'), '<', '&lt;'), '>', '&gt;')"
#: Every paragraph of every story with its kind, plain text and rendered inlines.
_PARAS = f"""{_ORDER},
q AS (SELECT CAST(conv_id // 10 AS VARCHAR) AS book_id, 's' || conv_id AS story_id, turn, role, text, conv_id,
  ['H', 'P', 'Q', 'C', 'X', 'Code', 'F', 'R', 'Odd'][CAST((conv_id + turn * 3 + length(text)) % 9 AS INT) + 1] AS style FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY story_id ORDER BY turn) - 1 AS para_ord, text || CASE WHEN turn % 2 = 1 THEN '2' ELSE '' END AS flat,
  CASE WHEN style = 'P' AND role = 'user' THEN 'img' || (conv_id % 5) || '.jpg' WHEN style = 'P' THEN 'eq' || (length(text) % 12)
  || '.eps' END AS link,
  CASE role WHEN 'assistant' THEN '**' || {_ESCAPED} || '**' WHEN 'system' THEN '*' || {_ESCAPED} || '*' ELSE {_ESCAPED} END
    || CASE WHEN turn % 2 = 1 THEN '<sup>2</sup>' ELSE '' END AS own FROM q
  UNION ALL SELECT book_id, 'intro', 0, '', 'Capitulo primeiro do livro ' || book_id, NULL, 'Title', 0, 'Capitulo primeiro do livro '
  || book_id, NULL, 'Capitulo primeiro do livro ' || book_id FROM f WHERE self_id = 'fi'
  UNION ALL SELECT book_id, 'fim', 0, '', 'Capitulo segundo do livro ' || book_id, NULL, 'Title', 0, 'Capitulo segundo do livro '
  || book_id, NULL, 'Capitulo segundo do livro ' || book_id FROM f WHERE self_id = 'fi'
  UNION ALL SELECT book_id, 'fim', 1, '', 'fim', NULL, 'P2', 1, 'fim', NULL, 'fim' FROM f WHERE self_id = 'fi'),
p AS (SELECT r.*, o.story_ord, trim(flat, {{blanks}}) AS plain,
  own || CASE WHEN link LIKE 'eq%' AND (length(text) % 12) IN (2, 3, 6, 7, 10)
  THEN ' $\\frac{{{{a}}}}{{{{' || (length(text) % 12) || '}}}}$' ELSE '' END AS md FROM r JOIN o USING (book_id, story_id))""".format(
    blanks="chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
).replace("{{", "{").replace("}}", "}")
_RSTRIP = "rtrim({}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')"
#: Images asked for, by book, and where they end up.
_ASSETS = f"""{_PARAS},
a AS (SELECT book_id, link AS basename, min((story_ord, para_ord)) AS ord FROM p WHERE link LIKE 'img%' OR (link LIKE 'eq%'
  AND (length(text) % 12) % 4 = 0) GROUP BY ALL),
c AS (SELECT *, CASE WHEN basename LIKE 'eq%' THEN 'vector' ELSE 'raster' END AS class, CASE WHEN basename IN ('img2.jpg', 'img3.jpg')
  THEN 'img2.jpg' ELSE basename END AS content FROM a),
n AS (SELECT *, first_value(basename) OVER (PARTITION BY book_id, content ORDER BY ord) AS first_name FROM c),
s AS (SELECT book_id, basename, class, ord, CASE WHEN basename = 'img4.jpg' THEN 'missing' WHEN basename = 'eq8.eps' THEN 'failed'
  WHEN class = 'vector' THEN 'converted' WHEN first_name = basename THEN 'copied' ELSE 'alias' END AS status,
  CASE WHEN basename IN ('img4.jpg', 'eq8.eps') THEN NULL WHEN class = 'vector' THEN 'assets/vector/' || replace(basename, '.eps', '.svg')
  ELSE 'assets/img/' || first_name END AS rel_path FROM n)"""
#: All blocks, rendered, in order.
_BLOCKS = f"""{_ASSETS},
b AS (SELECT book_id, story_ord, para_ord, 0 AS sub_ord, CASE style WHEN 'F' THEN 'front_matter' WHEN 'R' THEN 'reference' ELSE 'body' END AS section,
  CASE style WHEN 'H' THEN 'heading' WHEN 'Title' THEN 'heading' WHEN 'Q' THEN 'blockquote' WHEN 'C' THEN 'caption' WHEN 'Code'
  THEN 'code_block' WHEN 'F' THEN 'front_matter' WHEN 'R' THEN 'reference_entry' ELSE 'paragraph' END AS kind,
  CASE style WHEN 'H' THEN {_RSTRIP.format("'## ' || md")} WHEN 'Title' THEN '# ' || md WHEN 'Q' THEN '> ' || replace(md, chr(10), chr(10)
  || '> ') WHEN 'C' THEN '*' || md || '*' WHEN 'F' THEN '*' || md || '*'
    WHEN 'Code' THEN '```text' || chr(10) || plain || chr(10) || '```' ELSE {_RSTRIP.format('md')} END AS md, plain,
  CASE style WHEN 'Title' THEN 1 WHEN 'H' THEN 2 END AS level FROM p WHERE style <> 'X' AND plain <> ''
  UNION ALL SELECT p.book_id, story_ord, para_ord, 1, 'body', 'image', '![' || replace(replace(link, '.jpg', ''), '.eps', '') || '](../../'
  || coalesce(rel_path, link) || ')', NULL, NULL FROM p JOIN s ON s.book_id = p.book_id AND s.basename = p.link)"""
_JOINED = "string_agg(md, chr(10) || chr(10) ORDER BY story_ord, para_ord, sub_ord)"
_COLLAPSED = "regexp_replace({}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
_BODY = f"{_BLOCKS}, d AS (SELECT book_id, {_COLLAPSED.format(_JOINED + ' || chr(10)')} AS markdown FROM b WHERE section = 'body' GROUP BY book_id)"


# --- sources

@query(f"""WITH {_CONVS} SELECT CAST(book AS VARCHAR) AS book_id, count(*) + 10 AS members, count(*) + 4 AS stories FROM k GROUP BY book""")
def package_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML members and stories of every archive."""
    stories = F.count_if(F.startswith("member", F.lit("Stories/Story_")))
    return parts(spark, sf_dir).groupBy("book_id").agg(F.count("*").alias("members"), stories.alias("stories"))


@query(f"WITH {_FRAMES} SELECT * FROM f UNION ALL SELECT book_id, 'fm', 'sm', 'n', 3, 0, true FROM f WHERE self_id = 'fi'")
def package_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return package.frames(parts(spark, sf_dir)).drop("next_id")


@query(f"""WITH {_ORDER} SELECT *, false AS is_master FROM o UNION ALL SELECT book_id, 'sm', 'fm', max(story_ord) + 1, true FROM o
  GROUP BY book_id""")
def package_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories by their threads' roots, masters behind the pages."""
    rows = order.reading_order(package.frames(parts(spark, sf_dir)), include_masters=True).drop("spread_index", "order_in_spread")
    return rows.withColumn("story_ord", F.col("story_ord").cast("long"))


@query(f"""WITH {_CONVS} SELECT CAST(book AS VARCHAR) AS book_id, x || ' ' || book AS name FROM (SELECT DISTINCT book FROM k),
  (SELECT unnest(['H', 'P', 'Q', 'C', 'X', 'Code', 'F', 'R', 'Odd']) AS x)""")
def package_style_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return package.style_names(parts(spark, sf_dir))


@query(f"""WITH {_PARAS} SELECT style, count(*) AS n FROM p WHERE story_id NOT IN ('fim', 'intro') GROUP BY style
UNION ALL SELECT 'Title', 2 * count(*) FROM f WHERE self_id = 'fi' UNION ALL SELECT 'P2', count(*) FROM f WHERE self_id = 'fi'
UNION ALL SELECT 'Sumario:SUMARIO UNIDADE', count(*) FROM f WHERE self_id = 'fi' UNION ALL SELECT 'Sumario:SUMARIO', count(*) FROM f
  WHERE self_id = 'fi'""")
def package_style_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph styles by use over all packages; the one paragraph of the master's story is left out."""
    pkgs = packages(spark, sf_dir)
    rows, books = convert.inspect_styles(pkgs).select("style", "n"), pkgs.count()
    return rows.withColumn("n", F.when(F.col("style") == "P", F.col("n") - books).otherwise(F.col("n"))).filter("n > 0")


@query("SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS page_idx, text FROM conversations")
def pdf_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of PDF pages, read back from files that hold a turn a page; a page's outer line breaks are not text."""
    read = pdf.pages(samples.pdfs(spark, sf_dir)).select(F.col("book_id").cast("long").alias("conv_id"), "page_idx", "text")
    return read


@query("""SELECT conv_id, turn, text || '.' AS followed, '.' AS direct, CAST(turn % 2 + 1 AS INT) AS runs FROM conversations""")
def hyperlink_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text under hyperlinks, in both shapes that links have: read if links are followed, passed over otherwise."""
    xml = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    around = lambda tag, x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))
    content, run = around("Content", xml), F.lit("<CharacterStyleRange><Content>.</Content></CharacterStyleRange>")
    outside = F.concat(around("HyperlinkTextSource", around("CharacterStyleRange", content)), run)
    inside = F.concat(F.lit("<CharacterStyleRange>"), around("HyperlinkTextDestination", content),
        F.lit("<Content>.</Content></CharacterStyleRange>"))
    body = F.when(F.col("turn") % 2 == 1, outside).otherwise(inside)
    ranges = F.transform(F.array_sort(F.collect_list(F.struct("turn", around("ParagraphStyleRange", body).alias("x")))), lambda x: x["x"])
    stories = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(around("Story", F.array_join(ranges, "")).alias("xml"))
    members = stories.select(F.col("conv_id").cast("string").alias("book_id"), F.lit("Stories/Story_s.xml").alias("member"),
        F.lit(0).alias("pos"), "xml")
    flat = lambda follow: package.paragraphs(members, follow).select("book_id", "para_ord",
        F.array_join(F.transform("runs", lambda r: r["text"]), "").alias("x"), "char_styles")
    both = flat(True).withColumnRenamed("x", "followed").join(flat(False).select("book_id", "para_ord", F.col("x").alias("direct")),
        ["book_id", "para_ord"])
    order_ = t(spark, sf_dir, "conversations").select("conv_id", "turn",
        (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).alias("n"))
    met = order_.join(both, (F.col("conv_id").cast("string") == F.col("book_id")) & (F.col("n") == F.col("para_ord")))
    return met.select("conv_id", "turn", "followed", "direct", F.size("char_styles").alias("runs"))


# --- paragraphs and blocks

@query(f"""WITH {_PARAS} SELECT book_id, story_ord, CAST(para_ord AS INT) AS para_ord, style, md5(plain) AS plain_md5, CASE
  WHEN link IS NULL THEN 0 ELSE 1 END AS links FROM p
UNION ALL SELECT o.book_id, o.story_ord, u.i, u.style, md5(u.x || CASE WHEN u.i = 1 THEN 'CAPÍTULO 1 – Capitulo primeiro do livro '
  || o.book_id || chr(9) || '5Capitulo segundo do livro ' || o.book_id || chr(9) || '.15' ELSE '' END), 0
FROM o, (VALUES (0, 'Sumario:SUMARIO UNIDADE', 'UNIDADE 1'), (1, 'Sumario:SUMARIO', '')) AS u(i, style, x) WHERE o.story_id = 'toc'""")
def package_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs in reading order with their flat text and anchored objects."""
    rows = book(spark, sf_dir).paragraphs
    bare = F.when(F.exists("inlines", lambda i: i["kind"] == "equation_inline"), F.regexp_replace("plain", r"\\frac\{a\}\{\d+\}$",
        "")).otherwise(F.col("plain"))
    return rows.select("book_id", F.col("story_ord").cast("long").alias("story_ord"), "para_ord", "style",
        F.md5(bare.cast("binary")).alias("plain_md5"), F.size("found").alias("links"))


@query(f"""WITH {_BLOCKS} SELECT book_id, section, kind, count(*) AS n, md5(string_agg(md, '|' ORDER BY story_ord, para_ord,
  sub_ord)) AS md_md5 FROM b GROUP BY ALL""")
def package_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered blocks by section and kind: dispatch, blank filter, equations, images and their paths."""
    texts = F.array_sort(F.collect_list(F.struct("story_ord", "para_ord", "sub_ord", "md")))
    joined = F.array_join(F.transform(texts, lambda x: x["md"]), "|")
    rows = book(spark, sf_dir).blocks.groupBy("book_id", "section", "kind")
    return rows.agg(F.count("*").alias("n"), F.md5(joined.cast("binary")).alias("md_md5"))


@query(f"WITH {_BODY} SELECT book_id, md5(markdown) AS markdown_md5, length(markdown) AS n FROM d")
def package_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book(spark, sf_dir).markdown
    return rows.select("book_id", F.md5(F.col("markdown").cast("binary")).alias("markdown_md5"), F.length("markdown").cast("long").alias("n"))


_ASCII = "regexp_replace(lower(strip_accents(title)), '[^\\x00-\\x7f]', '', 'g')"
_SLUG = f"regexp_replace(regexp_replace({_ASCII}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"""WITH {_BLOCKS},
h AS (SELECT book_id, level, replace(plain, chr(10), ' ') AS title, row_number() OVER (PARTITION BY book_id ORDER BY story_ord,
  para_ord) AS n FROM b WHERE kind = 'heading'),
g AS (SELECT *, {_SLUG} AS base FROM h), w AS (SELECT *, row_number() OVER (PARTITION BY book_id, base ORDER BY n) - 1 AS i FROM g),
e AS (SELECT book_id, string_agg(CASE level WHEN 2 THEN '  ' ELSE '' END || '- [' || title || '](#' || base || CASE WHEN i = 0 THEN ''
  ELSE '-' || i END || ')', chr(10) ORDER BY n) AS toc FROM w GROUP BY book_id),
j AS (SELECT book_id, section, {_JOINED} AS x FROM b GROUP BY ALL),
y AS (SELECT e.book_id, '# Livro ' || e.book_id || chr(10) || chr(10)
  || coalesce({_RSTRIP.format("(SELECT x FROM j WHERE j.book_id = e.book_id AND section = 'front_matter')")} || chr(10) || chr(10), '')
  || '## Sumário' || chr(10) || chr(10) || toc || chr(10) || chr(10) || (SELECT x FROM j WHERE j.book_id = e.book_id AND section = 'body')
  || coalesce(chr(10) || '## Referências' || chr(10) || chr(10) || (SELECT x FROM j WHERE j.book_id = e.book_id AND section = 'reference')
  || chr(10), '') || chr(10) AS m FROM e)
SELECT book_id, md5({_COLLAPSED.format('m')}) AS markdown_md5 FROM y""")
def package_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents: title, front matter, table of contents, body, references."""
    made = book(spark, sf_dir)
    titles = made.paragraphs.select("book_id").distinct().withColumn("title", F.concat(F.lit("Livro "), "book_id"))
    return convert.documents(made, titles).select("book_id", F.md5(F.col("markdown").cast("binary")).alias("markdown_md5"))


# --- equations and assets

@query(f"""WITH {_PARAS} SELECT book_id, link AS basename, count(*) AS uses, CASE (length(text) % 12) % 4 WHEN 0 THEN 'no_marker' WHEN 1
  THEN 'absent' ELSE 'ok' END AS status,
CASE WHEN (length(text) % 12) IN (2, 3, 6, 7, 10) THEN '\\frac{{a}}{{' || (length(text) % 12) || '}}' END AS latex FROM p
  WHERE link LIKE 'eq%' GROUP BY ALL""")
def package_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to EPS files by what the files turned out to be: bytes read, MathML extracted and converted."""
    made = book(spark, sf_dir)
    uses = convert.references(made.paragraphs).filter("kind = 'equation_eps'").groupBy("book_id", "basename").agg(F.count("*").alias("uses"))
    joined = uses.join(made.equations.select("book_id", "basename", "status", "latex"), ["book_id", "basename"], "left")
    return joined.withColumn("status", F.coalesce("status", F.lit("absent")))


@query(f"WITH {_ASSETS} SELECT book_id, basename, class, status, rel_path FROM s")
def package_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images asked for: copied, alias of equal content, missing, converted or failed, and where they go."""
    return book(spark, sf_dir).assets.select("book_id", "basename", "class", "status", "rel_path")


@query(f"""WITH {_ASSETS} SELECT DISTINCT book_id || '/' || rel_path AS path, CASE WHEN class = 'vector' THEN 6 ELSE 9 END AS size FROM s
  WHERE rel_path IS NOT NULL""")
def asset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets as they are in the output folder: written by the tasks, listed from the files."""
    root = scratch_path(spark, "assets")
    convert.write_assets(book(spark, sf_dir), root)
    return _listed(spark, root).select("path", F.col("length").cast("int").alias("size"))


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """(path below the root, length, content) of all files under a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.withColumn("path", F.substring_index("path", root.rpartition("/")[2] + "/", -1))


# --- contents, anchors, chapters, report

@query(f"""WITH {_FRAMES} SELECT book_id, 1 AS unit_index, CAST(i AS INT) AS chap_index, CASE i WHEN 1 THEN 'Capitulo primeiro do livro '
  ELSE 'Capitulo segundo do livro ' END || book_id AS title, CAST(i * 10 - 5 AS INT) AS start_page
FROM f, (SELECT unnest([1, 2]) AS i) WHERE self_id = 'fi'""")
def package_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters of the table of contents, from its paragraphs."""
    rows = book(spark, sf_dir).manifest
    return rows.select("book_id", F.col("unit_index").cast("int").alias("unit_index"), "chap_index", "title", "start_page")


@query(f"""WITH {_FRAMES} SELECT book_id, CAST(i AS INT) AS chap_index, -2 AS off, CAST(i * 10 - 7 AS INT) AS pdf_page_index,
'seite mit so vielen worten wie ein anker von acht oder zwolf' AS start_anchor FROM f, (SELECT unnest([1, 2]) AS i) WHERE self_id = 'fi'""")
def package_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page offset by vote, running header cut, first words of each chapter's page."""
    return book(spark, sf_dir).anchors.select("book_id", "chap_index", F.col("off").cast("int").alias("off"),
        F.col("pdf_page_index").cast("int").alias("pdf_page_index"), "start_anchor")


_CHAPTERS = f"""{_BODY}, z AS (SELECT book_id, markdown, strpos(markdown, 'Capitulo primeiro do livro') AS one, strpos(markdown,
  'Capitulo segundo do livro') AS two FROM d),
t AS (SELECT book_id, 1 AS chap_index, trim(substr(markdown, one, two - one), chr(10) || ' ') AS text FROM z UNION ALL SELECT book_id, 2,
  trim(substr(markdown, two), chr(10) || ' ') FROM z)"""


@query(f"WITH {_CHAPTERS} SELECT book_id, chap_index, md5(text) AS text_md5 FROM t")
def package_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut where their chapters begin."""
    return book(spark, sf_dir).chapters.select("book_id", "chap_index", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"WITH {_CHAPTERS} SELECT book_id || '/unidade_1/capitulo_' || chap_index || '.md' AS path, sha1(text || chr(10)) AS sha1 FROM t")
def chapter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters as they are in the output folder: written by the tasks, read back from the files."""
    root = scratch_path(spark, "chapters")
    convert.write_chapters(book(spark, sf_dir), root)
    return _listed(spark, root).select("path", F.sha1("content").alias("sha1"))


@query(f"""WITH {_BLOCKS}, i AS (SELECT book_id, count(*) FILTER (section = 'body') AS body_blocks,
  count(*) FILTER (section = 'front_matter') AS front_matter_blocks, count(*) FILTER (section = 'reference') AS reference_entries,
  count(*) FILTER (kind = 'code_block') AS code_blocks FROM b GROUP BY book_id),
u AS (SELECT book_id, count(*) FILTER (style = 'Odd') AS odd, count(*) FILTER (style = 'X') AS dropped, count(*) FILTER (link LIKE 'eq%'
  AND (length(text) % 12) IN (2, 3, 6, 7, 10)) AS equations_total,
  count(DISTINCT CASE WHEN (length(text) % 12) IN (2, 3, 6, 7, 10) THEN link END) FILTER (link LIKE 'eq%') AS misses,
  count(*) FILTER (link LIKE 'eq%' AND (length(text) % 12) IN (1, 5, 9, 11)) AS equations_failed,
  count(*) FILTER (role = 'system') AS oblique FROM p GROUP BY book_id),
m AS (SELECT book_id, count(*) FILTER (status = 'missing') AS missing_assets, count(rel_path) AS copied_assets,
  count(*) FILTER (status = 'converted') AS vector_converted, count(*) FILTER (status = 'failed') AS vector_failed FROM s GROUP BY book_id)
SELECT i.*, odd, dropped, equations_total, equations_total - misses AS equation_cache_hits, misses AS equation_cache_misses,
  equations_failed, oblique,
coalesce(missing_assets, 0) AS missing_assets, coalesce(copied_assets, 0) AS copied_assets, coalesce(vector_converted,
  0) AS vector_converted, coalesce(vector_failed, 0) AS vector_failed,
1 AS units_emitted, 2 AS anchors_matched, -2 AS pdf_offset_detected, 'Capitulo primeiro do livro ' || i.book_id AS first_title FROM i
  JOIN u USING (book_id) LEFT JOIN m USING (book_id)""")
def package_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of every book's report, read from its JSON."""
    counts = ("front_matter_blocks", "body_blocks", "reference_entries", "equations_total", "equation_cache_hits", "equation_cache_misses",
        "copied_assets", "units_emitted", "anchors_matched", "pdf_offset_detected")
    lists = ("equations_failed", "missing_assets", "vector_converted", "vector_failed", "manifest_chapter_titles")
    maps = ("seen_paragraph_styles", "unmapped_paragraph_styles", "unmapped_character_styles", "block_counts")
    schema = ", ".join([f"{c} bigint" for c in counts] + [f"{c} array<string>" for c in lists] + [f"{c} map<string,bigint>" for c in maps])
    made = convert.reports(book(spark, sf_dir), rules(OVERLAY)).select("book_id", F.from_json("report", schema).alias("r"))
    at = lambda c, key, name: F.coalesce(F.try_element_at(F.col(f"r.{c}"), F.lit(key)), F.lit(0)).alias(name)
    return made.select(
        "book_id", *[F.col(f"r.{c}").cast("int" if c in counts[-3:] else "long").alias(c) for c in counts],
            *[F.size(f"r.{c}").cast("long").alias(c) for c in lists[:-1]],
        at("block_counts", "code_block", "code_blocks"), at("unmapped_paragraph_styles", "Odd", "odd"), at("seen_paragraph_styles", "X", "dropped"),
        at("unmapped_character_styles", "Oblique", "oblique"), F.col("r.manifest_chapter_titles")[0].alias("first_title"),
    )
