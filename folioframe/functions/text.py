"""Scalar text functions as Column expressions: all stay in the JVM."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

SHY = "\u00ad"
#: What Python and Unicode call white space, for trimming.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Those of them that are spaces to Unicode (category Zs).
SPACES = "".join(c for c in BLANKS if unicodedata.category(c) == "Zs")


def bound(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a column that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end. Spark trims blanks fast, and other characters only where there are any."""
    rest = [b for b in BLANKS if b != " "]
    ends = lambda x: F.substring(x, 1, 1).isin(rest) | F.substring(x, -1, 1).isin(rest)
    return bound(F.trim(c), lambda x: F.when(ends(x), F.btrim(x, F.lit(BLANKS))).otherwise(x))


def rstrip(c: Column) -> Column:
    rest = [b for b in BLANKS if b != " "]
    return bound(F.rtrim(c), lambda x: F.when(F.substring(x, -1, 1).isin(rest), F.rtrim(x, F.lit(BLANKS))).otherwise(x))


def _class(points: list[int]) -> str:
    """A regular expression's class of code points, as ranges."""
    out, at = [], 0
    while at < len(points):
        end = at
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out.append(f"\\x{{{points[at]:x}}}-\\x{{{points[end]:x}}}")
        at = end + 1
    return "".join(out)


#: Characters from here on are looked at one by one only in texts that have any.
RARE = 0x200


@functools.cache
def decompositions() -> tuple[str, str, dict[str, str], str, str]:
    """Of all characters beyond ASCII: those that fold to one ASCII character and what to, those that fold to several, and two classes.

    Folding is compatibility decomposition without combining marks, in lower
    case. Characters that fold to nothing in ASCII are left as they are. The
    classes are those of characters that fold to several, and of combining marks.
    """
    one, base, several, marks = [], [], {}, []
    for point in chain(range(0x80, 0xD800), range(0xE000, 0x110000)):
        c = chr(point)
        if unicodedata.combining(c):
            marks.append(point)
        elif unicodedata.decomposition(c):
            folded = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
            if not folded:
                marks.append(point)
            elif len(folded) == 1 and folded.isascii():
                one.append(c)
                base.append(folded)
            elif any(map(str.isascii, folded)):
                several[c] = folded
    return "".join(one), "".join(base), several, _class(sorted(map(ord, several))), _class(marks)


def fold(c: Column) -> Column:
    """Lower case without accents: compatibility decomposition, combining marks gone.

    Characters that fold to one are translated in every text; what folds to
    several, and marks, are looked for where a text has rare characters.
    """
    one, base, several, spelled_out, marks = decompositions()
    table = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in several.items())), F.lit("\x01"), F.lit("\x02"))
    rare = _class(sorted(x for x in map(ord, several) if x < RARE)) + f"\\x{{{RARE:x}}}-\\x{{10ffff}}"

    def spelled(x: Column) -> Column:
        parts = F.split(x, f"(?<=[{spelled_out}])|(?=[{spelled_out}])")
        whole = F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(table, p), p)), "")
        return F.regexp_replace(whole, f"[{marks}]+", "")

    return bound(F.lower(F.translate(c, one, base)), lambda x: F.when(x.rlike(f"[{rare}]"), spelled(x)).otherwise(x))


def normalize_search(c: Column) -> Column:
    """Search form: folded, Markdown marks deleted, hyphens within words joined, all else single spaces."""
    joined = F.regexp_replace(F.regexp_replace(fold(c), r"[*_`~]+", ""), rf"(?U)(?<=\w)[-{SHY}](?=\w)", "")
    return F.trim(F.regexp_replace(joined, "[^a-z0-9]+", " "))


def slugify(c: Column) -> Column:
    """ASCII slug: folded, characters without a base dropped, other runs one hyphen."""
    ascii_only = F.regexp_replace(fold(c), r"[^\x00-\x7f]", "")
    return F.regexp_replace(F.regexp_replace(ascii_only, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def title_from_stem(c: Column) -> Column:
    return strip(F.translate(c, "_", " "))


def percent_decoded(c: Column) -> Column:
    """Percent escapes decoded, plus signs kept; a malformed text stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def style_name(c: Column) -> Column:
    """What follows the first slash (all, without one), percent-decoded."""
    return percent_decoded(F.when(F.contains(c, F.lit("/")), F.substring(c, F.locate("/", c) + 1, F.length(c))).otherwise(c))


def clean_content(c: Column) -> Column:
    """Line and paragraph separators become newlines; soft hyphens and byte-order marks go."""
    return F.translate(F.replace(F.replace(c, F.lit(" "), F.lit("\n")), F.lit(" "), F.lit("\n\n")), SHY + "﻿", "")


def inline_kind(font_style: Column, position: Column) -> Column:
    """superscript, subscript, bold_italic, bold, italic or text, in that precedence."""
    font, pos = F.lower(F.coalesce(font_style, F.lit(""))), F.lower(F.coalesce(position, F.lit("")))
    bold, italic = font.rlike("bold|black|heavy"), font.rlike("italic|oblique")
    return (
        F.when(F.contains(pos, F.lit("superscript")), "superscript")
        .when(F.contains(pos, F.lit("subscript")), "subscript")
        .when(bold & italic, "bold_italic")
        .when(bold, "bold")
        .when(italic, "italic")
        .otherwise("text")
    )


def uri_basename(uri: Column) -> Column:
    """Last segment after the first ``Links/`` (of the whole, without one), decoded before it is cut again."""
    after = F.when(F.contains(uri, F.lit("Links/")), F.substring(uri, F.locate("Links/", uri) + 6,
        F.length(uri))).otherwise(F.element_at(F.split(uri, "/"), -1))
    return F.element_at(F.split(percent_decoded(after), "/"), -1)


# Extensions by what they hold.
RASTER = (".jpg", ".jpeg", ".png", ".gif", ".tif", ".tiff", ".webp")
VECTOR = (".ai",)
EQUATION = (".eps",)


def extension(name: Column) -> Column:
    """Last dot and what follows, lower case; empty without one or for a leading dot."""
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1))


def link_kind(name: Column) -> Column:
    ext = extension(name)
    return F.when(ext.isin(*RASTER), "image_raster").when(ext.isin(*VECTOR), "image_vector").when(ext.isin(*EQUATION),
        "equation_eps").otherwise("other")


def md_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def md_wrap(text: Column, kind: Column) -> Column:
    around = lambda left, right=None: F.concat(F.lit(left), text, F.lit(right or left))
    return (
        F.when(kind == "bold", around("**"))
        .when(kind == "italic", around("*"))
        .when(kind == "bold_italic", around("***"))
        .when(kind == "superscript", around("<sup>", "</sup>"))
        .when(kind == "subscript", around("<sub>", "</sub>"))
        .otherwise(text)
    )


ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X")


def list_marker(ordered: Column, marker: Column, n: Column) -> Column:
    """Marker of the n-th item, from one: roman up to ten and letters up to 26, decimal beyond."""
    decimal = F.concat(n.cast("string"), F.lit("."))
    roman = F.concat(F.element_at(F.array(*map(F.lit, ROMAN)), F.least(n, F.lit(10)).cast("int")), F.lit("."))
    upper = F.concat(F.char(F.least(n, F.lit(26)) + 64), F.lit("."))
    return (
        F.when(~ordered, "-")
        .when((marker == "upper-roman") & (n <= 10), roman)
        .when((marker == "upper-alpha") & (n <= 26), upper)
        .otherwise(decimal)
    )


def heading(level: Column, text: Column) -> Column:
    hashes = F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(level, F.lit(6))).cast("int"))
    return rstrip(F.concat(hashes, F.lit(" "), text))


def collapse_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def toc_tokens(payload: Column) -> Column:
    """Array of (title, page): titles up to a tab, an optional mark, digits; blank titles dropped."""
    pattern = r"(?s)(.+?)\t[.,;:]?(\d+)"
    part = lambda group: F.regexp_extract_all(payload, F.lit(pattern), F.lit(group))
    pairs = F.zip_with(part(1), part(2), lambda t, p: F.struct(strip(t).alias("title"), p.cast("int").alias("page")))
    return F.filter(pairs, lambda x: x["title"] != "")


def toc_title(c: Column) -> Column:
    """Without a leading chapter label, white space collapsed."""
    bare = F.regexp_replace(c, r"(?iu)^\s*cap[i\u00ed]tulo\s+\d+\s*[\u2013\u2014-]\s*", "")
    return strip(F.regexp_replace(bare, rf"[{BLANKS}]+", " "))


def words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def first_words(c: Column, n: int) -> Column:
    """The first n words, single-spaced."""
    return F.array_join(F.slice(words(c), 1, n), " ")


def strip_header(anchor: Column, header: Column) -> Column:
    """The anchor without a running header that it begins with and outlasts; both are word arrays."""
    longer = (F.size(header) > 0) & (F.size(anchor) > F.size(header)) & (F.slice(anchor, F.lit(1), F.greatest(F.size(header), F.lit(1))) == header)
    return F.when(longer, F.slice(anchor, F.size(header) + 1, F.size(anchor))).otherwise(anchor)


def page_lines(text: Column) -> Column:
    """Non-blank lines, trimmed."""
    lines = F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    return F.filter(F.transform(lines, strip), lambda x: x != "")


def candidate_page_numbers(text: Column) -> Column:
    """Lines of one to four digits among the first five and the last five; a line in both windows counts twice."""
    lines = page_lines(text)
    ends = F.concat(F.slice(lines, 1, 5), F.slice(lines, F.greatest(F.size(lines) - 4, F.lit(1)), F.lit(5)))  # short pages: both windows
    return F.transform(F.filter(ends, lambda x: x.rlike(r"^[0-9]{1,4}$")), lambda x: x.cast("int"))


def split_words(c: Column) -> Column:
    """Cut at runs of any white space; the short way where a text has none but the usual."""
    rare = r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    return bound(c, lambda x: F.when(x.rlike(rare), F.split(x, f"[{BLANKS}]+")).otherwise(F.split(x, r"\s+")))


def significant_words(text: Column, n: int) -> Column:
    """The first n words of the search form that are not all digits, from at most 3n raw words of lines that are no page number."""
    lines = F.filter(page_lines(text), lambda x: ~x.rlike(r"^[0-9]{1,4}$"))
    raw = F.slice(F.filter(split_words(F.array_join(lines, " ")), lambda w: w != ""), 1, 3 * n)
    found = F.filter(words(normalize_search(F.array_join(raw, " "))), lambda w: ~w.rlike("^[0-9]+$"))
    return F.array_join(F.slice(found, 1, n), " ")


def joined(chunks: Column, sep: str, keep: Callable[[Column], Column] = lambda x: x != "") -> Column:
    return F.array_join(F.filter(chunks, keep), sep)
