"""The search form with offsets, and where chapters begin in it: each search starts where the last ended, so one call a book.

The text is taken apart once, as an array: every character becomes its folded
letters, a blank, or nothing (as a joint does, a hyphen within a word). Each distinct
character is folded once, and the offsets are cut along with the folded text.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from itertools import chain, repeat

import numpy as np

HYPHENS, MARKS = "-­", "*_`~"
HEADING = re.compile(r"^(#{1,6})\s+", re.MULTILINE)
#: Words of a title that is searched for, and of an anchor at most and at least.
LEAST_TITLE, MOST_ANCHOR, LEAST_ANCHOR = 2, 8, 4

#: A hyphen that a letter or digit follows within four characters and before any blank.
_JOINT = re.compile(rf"[{HYPHENS}](?=[^ \t\n\r]{{0,3}}[^\W_])")


def plain(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@functools.lru_cache(1 << 14)
def _spread(ch: str) -> str:
    return "" if ch in MARKS else "".join(low if (low := c.lower()).isalnum() else " " for c in plain(ch))


def with_offsets(text: str) -> tuple[str, list[int]]:
    """Search form, and for each of its characters the offset of the one it comes from; one entry more marks the end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known, which = np.unique(codes, return_inverse=True)
    pieces = [_spread(chr(c)) for c in known.tolist()]
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    size, first = sizes[which], (np.cumsum(sizes) - sizes)[which]
    if joints := [m.start() for m in _JOINT.finditer(text)]:
        size[joints] = 0  # what a joint parts is one word
    source = np.repeat(np.arange(len(text)), size)
    within = np.arange(len(source)) - np.repeat(np.cumsum(size) - size, size)
    spread = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)[np.repeat(first, size) + within]
    blank = spread == ord(" ")
    kept = ~(blank & np.concatenate(([True], blank[:-1])))  # of a gap its first blank, and none before the first word
    form, at, ending = spread[kept], source[kept], len(text)
    if len(form) and form[-1] == ord(" "):
        form, at, ending = form[:-1], at[:-1], int(at[-1])
    return form.tobytes().decode("utf-32-le", "surrogatepass"), [*at.tolist(), ending]


def search_form(text: str) -> str:
    """Python twin of the Column expression: other letters than a to z part words."""
    bare = re.sub(rf"[{MARKS}]+", "", plain(text).lower())
    return " ".join(re.findall("[a-z0-9]+", re.sub(rf"(?<=\w)[{HYPHENS}](?=\w)", "", bare)))


def heading_offsets(markdown: str, at: list[int]) -> list[int]:
    """Where in the search form each heading's text begins."""
    ends = [m.end() for m in HEADING.finditer(markdown)]
    return [k for k in np.searchsorted(at, ends).tolist() if k < len(at)]


def needles(title: str, anchor: str) -> list[tuple[str, bool]]:
    """What is looked for, in turn, and whether at headings only: the title, ever fewer words of the anchor, the title anywhere."""
    form, key = search_form(title), anchor.split()[:MOST_ANCHOR]
    titled = [form] if form.count(" ") + 1 >= LEAST_TITLE else []
    shorter = (" ".join(key[:n]) for n in range(len(key), LEAST_ANCHOR - 1, -1))
    return list(chain(zip(titled, repeat(True)), zip(shorter, repeat(False)), zip(titled, repeat(False))))


def place(norm: str, headings: list[int], cursor: int, needle: str, at_heading: bool) -> int:
    """First place at or after the cursor, or -1."""
    if not at_heading:
        return norm.find(needle, cursor)
    return next((h for h in headings if h >= cursor and norm.startswith(needle, h)), -1)


def positions(markdown: str, wanted: list[tuple[str, str]], sentinel: str | None = None, snap_to_line: bool = False) -> tuple[list[int], int]:
    """Offsets of the chapters (title, anchor) in order, -1 where one is missing, and where the last one ends."""
    norm, at = with_offsets(markdown)
    headings, cursor, found = heading_offsets(markdown, at), 0, []
    for chapter in wanted:
        hits = ((place(norm, headings, cursor, *n), len(n[0])) for n in needles(*chapter))
        k, size = next((hit for hit in hits if hit[0] >= 0), (-1, 0))
        start = at[k] if k >= 0 else -1
        found.append(markdown.rfind("\n", 0, start) + 1 if snap_to_line and k >= 0 else start)
        cursor = k + size if k >= 0 else cursor
    ending = " ".join((sentinel or "").split()[:MOST_ANCHOR])
    last = norm.find(ending, cursor) if ending else -1
    return found, at[last] if last >= 0 else len(markdown)
