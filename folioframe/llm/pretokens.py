"""Pre-tokens of the byte-level BPE, and their ids, as the tokenizers library gives them.

The library parts a text by a fixed pattern and codes each pre-token alone, so
each distinct pre-token needs coding once. The pattern is restated over the
categories of assigned characters, in one form for texts of the basic plane and
in a slower one for texts with characters beyond it; a text with an unassigned
character, or a tokenizer of another kind, goes to the library whole.

Many texts at once (``Pretokenizer.many``) need no pattern: a pre-token begins
where the kind of character changes, but for white space and contractions, so
the begins of all texts are found over their bytes, and only the distinct
pre-tokens become Python objects.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Distinct pre-tokens a worker remembers; beyond that it starts afresh. Bounds memory, not results.
REMEMBERED = 400_000

#: Bytes of text whose pre-tokens are found at once, about.
AT_ONCE = 8 << 20


def _ranges(which: Callable[[str], bool], end: int) -> str:
    """A class of the characters below ``end``, as ranges."""
    out, start = [], None
    for i in range(end + 1):
        inside = i < end and not 0xD800 <= i < 0xE000 and which(chr(i))
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{i - 1:08x}")
            start = None
    return "".join(out)


#: White space by the Unicode property, which Python's own test widens by four controls.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))


@functools.cache
def pattern(end: int = 0x10000) -> re.Pattern:
    """The library's pattern over the characters below ``end``; any other character is a match of its own."""
    kind = unicodedata.category
    letter, number = _ranges(lambda c: kind(c)[0] == "L", end), _ranges(lambda c: kind(c)[0] == "N", end)
    space = _ranges(lambda c: c in _SPACE, end)
    other = _ranges(lambda c: kind(c)[0] not in "LN" and c not in _SPACE and kind(c) != "Cn", end)
    words = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[{other}]+"
    return re.compile(rf"{words}|[{space}]+(?![^{space}])|[{space}]+|[^{space}{letter}{number}{other}]", re.DOTALL)


#: Characters beyond the basic plane.
_ASTRAL = re.compile("[\U00010000-\U0010ffff]").search


def found(text: str) -> list[str]:
    """Pre-tokens of a text."""
    return (pattern() if text.isascii() or not _ASTRAL(text) else pattern(0x110000)).findall(text)


OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)


@functools.cache
def kinds(end: int = 0x10000) -> np.ndarray:
    """What the pattern takes each character below ``end`` for."""
    of = {"L": LETTER, "N": NUMBER}
    names = ((c, unicodedata.category(c)) for c in map(chr, range(end)))
    return np.array([SPACE if c in _SPACE else UNKNOWN if k in ("Cn", "Cs") else of.get(k[0], OTHER) for c, k in names], np.uint8)


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of valid UTF-8 is of."""
    out = kinds()[data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return out
    first = data[lead]
    for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
        at = lead[(first >= low) & (first < high)]
        if len(at):
            point = data[at].astype(np.int32) & (0x3F >> more)
            for k in range(1, more + 1):
                point = point << 6 | (data[at + k] & 0x3F)
            kind = kinds(0x110000 if more == 3 else 0x10000)[point]
            for k in range(more + 1):
                out[at + k] = kind
    return out


def _begins(data: np.ndarray, rows: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each byte; ``rows`` are the texts' offsets, the end included."""
    n = len(data)
    edge = np.zeros(n + 1, bool)  # where a text begins or ends
    edge[rows] = True
    begins = edge[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # of white space before something else the last character stands alone, and a blank goes with what follows
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n])
    blank = data[last] == 0x20
    begins[last[blank] + 1] = False
    first = last.copy()
    for _ in range(2):
        first -= (data[first] & 0xC0) == 0x80
    begins[first] = True
    # contractions, where the apostrophe is not part of something longer
    quote = np.flatnonzero((data[:-1] == 0x27) & begins[:-1] & ~edge[1:n])
    after = data[quote + 1]
    one = quote[np.isin(after, np.frombuffer(b"stmd", np.uint8))]
    pair = quote[quote + 2 < n]
    pair = pair[~edge[pair + 2]]
    both = data[pair + 1].astype(np.uint16) << 8 | data[pair + 2]
    two = pair[np.isin(both, np.frombuffer(b"revell", ">u2").astype(np.uint16))]
    begins[one + 1] = begins[two + 1] = False
    for at in (one + 2, two + 3):
        begins[at[at < n]] = True
    return begins


def _cuts(data: np.ndarray, most: int) -> np.ndarray:
    """Offsets that cut a text into parts of about ``most`` bytes, each before a blank that ends a pre-token."""
    out, at = [0], most
    while at < len(data):
        part = data[at - 1 : at + most]
        found = np.flatnonzero((part[1:] == 0x20) & (part[:-1] > 0x20) & (part[:-1] < 0x7F))
        if len(found):
            out.append(at + int(found[0]))
            at = out[-1]
        at += most
    return np.array([*out, len(data)], np.int32)


class Whole(Exception):
    """The text needs the library's own pre-tokens."""


class Pretokenizer:
    """Ids of texts by pre-token; ``path`` is a tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model, added = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("added_tokens") or []
        self.plain = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and not spec.get("truncation") and model["type"] == "BPE" and not model.get("dropout")
            and not any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added)
        )
        self.special = {a["content"]: a["id"] for a in added}
        self.split = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.find = found
        self.remembered: dict[str, bytes] = {}
        chars = bytes(range(33, 127)) + bytes(range(161, 173)) + bytes(range(174, 256))
        rest = [b for b in range(256) if b not in chars]
        self.letters = {chr(b): chr(b) for b in chars} | {chr(b): chr(256 + i) for i, b in enumerate(rest)}
        self.letters = str.maketrans(self.letters)

    def code(self, piece: str) -> bytes:
        """Ids of one pre-token, coded by the library's model."""
        if len(piece) == 1 and unicodedata.category(piece) in ("Cn", "Cs"):
            raise Whole
        coded = self.library.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.letters))
        return np.array([t.id for t in coded], self.dtype).tobytes()

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens; raises Whole where the pattern is not the library's."""
        return self.find(text)

    def ids(self, text: str | None) -> bytes:
        """All ids of a text, little-endian in ``dtype``."""
        if not text:
            return b""
        if self.plain:
            try:
                if self.split is None or not any(x in text for x in self.special):
                    return self._ids(text)
                parts = self.split.split(text)
                return b"".join(np.array([self.special[p]], self.dtype).tobytes() if i % 2 else self._ids(p) for i, p in enumerate(parts) if p)
            except Whole:
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def many(self, texts: pa.Array) -> Iterator[bytes]:
        """``ids`` of each text of an Arrow array of strings."""
        if not self.plain:
            yield from map(self.ids, texts.to_pylist())
            return
        if not len(texts):
            return
        texts = texts.cast(pa.string()).fill_null("")
        texts.validate(full=True)
        rows, at = _offsets(texts), 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(rows, int(rows[at]) + AT_ONCE, "right")) - 1)
            part, at = texts.slice(at, end - at), end
            special = self._special(part)
            if len(part) > 1 or special[0] or rows[end] - rows[end - 1] <= AT_ONCE:
                yield from self._many(part, special)
            else:
                cuts = _cuts(_bytes(part), AT_ONCE)
                data = part.buffers()[2].slice(int(rows[end - 1]))
                parts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), data)
                yield b"".join(x for i in range(len(parts)) for x in self._many(parts.slice(i, 1), special))

    def _special(self, texts: pa.StringArray) -> np.ndarray:
        """Which texts hold a special token."""
        found = np.zeros(len(texts), bool)
        for x in self.special:
            found |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        return found

    def _many(self, texts: pa.StringArray, special: np.ndarray) -> list[bytes]:
        data, rows = _bytes(texts), _offsets(texts)
        rows = rows - rows[0]
        if not len(data):
            return [b""] * len(texts)
        kind = _kinds_of(data)
        apart = special.copy()  # texts that are coded one by one
        apart[np.searchsorted(rows, np.flatnonzero(kind == UNKNOWN), "right") - 1] = True
        begin = np.flatnonzero(_begins(data, rows, kind)).astype(np.int32)
        per = np.diff(np.searchsorted(begin, rows))
        pieces = pa.StringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, np.int32(len(data)))), pa.py_buffer(data))
        if apart.all():
            return [self.ids(x) for x in texts.to_pylist()]
        if apart.any():
            pieces = pieces.filter(pa.array(np.repeat(~apart, per)))
            per[apart] = 0
        distinct = pieces.dictionary_encode()
        coded = pa.array(self._codes(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary()).take(distinct.indices)
        ends = _offsets(coded)[np.append(0, np.cumsum(per))].tolist()
        ids = coded.buffers()[2].to_pybytes()
        out = [ids[a:b] for a, b in itertools.pairwise(ends)]
        for i in np.flatnonzero(apart).tolist():
            out[i] = self.ids(texts[i].as_py())
        return out

    def _codes(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of distinct pre-tokens of known characters."""
        known, tokenize = self.remembered, self.library.model.tokenize
        found = list(map(known.get, pieces))
        new = [i for i, x in enumerate(found) if x is None]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            known.update((p, x) for p, x in zip(pieces, found, strict=True) if x is not None)
        mapped = b"\xff".join([pieces[i].encode() for i in new]).decode("latin-1").translate(self.letters)  # no text has this byte
        ids, ends = [], []
        for piece in mapped.split("\xff") if new else []:
            ids += [t.id for t in tokenize(piece)]
            ends.append(len(ids) * self.dtype.itemsize)
        coded = np.array(ids, self.dtype).tobytes()
        for i, a, b in zip(new, [0, *ends], ends, strict=False):
            known[pieces[i]] = found[i] = coded[a:b]
        return found

    def _ids(self, text: str) -> bytes:
        known = self.remembered
        pieces = self.find(text)
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for piece in set(pieces).difference(known):
            known[sys.intern(piece) if len(piece) < 32 else piece] = self.code(piece)
        return b"".join(map(known.__getitem__, pieces))


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]


def _bytes(texts: pa.StringArray) -> np.ndarray:
    offsets = _offsets(texts)
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]


@functools.lru_cache(4)
def pretokenizer(path: str) -> Pretokenizer:
    return Pretokenizer(path)
