"""Page text of PDF files.

``pypdf`` reads them where it is installed. Without it a reader of the common
kind of file stands in: objects by their markers, object streams, Flate streams,
the page tree, text operators, and fonts' maps to Unicode. It knows no
encryption and no other filters; such pages have no text.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import on_workers

PAGES = "book_id string, page_idx int, text string"
_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.DOTALL)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.DOTALL)
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
#: Of a content stream: strings in brackets or hexadecimal, names, numbers, and operators.
_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|/[^\s/\[\]<>()]+|[-+.\d]+|\[|\]|[A-Za-z'\"*]+", re.DOTALL)
# Escapes within a string.
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
_ESCAPE = re.compile(rb"\\(\r\n|[0-7]{1,3}|.)", re.DOTALL)


def _unescaped(m: re.Match) -> bytes:
    x = m[1]
    return bytes([int(x, 8) & 255]) if x[:1].isdigit() else b"" if x in (b"\n", b"\r\n") else _ESCAPES.get(x, x)


class Document:
    def __init__(self, content: bytes):
        if b"/Encrypt" in content[-4096:]:
            raise ValueError("encrypted")
        self.objects = {int(m[1]): m[3] for m in _OBJECT.finditer(content)}
        for body in [b for b in self.objects.values() if b"/ObjStm" in b]:
            data, n, first = self.stream(body), *(int(re.search(rb"/%s\s+(\d+)" % key, body)[1]) for key in (b"N", b"First"))
            heads = list(map(int, data[:first].split()))[: 2 * n]
            starts = [first + x for x in heads[1::2]] + [len(data)]
            self.objects |= {number: data[a:z] for number, a, z in zip(heads[::2], starts, starts[1:], strict=False)}

    def stream(self, body: bytes) -> bytes:
        data = m[1] if (m := _STREAM.search(body)) else b""
        return zlib.decompressobj().decompress(data) if b"/FlateDecode" in body else data

    def value(self, body: bytes, key: bytes) -> bytes:
        """What follows a key: the object it refers to, or the text behind it."""
        m = re.search(rb"/" + key + rb"\b\s*", body)
        if not m:
            return b""
        rest = body[m.end() :]
        ref = _REF.match(rest)
        return self.objects.get(int(ref[1]), b"") if ref else rest

    def kids(self, body: bytes) -> Iterator[bytes]:
        m = re.match(rb"\s*\[(.*?)\]", self.value(body, b"Kids"), re.DOTALL)
        for ref in _REF.finditer(m[1] if m else b""):
            child = self.objects.get(int(ref[1]), b"")
            if re.search(rb"/Type\s*/Pages\b", child):
                yield from self.kids(child)
            else:
                yield child

    def pages(self) -> list[bytes]:
        root = next((b for b in self.objects.values() if re.search(rb"/Type\s*/Catalog\b", b)), b"")
        return list(self.kids(self.value(root, b"Pages")))

    def fonts(self, page: bytes) -> dict[bytes, dict[int, str]]:
        """Maps to Unicode of a page's fonts that have one."""
        found = {}
        for m in re.finditer(rb"/(\S+?)\s+(\d+)\s+\d+\s+R", self.value(self.value(page, b"Resources") or page, b"Font")):
            if b"/ToUnicode" in (body := self.objects.get(int(m[2]), b"")):
                found[m[1]] = unicode_map(self.stream(self.value(body, b"ToUnicode")))
        return found

    def text(self, page: bytes) -> str:
        body = self.value(page, b"Contents")
        listed = re.search(rb"/Contents\s*\[(.*?)\]", page, re.DOTALL)
        parts = [self.objects.get(int(r[1]), b"") for r in _REF.finditer(listed[1])] if listed else [body]
        return shown(b"\n".join(map(self.stream, parts)), self.fonts(page))


def unicode_map(cmap: bytes) -> dict[int, str]:
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    out = {}
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.DOTALL):
        out |= {int(a, 16): text(b) for a, b in re.findall(rb"<(\w+)>\s*<(\w+)>", block)}
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.DOTALL):
        for a, z, b in re.findall(rb"<(\w+)>\s*<(\w+)>\s*<(\w+)>", block):
            start = text(b)
            out |= {int(a, 16) + i: start[:-1] + chr(ord(start[-1]) + i) for i in range(int(z, 16) - int(a, 16) + 1)}
    return out


def shown(stream: bytes, fonts: dict[bytes, dict[int, str]]) -> str:
    """Text that a content stream shows; moves to another line are newlines."""
    out: list[str] = []
    known: dict[int, str] | None = None
    operands: list[bytes] = []

    def decoded(token: bytes) -> str:
        if token[:1] == b"<":
            raw = bytes.fromhex((digits := b"".join(token[1:-1].split()).decode()) + "0" * (len(digits) % 2))
        else:
            raw = _ESCAPE.sub(_unescaped, token[1:-1])
        if known is None:
            return raw.decode("cp1252", "replace")
        width = 2 if max(known, default=0) > 255 else 1
        return "".join(known.get(int.from_bytes(raw[i : i + width], "big"), "") for i in range(0, len(raw), width))

    for token in _TOKEN.findall(stream):
        if not (token[:1].isalpha() or token in (b"'", b'"')):
            operands.append(token)
            continue
        if token == b"Tf" and len(operands) > 1:
            known = fonts.get(operands[-2][1:])
        elif token in (b"T*", b"'", b'"', b"Tm", b"ET") or (token in (b"Td", b"TD") and operands and float(operands[-1] or 0)):
            out.append("\n")
        if token in (b"Tj", b"TJ", b"'", b'"'):
            for x in operands:
                if x[:1] in b"(<":
                    out.append(decoded(x))
                elif token == b"TJ" and x[:1] == b"-" and float(x) < -200:  # a wide gap stands for a blank
                    out.append(" ")
        operands.clear()
    return re.sub("\n{2,}", "\n", "".join(out)).strip("\n")


def page_texts(content: bytes) -> list[str]:
    """Text of every page; a page that fails has none, and a file that is no PDF raises."""
    try:
        from pypdf import PdfReader
    except ImportError:
        document = Document(content)
        pages: list[Callable[[], str]] = [lambda p=p: document.text(p) for p in document.pages()]
    else:
        pages = [lambda p=p: p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages]
    found = []
    for page in pages:
        try:
            found.append(page())
        except (KeyError, ValueError, AttributeError, IndexError, zlib.error):
            found.append("")
    return found


def pages(files: DataFrame) -> DataFrame:
    """(book_id, page_idx, text) from (book_id, content). A file that cannot be read has no pages."""
    on_workers(files.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for book, content in zip(b["book_id"], b["content"], strict=True):
                try:
                    texts = page_texts(bytes(content))
                except Exception:  # whatever is wrong with the file, it is that book's failure and no other's
                    texts = []
                yield pd.DataFrame({"book_id": book, "page_idx": range(len(texts)), "text": texts})

    return files.select("book_id", "content").mapInPandas(read, PAGES)


def largest_sibling(files: DataFrame, keys: list[str], name: str = "path", size: str = "length") -> DataFrame:
    """(keys, name): of the files beside a package, that with most bytes; of equal ones the first by name."""
    return files.groupBy(*keys).agg(F.min_by(name, F.struct(-F.col(size), F.col(name))).alias(name))
