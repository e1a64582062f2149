"""Packages and PDF files made of the test tables, so that queries can start from archives.

Ten conversations make a book: each is a story, its turns are paragraphs. A
story has two frames, the second on the next spread; a first and a last story
open the book's two chapters, and one story is the table of contents.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import made_rows, on_workers
from .registry import t

#: Styles by a paragraph's number, and their rules; the last has none.
STYLES = ("H", "P", "Q", "C", "X", "Code", "F", "R", "Odd")
RULES = {
    "H": {"kind": "heading", "level": 2}, "P": {"kind": "paragraph"}, "Q": {"kind": "blockquote"}, "C": {"kind": "caption"}, "X": {"kind": "drop"},
    "Code": {"kind": "code_block", "language": "text"}, "F": {"kind": "front_matter", "role": "authors"}, "R": {"kind": "reference_entry"},
    "Title": {"kind": "heading", "level": 1},
}
FONTS = {"user": "Regular", "assistant": "Bold", "system": "Oblique"}
SPREADS = ("c", "a", "b")


def _range(style: str, *parts: str) -> str:
    return f'<ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/{style}">{"".join(parts)}</ParagraphStyleRange>'


def _run(text: str, font: str = "Regular", position: str = "Normal", more: str = "") -> str:
    head = f'<CharacterStyleRange AppliedCharacterStyle="CharacterStyle/{font}" FontStyle="{font}" Position="{position}">'
    return f"{head}<Content>{escape(text)}</Content>{more}</CharacterStyleRange>"


def _story(body: str) -> str:
    return f'<p:Story xmlns:p="x"><Story>{body}</Story></p:Story>'


def _frame(name: str, story: str, prev: str = "n") -> str:
    return f'<TextFrame Self="{name}" ParentStory="{story}" PreviousTextFrame="{prev}" NextTextFrame="n"/>'


def turn_range(conv: int, turn: int, role: str, text: str) -> str:
    """One turn: its text in the role's font, a raised 2 in odd turns, an image or an equation where the style is P."""
    style = STYLES[(conv + turn * 3 + len(text)) % len(STYLES)]
    raised = _run("2", "Regular", "Superscript") if turn % 2 else ""
    link = ""
    if style == "P":
        name = f"img{conv % 5}.jpg" if role == "user" else f"eq{len(text) % 12}.eps"
        link = _run("", more=f'<Rectangle><Link LinkResourceURI="file:/x/Links/{name}"/></Rectangle>').replace("<Content></Content>", "")
    return _range(style, _run(text, FONTS[role]), raised, link)


def archive(book: int, turns: list[dict]) -> bytes:
    """The package of one book of turns in order; members' times are fixed, so equal books are equal bytes."""
    stories: dict[int, list[dict]] = {}
    for r in turns:
        stories.setdefault(r["conv_id"], []).append(r)
    convs = sorted(stories)
    place = {c: i % 3 for i, c in enumerate(convs)}
    spreads: list[list[str]] = [[_frame("fi", "intro"), _frame("ft", "toc")], [], []]
    for c in convs:
        spreads[(place[c] + 1) % 3].append(_frame(f"f{c}b", f"s{c}", f"f{c}a"))
    for c in convs:
        spreads[place[c]].append(f"<Group>{_frame(f'f{c}a', f's{c}')}</Group>")
    spreads[2].append(_frame("ff", "fim"))
    title = lambda which: f"Capitulo {which} do livro {book}"
    toc = _range("Sumario:SUMARIO%20UNIDADE", _run("UNIDADE 1")) + _range(
        "Sumario:SUMARIO", _run(f"CAPÍTULO 1 – {title('primeiro')}\t5"), _run(f"{title('segundo')}\t.15")
    )
    members = {
        "mimetype": "x",
        "designmap.xml": '<D xmlns:p="x">' + "".join(f'<p:Spread src="Spreads/Spread_{s}.xml"/>' for s in SPREADS) + '<p:MasterSpread src="MasterSpreads/MasterSpread_m.xml"/></D>',
        "MasterSpreads/MasterSpread_m.xml": f"<S>{_frame('fm', 'sm')}</S>",
        "Resources/Styles.xml": "<R>" + "".join(f'<ParagraphStyle Self="ParagraphStyle/{s}%20{book}"/>' for s in STYLES) + "</R>",
        "Stories/Story_intro.xml": _story(_range("Title", _run(title("primeiro")))),
        "Stories/Story_fim.xml": _story(_range("Title", _run(title("segundo"))) + _range("P2", _run("fim"))),
        "Stories/Story_toc.xml": _story(toc),
        "Stories/Story_sm.xml": _story(_range("P", _run("mestre"))),
    }
    members |= {f"Spreads/Spread_{s}.xml": f"<S>{''.join(frames)}</S>" for s, frames in zip(SPREADS, spreads, strict=True)}
    for c in convs:
        body = "".join(turn_range(c, r["turn"], r["role"], r["text"]) for r in stories[c])
        members[f"Stories/Story_s{c}.xml"] = _story(body)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(zipfile.ZipInfo(name), content)
    return out.getvalue()


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, path, content) of all conversations, ten a book."""
    turns = t(spark, sf_dir, "conversations").groupBy(F.floor(F.col("conv_id") / 10).alias("book"))
    books = turns.agg(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "role", "text"))).alias("turns"))
    made = lambda book, turns: [(str(book), f"{book}.idml", archive(book, turns))]
    return made_rows(books, made, "book_id string, path string, content binary")


def equation(i: int) -> bytes | None:
    """Every fourth file is a drawing, the one after it is absent, number 11 is no XML."""
    if i % 4 == 1:
        return None
    if i % 4 == 0:
        return b"%!PS drawing"
    body = "<mi>" if i == 11 else f"<mfrac><mi>a</mi><mn>{i}</mn></mfrac>"
    return f"%!PS\r\n%MathType!MathML!1!\r\n%<mathxmlns='u'>\r\n%{body}</math>\r\nend".encode("latin-1")


def files(spark: SparkSession, books: DataFrame) -> DataFrame:
    """(book_id, basename, content): images of which the fourth equals the third and the fifth is absent, and equations."""
    images = [(f"img{i}.jpg", bytes([min(i, 2)]) * 9) for i in range(4)]
    listed = images + [(f"eq{i}.eps", e) for i in range(12) if (e := equation(i)) is not None]
    every = F.array(*[F.struct(F.lit(n).alias("basename"), F.lit(bytearray(c)).alias("content")) for n, c in listed])
    return books.select("book_id", F.explode(every).alias("f")).select("book_id", "f.*")


def drawn(name: str, content: bytes) -> tuple[str, bytes] | None:
    """A converter that fails for one drawing."""
    return None if name == "eq8.eps" else (name.replace(".eps", ".svg"), b"<svg/>")


def page_text(books: DataFrame) -> DataFrame:
    """(book_id, page_idx, text): thirty pages a book, numbered from 2, under one running header."""
    body = F.concat(F.lit("Seite "), F.col("book_id"), F.lit(" mit so vielen Worten wie ein Anker von acht oder zwölf davon hier braucht"))
    pages = books.select("book_id", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("page_idx"))
    head = F.concat((F.col("page_idx") + 2).cast("string"), F.lit("\t\nDer Kopf dieses Buches\n"))
    return pages.select("book_id", "page_idx", F.concat(head, body).alias("text"))


def pdf_of(texts: list[str]) -> bytes:
    """A PDF with a page a text, every other page compressed."""
    marked = str.maketrans({c: f"\\{c}" for c in "\\()"})
    line = lambda x: b"(" + x.translate(marked).encode("cp1252") + b") Tj 0 -12 Td"
    objects, kids = [b"<</Type /Catalog /Pages 2 0 R>>", b""], []
    for i, text in enumerate(texts):
        shown = b"BT /F1 12 Tf " + b"\n".join(map(line, text.split("\n"))) + b" ET"
        body, how = (zlib.compress(shown), b" /Filter /FlateDecode") if i % 2 else (shown, b"")
        kids.append(b"%d 0 R" % (len(objects) + 1))
        objects.append(b"<</Type /Page /Contents %d 0 R>>" % (len(objects) + 2))
        objects.append(b"<</Length %d%s>>\nstream\n%s\nendstream" % (len(body), how, body))
    objects[1] = b"<</Type /Pages /Kids [" + b" ".join(kids) + b"]>>"
    numbered = b"".join(b"%d 0 obj\n%s\nendobj\n" % (i + 1, o) for i, o in enumerate(objects))
    return b"%PDF-1.4\n" + numbered + b"trailer <</Root 1 0 R>>"


def pdfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, content): a PDF a conversation, a page a turn."""
    on_workers(spark)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"book_id": b["book_id"], "content": [pdf_of(list(x)) for x in b["texts"]]})

    turns = t(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("book_id"))
    texts = turns.agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("texts"))
    return texts.mapInPandas(made, "book_id string, content binary")
