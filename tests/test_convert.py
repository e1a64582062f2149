"""A synthetic package from archive to chapters."""

import io
import json
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from folioframe import cli
from folioframe.operators import batch, order, toc
from folioframe.plans import books as plans
from folioframe.plans import convert
from folioframe.sources import package, pdf
from folioframe.sources.rules import rules


def psr(style, *content):
    return f'<ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/{style}">{"".join(content)}</ParagraphStyleRange>'


def csr(text="", font="", position="", extra=""):
    return f'<CharacterStyleRange AppliedCharacterStyle="CharacterStyle/Bold" FontStyle="{font}" Position="{position}">{"<Content>" + text + "</Content>" if text else ""}{extra}</CharacterStyleRange>'


def link(name):
    return f'<Rectangle><Link LinkResourceURI="file:/x/Links/{name}"/></Rectangle>'


TABLE = '<Table HeaderRowCount="1" BodyRowCount="1" ColumnCount="2">' + "".join(f'<Cell Name="{n}">{psr("Texto%20de%20tabela", csr(t))}</Cell>' for n, t in (("0:0", "A"), ("0:1", "B|C"), ("1:0", "1"), ("1:1", "2"), ("9:9", "out"), ("bad", "x"))) + "</Table>"

STORY = "".join((
    psr("T1", csr("Juros simples")), psr("Texto%20principal", csr("Um "), csr("forte", "Bold"), csr(" &lt;x&gt;"), csr("2", "", "Superscript")),
    psr("Bullet", csr("a", extra="<Br/><Content>b</Content>")), psr("Bullet", csr("c")), psr("Bullet%20N%C3%BAmeros", csr("um")), psr("Bullet%20ABC", csr("sub")), psr("Bullet%20N%C3%BAmeros", csr("dois")),
    psr("T%C3%ADtulo%20texto%20BOX", csr("Nota")), psr("Texto%20BOX", csr("dentro")), psr("Texto%20BOX", csr("ainda")),
    psr("Texto%20principal", csr("Valor"), csr(extra=link("eq.eps"))), psr("Texto%20principal", csr(extra=link("eq.eps"))), psr("ANCORAGEM%20IMAGEM", csr(extra=link("f.jpg"))),
    psr("Texto%20principal", csr(extra=TABLE)), psr("Rodap%C3%A9", csr("fora")), psr("Cita%C3%A7%C3%A3o", csr("dito")),
    psr("T1", csr("Taxas de juros")), psr("Texto%20principal", csr("O segundo capitulo fala de taxas e de outras coisas mais")), psr("Estilo%20novo", csr("sem regra")),
))
TOC = psr("Sumario:SUMARIO%20UNIDADE", csr("UNIDADE 1")) + psr("Sumario:SUMARIO", csr("Juros simples\t7Taxas de juros\t17"))
EPS = b"%!PS\n%MathType!MathML!1!\n%<math><mi>x</mi></math>\n"


def wrap(story, body):
    return f'<idPkg:Story xmlns:idPkg="p"><Story Self="{story}">{body}</Story></idPkg:Story>'


def frame(name, story, prev="n"):
    return f'<TextFrame Self="{name}" ParentStory="{story}" PreviousTextFrame="{prev}" NextTextFrame="n"/>'


@pytest.fixture(scope="module")
def books(tmp_path_factory):
    root = tmp_path_factory.mktemp("books")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("mimetype", "x")
        z.writestr("designmap.xml", '<D xmlns:p="p"><p:Spread src="Spreads/Spread_B.xml"/><p:Spread src="Spreads/Spread_A.xml"/><p:MasterSpread src="MasterSpreads/MasterSpread_M.xml"/></D>')
        z.writestr("Spreads/Spread_A.xml", f"<S>{frame('f2', 's1', 'f1')}</S>")
        z.writestr("Spreads/Spread_B.xml", f"<S>{frame('f0', 'toc')}<Group>{frame('f1', 's1')}</Group></S>")
        z.writestr("MasterSpreads/MasterSpread_M.xml", f"<S>{frame('fm', 'sm')}</S>")
        z.writestr("Stories/Story_toc.xml", wrap("toc", TOC))
        z.writestr("Stories/Story_s1.xml", wrap("s1", STORY))
        z.writestr("Stories/Story_sm.xml", wrap("sm", psr("T1", csr("mestre"))))
        z.writestr("Resources/Styles.xml", '<R><ParagraphStyle Self="ParagraphStyle/Corpo%3aRecuo"/><CharacterStyle Self="CharacterStyle/Bold"/></R>')
    (root / "b").mkdir()
    (root / "b" / "livro.idml").write_bytes(buf.getvalue())
    return root


@pytest.fixture(scope="module")
def pages(spark):
    words = {7: "Juros simples e o que mais vem aqui dentro hoje", 17: "O segundo capitulo fala de taxas e de outras coisas"}
    rows = [("livro", i, f"{i + 1}\n{words.get(i + 1, 'Outra pagina qualquer')}") for i in range(30)]
    return spark.createDataFrame(rows, "book_id string, page_idx int, text string")


@pytest.fixture(scope="module")
def book(spark, books, pages):
    files = spark.createDataFrame([("livro", "eq.eps", bytearray(EPS)), ("livro", "f.jpg", bytearray(b"jpg"))], "book_id string, basename string, content binary")
    return convert.plan(spark, package.packages(spark, str(books)), pages, files, convert.Options(units=1, per_unit=2))


def test_markdown(book):
    text = book.markdown.first()["markdown"]
    assert text == (
        "# Juros simples\n\nUm **forte** &lt;x&gt;<sup>2</sup>\n\n- a\n- b\n- c\n\n1. um\n  A. sub\n2. dois\n\n> [!NOTE]\n> **Nota**\n> dentro\n> ainda\n\nValor $x$\n\n$$\nx\n$$\n\n**\n\n"
        "![f](../../assets/img/f.jpg)\n\n| A | B\\|C |\n| --- | --- |\n| 1 | 2 |\n\n> dito\n\n# Taxas de juros\n\nO segundo capitulo fala de taxas e de outras coisas mais\n\nsem regra\n"
    )


def test_anchors_and_chapters(book):
    a = {r["chap_index"]: r for r in book.anchors.collect()}
    assert a[1]["off"] == -1 and a[1]["pdf_page_index"] == 6 and a[2]["start_anchor"].startswith("o segundo capitulo")
    c = {r["chap_index"]: r["text"] for r in book.chapters.collect()}
    assert c[1].startswith("Juros simples") and c[1].endswith("#") and c[2].startswith("Taxas de juros") and c[2].endswith("sem regra")


def test_report(book):
    r = json.loads(convert.reports(book, rules()).filter("book_id = 'livro'").first()["report"])
    assert r["unmapped_paragraph_styles"] == {"Estilo novo": 1} and (r["equations_total"], r["equation_cache_hits"], r["equation_cache_misses"]) == (2, 1, 1) and r["chapters_emitted_per_unit"] == [2]
    assert r["copied_assets"] == 1 and r["missing_assets"] == [] and r["manifest_chapter_titles"] == ["Juros simples", "Taxas de juros"]
    assert r["block_counts"]["list"] == 2 and r["block_counts"]["table"] == 1 and r["pdf_offset_detected"] == -1
    assert r["seen_paragraph_styles"]["Bullet"] == 2 and len(r) == 24


def test_frames_and_styles(spark, books):
    parts = package.members(package.packages(spark, str(books)))
    f = {r["self_id"]: r for r in package.frames(parts).collect()}
    assert f["f1"]["spread_index"] == 0 and f["f2"]["spread_index"] == 1 and f["fm"]["is_master"] and f["fm"]["spread_index"] == 2
    assert [r["name"] for r in package.style_names(parts).collect()] == ["Corpo:Recuo"]
    top = convert.inspect_styles(package.packages(spark, str(books)), 1).collect()
    assert (top[0]["style"], top[0]["n"]) == ("Texto de tabela", 6)


def zipped(story):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("designmap.xml", '<D><S src="Spreads/Spread_A.xml"/></D>')
        z.writestr("Spreads/Spread_A.xml", f"<S>{frame('f', 's')}</S>")
        z.writestr("Stories/Story_s.xml", wrap("s", story))
    return bytearray(buf.getvalue())


def converted(spark, story, **options):
    pkgs = spark.createDataFrame([("b", "p", zipped(story))], "book_id string, path string, content binary")
    return convert.plan(spark, pkgs, o=convert.Options(**options)).markdown.first()["markdown"]


def test_links_and_overlay(spark):
    wrapped = psr("Novo", csr("a "), f"<HyperlinkTextSource>{csr('dentro', 'Bold')}</HyperlinkTextSource>", csr(extra="<HyperlinkTextDestination><Content> direto</Content></HyperlinkTextDestination>"))
    assert converted(spark, wrapped) == "a\n"
    assert converted(spark, wrapped, follow_links=True) == "a **dentro** direto\n"
    assert converted(spark, wrapped, overlay={"paragraph_styles": {"Novo": {"kind": "heading", "level": 2}}}) == "## a\n"
    assert converted(spark, psr("??", csr("weg")) + psr("T2", csr("da")), overlay={"defaults": {"unknown_paragraph_style": "drop"}}) == "## da\n"


def test_runs_and_sublists(spark):
    ordered, nested, letters = "Bullet%20N%C3%BAmeros", "Bullet%20N%C3%BAmeros%20-%20N%C3%ADvel%20II", "Bullet%20ABC"
    bullet = lambda t: psr("Bullet", csr(t))
    story = bullet("p") + psr(nested, csr("gone")) + psr(letters, csr("x")) + psr(letters, csr("y")) + bullet("q") + psr("T2", csr("h")) + psr(ordered, csr("1")) + psr("Rodap%C3%A9", csr("drop")) + psr(ordered, csr("2"))
    assert converted(spark, story) == "- p\n  A. x\n  B. y\n- q\n\n## h\n\n1. 1\n2. 2\n"
    boxes = psr("T%C3%ADtulo%20texto%20BOX", csr("A")) + psr("Texto%20BOX", csr("1")) + psr("T%C3%ADtulo%20texto%20BOX", csr("B")) + psr("Texto%20BOX", csr("2")) + psr("TEXTO%20OBJETIVO", csr("o"))
    assert converted(spark, boxes) == "> [!NOTE]\n> **A**\n> 1\n> 2\n\n> [!TIP]\n> **Objetivos**\n> o\n"


def test_thread_roots(spark):
    chain = [("b", f"f{i}", "s", f"f{i - 1}" if i else "n", "n", 0, i, False) for i in range(300)]
    odd = [("b", "x", "t", "gone", "n", 1, 0, False), ("b", "c1", "u", "c2", "n", 2, 0, False), ("b", "c2", "u", "c1", "n", 2, 1, False)]
    frames = spark.createDataFrame(chain + odd, package.FRAMES)
    roots = {r["self_id"]: r["root_id"] for r in order.thread_roots(frames).collect()}
    assert roots["f299"] == "f0" and roots["x"] == "x" and roots["c1"] in ("c1", "c2")
    ranked = [r["story_id"] for r in order.reading_order(frames).orderBy("story_ord").collect()]
    assert ranked == ["s", "t", "u"]


def test_toc_errors(spark):
    rows = spark.createDataFrame([("b", 0, False, "orphan\t1"), ("b", 1, True, "U"), ("b", 2, False, "A\t9B\t8"), ("b", 3, False, "REFERÊNCIAS\t50")], "book_id string, ord int, is_unit boolean, text string")
    with pytest.raises(toc.TocParseError, match="page 8"):
        toc.manifest(rows, 1, 2)
    got = toc.chapters(toc.unit_groups(rows)).orderBy("pos").collect()
    assert [(r["title"], r["chap_index"]) for r in got] == [("A", 1), ("B", 2), ("REFERÊNCIAS", None)]


def test_batch(spark):
    tasks = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    done = spark.createDataFrame([("a", "error"), ("a", "output"), ("b", "done")], "key string, kind string")
    assert {r["key"]: r["reason"] for r in batch.skipped(tasks, done).collect()} == {"a": "output", "b": "done"}
    assert [r["key"] for r in batch.pending(tasks, done).collect()] == ["c"]
    none = batch.success_rate(spark.createDataFrame([("skipped",)], "status string")).first()
    assert none["rate"] == 0 and not none["passed"]


def test_cli(spark, books, pages, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "drop_scratch", lambda spark: None)  # other tests' tables are there too
    pages.write.parquet(str(tmp_path / "pages"))
    assert cli.main(["version"]) == 0
    assert cli.main(["inspect", str(books), "--top", "2"]) == 0 and "Texto de tabela" in capsys.readouterr().out
    (books / "b" / "Links").mkdir(exist_ok=True)
    (books / "b" / "Links" / "eq.eps").write_bytes(EPS)
    common = ["--pages", str(tmp_path / "pages"), "--units", "1", "--per-unit", "2", "--cache", str(tmp_path / "cache")]
    assert cli.main(["convert", str(books / "b" / "livro.idml"), "-o", str(tmp_path / "one"), "--title", "Meu Título", *common]) == 0
    report = json.loads((tmp_path / "one/meu-titulo/_report.json").read_text())
    assert report["book_title"] == "Meu Título" and report["equations_total"] == 2 and report["missing_assets"] == ["f.jpg"]
    assert (tmp_path / "one/meu-titulo/unidade_1/capitulo_1.md").read_text().startswith("Juros simples")
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 1


def pdf_of(*texts):
    """A PDF with a page a text; odd pages are compressed."""
    objects = [b"<</Type /Catalog /Pages 2 0 R>>", b""]
    kids = []
    for i, t in enumerate(texts):
        shown = b"BT /F1 12 Tf " + b" ".join(b"(" + line.encode("cp1252") + b") Tj 0 -12 Td" for line in t.split("\n")) + b" ET"
        body, kind = (zlib.compress(shown), b" /Filter /FlateDecode") if i % 2 else (shown, b"")
        kids.append(b"%d 0 R" % (len(objects) + 1))
        objects.append(b"<</Type /Page /Contents %d 0 R>>" % (len(objects) + 2))
        objects.append(b"<</Length %d%s>>\nstream\n%s\nendstream" % (len(body), kind, body))
    objects[1] = b"<</Type /Pages /Kids [" + b" ".join(kids) + b"]>>"
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i + 1, o) for i, o in enumerate(objects)) + b"trailer <</Root 1 0 R>>"


def test_pdf():
    assert pdf.page_texts(pdf_of("Olá \\(a\\)\n12", "dois", "")) == ["Olá (a)\n12", "dois", ""]
    cmap = b"1 beginbfchar <0003> <0041> endbfchar 1 beginbfrange <0010> <0012> <0061> endbfrange"
    assert pdf.shown(b"/F1 9 Tf [<00030010> -300 <0012>] TJ", {b"F1": pdf.unicode_map(cmap)}) == "Aa c"


def test_batch_isolates_bad_books(spark, books, tmp_path):
    """Books in one job: two whole ones, a broken archive, one without a PDF, one with other contents; then all are skipped."""
    words = {7: "Juros simples e o que mais vem aqui dentro hoje", 17: "O segundo capitulo fala de taxas e de outras coisas"}
    texts = [f"{i + 1}\n{words.get(i + 1, 'Outra pagina qualquer')}" for i in range(30)]
    whole = (books / "b" / "livro.idml").read_bytes()
    for name, package_, pages_ in (("um", whole, texts), ("dois", whole, texts), ("quebrado", b"no zip", texts), ("sem", whole, None), ("curto", bytes(zipped(psr("T1", csr("x")))), texts)):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / f"Livro_{name}.idml").write_bytes(package_)
        if pages_:
            (tmp_path / "in" / name / "capa.pdf").write_bytes(b"%PDF")
            (tmp_path / "in" / name / "miolo.pdf").write_bytes(pdf_of(*pages_))
    settings = plans.Settings(options=convert.Options(units=1, per_unit=2), workers=2)
    at = [tmp_path / x for x in ("in", "out", "done", "errors")]
    got = {r["slug"]: (r["status"], r["message"]) for r in plans.convert_folder(spark, *at, settings).collect()}
    assert {k: v[0] for k, v in got.items()} == {"livro-um": "done", "livro-dois": "done", "livro-quebrado": "error", "livro-sem": "error", "livro-curto": "error"}
    assert "BadZipFile" in got["livro-quebrado"][1] and "no page offset" in got["livro-sem"][1] and got["livro-curto"][1] == "no table of contents"
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"livro-um", "livro-dois"} == {p.parent.parent.name for p in (tmp_path / "out").glob("*/unidade_1/capitulo_2.md")}
    assert (tmp_path / "done/um/_report.json").exists() and "BadZipFile" in (tmp_path / "errors/quebrado/_batch_error.json").read_text()
    for name in ("um", "sem"):  # what comes again under a known name is skipped
        (tmp_path / "in" / name).mkdir()
        (tmp_path / "in" / name / f"Livro_{name}.idml").write_bytes(whole)
    again = {r["slug"]: r["message"] for r in plans.convert_folder(spark, *at, settings).collect()}
    assert again == {"livro-um": "output", "livro-sem": "error"}


def test_packages_of_one_name(spark, books, tmp_path):
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "livro.idml").write_bytes((books / "b" / "livro.idml").read_bytes())
    ids = [r["book_id"] for r in package.packages(spark, str(tmp_path)).collect()]
    assert len(set(ids)) == 2 and all(i.startswith("livro-") for i in ids)
    roots = order.thread_roots(package.frames(package.members(package.packages(spark, str(tmp_path)))))
    assert roots.count() == 8


def test_frames_given_twice(spark):
    chain = [("b", f"f{i}", "s", f"f{i - 1}" if i else "n", "n", 0, i, False) for i in range(6)]
    master = [("b", "f3", "s", "n", "n", 9, 0, True)]
    frames = spark.createDataFrame(chain + chain + master, package.FRAMES)
    assert sorted((r["self_id"], r["root_id"]) for r in order.thread_roots(frames).collect()) == [(f"f{i}", "f0") for i in range(6)]
    assert order.reading_order(frames, include_masters=True).count() == 1


def test_document(book, spark):
    titles = spark.createDataFrame([("livro", "Meu livro")], "book_id string, title string")
    text = convert.documents(book, titles).first()["markdown"]
    assert text.startswith("# Meu livro\n\n## Sumário\n\n- [Juros simples](#juros-simples)\n- [Taxas de juros](#taxas-de-juros)\n\n# Juros simples\n\nUm")


def test_stream(spark, books, tmp_path):
    from folioframe.streaming import queue

    work = lambda df: df.select("path", F.length("content").alias("n"))
    for _ in range(2):  # the second run finds nothing new
        queue.drain(queue.incoming(spark, str(books)), work, str(tmp_path / "r"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1
