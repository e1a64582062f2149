"""Operators on small hand-made tables."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioframe.functions import latex
from folioframe.operators import anchors, assets, batch, chunks, render, sequence, styles, tables
from folioframe.sources.rules import load_rules, rules

INLINES = f"array<{render.INLINE}>"


def run(*parts):
    return [(k, t) for k, t in parts]


@pytest.mark.parametrize(
    "inlines,want",
    [
        ([("text", "a"), ("bold", "b"), ("line_break", None), ("italic", "c")], "a**b**  \n*c*"), ([("text", "<a>\\*_&")], "&lt;a&gt;\\\\*_&"), ([("text", "x"), ("equation_inline", "y")], "x $y$"),
        ([("equation_inline", "y")], "$y$"), ([("text", "(")] + [("equation_inline", "a<b")], "($a<b$"), ([("bold_italic", "z"), ("superscript", "2"), ("subscript", "i")], "***z***<sup>2</sup><sub>i</sub>"), ([], ""), ([("bold", "")], ""),
    ],
)
def test_inlines(spark, inlines, want):
    df = spark.createDataFrame([(inlines,)], f"i {INLINES}")
    assert df.select(render.render_inlines(F.col("i")).alias("x")).first()["x"] == want


def test_breaks(spark):
    df = spark.createDataFrame([([("text", "a"), ("line_break", None), ("text", " "), ("line_break", None), ("bold", "b"), ("line_break", None)],), ([("text", " "), ("line_break", None)],), ([("line_break", None)],)], f"i {INLINES}")
    items = [[[i["text"] for i in item] for item in r["x"]] for r in df.select(sequence.split_by_break(F.col("i")).alias("x")).collect()]
    assert items == [[["a"], ["b"]], [[" ", None]], [[None]]]
    cut = [len(r["x"]) for r in df.select(render.without_trailing_breaks(F.col("i")).alias("x")).collect()]
    assert cut == [5, 1, 0]


def test_callout(spark):
    df = spark.createDataFrame([("tip", "T", ["a\nb", ""]), ("odd", None, ["x"])], "v string, t string, c array<string>")
    got = [r["x"] for r in df.select(render.render_callout(F.col("v"), F.col("t"), F.col("c")).alias("x")).collect()]
    assert got == ["> [!TIP]\n> **T**\n> a\n> b\n>", "> [!NOTE]\n> x"]


BLOCKS = "kind string, text string, level int, language string, src string, alt string, role string"


@pytest.mark.parametrize(
    "row,want",
    [
        (("heading", "T ", 9, "", "", "", ""), "###### T"), (("code_block", "x", 1, "python", "", "", ""), "```python\nx\n```"), (("blockquote", "a\nb", 1, "", "", "", ""), "> a\n> b"),
        (("image", "", 1, "", "s.png", "s", ""), "![s](s.png)"), (("equation_display", " ", 1, "", "", "", ""), ""), (("equation_display", "x", 1, "", "", "", ""), "$$\nx\n$$"),
        (("caption", "", 1, "", "", "", "caption"), "**"), (("front_matter", "A", 1, "", "", "", "title"), "**A**"), (("front_matter", "A", 1, "", "", "", "authors"), "*A*"), (("paragraph", "p ", 1, "", "", "", ""), "p"),
    ],
)
def test_block(spark, row, want):
    df = spark.createDataFrame([row], BLOCKS)
    got = df.select(render.render_block(*(F.col(c) for c in ("kind", "text")), **{c: F.col(c) for c in ("level", "language", "src", "alt", "role")}).alias("x"))
    assert got.first()["x"] == want


def table(spark, cells, header=0, body=2, columns=2, order="row:col"):
    df = spark.createDataFrame([(1, n, r, c, b, header, body, columns) for n, r, c, b in cells], f"t int, name string, row_span int, col_span int, blocks array<{tables.BLOCK}>, header_rows int, body_rows int, columns int")
    return tables.grid(df, ["t"], order).select(tables.render_table(F.col("rows"), F.col("header_rows")).alias("x")).first()["x"]


def para(text, kind="text"):
    return ("paragraph", [(kind, text)], None, None, None)


def test_tables(spark):
    two = [("0:0", 1, 1, [para("a")]), ("0:1", 1, 1, [para("b|c\nd", "bold")]), ("1:1", 1, 1, [para("e")]), ("5:0", 1, 1, [para("out")]), ("x", 1, 1, [])]
    assert table(spark, two) == "|  |  |\n| --- | --- |\n| a | **b\\|c d** |\n| e |  |"
    assert table(spark, two, 1, 1).startswith("| a | **b\\|c d** |\n| --- | --- |")
    assert "| a | e |" not in table(spark, two, order="col:row") and table(spark, two, order="col:row").count("\n") == 3
    spanned = table(spark, [("0:0", 1, 2, [para("a"), ("image", [], "s.png", "s", None)]), ("1:0", 2, 1, [("equation_display", [], None, None, "x")])], 1, 1)
    assert spanned == '<table>\n  <tr>\n    <th colspan="2">a<br /><img src="s.png" alt="s" /></th>\n  </tr>\n  <tr>\n    <td rowspan="2">$$x$$</td>\n  </tr>\n</table>'
    assert table(spark, [("9:9", 1, 1, [])]) == ""


def test_anchor_pages(spark):
    rows = [("b", i, f"Meu Livro de Juros\nTexto {i} da pagina\n{i + 3}") for i in range(12)] + [("c", 0, "so uma"), ("c", 1, None)]
    pages = spark.createDataFrame(rows, "book_id string, page_idx int, text string")
    assert [(r["book_id"], r["header"], r["n"]) for r in anchors.running_headers(pages).collect()] == [("b", ["meu", "livro", "de", "juros"], 12)]
    assert [(r["off"]) for r in anchors.voted_offset(pages).collect()] == [-3]
    manifest = spark.createDataFrame([("b", 1, 1, "Texto 6 da", 9), ("c", 1, 1, "so uma", 4)], "book_id string, unit_index int, chap_index int, title string, start_page int")
    got = {r["book_id"]: r["off"] for r in anchors.offsets(pages, manifest).collect()}
    assert got == {"b": -3, "c": -4}
    with pytest.raises(anchors.PdfAnchorError, match="too short"):
        anchors.anchors(pages, manifest)


def test_title_fallback_takes_any_offset(spark):
    pages = spark.createDataFrame([(b, i, "Juros Simples" if i in at else "nada") for b, at in (("far", (12, 14)), ("early", (5,)), ("late", (45,))) for i in range(50)], "book_id string, page_idx int, text string")
    manifest = spark.createDataFrame([(b, 1, 1, start, "Juros simples") for b, start in (("far", 1), ("early", 30), ("late", 44))], "book_id string, unit_index int, chap_index int, start_page int, title string")
    assert {r["book_id"]: r["off"] for r in anchors.offsets(pages, manifest).collect()} == {"far": 11, "early": -25, "late": None}


def test_split_errors(spark):
    text = spark.createDataFrame([("b", "# Um dois\n\ncorpo\n\n# Tres quatro\n\nfim")], "book_id string, markdown string")
    want = spark.createDataFrame([("b", 1, 1, "Um dois", ""), ("b", 1, 2, "Nada disso", "")], "book_id string, unit_index int, chap_index int, title string, start_anchor string")
    with pytest.raises(chunks.ChapterSplitError, match="1.2"):
        chunks.split(text, want)
    loose = {r["chap_index"]: r["text"] for r in chunks.split(text, want, strict=False).collect()}
    assert loose[2] is None and loose[1].endswith("fim")


def test_assets(spark):
    files = spark.createDataFrame([("b", "a.jpg", bytearray(b"1")), ("b", "copy.jpg", bytearray(b"1")), ("b", "v.ai", bytearray(b"v")), ("b", "bad.eps", bytearray(b"e"))], "book_id string, basename string, content binary")
    asked = spark.createDataFrame([("b", "a.jpg", 0), ("b", "copy.jpg", 1), ("b", "a.jpg", 2), ("b", "gone.png", 3), ("b", "t.txt", 4)], "book_id string, basename string, ord int")
    got = {r["basename"]: (r["status"], r["rel_path"]) for r in assets.plan_rasters(asked, files).collect()}
    assert got == {"a.jpg": ("copied", "assets/img/a.jpg"), "copy.jpg": ("alias", "assets/img/a.jpg"), "gone.png": ("missing", None), "t.txt": ("skipped", None)}

    def convert(name, content):
        if name == "bad.eps":
            raise RuntimeError
        return name + ".svg", content

    got = {r["basename"]: (r["status"], r["out_name"]) for r in assets.convert_vectors(files, convert).collect()}
    assert got == {"v.ai": ("converted", "v.ai.svg"), "bad.eps": ("failed", None)}


def test_programs(tmp_path, monkeypatch):
    assert assets.run([sys.executable, "-c", "print(1)"]) == (0, "1\n", "")
    assert assets.run([sys.executable, "-c", "import sys; sys.exit(3)"])[0] == 3
    assert assets.run([sys.executable, "-c", "import time; time.sleep(9)"], timeout=0.2)[0] == 124
    with pytest.raises(assets.BinaryNotFoundError):
        assets.run(["no-such-program"])
    assert assets.inkscape(str(tmp_path / "none")) is None
    program = tmp_path / "ink"
    program.write_text("")
    monkeypatch.setenv("FOLIOFRAME_INKSCAPE_PATH", str(program))
    assert assets.inkscape() == str(program)


def test_finalize(tmp_path):
    for name in ("x", "y"):
        (tmp_path / "in" / name).mkdir(parents=True)
    done, errors = tmp_path / "done", tmp_path / "errors"
    assert batch.finalize(tmp_path / "in/x", "x", "done", None, done, errors) and (done / "x").is_dir()
    assert batch.finalize(tmp_path / "in/y", "y", "error", "why", done, errors) and "why" in (errors / "y/_batch_error.json").read_text()
    Path(tmp_path / "in/x").mkdir()
    assert not batch.finalize(tmp_path / "in/x", "x", "done", None, done, errors)


def test_rules(spark, tmp_path):
    over = tmp_path / "o.yaml"
    over.write_text('paragraph_styles: {"T1": {level: 2}, "Novo": {kind: caption}}\nequations: {cache_dir: x}')
    got = rules(str(over))
    assert got["paragraph_styles"]["T1"] == {"kind": "heading", "level": 2} and got["paragraph_styles"]["Novo"] == {"kind": "caption"} and got["equations"]["cache_dir"] == "x"
    assert len(load_rules()["paragraph_styles"]) == 65 and len(load_rules()["character_styles"]) == 5
    assert styles.merged({"a": {"b": 1}}, {"a": 2}) == {"a": 2}
    with pytest.raises(TypeError):
        styles.rules_table(spark, {"a": 1})
    over.write_text("[1]")
    with pytest.raises(TypeError):
        load_rules(over)
    seen = spark.createDataFrame([("T1",), ("$ID/x",), ("??",), ("??",)], "style string")
    table_ = styles.rules_table(spark, {"T1": {}})
    assert {r["style"]: (r["seen"], r["unmapped"]) for r in styles.seen_and_unmapped(seen, table_, silent_prefix="$ID/").collect()} == {"T1": (1, 0), "$ID/x": (1, 0), "??": (2, 2)}


def test_equation_cache(spark, tmp_path):
    eqs = spark.createDataFrame([("a", "s1", "<math><mi>x</mi></math>"), ("b", "s1", "<math><mi>x</mi></math>"), ("c", "s2", "<math>"), ("d", None, None)], "basename string, sha1 string, mathml string")
    done = latex.converted(eqs)
    assert {r["basename"]: (r["latex"], r["latex_error"] is None) for r in done.collect()} == {"a": ("x", True), "b": ("x", True), "c": (None, False), "d": (None, True)}
    latex.extend_cache(done, None, str(tmp_path / "c"))
    cache = spark.read.parquet(str(tmp_path / "c"))
    marked = cache.withColumn("latex", F.lit("cached"))
    assert {r["latex"] for r in latex.converted(eqs, marked).filter("sha1 = 's1'").collect()} == {"cached"}
    assert latex.cache_use(done, None).first().asDict() == {"hits": 1, "misses": 2} and latex.cache_use(done, cache).first().asDict() == {"hits": 2, "misses": 1}
