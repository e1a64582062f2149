import pytest
from pyspark.sql import functions as F

from folioframe.functions import equations, latex, offsets
from folioframe.functions import text as X


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,want",
    [("Lição 4: a *mat*riz", "licao 4 a matriz"), ("bem-vindo", "bemvindo"), ("a - b", "a b"), ("soft­hyphen", "softhyphen"), ("", ""), ("a--b", "a b"), ("Ünï_codé`~", "unicode"), ("Việt ﬁm ½ x²", "viet fim 1 2 x2"), ("a\u3000b\tc…d", "a b c d"), ("𝐀𝟗-ß", "a9")],
)
def test_search_form(spark, text, want):
    assert one(spark, X.normalize_search(F.col("t")), t=text) == want == offsets.search_form(text)


@pytest.mark.parametrize("text", ["Seção 1", "Juros compostos: o *valor*", "bem-vindo ao curso", "a b", "É"])
def test_forms_agree(text):
    assert offsets.with_offsets(text)[0] == offsets.search_form(text)


def test_forms_disagree():
    assert offsets.with_offsets("a--b")[0] == "ab" and offsets.search_form("a--b") == "a b"
    assert offsets.with_offsets("Straße")[0] == "straße" and offsets.search_form("Straße") == "stra e"


def test_offsets_point_at_sources():
    text = "  **Olá**, mundo!"
    norm, at = offsets.with_offsets(text)
    assert norm == "ola mundo"
    assert text[at[0]] == "O" and text[at[4]] == "m"


@pytest.mark.parametrize("raw,want", [("ParagraphStyle/Corpo%3aRecuo", "Corpo:Recuo"), ("A+B", "A+B"), ("P/a%2", "a%2"), ("P/$ID/x", "$ID/x")])
def test_style_name(spark, raw, want):
    assert one(spark, X.style_name(F.col("t")), t=raw) == want


@pytest.mark.parametrize("uri,want", [("file:/C:/x/Links/a%20b.eps", "a b.eps"), ("x/Links/p/q.jpg", "q.jpg"), ("only.png", "only.png"), ("d/e.ai", "e.ai")])
def test_uri(spark, uri, want):
    assert one(spark, X.uri_basename(F.col("t")), t=uri) == want


def test_slug(spark):
    assert one(spark, X.slugify(F.col("t")), t="  Matemática — Financeira! ") == "matematica-financeira"
    assert one(spark, X.slugify(F.col("t")), t="Việt ﬁm x²") == "viet-fim-x2" and one(spark, X.slugify(F.col("t")), t="a\xa0b…c") == "a-b-c"


def test_toc(spark):
    got = one(spark, X.toc_tokens(F.col("t")), t="Juros\t10Taxas de\njuros\t.20 \t30")
    assert [(r["title"], r["page"]) for r in got] == [("Juros", 10), ("Taxas de\njuros", 20)]
    assert one(spark, X.toc_title(F.col("t")), t="CAPÍTULO 3 – O  fim") == "O fim"


def test_page_numbers(spark):
    assert one(spark, X.candidate_page_numbers(F.col("t")), t="12\na\nb") == [12, 12] == one(spark, X.candidate_page_numbers(F.col("t")), t="\xa012\t\na\n\t\n")
    assert one(spark, X.candidate_page_numbers(F.col("t")), t="1\n" + "x\n" * 10 + "99") == [1, 99]
    assert one(spark, X.significant_words(F.col("t"), 3), t="7\nUm dois 3 três quatro") == "um dois tres"


@pytest.mark.parametrize(
    "mathml,want",
    [
        ("<math><mi>x</mi></math>", "x"), ("<math><mi>sin</mi></math>", r"\mathrm{sin}"), ("<math><mn> 2,5 </mn><mo>×</mo><mi>α</mi></math>", r"2,5\times\alpha"),
        ("<math><mfrac><mi>a</mi><mn>2</mn></mfrac></math>", r"\frac{a}{2}"), ("<math><mroot><mi>x</mi><mn>3</mn></mroot></math>", r"\sqrt[3]{x}"),
        ("<math><msubsup><mi>x</mi><mn>1</mn><mn>2</mn></msubsup></math>", "x_{1}^{2}"), ("<math><munderover><mo>∑</mo><mi>i</mi><mi>n</mi></munderover></math>", r"\overset{n}{\underset{i}{\sum}}"),
        ("<math><mfenced open='[' close='' separators=';'><mi>a</mi><mi>b</mi></mfenced></math>", r"\left[a;b\right."), ("<math><mtext> a_b </mtext></math>", r"\text{a\_b}"),
        ("<math><mi>o</mi><mi>u</mi></math>", r"\text{ou}"), ("<math><mi>F</mi><mi>V</mi></math>", r"\mathrm{FV}"), ("<math><mi>t</mi><mi>a</mi><mi>x</mi><mi>a</mi></math>", r"\text{taxa}"),
        ("<math><mi>a</mi><mo>\u00a0</mo><mi>d</mi><mi>e</mi></math>", r"a\,\text{de}"), ("<math><mo>·</mo><mi>a</mi></math>", r"\cdot a"), ("<math><mi>x</mi><mi>x</mi><mi>x</mi></math>", r"\mathrm{xxx}"),
        ("<math><mtable><mtr><mtd><mi>a</mi></mtd><mtd><mi>b</mi></mtd></mtr></mtable></math>", r"\begin{matrix} a & b \end{matrix}"), ("<math><msup/></math>", ""), ("<math><mspace/></math>", r"\,"),
    ],
)
def test_latex(mathml, want):
    assert latex.convert(mathml) == want


def test_latex_error():
    with pytest.raises(latex.MathMLConversionError):
        latex.convert("<math>")


def test_equations(spark):
    rows = [
        ("ok", "%!PS\n%MathType!MathML!1!1!+-\n%<mathxmlns='http://www.w3.org/1998/Math/MathML'display='block'>\n%<mi>x</mi></math>\nend"),
        ("no_marker", "%!PS drawing"), ("mtef_only", "%MathType!MTEF!2!1!"), ("no_block", "%MathType nothing"), ("no_math", "%MathType!MathML!1\n%<x/>\n"), ("copy", "%MathType!MathML!1!\n%<math><mi>x</mi></math>\n"),
    ]
    got = {r["name"]: r for r in latex.converted(equations.extract(spark.createDataFrame(rows, "name string, text string"))).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"ok": "ok", "no_marker": "no_marker", "mtef_only": "mtef_only", "no_block": "no_block", "no_math": "no_math", "copy": "ok"}
    assert got["ok"]["mathml"] == "<math xmlns=\"http://www.w3.org/1998/Math/MathML\" display='block'><mi>x</mi></math>"
    assert got["ok"]["latex"] == got["copy"]["latex"] == "x"


def test_chapter_search():
    text = "# Um começo\n\nteste aqui\n\n# Dois caminhos\n\ntexto final de tudo mesmo\n\nFim das contas"
    found, end = offsets.positions(text, [("Um começo", ""), ("Nada igual", "texto final de tudo")], "fim das contas")
    assert text[found[0] :].startswith("Um") and text[found[1] :].startswith("texto final") and text[end:] == "Fim das contas"
    assert offsets.positions(text, [("Outra coisa", "")])[0] == [-1]
    assert text[offsets.positions(text, [("Um começo", "")], snap_to_line=True)[0][0] :].startswith("# Um")
