"""How often and in what pieces work is done, on small tables: what decides how it grows."""

from pyspark.sql import functions as F

from folioframe.functions import latex
from folioframe.operators import chunks
from folioframe.plans import convert
from folioframe.session import made_rows
from folioframe.sources import package


def test_equations_are_not_shuffled_by_what_they_became(spark):
    """Few distinct equations, and rows without any, would be hot keys of a shuffle join."""
    math = F.when(F.col("id") % 2 == 0, F.format_string("<math><mn>%d</mn></math>", F.col("id") % 6))
    rows = spark.range(60).withColumn("mathml", math).withColumn("sha1", F.sha1(F.col("mathml").cast("binary")))
    done = latex.converted(rows)
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "Aggregate" not in plan and "PythonUDF" not in plan
    assert {(r["id"], r["latex"]) for r in done.collect()} == {(i, str(i % 6) if i % 2 == 0 else None) for i in range(60)}


def test_python_rows_are_handed_on_in_pieces(spark):
    """A worker holds one piece of output, whatever the rows of a batch or of a task."""
    big = "x" * 300_000
    rows = spark.createDataFrame([(i, big) for i in range(12)], "id int, text string").coalesce(1)
    made = made_rows(rows, lambda i, text: [(i, k, text) for k in range(3)], "id int, k int, text string")

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [sum(len(x.as_py()) for x in b.column(2))]})

    sent = [r["bytes"] for r in made.coalesce(1).mapInArrow(sizes, "bytes long").collect()]
    assert sum(sent) == 36 * len(big) and made.select("id", "k").distinct().count() == 36
    with_many = made_rows(spark.range(1, numPartitions=1), lambda i: ((k,) for k in range(2000)), "k long")
    assert with_many.count() == 2000 and [r["k"] for r in with_many.collect()] == list(range(2000))


def test_all_of_a_package_is_parsed_by_rows(spark):
    """None of the package's steps makes a frame of a whole batch of stories."""
    parts = spark.createDataFrame([("1", "Stories/Story_a.xml", 0, "<Story/>", None)], package.MEMBERS)
    pkgs = spark.createDataFrame([("1", bytearray(b"no archive"))], "book_id string, content binary")
    for made in (package.members(pkgs), package.frames(parts), package.paragraphs(parts), package.all_paragraphs(parts)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "MapInPandas" not in plan
    assert package.members(pkgs).first()["error"].startswith("BadZipFile")


def test_chapters_are_cut_in_one_pass(spark):
    """The documents, which are dear to make, are read once: no join back to them after the search."""
    books = spark.createDataFrame([("1", "# Der erste Teil\n\nText\n\n# Der zweite Teil\n\nmehr\n"), ("2", "# Nichts davon\n")], "book_id string, markdown string")
    wanted = [(b, 1, i, f"Der {n} Teil", "") for b in "12" for i, n in ((1, "erste"), (2, "zweite"))]
    anchors = spark.createDataFrame(wanted, "book_id string, unit_index int, chap_index int, title string, start_anchor string")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    cut = chunks.split(books.mapInArrow(counted, books.schema), anchors, strict=False)
    got = {(r["book_id"], r["chap_index"]): r["text"] for r in cut.collect()}
    assert got == {("1", 1): "Der erste Teil\n\nText\n\n#", ("1", 2): "Der zweite Teil\n\nmehr", ("2", 1): None, ("2", 2): None}
    assert read.value == 2


def test_files_to_write_are_not_planned_again(spark):
    """What is asked for, and where rasters go, is decided once: writing reads the decisions and the contents."""
    asked = [("1", f"img{i % 3}.jpg", "raster", (0, i, 0)) for i in range(3)] + [("1", "eq0.eps", "vector", (0, 9, 0))]
    requests = spark.createDataFrame(asked, "book_id string, basename string, class string, ord struct<story_ord:int,para_ord:int,k:int>")
    files = spark.createDataFrame([("1", "img0.jpg", bytearray(b"a")), ("1", "img1.jpg", bytearray(b"a")), ("1", "eq0.eps", bytearray(b"v"))], "book_id string, basename string, content binary")
    found, outputs = convert.plan_assets(requests, files, lambda name, data: ("eq0.svg", data))
    assert "sha1" not in outputs._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["basename"], r["status"]) for r in found.collect()} == {("img0.jpg", "copied"), ("img1.jpg", "alias"), ("img2.jpg", "missing"), ("eq0.eps", "converted")}
    assert {(r["rel_path"], bytes(r["content"])) for r in outputs.collect()} == {("assets/img/img0.jpg", b"a"), ("assets/vector/eq0.svg", b"v")}
