"""Runs of list items and callouts in closed window form, and what else follows from row order.

Everything is partitioned by story: a window never spans stories, so the longest
story, not the corpus, bounds a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def running(flag: Column, keys: list[str], order: list[str]) -> Column:
    """Running count of a flag: the island number of gaps and islands."""
    return F.sum(flag.cast("long")).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def islands(rows: DataFrame, value: Column, keys: list[str], order: list[str], name: str = "island") -> DataFrame:
    """Number maximal runs of equal ``value``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = ~value.eqNullSafe(F.lag(value).over(w)) | F.row_number().over(w).eqNullSafe(1)
    return rows.withColumn("_changed", changed).withColumn(name, running(F.col("_changed"), keys, order)).drop("_changed")


def block_runs(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Give every row of a story its block number.

    Input columns: ``type`` (list, adm, title or other), ``run_key`` (a list's
    marker or a callout's variant), ``nested``, ``closes`` (the row also emits
    display blocks), ``text`` (a title's), ``rule_title``. Output: the rows but
    titles, with ``block_no``, ``attached`` (a nested item under the block's
    item before it) and ``adm_title``.

    Title epochs number the callouts before a row; a title holds for the next
    callout whatever stands between. A stretch is a run of one type that nothing
    closes. The key that is open in a stretch is that of its last row that is
    not nested, or its first; a nested row with another key is attached and
    changes nothing.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_epoch", F.coalesce(F.count_if(F.col("type") == "adm").over(before), F.lit(0)))
    in_epoch = Window.partitionBy(*keys, "_epoch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_pending", F.last(F.when(F.col("type") == "title", F.col("text")), ignorenulls=True).over(in_epoch))
    # a title that carries display blocks closes the run though it emits nothing itself
    rows = rows.withColumn("_title_closes", running(((F.col("type") == "title") & F.col("closes")), keys, order)).filter("type <> 'title'")
    prev = lambda c: F.lag(c).over(w)
    starts = ~F.col("type").isin("list", "adm") | ~F.col("type").eqNullSafe(prev("type")) | F.coalesce(prev("closes"),
        F.lit(False)) | ~F.col("_title_closes").eqNullSafe(prev("_title_closes"))
    rows = rows.withColumn("_starts", starts).withColumn("_stretch", running(F.col("_starts"), keys, order))
    in_stretch = Window.partitionBy(*keys, "_stretch").orderBy(*order)
    opens = ~F.coalesce(F.col("nested"), F.lit(False)) | F.col("_starts")
    rows = rows.withColumn("_open", F.last(F.when(opens, F.col("run_key")),
        ignorenulls=True).over(in_stretch.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("attached", (F.col("type") == "list") & ~F.col("_open").eqNullSafe(F.col("run_key")))
    changed = F.col("_starts") | ~F.col("_open").eqNullSafe(F.lag("_open").over(in_stretch))
    rows = rows.withColumn("_changed", changed).withColumn("block_no", running(F.col("_changed"), keys, order))
    titled = F.when(F.col("type") == "adm", F.coalesce(F.nullif(F.col("_pending"), F.lit("")), F.col("rule_title")))
    in_block = Window.partitionBy(*keys, "block_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_title", titled).withColumn("adm_title", F.first("_title").over(in_block))
    return rows.drop("_epoch", "_pending", "_title_closes", "_starts", "_stretch", "_open", "_changed", "_title")


def carried(rows: DataFrame, value: Column, keys: list[str], order: list[str], name: str) -> DataFrame:
    """The last non-null value up to each row."""
    return rows.withColumn(name, F.last(value,
        ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def filled_item(item: Column, bare: Callable[[Column], Column] = strip) -> Column:
    """Whether an item has text that ``bare`` leaves something of."""
    return F.exists(item, lambda i: bare(F.coalesce(i["text"], F.lit(""))) != "")


def split_by_break(inlines: Column, bare: Callable[[Column], Column] = strip) -> Column:
    """Items of an inline array: cut at line breaks, those blank to ``bare`` dropped; the whole if all are blank."""
    kind = "struct<kind:string,text:string>"
    start = F.struct(F.array().cast(f"array<array<{kind}>>").alias("done"), F.array().cast(f"array<{kind}>").alias("now"))
    cut = F.aggregate(
        F.concat(inlines, F.array(F.struct(F.lit("line_break").alias("kind"), F.lit(None).cast("string").alias("text")))),
        start,
        lambda acc, x: F.when(x["kind"] == "line_break", F.struct(F.concat(acc["done"], F.array(acc["now"])).alias("done"),
            F.array().cast(f"array<{kind}>").alias("now"))).otherwise(
            F.struct(acc["done"].alias("done"), F.concat(acc["now"], F.array(x)).alias("now"))
        ),
        lambda acc: acc["done"],
    )
    filled = F.filter(cut, lambda item: filled_item(item, bare))
    return F.when(F.size(filled) > 0, filled).otherwise(F.array(inlines))


def boundaries(found: DataFrame, keys: list[str], order: list[str], start: str, end: Column) -> DataFrame:
    """Chunk i runs from its start to the next one's; the last to ``end``."""
    return found.withColumn("chunk_end", F.coalesce(F.lead(start).over(Window.partitionBy(*keys).orderBy(*order)), end))


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def ranked(rows: DataFrame, keys: list[str], order: str, name: str, buckets: int = 256) -> DataFrame:
    """Row number from zero within ``keys`` by one numeric column, however many rows a key has.

    The column is cut into ranges at approximate quantiles; rows are numbered
    within key and range, and a range starts at the count of those before it. A
    task holds a key's share of one range, not the key.
    """
    cuts = rows.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], 10_000).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    part = F.size(F.filter(F.lit(cuts), lambda c: c < F.col(order))) if cuts else F.lit(0)
    placed = rows.withColumn("_part", part)
    sizes = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_part") == F.col("_p")]
    local = placed.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(order)) - 1)
    return local.join(starts, same).withColumn(name, (F.col("_start") + F.col("_local")).cast("long")).drop("_part", "_p", "_start",
        "_local", *[f"_k{i}" for i in range(len(keys))])


def not_increasing(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value is not greater than that of the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("previous", F.lag(value).over(w)).filter(F.col(value) <= F.col("previous"))
