"""Reading order of stories: frames, their threads' roots, first appearance, rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: What decides between frames of one id: page frames before masters, then the earlier place.
PLACE = ("is_master", "spread_index", "order_in_spread")


def one_each(frames: DataFrame) -> DataFrame:
    """One row a (book_id, self_id): the first by place, of equal places the least by its other columns."""
    place = [c for c in PLACE if c in frames.columns]
    rest = [c for c in frames.columns if c not in ("book_id", "self_id", *place)]
    first = F.min(F.struct(*place, *rest)).alias("_first")
    return frames.groupBy("book_id", "self_id").agg(first).select(*[F.col(c if c in ("book_id",
        "self_id") else f"_first.{c}").alias(c) for c in frames.columns])


def thread_roots(frames: DataFrame, hops: int = 10_000, unique: bool = False) -> DataFrame:
    """(book_id, self_id, root_id): previous pointers followed to their end, one row a frame however often it is listed.

    Pointer doubling: every round looks up where each open frame's target itself
    points, so a chain of n frames takes about log2 n rounds, not n. Frames whose
    target is a root are settled and take no part in later rounds; each round
    writes the open frames only. A pointer to no known frame, or to itself, ends
    the chase at the last known one; a chase of ``hops`` steps ends where it
    stands, as does a cycle. ``unique`` says that no frame is listed twice.
    """
    pointer = F.nullif(F.nullif(F.coalesce("prev_id", F.lit("n")), F.lit("n")), F.lit(""))
    known = frames if unique else one_each(frames.select("book_id", "self_id", "prev_id", *[c for c in PLACE if c in frames.columns]))
    known = known.select("book_id", "self_id", F.nullif(pointer, F.col("self_id")).alias("up"))
    ids = known.select(F.col("book_id").alias("b"), F.col("self_id").alias("s"))
    at = (F.col("book_id") == F.col("b")) & (F.col("up") == F.col("s"))
    first = written(known.join(ids, at, "left").select("book_id", "self_id", F.coalesce("s", "self_id").alias("up"),
        (F.col("s").isNotNull()).alias("open")), "frames")
    done, open_, steps = first.filter(~F.col("open")).drop("open"), first.filter("open").drop("open"), 1
    while steps < hops and not open_.isEmpty():
        look = done.unionAll(open_).select(F.col("book_id").alias("b"), F.col("self_id").alias("s"), F.col("up").alias("upper"))
        moved = open_.join(look, at).select("book_id", "self_id", F.col("upper").alias("up"), (F.col("up") != F.col("upper")).alias("open"))
        moved = written(moved, "frames")
        done, open_, steps = done.unionAll(moved.filter(~F.col("open")).drop("open")), moved.filter("open").drop("open"), steps * 2
    return done.unionAll(open_).withColumnRenamed("up", "root_id")


def reading_order(frames: DataFrame, include_masters: bool = False) -> DataFrame:
    """(book_id, story_id, first_frame_id, spread_index, order_in_spread, is_master, story_ord).

    A story stands where its thread's root does; page frames before masters;
    equal places keep the order of first appearance.
    """
    rows = frames.filter(F.coalesce("parent_story", F.lit("")) != "")
    if not include_masters:
        rows = rows.filter(~F.col("is_master"))
    rows = written(one_each(rows.select("book_id", "self_id", "parent_story", "prev_id", *PLACE)), "frames")
    first = rows.groupBy("book_id", "parent_story").agg(F.min(F.struct(*PLACE, "self_id")).alias("seen")).withColumn("self_id", F.col("seen.self_id"))
    at = rows.select("book_id", F.col("self_id").alias("root_id"), "spread_index", "order_in_spread", "is_master")
    placed = first.join(thread_roots(rows, unique=True), ["book_id", "self_id"]).join(at, ["book_id", "root_id"])
    rank = F.row_number().over(Window.partitionBy("book_id").orderBy("is_master", "spread_index", "order_in_spread", "seen"))
    return placed.select(
        "book_id", F.col("parent_story").alias("story_id"), F.col("root_id").alias("first_frame_id"),
        "spread_index", "order_in_spread", "is_master", (rank - 1).alias("story_ord"),
    )
