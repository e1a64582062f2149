"""What the training-data operators share: written tables, Arrow mapping, sorted groups, components.

Nothing here gathers rows on the driver, keeps a group whole in one task without
a bound, or leaves files outside the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete, drop_scratch, on_workers, scratch_path, written  # noqa: F401

#: Rows handled at once inside a Python worker; long texts stay few at a time.
SLICE_ROWS = 1000

#: ASCII letters, digits and every byte above ASCII stay; all other bytes part words.
WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; null and empty texts have none."""
    return text.lower().encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that other columns can have any name."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def learnable(id_col: str = "doc_id") -> F.Column:
    """Rows that labels may be learned from: crc32 of the id as text, mod 4, is not 2."""
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4) != 2


def held_out(id_col: str = "doc_id") -> F.Column:
    """The rest; a null id is never learned from and counts as not held out."""
    return F.coalesce((F.crc32(F.col(id_col).cast("string").cast("binary")) % 4) == 2, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    on_workers(df.sparkSession)
    return df.mapInArrow(fn, schema)


def arrow_schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field(k, v) for k, v in kinds.items()])


def _column(batch: pa.RecordBatch, name: str):
    column = batch.column(name)
    return column.to_numpy(zero_copy_only=False)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of sorted rows, cut anew so that no group of equal keys is parted."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = _column(batch, k)
            change[1:] |= v[1:] != v[:-1]
        if rest and any(rest[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(rest)
            rest = []
        starts = np.flatnonzero(change)
        if len(starts):
            yield pa.Table.from_batches([*rest, batch.slice(0, starts[-1])])
            rest = [batch.slice(starts[-1])]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def sorted_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Deal rows out by ``keys``, sort, and hand ``fn`` tables of whole groups with the groups' start offsets.

    One Python call serves thousands of small groups. The caller bounds group
    sizes (see ``block_pairs``).
    """
    on_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            change = np.zeros(table.num_rows, bool)
            change[0] = True
            for k in keys:
                v = table.column(k).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            yield from fn(table, np.append(np.flatnonzero(change), table.num_rows))

    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(run, schema)


def block_pairs(df: DataFrame, keys: list[str], item: str, most: int) -> DataFrame:
    """Split groups of more than ``most`` rows into blocks and deal every pair of blocks to a group of its own.

    Adds ``bi`` and ``bj`` (bi <= bj) and ``bk``, the row's own block. Two rows of
    one key meet in exactly one group (bi, bj) with bi, bj their blocks; rows of
    the same block meet in (b, b). So no pair is lost, no task holds more than
    about two blocks of a group, and small groups are not copied.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("group_rows")).filter(F.col("group_rows") > most)
    joined = df.join(sizes.withColumnsRenamed({k: f"size_{k}" for k in keys}), on=[df[k].eqNullSafe(F.col(f"size_{k}")) for k in keys], how="left")
    blocks = F.ceil(F.coalesce(F.col("group_rows"), F.lit(1)) / F.lit(most)).cast("int")
    return (
        joined.withColumn("blocks", blocks)
        .withColumn("bk", F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("bi", F.least("bk", "other"))
        .withColumn("bj", F.greatest("bk", "other"))
        .select(*df.columns, "bi", "bj", "bk")
    )


def local_labels(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable index of every node of a small undirected graph, given as a boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        best = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
        best = best[best]
        if (best == label).all():
            return label
        label = best


def connected_components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, component) for the undirected edges (u, v): component is the smallest node reachable.

    Smallest-label spreading with pointer jumping. Each round's labels are
    written to the shared folder, where the next reads them: joins are between
    plain scans, so a hub's edges or a large component's label can be split by
    adaptive execution, and lost executors cost one round at most. A round's
    tables are removed when the next round's are whole. Loops and null ends are
    no edges; an empty input gives an empty result.
    """
    spark, old = edges.sparkSession, []

    def round_table(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        old.append(path)
        return spark.read.schema(df.schema).parquet(path)

    e = edges.select("u", "v").filter(F.col("u") != F.col("v"))
    e = written(e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    label = round_table(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    for _ in range(rounds):
        near = e.join(label, e["v"] == label["node"]).groupBy("u").agg(F.min("label").alias("m"))
        spread = label.join(near, label["node"] == near["u"], "left")
        spread = round_table(spread.select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "spread")
        top = spread.select(F.col("node").alias("top"), F.col("label").alias("top_label"))
        jumped = F.least("label", "top_label")
        joined = spread.join(top, spread["label"] == top["top"])
        label = round_table(joined.select("node", jumped.alias("label"), (F.col("old") != jumped).alias("moved")), "labels")
        while len(old) > 1:
            delete(spark, old.pop(0))
        if label.filter("moved").isEmpty():
            return label.select("node", F.col("label").alias("component"))
        label = label.select("node", "label")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def most_frequent(df: DataFrame, count: str, key: str, most: int) -> DataFrame:
    """The rows of highest ``count``, about ``most`` of them and not more.

    The count is cut by a histogram of fine logarithmic steps, a few hundred
    rows on the driver, so no task gathers candidates. Of the step that would
    exceed the bound, rows stay by a hash of ``key``, as many as there is room.
    """
    step = F.floor(F.log2(F.col(count)) * 16).cast("int")
    part = F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(1024))
    sizes = df.groupBy(step.alias("step"), part.alias("part")).agg(F.count("*").alias("rows"))
    by_step = sizes.groupBy("step").agg(F.sum("rows").alias("rows")).collect()
    total = 0
    for s, n in sorted(((r["step"], r["rows"]) for r in by_step), reverse=True):
        if total + n > most:
            inside = sorted((r["part"], r["rows"]) for r in sizes.filter(F.col("step") == s).collect())
            room, below = most - total, 0
            for part_no, rows in inside:
                if rows > room:
                    break
                room, below = room - rows, part_no + 1
            return df.filter((step > s) | ((step == s) & (part < below)))
        total += n
    return df
