"""Embedding near-duplicates: sign hashes of random hyperplanes in several tables, exact cosines, components.

Equal vectors of a label form a class, hashed once. A table's key is the signs
of its hyperplanes; classes of one label that share a key in some table are
compared by cosine in double precision. A pair counts in the first table that
brings it together: signs of earlier tables are made again, for linked rows
alone. Counts of links leave a task summed per class and links as a spanning
forest, so a group's output grows with its rows, not its pairs.

Keys hold ``per_key`` classes about, which one task compares tile by tile; large
keys make few tables, and each table costs one copy of the vectors in the
shuffle, in single precision where they came so. The number of hyperplanes
follows the largest label, and the number of tables follows from it: a pair at
the threshold shares a key with probability ``recall`` at least. A key with more
than ``block`` classes is compared block by block.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing; vectors of unequal
length never link; repeated rows are vectors of their own, linked with each
other; a null vec_id never names a component unless all of it are null. Only
the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.styles import small
from .common import arrow_map, arrow_schema, batch_of, connected_components, slices, sorted_groups, written

#: Rows of a group compared with all its rows at once.
TILE = 256


@dataclass(frozen=True)
class Planes:
    threshold: float = 0.93
    recall: float = 0.9999
    per_key: int = 2048
    block: int = 4096
    seed: int = 20_250_101

    def shape(self, classes: int) -> tuple[int, int]:
        """(hyperplanes of a table, tables) for so many classes of a label."""
        bits = min(60, round(math.log2(max(1.0, classes / self.per_key))))
        meet = (1 - math.acos(self.threshold) / math.pi) ** bits
        return bits, 1 if meet >= self.recall else math.ceil(math.log(1 - self.recall) / math.log(1 - meet))


class Signs:
    """Keys of vectors in every table; the hyperplanes follow from the seed and the vectors' length."""

    def __init__(self, p: Planes, bits: int, tables: int):
        self.p, self.bits, self.tables, self.planes = p, bits, tables, {}
        self.weights = (1 << np.arange(bits)).astype(np.int64)

    def __call__(self, x: np.ndarray, tables: int | None = None) -> np.ndarray:
        """(rows, tables) of the rows of a matrix."""
        tables, dim = self.tables if tables is None else tables, x.shape[1]
        if (plane := self.planes.get(dim)) is None:
            plane = self.planes[dim] = np.random.default_rng(self.p.seed + dim).standard_normal((self.tables * self.bits, dim))
        # one row at a time: a matrix product may round a row otherwise in another company
        side = np.array([plane[: tables * self.bits] @ row for row in scaled(x)]) > 0
        return side.reshape(len(x), tables, self.bits).astype(np.int64) @ self.weights


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows by powers of two, which is exact, so that squares cannot overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _valid(vector: F.Column) -> F.Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector,
        lambda x: x != 0)


def forest(near: np.ndarray) -> np.ndarray:
    """Smallest reachable index of every row of a symmetric boolean matrix, tile by tile."""
    n = len(near)
    label = np.arange(n)
    while True:
        least = [np.where(near[a : a + TILE], label[None, :], n).min(axis=1, initial=n) for a in range(0, n, TILE)]
        best = np.minimum(label, np.concatenate(least))
        best = best[best]
        if (best == label).all():
            return label
        label = best


def compared(x: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows have a cosine at or over the threshold, themselves left out."""
    x = scaled(x)
    norm = np.sqrt((x * x).sum(axis=1))
    near = np.empty((len(x), len(x)), bool)
    for a in range(0, len(x), TILE):
        near[a : a + TILE] = x[a : a + TILE] @ x.T / np.outer(norm[a : a + TILE], norm) >= threshold
    near |= near.T  # tiles may round the two orders of a pair differently
    np.fill_diagonal(near, False)
    return near


def near_duplicates(vectors: DataFrame, p: Planes = Planes()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    dtype = np.dtype("<f4" if kind == "float" else "<f8")
    columns = {"vec_id": "long", "label": "string", "embedding": f"array<{kind}>"}
    rows = vectors.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()]).withColumnRenamed("embedding", "v")
    zero = F.lit(0.0).cast(kind)
    rows = rows.withColumn("v", F.when(_valid(F.col("v")), F.transform("v", lambda x: x + zero)))  # one zero, not two
    key = F.unhex(F.substring(F.sha2(F.concat_ws("|", F.col("label"), F.col("v").cast("string")).cast("binary"), 256), 1, 32))
    rows = written(rows.withColumn("class", F.when(F.col("v").isNotNull(), key)), "vectors")
    # the vector of a class is that of any of its rows: they are equal
    grouped = rows.filter("class is not null").groupBy("class")
    classes = grouped.agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = written(classes, "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs = Signs(p, *p.shape(largest))
    hashed = arrow_schema(class_=pa.binary(), copies=pa.int64(), label=pa.string(), dim=pa.int32(), v=pa.binary(), signs=pa.list_(pa.int64()))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made = [np.asarray(v.values, dtype) for v in b["v"]]
            dims = np.array(list(map(len, made)))
            keys: list = [None] * len(made)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                found = signs(np.stack([made[i] for i in at]).astype(np.float64)).tolist()
                for i, k in zip(at.tolist(), found, strict=True):
                    keys[i] = k
            yield batch_of(hashed, b["class"], b["copies"], b["label"], dims, [v.tobytes() for v in made], keys)

    listed = "class binary, copies long, label string, dim int, v binary, signs array<long>"
    signed = arrow_map(classes.select("class", "copies", "label", "v"), sign, listed)
    keys = ["label", "dim", "t", "sign"]
    dealt = signed.select("class", "copies", "label", "dim", "v", F.posexplode("signs").alias("t", "sign"))
    dealt = _blocks(dealt, keys, p.block)
    out = arrow_schema(u=pa.binary(), v=pa.binary(), n=pa.int64())

    def compare(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        t, bi, bj, bk, copies = (table[c].to_numpy() for c in ("t", "bi", "bj", "bk", "copies"))
        for a, z in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if z - a < 2:
                continue
            x = np.frombuffer(b"".join(table["v"].slice(a, z - a).to_pylist()), dtype).reshape(z - a, -1).astype(np.float64)
            near = compared(x, p.threshold)
            if bi[a] != bj[a]:  # pairs within a block are compared in that block's own group
                near &= bk[a:z, None] != bk[None, a:z]
            linked = np.flatnonzero(near.any(axis=1))
            if not len(linked):
                continue
            near = near[np.ix_(linked, linked)]
            if t[a]:
                before = signs(x[linked], int(t[a]))
                for k in range(t[a]):  # pairs that an earlier table brought together count there
                    near &= before[:, k, None] != before[None, :, k]
            counts = near @ copies[a:z][linked]
            at = np.flatnonzero(counts)
            if len(at):
                name, label = np.array(table["class"].slice(a, z - a).to_pylist(), object)[linked], forest(near)
                yield batch_of(out, name[at].tolist(), name[label[at]].tolist(), counts[at].tolist())

    found = written(sorted_groups(dealt, [*keys, "bi", "bj"], compare, "u binary, v binary, n long"), "links")
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    component = connected_components(found.select("u", "v"))
    named = classes.select("class", "copies", "least").join(component, F.col("class") == F.col("node"), "left")
    named = named.join(counts, F.col("class") == F.col("u"), "left")
    n_links = (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    named = written(named.select("class", "least", n_links, F.coalesce("component", "class").alias("component")), "named")
    least = written(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = written(named.join(least, "component").select(F.col("class").alias("own"), "n_links", "component_id"), "components")
    joined = rows.select("vec_id", "class").join(named, rows["class"] == named["own"], "left")
    component_id = F.when(F.col("own").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    counted = F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    return joined.select("vec_id", counted, component_id.alias("component_id"), F.col("vec_id").eqNullSafe(component_id).alias("kept"))


def _blocks(dealt: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``dealt`` with the blocks of ``common.block_pairs``; sizes are counted on the keys alone, and only those of large keys are joined."""
    sizes = written(dealt.select(*keys).groupBy(*keys).agg(F.count("*").alias("group_rows")).filter(F.col("group_rows") > most), "large")
    named = small(sizes.select(*[F.col(k).alias(f"size_{k}") for k in keys], "group_rows"))
    joined = dealt.join(named, [F.col(k) == F.col(f"size_{k}") for k in keys], "left")
    blocks = F.ceil(F.coalesce(F.col("group_rows"), F.lit(1)) / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64("class", F.lit(7)), F.col("blocks")).cast("int")
    spread = joined.withColumn("blocks", blocks).withColumn("bk", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.withColumn("bi", F.least("bk", "other")).withColumn("bj", F.greatest("bk", "other")).select(*dealt.columns, "bi", "bj", "bk")
