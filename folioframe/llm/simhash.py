"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. Two that differ in at most three bits differ in at
most one bit of their left or of their right half, so each half is searched for
one differing bit. The anchors of a half are the codewords of the [31, 26]
Hamming code over 31 of its bits: the code covers every word within radius one.
A fingerprint has its *home* at the one anchor within the covering radius, and
is replicated to every anchor within covering radius plus threshold, one plus
one; those are at most 16. Whoever differs from it in one bit of the half
visits its home, so comparing homes with visitors anchor by anchor misses no
pair. Per anchor only a spanning forest of the links leaves the task, and an
anchor with many fingerprints is compared block by block.

Defined results: null and empty texts, and texts without words, have the
fingerprint zero and link like any other; repeated rows are rows of their own
with the same fingerprint; a null id never names a component unless all ids of
the component are null. Only the named columns are read, so other columns may
have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, arrow_schema, batch_of, block_pairs, connected_components, id_and_text, local_labels, slices, sorted_groups, written

_hash = partial(xxhash.xxh64_intdigest, seed=42)
#: Shingles hashed at once, and fingerprints of an anchor compared at once.
PART, BLOCK = 1 << 16, 1024
#: Home and visited anchors by distance in bits of the 31 that the code covers.
CODE_BITS = 31


def fingerprint(text: str | None, words: int = 3) -> int:
    """A bit is set where over half of the shingles' hashes have it set."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, PART):
        end = min(n, at + PART)
        parts = map(b" ".join, zip(*(w[at + i : end + i] for i in range(words)), strict=True)) if len(w) >= words else [b" ".join(w)]
        hashes = np.fromiter(map(_hash, parts), np.uint64, end - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, sign, fp) of every row: sign is a hash of the text, fp the 64 bits as a signed long."""
    out = arrow_schema(doc_id=pa.int64(), sign=pa.int64(), fp=pa.int64())

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield batch_of(out, b["doc_id"], b["sign"], pa.array(np.array([fingerprint(t) for t in b["text"].to_pylist()], np.uint64).view(np.int64)))

    return arrow_map(id_and_text(docs).withColumn("sign", F.xxhash64("text")), made, "doc_id long, sign long, fp long")


def anchors(fps: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of every anchor that a fingerprint has in one half: its home and those it visits."""
    word = (fps.view(np.uint64) >> np.uint64(32 * half)) & np.uint64((1 << CODE_BITS) - 1)
    # the syndrome of a Hamming code is the exclusive or of the set bits' positions, counted from one
    syndrome = np.zeros(len(word), np.int64)
    for i in range(CODE_BITS):
        syndrome ^= np.where((word >> np.uint64(i)) & np.uint64(1), i + 1, 0)
    bit = lambda position: np.where(position > 0, np.uint64(1) << np.maximum(position - 1, 0).astype(np.uint64), np.uint64(0))
    rows, found, home = [np.arange(len(word))], [word ^ bit(syndrome)], [np.ones(len(word), bool)]
    for i in range(1, CODE_BITS + 1):
        j = syndrome ^ i
        at = np.flatnonzero((syndrome > 0) & (j > i))
        rows.append(at)
        found.append(word[at] ^ bit(np.full(len(at), i)) ^ bit(j[at]))
        home.append(np.zeros(len(at), bool))
    return np.concatenate(rows), np.concatenate(found).astype(np.int64) | np.int64(half) << np.int64(CODE_BITS), np.concatenate(home)


def links(distinct: DataFrame, threshold: int = 3) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that span all links of at most ``threshold`` bits, 3 at most."""
    if threshold > 3:
        raise ValueError("halves within one bit cover three differing bits, not more")
    placed = arrow_schema(anchor=pa.int64(), fp=pa.int64(), home=pa.bool_())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = b["fp"].to_numpy()
            for half in (0, 1):
                row, anchor, home = anchors(fps, half)
                yield batch_of(placed, pa.array(anchor), pa.array(fps[row]), pa.array(home))

    edges = arrow_schema(u=pa.int64(), v=pa.int64())

    def compare(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        fp, home = table["fp"].to_numpy(), table["home"].to_numpy()
        bi, bj, bk = (table[c].to_numpy() for c in ("bi", "bj", "bk"))
        homes = np.add.reduceat(home.astype(np.int64), starts[:-1])
        us, vs = [], []
        for g in np.flatnonzero((np.diff(starts) > 1) & (homes > 0)):
            a, z = starts[g], starts[g + 1]
            x = fp[a:z]
            at = np.flatnonzero(home[a:z])
            near = np.bitwise_count(x[at, None].view(np.uint64) ^ x[None, :].view(np.uint64)) <= threshold
            if bi[a] != bj[a]:  # pairs within a block are compared in that block's own group
                near &= bk[a:z][at][:, None] != bk[a:z][None, :]
            if near.sum() <= len(at):  # each meets itself only
                if not (near & (x[at, None] != x[None, :])).any():
                    continue
            linked = np.zeros((len(x), len(x)), bool)
            linked[at] = near
            label = local_labels(linked | linked.T)
            other = np.flatnonzero(label != np.arange(len(x)))
            us.append(x[other])
            vs.append(x[label[other]])
        if us:
            yield batch_of(edges, pa.array(np.concatenate(us)), pa.array(np.concatenate(vs)))

    spread = arrow_map(distinct.select("fp"), place, "anchor long, fp long, home boolean")
    spread = block_pairs(written(spread, "anchors"), ["anchor"], "fp", BLOCK)
    return sorted_groups(spread, ["anchor", "bi", "bj"], compare, "u long, v long")


def near_duplicates(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """(doc_id, sign, fp, component, component_id) of every row.

    component names the group by a fingerprint; component_id is the smallest id
    reachable by links.
    """
    rows = written(fingerprints(docs), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    component = connected_components(links(distinct, threshold))
    named = distinct.join(component, distinct["fp"] == component["node"], "left").select("fp", "least", F.coalesce("component",
        "fp").alias("component"))
    named = written(named, "named")
    least = written(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = written(named.join(least, "component").select(F.col("fp").alias("own_fp"), "component", "component_id"), "components")
    return rows.join(named, rows["fp"] == named["own_fp"]).select("doc_id", "sign", "fp", "component", "component_id")


def simhash(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group, all columns kept: that with the group's smallest id.

    Rows are known by id and text, so an id that texts of several groups share
    costs no group its row; of rows of equal id and text one stays, the first by
    its JSON form. Which rows stay is decided on ids and hashes alone; whole rows
    are shuffled once, and compared only where a row that stays is there twice.
    The rows' own columns travel as one struct, so they may have any name.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sign")).alias("first")
    found = written(near_duplicates(docs).select("doc_id", "sign", "component"), "named-rows")
    kept = found.groupBy("component").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.sign").alias("kept_sign"))
    kept = written(kept.distinct(), "kept")
    key = [F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(F.col("text").cast("string")).alias("own_sign")]
    rows = docs.select(*key, F.struct("*").alias("row"))
    same = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_sign") == F.col("kept_sign"))
    stay = rows.join(kept, same, "left_semi")
    copies = found.groupBy("doc_id", "sign").agg(F.count("*").alias("n")).filter("n > 1")
    at = F.col("kept_id").eqNullSafe(F.col("doc_id")) & (F.col("kept_sign") == F.col("sign"))
    repeated = written(kept.join(copies, at, "left_semi"), "repeated")
    if repeated.isEmpty():
        return stay.select("row.*")
    once = stay.join(repeated, same, "left_anti").select("row")
    one = stay.join(repeated, same, "left_semi").groupBy("own_id", "own_sign").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return once.unionAll(one.select("row")).select("row.*")
