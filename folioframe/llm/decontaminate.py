"""Benchmark decontamination: size-partitioned MinHash containment search, exact verification.

Texts are lower-cased words; an item is the set of its five-word shingles. An
item of n < 5 words is its one n-word shingle, looked for among the n-word
shingles of all documents. Items are partitioned by size; each
partition keeps, of every item, the bottom-k MinHash sketch with k the number of
shingles that may be missing at the threshold, plus one. So a document that contains an
item holds at least one sketch shingle: the search loses nothing. Documents too
short for a size partition skip it. Candidates are verified on the shingles
themselves.

Items of one block are broadcast and met where the documents are. More items
than that are met by hash joins instead, with one pass over the documents
whatever their number: a bitmap of fixed size keeps out shingles that no sketch
has, the rest join the sketches, and the candidates' shingles join each other.

Defined results: items and documents without words match nothing; a document
shorter than five words can hold shorter items only; repeated items and repeated
documents each give their rows; null ids are carried. Only the named columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.styles import small
from .common import arrow_map, arrow_schema, batch_of, id_and_text, on_workers, slices, words_of, written

_hash = partial(xxhash.xxh64_intdigest, seed=11)
_MIX = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 400_000


@dataclass(frozen=True)
class Containment:
    """At most ``block_items`` items of at most ``block_bytes`` of text are broadcast; ``bitmap_bits`` (a multiple of 32,768) bounds what is for more."""

    words: int = 5
    threshold: float = 0.8
    block_items: int = 20_000
    block_bytes: int = 16 << 20
    bitmap_bits: int = 1 << 27


def shingles(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[i:] for i in range(n)), strict=False)) if len(words) >= n else {tuple(words)} if words else set()


class Hasher:
    """64-bit hashes of all shingles of a word list, by mixing remembered word hashes."""

    def __init__(self, n: int, known: dict[bytes, int] | None = None):
        self.n, self.known = n, {} if known is None else known

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = _hash(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(words))
        mixed = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ h[i : len(h) - n + 1 + i]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        return mixed * _MIX


def sketch_of(hashes: np.ndarray, size: int, p: Containment) -> np.ndarray:
    """The bottom-k hashes of an item, k by the largest size of its partition."""
    largest = (1 << size.bit_length()) - 1
    return np.unique(hashes)[: largest - int(np.ceil(largest * p.threshold - 1e-9)) + 1]


@dataclass(frozen=True)
class Partition:
    """Sketches of the items of one size class: hashes in order, whose items they are, and the fewest shingles a document needs."""

    least: int
    keys: np.ndarray
    owners: np.ndarray


class Index:
    """Sketches of one block of items, in partitions by size."""

    def __init__(self, items: list[tuple[int | None, str | None]], p: Containment):
        hasher = Hasher(p.words)
        self.items, short = [], set()
        parts: dict[int, list[tuple[np.ndarray, int, int]]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if not (own := shingles(words, p.words)):
                continue
            need = int(-(-len(own) * p.threshold // 1))
            parts[len(own).bit_length()].append((sketch_of(hasher(words), len(own), p), len(self.items), need))
            self.items.append((item_id, own, need))
            short |= {len(words)} & set(range(1, p.words))
        self.maybe = np.zeros(1 << 16, bool)
        self.partitions = [self._partition(found) for _, found in sorted(parts.items())]
        self.p, self.hashers = p, [Hasher(n, hasher.known) for n in (*sorted(short), p.words)]

    def _partition(self, found: list[tuple[np.ndarray, int, int]]) -> Partition:
        keys = np.concatenate([sketch for sketch, *_ in found])
        owners = np.repeat([item for _, item, _ in found], [len(sketch) for sketch, *_ in found])
        order = np.argsort(keys, kind="stable")
        self.maybe[(keys >> np.uint64(48)).astype(np.int64)] = True
        return Partition(min(need for *_, need in found), keys[order], owners[order].astype(np.int64))

    def found(self, words: list[bytes]) -> Iterator[tuple[int | None, int, int]]:
        """(item_id, shingles wanted, shingles shared) of every item contained; n-word shingles for items of n words."""
        for hasher in self.hashers:
            if hasher.n <= len(words) and (candidates := self.search(hasher(words))):
                own = shingles(words, hasher.n)
                for i in sorted(candidates):
                    item_id, wanted, need = self.items[i]
                    if len(own) >= need and (n := len(wanted & own)) >= len(wanted) * self.p.threshold:
                        yield item_id, len(wanted), n

    def search(self, hashes: np.ndarray) -> set[int]:
        """Items of which some sketch hash is among ``hashes``; a document of fewer shingles than a partition needs skips it."""
        h, out = np.unique(hashes[self.maybe[(hashes >> np.uint64(48)).astype(np.int64)]]), set()
        if not len(h):
            return out
        for part in self.partitions:
            if part.least > len(hashes):
                break
            a, z = np.searchsorted(part.keys, h, "left"), np.searchsorted(part.keys, h, "right")
            hit = np.flatnonzero(z > a)
            for i, j in zip(a[hit].tolist(), z[hit].tolist(), strict=True):
                out.update(part.owners[i:j].tolist())
        return out


def _block(items: DataFrame, p: Containment) -> Broadcast | None:
    """All items, if they are one block."""
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    if size["n"] > p.block_items or size["b"] > p.block_bytes:
        return None
    return items.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])


def _items(items: DataFrame) -> DataFrame:
    return id_and_text(items, "item_id").withColumnRenamed("doc_id", "item_id")


FOUND = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"


def contained(docs: DataFrame, items: DataFrame, p: Containment = Containment()) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every pair at or over the threshold."""
    texts, items = id_and_text(docs), _items(items)
    out = arrow_schema(doc_id=pa.int64(), item_id=pa.int64(), n_shingles=pa.int64(), n_shared=pa.int64(), containment=pa.float64())
    block = _block(items, p)
    if block is None:
        keyed = texts.withColumn("sign", F.xxhash64("text"))
        met = _met(keyed, items, p)
        same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("sign") == F.col("of_sign"))
        return keyed.select("doc_id", "sign").join(met, same).select("doc_id", "item_id", "n_shingles", "n_shared", "containment")

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for b in slices(batches):
            index = index or Index(block.value, p)
            rows = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                rows += [(doc_id, item_id, wanted, n, n / wanted) for item_id, wanted, n in index.found(words_of(text))]
            yield batch_of(out, *([list(x) for x in zip(*rows, strict=True)] or [[]] * 5))

    return arrow_map(texts, matched, FOUND)


def _met(keyed: DataFrame, items: DataFrame, p: Containment) -> DataFrame:
    """(of, of_sign, item_id, n_shingles, n_shared, containment) of distinct (doc_id, sign) and every item, by joins alone."""
    spark = keyed.sparkSession
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "items")
    sketched = arrow_schema(item=pa.int64(), n=pa.int32(), hash=pa.int64())
    parted = arrow_schema(item=pa.int64(), n=pa.int32(), shingle=pa.binary(), n_shingles=pa.int64())

    def sizes(words: list[bytes]) -> int:
        return min(len(words), p.words)

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for item, text in zip(b["item"].to_pylist(), b["text"].to_pylist(), strict=True):
                if words := words_of(text):
                    found = sketch_of(Hasher(p.words)(words), len(shingles(words, p.words)), p).view(np.int64)
                    yield batch_of(sketched, [item] * len(found), [sizes(words)] * len(found), pa.array(found))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for item, text in zip(b["item"].to_pylist(), b["text"].to_pylist(), strict=True):
                if own := shingles(words := words_of(text), p.words):
                    yield batch_of(parted, [item] * len(own), [sizes(words)] * len(own), list(map(b" ".join, own)), [len(own)] * len(own))

    sketch = written(arrow_map(items.select("item", "text"), sketches, "item long, n int, hash long"), "sketches")
    lengths = [r["n"] for r in sketch.select("n").distinct().collect()]  # five at most
    place, segment = F.pmod("hash", F.lit(p.bitmap_bits)), 1 << 15
    filled = sketch.groupBy(F.floor(place / segment).alias("k")).agg(F.bitmap_construct_agg(F.pmod(place, F.lit(segment))).alias("bits"))
    bitmap = np.zeros(p.bitmap_bits // 8, np.uint8)
    for r in filled.collect():  # as many rows as the bitmap has segments
        bitmap[r["k"] * segment // 8 : (r["k"] + 1) * segment // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)
    hit = arrow_schema(doc_id=pa.int64(), sign=pa.int64(), n=pa.int32(), hash=pa.int64())

    def hashers(words: list[bytes], known: dict) -> Iterator[Hasher]:
        """Of the lengths that items' shingles have, those that fit the document."""
        return (Hasher(n, known) for n in lengths if n <= len(words))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for b in slices(batches):
            for doc_id, sign, text in zip(b["doc_id"].to_pylist(), b["sign"].to_pylist(), b["text"].to_pylist(), strict=True):
                words = words_of(text)
                for hasher in hashers(words, known):
                    h = np.unique(hasher(words)).view(np.int64)
                    at = np.mod(h, p.bitmap_bits)
                    h = h[(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]
                    if len(h):
                        yield batch_of(hit, [doc_id] * len(h), [sign] * len(h), [hasher.n] * len(h), pa.array(h))

    def own_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for doc_id, sign, text in zip(b["doc_id"].to_pylist(), b["sign"].to_pylist(), b["text"].to_pylist(), strict=True):
                words = words_of(text)
                for n in lengths:
                    if n <= len(words):
                        own = shingles(words, n)
                        yield batch_of(exact, [doc_id] * len(own), [sign] * len(own), [n] * len(own), list(map(b" ".join, own)))

    exact = arrow_schema(doc_id=pa.int64(), sign=pa.int64(), n=pa.int32(), shingle=pa.binary())
    on = lambda *names: [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names]
    candidates = arrow_map(keyed.select("doc_id", "sign", "text"), hits, "doc_id long, sign long, n int, hash long").alias("a")
    pairs = candidates.join(sketch.alias("b"), on("n", "hash")).select("a.doc_id", "a.sign", "b.item").distinct()
    pairs = written(pairs, "pairs")
    of_docs = keyed.alias("a").join(pairs.select("doc_id", "sign").distinct().alias("b"), on("doc_id", "sign"), "left_semi")
    of_docs = of_docs.dropDuplicates(["doc_id", "sign"]).select("doc_id", "sign", "text")
    have = arrow_map(of_docs, own_parts, "doc_id long, sign long, n int, shingle binary")
    wanted = arrow_map(items.select("item", "text"), parts, "item long, n int, shingle binary, n_shingles long")
    asked = pairs.alias("a").join(wanted.alias("b"), on("item")).select("a.doc_id", "a.sign", "a.item", "b.n", "b.shingle", "b.n_shingles")
    met = asked.alias("a").join(have.alias("b"), on("doc_id", "sign", "n", "shingle")).groupBy("a.doc_id", "a.sign", "a.item", "a.n_shingles")
    met = met.agg(F.count("*").alias("n_shared")).filter(F.col("n_shared") >= F.col("n_shingles") * F.lit(p.threshold))
    named = met.join(items.select(F.col("item").alias("i"), "item_id"), F.col("item") == F.col("i"))
    share = (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    return written(named.select(F.col("doc_id").alias("of"), F.col("sign").alias("of_sign"), "item_id", "n_shingles", "n_shared", share), "contained")


def _clean(block: Broadcast, p: Containment):
    """Whether a text contains no item of the block."""

    @F.pandas_udf("boolean")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(block.value, p)
        for texts in parts:
            yield pd.Series([next(index.found(words_of(text)), None) is None for text in texts], dtype=bool)

    return clean


def drop_contaminated(docs: DataFrame, items: DataFrame, p: Containment = Containment()) -> DataFrame:
    """Documents that contain no item, all their columns kept.

    Items of one block judge each row where it stands, so no join is needed; more
    items give ids and hashes of texts, which rows are held against.
    """
    on_workers(docs.sparkSession)
    block = _block(_items(items), p)
    if block is not None:
        return docs.filter(_clean(block, p)(F.col("text").cast("string")))
    keyed = id_and_text(docs).withColumn("sign", F.xxhash64("text"))
    gone = written(_met(keyed, _items(items), p).select("of", "of_sign").distinct(), "contaminated")
    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(F.col("text").cast("string")).alias("own_sign"),
        F.struct("*").alias("row"))
    same = F.col("own_id").eqNullSafe(F.col("of")) & (F.col("own_sign") == F.col("of_sign"))
    return rows.join(small(gone), same, "left_anti").select("row.*")


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], p: Containment = Containment()) -> set[tuple[int, int]]:
    """What ``contained`` finds of items of five words or more, pair by pair: for tests."""
    inverted = defaultdict(set)
    sets = {i: shingles(words_of(t), p.words) for i, t in items}
    for i, s in sets.items():
        for g in s:
            inverted[g].add(i)
    return {(d, i) for d, t in docs for own in [shingles(words_of(t),
        p.words)] for i in {i for g in own & set(inverted) for i in inverted[g]} if len(sets[i] & own) >= len(sets[i]) * p.threshold}
