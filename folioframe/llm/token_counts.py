"""Token counts without ids: pieces are counted once per distinct pre-token.

First the distinct pre-tokens of all texts, with how often they occur, have
their pieces counted by the tokenizers library. Then every document's pre-token
frequencies are joined to those counts and summed. The join is a hybrid: the
``head`` most frequent pre-tokens, that many at most, are broadcast and summed
where the text is; what remains of a document's frequencies, its rare
pre-tokens, joins by shuffle. A pre-token longer than ``key_chars`` is known by
its digest, so rules of dashes and the like are in the head as any other, and a
key is short wherever it goes. Every count is exact whatever the head.

Defined results: null and empty texts have no bytes and no tokens; repeated rows
are counted each; texts whose pre-tokens the pattern cannot give are coded whole
by the library. Only the named columns are read, so other columns may have any
name.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, arrow_schema, batch_of, id_and_text, most_frequent, slices, written
from .pretokens import Whole, pretokenizer


@dataclass(frozen=True)
class Counting:
    """At most ``head`` keys of at most ``key_chars`` characters are broadcast; ``gathered`` distinct pre-tokens are held before a task passes them on."""

    limit: int = 512
    head: int = 200_000
    key_chars: int = 64
    gathered: int = 400_000


def _parts(tok, text: str) -> tuple[list[str], int]:
    """Pre-tokens of a text and its number of special tokens; raises Whole."""
    if not tok.plain:
        raise Whole
    if tok.split is None or not any(x in text for x in tok.special):
        return tok.pieces(text), 0
    found, special = [], 0
    for i, part in enumerate(tok.split.split(text)):
        if i % 2:
            special += 1
        else:
            found += tok.pieces(part)
    return found, special


def key_of(piece: str, most: int) -> str:
    """A short pre-token itself, a longer one by its digest, behind a zero that no pre-token has before letters."""
    return piece if len(piece) <= most else "\0" + hashlib.blake2b(piece.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _n(tok, piece: str) -> int:
    return len(tok.code(piece)) // tok.dtype.itemsize


def token_counts(docs: DataFrame, path: str, p: Counting = Counting()) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    texts = id_and_text(docs)
    spark = docs.sparkSession
    piece_schema = arrow_schema(piece=pa.string(), n=pa.int64())

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, seen = pretokenizer(path), Counter()
        for b in slices(batches):
            for text in b["text"].to_pylist():
                if text:
                    try:
                        seen.update(_parts(tok, text)[0])
                    except Whole:
                        continue
                if len(seen) > p.gathered:
                    yield batch_of(piece_schema, list(seen), list(seen.values()))
                    seen.clear()
        yield batch_of(piece_schema, list(seen), list(seen.values()))

    coded = arrow_schema(key=pa.string(), n=pa.int64(), pieces=pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = pretokenizer(path)

        def of(piece: str) -> int:
            try:
                return _n(tok, piece)
            except Whole:  # a character that the pattern leaves to the library: never in the head, so its texts are coded whole
                return 0

        for b in batches:
            pieces = b["piece"].to_pylist()
            yield batch_of(coded, [key_of(x, p.key_chars) for x in pieces], b["n"], list(map(of, pieces)))

    pieces = arrow_map(texts.select("text"), distinct, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = written(arrow_map(pieces, count, "key string, n long, pieces long"), "pieces")
    top = most_frequent(pieces.filter(F.col("pieces") > 0), "n", "key", p.head).select("key", "pieces").toArrow()
    head = spark.sparkContext.broadcast(dict(zip(top["key"].to_pylist(), top["pieces"].to_pylist(), strict=True)))

    tail = pa.list_(pa.struct([("key", pa.string()), ("n", pa.int32())]))
    base = arrow_schema(uid=pa.int64(), doc_id=pa.int64(), n_bytes=pa.int64(), n_head=pa.int64(), tail=tail)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, known, whole = pretokenizer(path), head.value, tok_whole(path)
        uid = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for b in slices(batches):
            rows = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                uid += 1
                text = text or ""
                n_bytes = len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))
                try:
                    found, n = _parts(tok, text)
                    counts, rare = list(map(known.get, found)), Counter()
                    if None in counts:
                        n += sum(filter(None, counts))
                        for piece, c in zip(found, counts, strict=True):
                            if c is None:
                                if len(piece) == 1:
                                    tok.code(piece)  # raises Whole for a character the pattern leaves to the library
                                key = key_of(piece, p.key_chars)
                                if (c := known.get(key)) is None:
                                    rare[key] += 1
                                else:
                                    n += c
                    else:
                        n += sum(counts)
                except Whole:
                    n, rare = whole(text), {}
                rows.append((uid, doc_id, n_bytes, n, [{"key": k, "n": v} for k, v in rare.items()]))
            yield batch_of(base, *([list(x) for x in zip(*rows, strict=True)] or [[]] * 5))

    kinds = "uid long, doc_id long, n_bytes long, n_head long, tail array<struct<key:string,n:int>>"
    rows = written(arrow_map(texts, frequencies, kinds), "frequencies")
    rare = rows.select("uid", F.explode("tail").alias("t")).select("uid", F.col("t.key").alias("rare"), F.col("t.n").alias("times"))
    met = rare.join(pieces, rare["rare"] == pieces["key"]).groupBy(F.col("uid").alias("of"))
    sums = met.agg(F.sum(F.col("times") * F.col("pieces")).alias("n_tail"))
    tokens = (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).cast("long")
    joined = rows.select("uid", "doc_id", "n_bytes", "n_head").join(sums, F.col("uid") == F.col("of"), "left")
    return joined.select("doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > p.limit).alias("over_limit"))


def tok_whole(path: str):
    """Tokens of a text by the library alone."""
    library = pretokenizer(path).library
    return lambda text: len(library.encode(text, add_special_tokens=False).ids) if text else 0
