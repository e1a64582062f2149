"""Token ids as Arrow files of fixed-size lists, for zero-copy access to equal-length sequences and masks.

Documents are dealt out by ranges of doc_id, sorted, coded and written by the
task that holds them: one shuffle, of texts. Each task writes one Arrow file:
batches of rows ``ids: fixed_size_list<uint>[length]`` and ``mask:
fixed_size_list<bool>[length]``, the documents' ids one after another, each with
an end id, the last row padded under a false mask; and beside it an index file
(doc_id, start, n_tokens) in document order. ``sequences`` maps such a file and
gives row i as views of the mapped memory, ids as numbers and the mask as an
Arrow array of bits. A file gets its name when it is whole, so a task that runs
again after an executor is lost replaces it. Tasks are dealt by the bytes of the
texts, and a task begins another file when one holds ``file_ids`` ids.

Defined results: null and empty texts are the end id alone; null doc_ids come
first; rows that repeat a doc_id are ordered by a hash of the text and then by it; an
empty table has no sequences. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import filesystem, replace
from .common import arrow_map, arrow_schema, batch_of, id_and_text, scratch_path
from .pretokens import pretokenizer


@dataclass(frozen=True)
class Layout:
    length: int = 1024
    rows_per_batch: int = 256
    end_id: int = 0
    #: Bytes of text of a task, about, and documents at most, about.
    task_bytes: int = 24 << 20
    task_rows: int = 10_000
    #: Ids of a file, but for the end of its last document.
    file_ids: int = 1 << 26


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))],
        metadata={"length": str(length)})


class Writer:
    """Buffers ids up to a batch of rows; writes under a temporary name and renames when closed."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, layout: Layout):
        self.fs, at = filesystem(folder)
        self.fs.create_dir(at, recursive=True)
        self.final, self.temporary = f"{at}/{name}", f"{at}/.{name}.{uuid.uuid4().hex}"
        self.layout, self.dtype = layout, dtype
        self.schema = sequence_schema(dtype, layout.length)
        self.out = self.fs.open_output_stream(self.temporary)
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.rest: list[bytes] = []
        self.held = self.total = 0
        self.index: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.index.append((doc_id, self.total, n))
        self.rest.append(ids)
        self.total += n
        self.held += n
        if self.held >= self.layout.length * self.layout.rows_per_batch:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        length, ids = self.layout.length, np.frombuffer(b"".join(self.rest), self.dtype)
        per = self.layout.rows_per_batch * length  # all batches but the last have as many rows
        pad = -len(ids) % length if last else 0
        whole = len(ids) if last else len(ids) // per * per
        body, rest = np.concatenate([ids[:whole], np.zeros(pad, self.dtype)]), ids[whole:]
        mask = np.ones(len(body), bool)
        mask[whole:] = False
        for at in range(0, len(body), per):
            part = pa.array(body[at : at + per]), pa.array(mask[at : at + per])
            self.file.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(x, length) for x in part], schema=self.schema))
        self.rest, self.held = [rest.tobytes()], len(rest)

    def close(self) -> None:
        self._flush(True)
        self.file.close()
        self.out.close()
        with self.fs.open_output_stream(f"{self.temporary}.index") as out, pa.ipc.new_file(out, INDEX) as file:
            file.write_table(pa.table([list(x) for x in zip(*self.index, strict=True)] or [[]] * 3, schema=INDEX))
        replace(self.fs, f"{self.temporary}.index", f"{self.final}.index")
        replace(self.fs, self.temporary, self.final)


class sequences:  # noqa: N801
    """Random access to a file's rows: ``sequences(uri)[i]`` is (ids, mask), both views of the mapped file where it is local.

    The mask is an Arrow array of bits; ``to_numpy(False)`` makes bytes of it.
    """

    def __init__(self, uri: str):
        fs, at = filesystem(uri)
        self.source = pa.memory_map(at) if fs.type_name == "local" else fs.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.length = int(self.file.schema.metadata[b"length"])
        self.per = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        with fs.open_input_file(f"{at}.index") as f:
            self.index = pa.ipc.open_file(f).read_all()

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return (n - 1) * self.per + self.file.get_batch(n - 1).num_rows if n else 0

    def _row(self, i: int) -> tuple[pa.RecordBatch, int]:
        return self.file.get_batch(i // self.per), i % self.per

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        batch, at = self._row(i)
        ids = batch["ids"].values.to_numpy(zero_copy_only=True)[at * self.length : (at + 1) * self.length]
        return ids, batch["mask"].values.slice(at * self.length, self.length)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the file on, across rows and batches."""
        out, per = [], self.per * self.length
        while n > 0:
            values = self.file.get_batch(start // per)["ids"].values.to_numpy(zero_copy_only=True)
            part = values[start % per : start % per + n]
            if not len(part):
                raise ValueError("the index reaches beyond the file")
            out.append(part)
            start, n = start + len(part), n - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint16)


def write(docs: DataFrame, path: str, folder: str, layout: Layout = Layout()) -> list[tuple[str, int, int]]:
    """Write the files; their names in document order, with documents and ids. The list has a row a file."""
    texts = id_and_text(docs)
    size = texts.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    tasks = max(1, -(-size["bytes"] // layout.task_bytes), -(-size["rows"] // layout.task_rows))
    out = arrow_schema(part=pa.int32(), name=pa.string(), docs=pa.int64(), ids=pa.int64())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, writer, part, k = pretokenizer(path), None, TaskContext.get().partitionId(), 0
        end = np.array([layout.end_id], tok.dtype).tobytes()
        for b in batches:
            for doc_id, ids in zip(b["doc_id"].to_pylist(), tok.many(b["text"]), strict=True):
                if writer is None:
                    name, k = f"part-{part:06d}-{k:04d}.arrow", k + 1
                    writer = Writer(folder, name, tok.dtype, layout)
                writer.add(doc_id, ids + end)
                if writer.total >= layout.file_ids:
                    writer.close()
                    yield batch_of(out, [part], [name], [len(writer.index)], [writer.total])
                    writer = None
        if writer:
            writer.close()
            yield batch_of(out, [part], [name], [len(writer.index)], [writer.total])

    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = texts.repartitionByRange(tasks, *by).sortWithinPartitions(*by, "text")
    made = arrow_map(ranged, packed, "part int, name string, docs long, ids long").collect()
    return [(r["name"], r["docs"], r["ids"]) for r in sorted(made)]


def read(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; a task a file."""
    before, listed = 0, []
    for name, _, ids in files:
        listed.append((f"{folder}/{name}", before))
        before += ids
    names = spark.createDataFrame(listed, "uri string, before long")
    out = arrow_schema(doc_id=pa.int64(), start=pa.int64(), n_tokens=pa.int64(), ids_crc32=pa.int64())

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, offset in zip(b["uri"].to_pylist(), b["before"].to_pylist(), strict=True):
                stored = sequences(uri)
                start, n = stored.index["start"].to_numpy(), stored.index["n_tokens"].to_numpy()
                crc = [zlib.crc32(stored.ids(s, k).astype("<u4").tobytes()) for s, k in zip(start.tolist(), n.tolist(), strict=True)]
                doc_id = stored.index["doc_id"].combine_chunks()
                yield batch_of(out, doc_id if isinstance(doc_id, pa.Array) else doc_id.chunk(0), pa.array(start + offset), pa.array(n), crc)

    return arrow_map(names.repartition(max(1, len(listed))), unpacked, "doc_id long, start long, n_tokens long, ids_crc32 long")


def pack(docs: DataFrame, path: str, layout: Layout = Layout(), folder: str | None = None) -> DataFrame:
    """Write all documents to ``folder`` (the shared folder, if none is named) and read them back."""
    folder = folder or scratch_path(docs.sparkSession, "sequences")
    return read(docs.sparkSession, folder, write(docs, path, folder, layout))
