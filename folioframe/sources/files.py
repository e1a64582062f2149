"""Files by URI: what one machine writes, every other finds, wherever the folder is."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow.fs
from pyspark.sql import DataFrame

from ..session import on_workers


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and the path in it; a bare path is a local one."""
    if "://" not in uri:
        uri = f"file://{uri.removeprefix('file:')}"
    return pyarrow.fs.FileSystem.from_uri(uri)


def replace(fs: pyarrow.fs.FileSystem, temporary: str, final: str) -> None:
    """Give a whole file its name. Where the file system does not rename onto a file, the file there goes first."""
    try:
        fs.move(temporary, final)
    except OSError:
        if fs.get_file_info(final).type == pyarrow.fs.FileType.NotFound:
            raise
        fs.delete_file(final)
        fs.move(temporary, final)


def put(fs: pyarrow.fs.FileSystem, path: str, content: bytes, made: str | None = None) -> str:
    """Write a file; it gets its name when it is whole, so a task that runs again replaces it.

    The file's folder is returned; ``made`` is one that is known to be there.
    """
    folder, _, name = path.rpartition("/")
    if folder != made:
        fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(content)
    replace(fs, temporary, path)
    return folder


def write_files(rows: DataFrame, root: str) -> None:
    """Write (path, content) under the folder or URI ``root`` from where the rows are."""
    on_workers(rows.sparkSession)

    def each(part: Iterator) -> None:
        fs, at = filesystem(root)
        made = None
        for r in part:
            made = put(fs, f"{at.rstrip('/')}/{r['path']}", bytes(r["content"]), made)

    rows.select("path", "content").foreachPartition(each)
