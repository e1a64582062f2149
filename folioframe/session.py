"""A Spark session with the library's defaults, and tables written to the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = f"{root}:{env['PYTHONPATH']}" if env.get("PYTHONPATH") else root


#: Output of ``made_rows`` that a worker gathers at most before it hands it on: rows, and characters or bytes read and made.
PIECE_ROWS, PIECE_SIZE = 512, 1 << 20


def _size(values: Iterable[Any]) -> int:
    return sum(len(v) for v in values if isinstance(v, str | bytes))


def made_rows(rows: DataFrame, each: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """Rows of ``schema`` that ``each`` makes in a Python worker, called once a row with the row's columns.

    Beside Spark's own Arrow batch of the input, which Spark bounds, a worker holds one input row and one
    piece of output: how many rows a batch or a task has does not matter.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    on_workers(rows.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        size = 0
        for b in batches:
            for i in range(b.num_rows):
                given = [c[i].as_py() for c in b.columns]
                size += _size(given)
                for made in each(*given):
                    out.append(dict(zip(arrow.names, made, strict=True)))
                    size += _size(made)
                    if len(out) >= PIECE_ROWS or size >= PIECE_SIZE:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def session(app: str = "folioframe", **conf: str) -> SparkSession:
    """An active session, or a local one: adaptive execution, UTC, Arrow."""
    if (active := SparkSession.getActiveSession()) is not None:
        return active
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local default is set only where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file:///tmp/checkpoints"
    # with the file system it names or, if it names none, the cluster's default one
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found.rstrip("/"))
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


#: Folders below the application's own that written tables go to.
_WITHIN: ContextVar[tuple[str, ...]] = ContextVar("within", default=())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh place in the application's folder below the shared one."""
    return "/".join((shared_dir(spark), f"folioframe-{spark.sparkContext.applicationId}", *_WITHIN.get(), f"{label}-{uuid.uuid4().hex}"))


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[None]:
    """Tables written within go to a folder of their own, which is removed at the end."""
    folder = scratch_path(spark, label)
    token = _WITHIN.set((*_WITHIN.get(), folder.rpartition("/")[2]))
    try:
        yield
    finally:
        _WITHIN.reset(token)
        delete(spark, folder)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there and lost executors cost no rework."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's written tables, once no result that reads them is needed."""
    delete(spark, f"{shared_dir(spark)}/folioframe-{spark.sparkContext.applicationId}")
