"""What the operators of this subpackage share: the shared folder, written tables, worker state and Arrow text buffers."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 2 << 20
#: Rows with texts that go to a Python worker in one batch.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only a local session gets a temporary one where it is unset."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quern-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


#: Frees the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet into the shared folder and read again: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def drop(*tables: DataFrame) -> None:
    """Deletes tables that `written` returned, once nothing that is still to run reads them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_held: dict[str, Any] = {}


def worker_state(name: str, make: Callable[[], Any]) -> Any:
    """What make() gives, kept for later tasks of this Python worker; one object at a time, whichever operator it belongs to."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def least_rows(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The `limit` rows of df with the least keys (a uniform 64-bit hash), ordered by key and then all columns.

    A count gives the share of keys that is enough, so that about `limit` rows in all, not `limit` from each partition,
    reach the task that orders them.
    """
    n = df.count()
    if n > 2 * limit:
        share = (limit + 8 * limit**0.5 + 16) / n
        df = df.where(F.col(key) < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return df.orderBy(key, *(c for c in df.columns if c != key)).limit(limit)


def small_batches(spark: SparkSession) -> None:
    """From now on at most BATCH_ROWS rows go to Python at once, for they hold whole texts, in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_chunks(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = CHUNK_BYTES, keep: str = "") -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts in `column` have at most `limit` bytes, or are one row; memory goes back at the end.

    State that other operators keep in this worker is let go, but that named `keep`.
    """
    if keep not in _held:
        _held.clear()
    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            _, off = buffer_of(batch.column(column))
            start = 0
            while start < batch.num_rows:
                end = int(np.searchsorted(off, off[start] + limit, "right")) - 1
                end = min(max(end, start + 1), batch.num_rows)
                yield batch.slice(start, end - start)
                start = end
    finally:
        trim()


def trim() -> None:
    """Gives freed memory back to the system; Python workers outlive their tasks, and would hold it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts and ends in them; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[off[0] : off[-1]], off - off[0]


def longs(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Integers (0 for null) and which are null."""
    null = np.asarray(values.is_null())
    return np.asarray(values.fill_null(0)).astype(np.int64), null
