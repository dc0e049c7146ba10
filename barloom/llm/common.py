"""Helpers that the operators share: inputs, shared storage and Arrow plumbing."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a DataFrame; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a session of one process may leave it unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="barloom-")  # driver and executors are one process here, as in tests
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return f"file://{made}"


BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of few rows and bytes for the jobs run inside: rows may carry whole texts or sets.

    A setting of the session: a query that runs beside meanwhile has small batches too, and the same rows.
    """
    before = {k: spark.conf.get(k, None) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage through a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    with small_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes rows as Parquet to the shared folder and reads them back: column pruning and no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/barloom-{label}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the files behind a frame that ``stored`` returned, once nothing needs them."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/barloom-" in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def keyed_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Just the key as bigint ``doc_id`` and the text with null as empty, whatever else the input holds."""
    return df.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def slices(it: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few hundred rows, which bound what Python holds of them at once.

    At the end the worker, which waits for further tasks, returns what its allocators hold.
    """
    for batch in it:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    returned()


def returned() -> None:
    """Gives memory that this process has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def batches(fn: Callable[..., list], fields: list[tuple[str, pa.DataType]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Wraps a function of a batch's Python columns, giving output columns, for ``mapInArrow``."""
    schema = pa.schema(fields)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(it):
            out = fn(*(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run
