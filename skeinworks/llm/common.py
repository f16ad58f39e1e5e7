"""What the operators of this subpackage share: shared scratch tables and small text helpers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from ``spark.checkpoint.dir``.

    Where that setting is absent a temporary folder is made and set, but only under a local master, whose executors see it.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        told = spark.conf.get("spark.checkpoint.dir", None)
        if not told and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(told or tempfile.mkdtemp(prefix="skeinworks-"))
    return sc.getCheckpointDir()


@contextlib.contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Inside, each finished write removes its own shuffle files at once, so that stages don't pile up on disk."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


#: Rows and bytes that one Arrow batch may hold: whole texts travel in them, and each Python worker keeps its largest.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, which by default hold 10,000 rows of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@functools.cache
def _trim():
    """The C library's function that gives free memory back, where it has one."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda pad: 0


def lean(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of Arrow batches; at its end the worker, which waits for other tasks, gives its free memory back."""

    def leaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return leaner


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    #: Those made since ``dropped_scratch`` began.
    made: list[Scratch] | None = None

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        #: Tables that were written and not dropped.
        self.names: set[str] = set()
        if Scratch.made is not None:
            Scratch.made.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        with shuffle_cleanup(self.spark):
            df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.names.discard(name)


@contextlib.contextmanager
def dropped_scratch() -> Iterator[None]:
    """At the end, the tables that operators wrote inside go; what they returned must be written by then."""
    before, Scratch.made = Scratch.made, []
    try:
        yield
    finally:
        for scratch in Scratch.made:
            scratch.drop(*scratch.names)
        Scratch.made = before


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Whole rows in ``_row`` (so that no name of theirs clashes), each with a place of its own: _file and _line.

    A table's rows have their place in its files; other rows are written first.
    """

    def placed(df: DataFrame) -> DataFrame:
        told = df.metadataColumn("_metadata")
        return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.unhex(F.md5(told["file_path"].cast("binary"))).alias("_file"), told["row_index"].alias("_line"))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(scratch.write(docs, "rows"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` with the columns of ``ddl`` after its own."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
