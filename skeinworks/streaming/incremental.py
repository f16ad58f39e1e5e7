"""Incremental loads: a gate on line counts and digests, and a file stream that loads each new file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.plans.warehouse import Warehouse
from skeinworks.sources.landing import Cursor, Manifest, ids_in, line_mark, read_lines
from skeinworks.sources.tail import as_lines, register


def nightly(spark: SparkSession, warehouse: Warehouse, files: dict[str, str], cursor: Cursor, manifest: Manifest) -> dict[str, int]:
    """Load the sources whose lines changed, link, and record the ids of the new lines (of all, if old lines changed). State is saved last."""
    lines = {s: read_lines(spark, path) for s, path in files.items()}
    changed = {s: mark for s, x in lines.items() if (mark := line_mark(x))[0] and cursor.changed(s, mark)}
    loaded = {s: warehouse.load(s, files[s]) for s in changed}
    if loaded:
        warehouse.link()
    for s, mark in changed.items():
        manifest.merge(s, ids_in(lines[s], cursor.tail_start(s, lines[s])))
        cursor.set(s, mark)
    return loaded


def nightly_tails(warehouse: Warehouse, files: dict[str, str]) -> dict[str, int]:
    """Load what was appended to each source's file, and link if anything was. A file costs what it grew by; what was loaded waits for ``Warehouse.publish``."""
    loaded = {s: n for s, path in files.items() if (n := warehouse.load_tail(s, path))}
    if loaded:
        warehouse.link()
    return loaded


def publish_changes(spark: SparkSession, warehouse: Warehouse, target: Warehouse, manifest: Manifest) -> dict[str, int]:
    """Mirror the recorded ids' subtrees; the record is cleared once they are visible."""
    parts = manifest.parts()
    if not parts:
        return {}
    pending = manifest.load(parts)
    sources = [r.source for r in pending.select("source").distinct().collect()]  # at most one a kind of source
    out = warehouse.mirror_changes(target, {s: pending.where(F.col("source") == s).select("id") for s in sources}) if sources else {}
    manifest.clear(parts)
    return out


def stream_loads(spark: SparkSession, warehouse: Warehouse, source: str, folder: str, checkpoint: str):
    """Load every file that appears in a folder exactly once; a landing adds files and never appends to one (``tail`` reads growing files).

    A micro-batch is one load. Its number and the query's id stand in the version that it puts, so a batch that is run again after a crash
    changes nothing, and its ids are pending for publication once. Returns the query, which ends when all files there are loaded.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.select("path").distinct().orderBy("path").collect()]  # files of a micro-batch
        warehouse.load(source, paths, (f"files:{checkpoint}", batch_id))

    files = spark.readStream.format("text").option("recursiveFileLookup", "false").load(folder).selectExpr("_metadata.file_path as path")
    return files.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_tail(spark: SparkSession, warehouse: Warehouse, source: str, path: str, checkpoint: str, check: str = "edges"):
    """Load lines as they are appended to files, each exactly once; returns the query, which ends when all whole lines there are loaded."""

    def one(batch: DataFrame, batch_id: int) -> None:
        warehouse.load_lines(source, as_lines(batch), (f"tail:{checkpoint}", batch_id))

    rows = spark.readStream.format(register(spark)).options(path=path, check=check).load()
    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
