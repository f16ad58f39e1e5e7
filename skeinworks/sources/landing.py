"""Landed records: explicit-schema scans, line order, newest snapshots, and the small JSON state beside them."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, StringType, StructField, StructType

from skeinworks.functions.files import Files, shared_folder


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def _lenient(t: DataType) -> DataType:
    """The same type with text leaves, for numbers and booleans that come as text or the other way round."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _lenient(f.dataType)) for f in t.fields])
    return ArrayType(_lenient(t.elementType)) if isinstance(t, ArrayType) else StringType()


def _typed(c: Column, t: DataType) -> Column:
    if isinstance(t, StructType):
        return F.when(c.isNotNull(), F.struct(*(_typed(c[f.name], f.dataType).alias(f.name) for f in t.fields)))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda x: _typed(x, t.elementType))
    if isinstance(t, IntegerType):
        return F.coalesce(c.try_cast("int"), F.round(c.try_cast("double")).try_cast("int"))
    if isinstance(t, (DoubleType, BooleanType)):
        return c.try_cast(t)
    return c


def read_source(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One record a line by an explicit schema, numbers read leniently; a missing path is an empty relation.

    Lines that are no JSON objects are left out; ``corrupt_lines`` reports them.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return latest_lines(read_lines(spark, path), schema, key=None).drop("_line")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, _line): lines with an ordinal that rises with their place; taken at the scan, before any shuffle."""
    paths = [p for p in ([path] if isinstance(path, str) else path) if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], "value string, _line struct<file:string,block:long,at:long>")
    text = spark.read.text(paths)
    return text.select("value", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("_line"))


def _parsed(lines: DataFrame, schema: StructType) -> DataFrame:
    return lines.select(F.from_json("value", _lenient(schema)).alias("r"), "value", "_line").where(F.trim("value").startswith("{") & F.get_json_object("value", "$").isNotNull())


def corrupt_lines(lines: DataFrame) -> DataFrame:
    """Non-blank lines that hold no JSON object."""
    return lines.where(F.col("value").rlike(r"\S") & ~(F.trim("value").startswith("{") & F.get_json_object("value", "$").isNotNull()))


def latest_lines(lines: DataFrame, schema: StructType, key: str | None = "id") -> DataFrame:
    """Typed records with ``_line``; with a key only the newest line of each (records without a key are all kept)."""
    rows = _parsed(lines, schema).select(*(_typed(F.col(f"r.`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields), "_line")
    return rows if key is None else latest_per_key(rows, [key], ["_line"])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (nulls first); rows with a null key are all kept.

    An aggregate, not a sort: each task sends one row a key on, so a key with very many lines is no hot one.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    newest = df.where(whole).groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")
    return newest.unionByName(df.where(~whole))


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


# A line is what isn't blank, for numbers, counts, digests and ids alike ---------------------------------------------------------


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(value, _n): lines in order, counted from 0. Tasks number their own lines, after as many as the tasks before them have.

    The tasks' numbers are written to the shared folder, as they are read twice and another run of the tasks may part the lines otherwise.
    """
    kept = lines.where(F.col("value").rlike(r"\S"))
    folder = shared_folder(lines.sparkSession)
    kept.withColumn("_m", F.monotonically_increasing_id()).write.parquet(folder)
    # Of the ordinal the upper bits are the task's number and the lower ones the line's place there, once blank lines are gone.
    held = lines.sparkSession.read.parquet(folder)
    at = held.select("value", "_line", F.shiftright("_m", 33).alias("_task"), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))
    sizes = at.groupBy("_task").agg(F.count("*").alias("_size"), F.min("_line").alias("_first"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_task", before.alias("_start"))  # a row a task
    return at.join(F.broadcast(starts), "_task").select("value", (F.col("_start") + F.col("_place")).alias("_n"))


def ids_in(lines: DataFrame, start_line: int = 0) -> DataFrame:
    """Distinct ids at or after a line (counting from 0); broken lines are skipped."""
    rows = numbered_lines(lines).where(F.col("_n") >= start_line) if start_line else lines
    return rows.select(F.get_json_object("value", "$.id").alias("id")).where("id is not null").distinct()


def line_mark(lines: DataFrame, upto: int | None = None) -> tuple[int, str]:
    """Count and digest of the lines, or of the first ``upto``; lines that change, move or swap change the digest."""
    rows = numbered_lines(lines)
    rows = rows if upto is None else rows.where(F.col("_n") < upto)
    r = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64("value", "_n").cast("decimal(20,0)")).alias("digest")).first()
    return r.n, str(r.digest or 0)


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that aren't blank; 0 for a missing path."""
    return read_lines(spark, path).where(F.col("value").rlike(r"\S")).count()


def existing_ids(df: DataFrame) -> DataFrame:
    return df.select("id").where("id is not null").distinct()


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """One JSON record a line; an append adds files, and never changes one that is there."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "true").json(path)


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


_SITEMAP = "sitemap array<struct<loc:array<string>>>, url array<struct<loc:array<string>>>, _broken string"


def _sitemaps(df: DataFrame, column: str) -> DataFrame:
    """(xml, parsed): documents by Spark's XML parser, namespaces left out; a document that is no XML stands in ``_broken``."""
    told = F.from_xml(F.trim(F.col(column)), _SITEMAP, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "ignoreNamespace": "true", "excludeAttribute": "true"})
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias("xml"), told.alias("parsed"))


def sitemap_locations(df: DataFrame, column: str = "xml", pattern: str | None = None, parent: str | None = None) -> DataFrame:
    """Distinct addresses of sitemap documents, with or without a namespace, closing slash removed; malformed documents give none (``broken_sitemaps``).

    ``parent``: ``sitemap`` for an index's shards, ``url`` for a shard's pages; None takes both.
    """
    lists = [F.coalesce(F.flatten(F.col(f"parsed.{p}.loc")), F.array()) for p in ([parent] if parent else ["sitemap", "url"])]
    found = _sitemaps(df, column).select(F.explode(F.concat(*lists)).alias("loc")).select(F.trim("loc").alias("loc")).where("loc <> ''")
    found = found.where(F.col("loc").rlike(pattern)) if pattern else found
    return found.select(F.regexp_replace("loc", "/+$", "").alias("url")).distinct()


def broken_sitemaps(df: DataFrame, column: str = "xml") -> DataFrame:
    """Documents that are no XML, as they came."""
    return _sitemaps(df, column).where("parsed._broken is not null").select("xml")


def page_links(df: DataFrame, pattern: str, page: str = "page_id", html: str = "html") -> DataFrame:
    """Each page's link targets that match, the first place of each: (page, seq, href)."""
    hrefs = df.select(page, F.posexplode(F.regexp_extract_all(F.col(html), F.lit('href="([^"]*)"'), F.lit(1))).alias("seq", "href"))
    return hrefs.where(F.col("href").rlike(pattern)).groupBy(page, "href").agg(F.min("seq").alias("seq"))


# Control state (small JSON files) ----------------------------------------------------------------------------------------


class JsonState:
    """A tolerant JSON object: missing or broken files are empty. With a session the file may be on any file system that Spark reaches, as the
    next driver may run on another host; without one it is the driver's own."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        self.path, self.spark = Path(path), spark
        folder, _, self.name = path.rpartition("/")
        self.files = Files(spark, folder) if spark else None

    def load(self) -> dict:
        try:
            value = json.loads(self.files.read(self.name) or "" if self.files else self.path.read_text())
        except (OSError, ValueError):
            return {}
        return value if isinstance(value, dict) else {}

    def save(self, value: dict) -> None:
        text = json.dumps(value, sort_keys=True)
        if self.files:
            self.files.replace(self.name, text)
            return
        self.path.parent.mkdir(parents=True, exist_ok=True)
        part = self.path.with_suffix(".part")
        part.write_text(text)
        part.replace(self.path)


class Cursor(JsonState):
    """Line count and digest of each source at its last load."""

    def changed(self, source: str, mark: tuple[int, str]) -> bool:
        return self.load().get(source) != list(mark)

    def lines(self, source: str) -> tuple[int, str]:
        held = self.load().get(source)
        return (held[0], held[1]) if isinstance(held, list) and len(held) == 2 else (0, "0")

    def tail_start(self, source: str, lines: DataFrame) -> int:
        """Where the new lines begin; 0 if those that were there aren't there any more as they were."""
        n, digest = self.lines(source)
        return n if n and line_mark(lines, n) == (n, digest) else 0

    def set(self, source: str, mark: tuple[int, str]) -> None:
        self.save(self.load() | {source: list(mark)})


class Manifest:
    """Changed ids by source as a table, gathered until a publication commits; ids never pass through the driver."""

    SCHEMA = "source string, id string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def parts(self) -> list[str]:
        """What was merged and not cleared, whole parts only."""
        path, fs = self._fs()
        names = [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n for n in names if n.startswith("ids-") and fs.exists(self._fs(f"{n}/_SUCCESS")[0]))

    def merge(self, source: str, ids: DataFrame) -> None:
        """Adds ids (column ``id``) of a source."""
        ids.select(F.lit(source).alias("source"), F.col("id").cast("string")).write.parquet(f"{self.root}/ids-{uuid.uuid4().hex}")

    def load(self, parts: list[str] | None = None) -> DataFrame:
        """(source, id), distinct."""
        parts = self.parts() if parts is None else parts
        return self.spark.read.schema(self.SCHEMA).parquet(*(f"{self.root}/{p}" for p in parts)).distinct() if parts else self.spark.createDataFrame([], self.SCHEMA)

    def clear(self, parts: list[str] | None = None) -> None:
        """Removes the parts that were published (all without a list); what was merged since stays."""
        for name in self.parts() if parts is None else parts:
            path, fs = self._fs(name)
            fs.delete(path, True)
