"""The warehouse: bucketed tables in versions, loads by several writers, linkage, lookups, export and publication."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skeinworks.operators import linkage
from skeinworks.operators.merge import require_keys
from skeinworks.plans.flatten import flatten
from skeinworks.plans.schemas import SOURCES, TABLES, UNMANAGED
from skeinworks.plans.versions import Change, Layer, Version, Versions, evolved, folder_name
from skeinworks.sources.landing import latest_lines, path_exists, read_lines
from skeinworks.sources.tail import NOTHING, tail

#: Promotions whose titles both sources have.
PROMOTION_SLUGS = [("1", "wwe"), ("2287", "aew")]
CROSSWALKS = {"wrestler_crosswalk": ("wrestlers", "b_wrestlers"), "title_crosswalk": ("titles", "b_titles")}


ROOT = "_root"


def observed(told: Observation) -> int:
    """The count that a write observed; a plan that turned out empty, and so lost the observation, has none."""
    try:
        return told.get["n"]
    except Py4JJavaError:
        return 0


#: Tables that the crosswalks are made of.
LINKED = {"wrestlers", "wrestler_attributes", "b_wrestlers", "b_wrestler_name_history", "titles", "b_titles"}


class Warehouse:
    """Tables under ``root``; what a reader sees changes only when a version is put.

    Every row of a source's table also holds the id of the landed record that it comes from, and rows are stored in ``buckets`` by
    that id's hash, all rows of a record in the buckets of one number. A load lays its rows and its records' ids on top of these buckets: of a
    record, the rows of the topmost layer that names it count. What a load writes is therefore in proportion to what it loads. A bucket whose layers
    have grown too many, or too large beside its bottom, is written anew by the load that would add another one.

    Several writers may load, link and publish at once (``versions``). ``ddls`` overrides tables' columns; a table's columns may grow and its numbers widen.
    """

    #: Layers on a bucket's bottom, and their bytes as a share of the bottom's, from which the bucket is written anew.
    MOST_LAYERS, SHARE = 8, 0.3

    def __init__(self, spark: SparkSession, root: str, fresh: bool = False, buckets: int = 32, ddls: dict[str, str] | None = None):
        self.spark, self.root, self.buckets, self.ddls = spark, root.rstrip("/"), buckets, ddls or {}
        self.versions = Versions(spark, self.root)
        self.files = self.versions.files
        if fresh:
            self.files.delete()

    # Reading -----------------------------------------------------------------------------------------------------------------------

    def _ddl(self, name: str) -> str:
        return self.ddls.get(name, TABLES[name].ddl)

    def _folders(self) -> dict[str, dict[int, list[str]]]:
        """Folders of each bucket's layers of each table, in the newest version."""
        return {t: {b: [x["folder"] for x in layers] for b, layers in buckets.items() if layers} for t, buckets in self.versions.newest().tables.items()}

    def _bucket(self, id_: Column) -> Column:
        return F.pmod(F.xxhash64(id_), F.lit(self.buckets)).cast("int")

    def bucket_of(self, id_: str) -> int:
        return self.spark.range(1).select(self._bucket(F.lit(id_))).first()[0]

    def _stored(self, name: str, touched: list[int] | None = None, version: Version | None = None) -> DataFrame:
        """A table's rows with their record's id, of all buckets or of some. Columns added since a file was written are null there."""
        version = version or self.versions.newest()
        schema = StructType.fromDDL(self._ddl(name)).add(ROOT, "string")
        paths: dict[tuple[int, int], list[str]] = {}
        replaced: dict[int, list[str]] = {}
        for layers in version.layers(name, touched).values():
            for k, layer in enumerate(layers):
                if layer["folder"]:
                    paths.setdefault((k, layer["schema"]), []).append(f"{self.root}/{layer['folder']}")
                if k and layer["ids"]:
                    replaced.setdefault(k, []).append(f"{self.root}/{layer['ids']}")
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = None
        for (k, number), found in sorted(paths.items()):
            then = StructType.fromDDL(version.schemas[name][number]).add(ROOT, "string")
            one = fitted(self.spark.read.schema(then).parquet(*found), schema).withColumn("_layer", F.lit(k))
            rows = one if rows is None else rows.unionByName(one)
        if not replaced:
            return rows.drop("_layer")
        last = None
        for k, found in sorted(replaced.items()):
            one = self.spark.read.schema(f"{ROOT} string").parquet(*found).withColumn("_last", F.lit(k))
            last = one if last is None else last.unionByName(one)
        last = last.groupBy(ROOT).agg(F.max("_last").alias("_last"))
        return rows.join(last, ROOT, "left").where(F.coalesce("_last", "_layer") == F.col("_layer")).select(*schema.fieldNames())

    def table(self, name: str, version: Version | None = None) -> DataFrame:
        return self._stored(name, None, version).drop(ROOT)

    def tables(self, version: Version | None = None) -> dict[str, DataFrame]:
        now = version or self.versions.newest()
        return {name: self.table(name, now) for name in TABLES}

    def subtree(self, name: str, ids: DataFrame) -> DataFrame:
        """Rows of a table that come from some records (column ``id``)."""
        return self._stored(name, self._touched(ids)).join(ids.select(F.col("id").alias(ROOT)), ROOT, "left_semi").drop(ROOT)

    def of_record(self, name: str, id_: str, version: Version | None = None) -> DataFrame:
        """Rows of a table that come from one record: only its bucket's files are opened, and of these, which are sorted by record, the row groups between whose least and greatest it lies."""
        return self._stored(name, [self.bucket_of(id_)], version).where(F.col(ROOT) == id_).drop(ROOT)

    def person(self, a_id: str) -> DataFrame:
        """The second source's row of one of the first source's people, with how both were linked."""
        now = self.versions.newest()
        found = self.of_record("wrestler_crosswalk", a_id, now).collect()  # one row at most
        linked = self.spark.createDataFrame(found, StructType.fromDDL(self._ddl("wrestler_crosswalk")))
        people = self.of_record("b_wrestlers", found[0].b_id, now) if found else self._stored("b_wrestlers", []).drop(ROOT)
        return linked.join(people.withColumnRenamed("id", "b_id"), "b_id")

    def reigns(self, a_person: str, a_title: str) -> DataFrame:
        """The second source's reigns of one of the first source's people with one of its titles, in order."""
        now = self.versions.newest()
        people, titles = self.of_record("wrestler_crosswalk", a_person, now), self.of_record("title_crosswalk", a_title, now)
        title = titles.first()
        tables = [self.of_record(n, title.b_id, now) if title else self._stored(n, []).drop(ROOT) for n in ("b_title_reign_champions", "b_title_reigns")]
        return linkage.reigns_for(people, titles, *tables, a_person, a_title)

    def _touched(self, ids: DataFrame) -> list[int]:
        return [r.b for r in ids.select(self._bucket(F.col("id")).alias("b")).distinct().collect()]  # at most one a bucket

    # Writing -----------------------------------------------------------------------------------------------------------------------

    def _rooted(self, rows: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Adds the record's id: parents' own, children's by their parents among these rows (or those stored)."""
        out: dict[str, DataFrame] = {}
        for name in TABLES:
            if name not in rows:
                continue
            df, spec = rows[name], TABLES[name]
            if ROOT in df.columns:
                out[name] = df
            elif spec.parent is None or TABLES[spec.parent].parent is None:
                out[name] = df.withColumn(ROOT, F.col(spec.foreign or spec.key[0]).cast("string"))
            else:
                up = (out[spec.parent] if spec.parent in out else self._stored(spec.parent)).select(F.col("id").alias(spec.foreign), ROOT)
                out[name] = df.join(up, spec.foreign, "left").select(*df.columns, ROOT)
        return out

    def _written(self, name: str, rows: DataFrame) -> dict[int, Layer]:
        """A new folder of rows with their record's id; returns the bottom layer of each bucket that got some. A bucket is as many files as its size asks for."""
        folder = folder_name(name)
        dealt = rows.withColumn("_bucket", self._bucket(F.col(ROOT))).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", ROOT)
        dealt.write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        found = {n: size for n, size in self.files.sizes(folder).items() if n.startswith("_bucket=") and "HIVE" not in n}
        return {int(n.split("=")[1]): {"folder": f"{folder}/{n}", "ids": None, "bytes": size} for n, size in found.items()}

    def _grown(self, version: Version, names: list[str], bucket: int) -> bool:
        """Whether a bucket's layers are too many, or too large beside the bottom, in any of the tables."""
        for name in names:
            layers = version.tables.get(name, {}).get(bucket, [])
            if len(layers) > self.MOST_LAYERS or sum(x["bytes"] for x in layers[1:]) > self.SHARE * sum(x["bytes"] for x in layers[:1]) + (64 << 20):
                return True
        return False

    def _replaced(self, change: Change, base: Version, names: list[str], ids: DataFrame, rows: dict[str, DataFrame]) -> tuple[int, str]:
        """Adds to a change that the rows of some records (column ``id``) in some tables are these; returns the number of records, and the folder of their ids."""
        told = Observation()
        mine = ids.select(F.col("id").cast("string").alias(ROOT)).observe(told, F.count("*").alias("n"))
        held = self._written("ids", mine)
        n = observed(told)
        anew = [b for b in held if self._grown(base, names, b)]
        for name in names:
            found = rows.get(name)
            if anew:
                below = self._stored(name, anew, base).join(mine.select(ROOT), ROOT, "left_anti")
                found = below if found is None else below.unionByName(found)
            layers = {} if found is None else self._written(name, found)
            change.rewrite.setdefault(name, {}).update({b: [layers[b]] if b in layers else [] for b in anew})
            on_top = {b: {"folder": layers[b]["folder"] if b in layers else None, "ids": held[b]["folder"], "bytes": layers.get(b, held[b])["bytes"]} for b in held if b not in anew}
            change.append.setdefault(name, {}).update({b: layer for b, layer in on_top.items() if layer["folder"] or base.tables.get(name, {}).get(b)})
        return n, next(iter(held.values()))["folder"].partition("/_bucket=")[0] if held else ""

    def _commit(self, work: Callable[[Version], Change | None]) -> Change | None:
        return self.versions.commit(work, self._ddl)

    def replace(self, changed: dict[str, DataFrame], read: set[str] | None = None) -> None:
        """Replace whole tables, visible at once. ``read``: tables that these rows were made from, which must not have changed meanwhile."""
        self._commit(lambda base: Change(whole={name: {b: [y] for b, y in self._written(name, df).items()} for name, df in self._rooted(changed).items()}, read=read or set()))

    def load(self, source: str, path: str | list[str], batch: tuple[str, int] | None = None) -> int:
        """Load one source's file or files: newest line of each id, parents replaced, all children of the file's ids replaced.

        Returns the number of records; a missing file loads nothing. Children of strict tables with a null or repeated key raise ``KeyViolation``
        before anything is visible; other children have their list place in the key, and of those that repeat one the first counts.
        ``batch``: who loads, and the number of its batch; one that was committed already isn't loaded again. The ids of loaded records are kept for publication.
        """
        paths = [p for p in ([path] if isinstance(path, str) else path) if path_exists(self.spark, p)]
        if not paths:
            return 0
        return self.load_lines(source, read_lines(self.spark, paths), batch)

    def load_tail(self, source: str, path: str, check: str = "edges") -> int:
        """``load`` of the lines that were appended to a file, or to a folder's files, since the last call; how far was read is committed with them."""
        writer = f"tail:{source}:{path}"
        start = self.versions.newest().offsets.get(writer, {})
        lines, end = tail(self.spark, path, start, check)
        return 0 if end == (start or NOTHING) else self.load_lines(source, lines, offset=(writer, start, end))

    def load_lines(self, source: str, lines: DataFrame, batch: tuple[str, int] | None = None, offset: tuple[str, dict, dict] | None = None) -> int:
        """``load`` of lines (value, _line)."""
        if Change(batch=batch, offset=offset).done(self.versions.newest()):
            return 0
        raw = latest_lines(lines, StructType.fromDDL(SOURCES[source])).drop("_line").where("id is not null").persist()
        try:
            new, known = flatten(source, raw), self.versions.newest().schemas
            for name, rows in new.items():
                evolved(known.get(name, []), self._ddl(name), name)
                if TABLES[name].strict:
                    require_keys(rows, TABLES[name].key)
            new = self._rooted({name: fitted(df, StructType.fromDDL(self._ddl(name))) for name, df in new.items()})

            def work(base: Version) -> Change:
                change = Change(batch=batch, offset=offset)
                change.result, folder = self._replaced(change, base, [*new], raw.select("id"), new)
                change.pending = [[source, folder]] if folder else []
                return change

            done = self._commit(work)
        finally:
            raw.unpersist()
        return done.result if done else 0

    def link(self) -> dict[str, int]:
        """Rebuild both crosswalks from one version; returns their sizes. Rebuilt again if what they are made of changes meanwhile."""

        def work(base: Version) -> Change:
            change, counts = Change(read=LINKED), {}
            for name, rows in self._linked(base).items():
                told = Observation()
                change.whole[name] = {b: [y] for b, y in self._written(name, self._rooted({name: rows.observe(told, F.count("*").alias("n"))})[name]).items()}
                counts[name] = observed(told)
            change.result = counts
            return change

        return self._commit(work).result

    def _linked(self, version: Version) -> dict[str, DataFrame]:
        t = {name: self.table(name, version) for name in LINKED}
        alter = t["wrestler_attributes"].where("attr_type = 'alter_ego'").select(F.col("wrestler_id").alias("id"), F.col("value").alias("name"), F.lit(False).alias("is_primary"))
        rings = t["b_wrestlers"].where(F.col("name").contains("/")).select("id", F.explode(F.split("name", "/")).alias("name")).where(F.trim("name") != "").withColumn("is_primary", F.lit(True))  # each part is a name in its own right
        past = t["b_wrestler_name_history"].select(F.col("wrestler_id").alias("id"), "name", F.lit(False).alias("is_primary"))
        people = linkage.person_crosswalk(
            linkage.names(t["wrestlers"], "id", "name", True).unionByName(alter),
            linkage.names(t["b_wrestlers"], "id", "name", True).unionByName(rings).unionByName(past),
            t["wrestlers"].select("id", F.col("birthday").alias("day")),
            t["b_wrestlers"].select("id", F.col("birthday").alias("day")),
        )
        slugs = self.spark.createDataFrame(PROMOTION_SLUGS, "promotion string, slug string")
        return {"wrestler_crosswalk": people, "title_crosswalk": linkage.title_crosswalk(t["titles"], t["b_titles"].select("id", "name"), slugs)}

    def views(self) -> None:
        """Temporary views of linked rows side by side, and of every table."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
        for view, walk in (("v_wrestlers_matched", "wrestler_crosswalk"), ("v_titles_matched", "title_crosswalk")):
            a, b = CROSSWALKS[walk]
            linkage.matched_view(self.table(walk), self.table(a), self.table(b)).createOrReplaceTempView(view)

    def counts(self) -> DataFrame:
        """(table, n) of every table in one job."""
        return counted(self.tables())

    def export(self, folder: str, one_file: bool = False) -> list[str]:
        """Every managed table as Parquet."""
        names = [n for n in TABLES if n not in UNMANAGED]
        now = self.tables()
        for name in names:
            df = now[name]
            (df.coalesce(1) if one_file else df).write.mode("overwrite").parquet(f"{folder}/{name}")
        return names

    def mirror(self, target: Warehouse) -> dict[str, int]:
        """All managed tables to another warehouse, visible there at once; rows are counted as they are written."""
        now = self.versions.newest()
        names = [n for n in TABLES if n not in UNMANAGED]
        told = {n: Observation() for n in names}
        target.replace({n: self._stored(n, None, now).observe(told[n], F.count("*").alias("n")) for n in names})
        return {n: observed(told[n]) for n in names}

    def mirror_changes(self, target: Warehouse, changes: dict[str, DataFrame]) -> dict[str, int]:
        """Only the subtrees of the changed ids (``id`` by source), and the crosswalks of changed kinds in full, visible at once; rows are counted as they are written."""
        now = self.versions.newest()
        counts: dict[str, int] = {}

        def work(base: Version) -> Change:
            change = Change()
            for source, ids in changes.items():
                names = [n for n, spec in TABLES.items() if spec.source == source]
                mine, told = self._touched(ids), {n: Observation() for n in names}
                sent = {n: self._stored(n, mine, now).join(ids.select(F.col("id").cast("string").alias(ROOT)), ROOT, "left_semi").observe(told[n], F.count("*").alias("n")) for n in names}
                target._replaced(change, base, names, ids.select("id").distinct(), sent)
                counts.update({n: observed(told[n]) for n in names})
            for walk in (w for w, kinds in CROSSWALKS.items() if {*kinds} & {*changes}):
                told = Observation()
                change.whole[walk] = {b: [y] for b, y in target._written(walk, self._stored(walk, None, now).observe(told, F.count("*").alias("n"))).items()}
                counts[walk] = observed(told)
            return change

        if changes:
            target._commit(work)
        return counts

    def pending(self) -> tuple[list[list[str]], dict[str, DataFrame]]:
        """The loads whose ids weren't published yet, and their ids by source."""
        told = self.versions.newest().pending
        by_source: dict[str, list[str]] = {}
        for source, folder in told:
            by_source.setdefault(source, []).append(f"{self.root}/{folder}")
        return told, {s: self.spark.read.schema(f"{ROOT} string").option("recursiveFileLookup", "true").parquet(*folders).select(F.col(ROOT).alias("id")).distinct() for s, folders in by_source.items()}

    def publish(self, target: Warehouse) -> dict[str, int]:
        """Mirror what was loaded since the last publication; a load is ticked off once it is visible in the target, in a version of its own."""
        told, ids = self.pending()
        if not told:
            return {}
        counts = self.mirror_changes(target, ids)
        self.published(told)
        return counts

    def published(self, told: list[list[str]]) -> None:
        """Tick off loads that are visible elsewhere."""
        self._commit(lambda base: Change(published=told))

    def vacuum(self, keep_seconds: float = 7 * 86400.0, now: float | None = None) -> list[str]:
        """Remove what no version of the last ``keep_seconds`` names; returns the names of what went."""
        return self.versions.vacuum(keep_seconds, now)

    def clear(self, source: str, ids: DataFrame) -> None:
        """Remove the children of some ids at all levels; the parents stay."""
        names = [n for n, spec in TABLES.items() if spec.source == source and spec.parent]

        def work(base: Version) -> Change:
            change = Change()
            self._replaced(change, base, names, ids.select("id").distinct(), {})
            return change

        self._commit(work)


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns and types of a schema from rows that may lack columns added since (null) or have others (left out)."""
    return df.select(*((F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))


def conformed(df: DataFrame, name: str) -> DataFrame:
    """``fitted`` to a table of the data model."""
    return fitted(df, StructType.fromDDL(TABLES[name].ddl))


def counted(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n) in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        out = one if out is None else out.unionByName(one)
    return out
