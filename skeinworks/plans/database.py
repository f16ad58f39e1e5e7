"""Publication into a database over JDBC: rows go into staging tables in parallel, then one transaction puts them into place.

Tasks write to staging tables alone, each in transactions of its own; a task that fails or runs twice never touches a target. The swap is a few
statements on one connection: rows that go are deleted children first, rows that come are inserted parents first, by column names, so a target may
have columns of its own. If any step fails, targets are as they were, and staging tables are dropped. Of changed records the ids are
staged as a table, so no list of ids stands in a statement.
"""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from skeinworks.plans.schemas import TABLES, UNMANAGED
from skeinworks.plans.warehouse import CROSSWALKS, Warehouse, conformed, observed

#: Type of text in keys, which databases compare and index; keys hold no nulls.
KEY_TYPE = "VARCHAR(255)"


def columns_of(name: str) -> list[str]:
    return StructType.fromDDL(TABLES[name].ddl).fieldNames()


def scope(name: str, ids: str) -> str:
    """The condition that a table's row comes from one of the records whose ids stand in a table."""
    spec = TABLES[name]
    if spec.parent is None:
        return f'"id" IN (SELECT "id" FROM {ids})'
    if TABLES[spec.parent].parent is None:
        return f'"{spec.foreign}" IN (SELECT "id" FROM {ids})'
    return f'"{spec.foreign}" IN (SELECT "id" FROM {spec.parent} WHERE {scope(spec.parent, ids)})'


def swap(names: Iterable[str], where: dict[str, str] | None = None) -> list[str]:
    """Statements that put staging tables into place: all rows of a table go, or those for which its condition holds."""
    ordered, where = [n for n in TABLES if n in set(names)], where or {}
    gone = [f"DELETE FROM {n}" + (f" WHERE {where[n]}" if n in where else "") for n in reversed(ordered)]
    listed = {n: ", ".join(f'"{c}"' for c in columns_of(n)) for n in ordered}
    return gone + [f"INSERT INTO {n} ({listed[n]}) SELECT {listed[n]} FROM staging_{n}" for n in ordered]


class Database:
    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None):
        self.spark, self.url, self.properties = spark, url, properties or {}

    def table(self, name: str) -> DataFrame:
        """A table of the database in the data model's columns and types; what is missing there is null."""
        return conformed(self.spark.read.jdbc(self.url, name, properties=self.properties), name)

    def execute(self, statements: list[str]) -> None:
        """All statements in one transaction, or none."""
        jvm = self.spark._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        told = jvm.java.util.Properties()
        for k, v in self.properties.items():
            told.setProperty(k, v)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, told)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for s in statements:
                statement.execute(s)
            connection.commit()
        except Py4JJavaError:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _can(self, statement: str) -> bool:
        try:
            self.execute([statement])
        except Py4JJavaError:
            return False
        return True

    def _staged(self, name: str, rows: DataFrame) -> int:
        """Rows into a staging table of their own; returns their number, counted as they are written."""
        told = Observation()
        own = {"id"} if name not in TABLES else {*TABLES[name].key, TABLES[name].foreign}
        keys = [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType) and f.name in own]
        writer = rows.observe(told, F.count("*").alias("n")).write.mode("overwrite")
        if keys:
            writer = writer.option("createTableColumnTypes", ", ".join(f"{k} {KEY_TYPE}" for k in keys))
        writer.jdbc(self.url, f"staging_{name}", properties=self.properties)
        return observed(told)

    def _publish(self, rows: dict[str, DataFrame], where: dict[str, str], ids: dict[str, DataFrame]) -> dict[str, int]:
        staged: list[str] = []
        try:
            counts = {}
            for name, df in ids.items():
                staged.append(f"ids_{name}")
                self._staged(f"ids_{name}", df.select(F.col("id").cast("string")).distinct())
            for name, df in rows.items():
                staged.append(name)
                counts[name] = self._staged(name, df)
            for name in rows:
                if not self._can(f"SELECT 1 FROM {name} WHERE 1 = 0"):
                    self.execute([f"CREATE TABLE {name} AS SELECT * FROM staging_{name} WITH NO DATA"])
            self.execute(swap(rows, where))
            return counts
        finally:
            for name in staged:
                self._can(f"DROP TABLE staging_{name}")

    def publish(self, warehouse: Warehouse, tables: list[str] | None = None) -> dict[str, int]:
        """All managed tables, or some, as they stand in one version of the warehouse; returns their sizes."""
        now = warehouse.versions.newest()
        return self._publish({n: warehouse.table(n, now) for n in tables or TABLES if n not in UNMANAGED}, {}, {})

    def publish_changes(self, warehouse: Warehouse, changes: dict[str, DataFrame]) -> dict[str, int]:
        """Only the rows that come from changed records (ids by source), and the crosswalks of changed kinds in full; returns how many came."""
        rows: dict[str, DataFrame] = {}
        where: dict[str, str] = {}
        for source, ids in changes.items():
            for name in (n for n, spec in TABLES.items() if spec.source == source):
                rows[name], where[name] = warehouse.subtree(name, ids), scope(name, f"staging_ids_{source}")
        for walk in (w for w, kinds in CROSSWALKS.items() if {*kinds} & {*changes}):
            rows[walk] = warehouse.table(walk)
        return self._publish(rows, where, changes) if changes else {}

    def publish_pending(self, warehouse: Warehouse) -> dict[str, int]:
        """What was loaded since the last publication; it is ticked off once it is in the database."""
        told, ids = warehouse.pending()
        counts = self.publish_changes(warehouse, ids)
        if told:
            warehouse.published(told)
        return counts
