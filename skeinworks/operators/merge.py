"""DML on plain tables: upsert, insert-ignore, child replacement, key checks and refresh policies."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.sources.landing import first_per_key


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with their keys; others stay. ``keep`` columns hold their old values."""
    if keep:
        before = old.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in keep), F.lit(True).alias("_had"))
        new = new.join(before, keys, "left").select(*(F.when(F.col("_had"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in keep else F.col(c) for c in new.columns))
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[str | Column] | None = None) -> DataFrame:
    """Rows of ``new`` whose keys are in neither ``old`` nor an earlier row of ``new``."""
    once = first_per_key(new, keys, order) if order else new.dropDuplicates(keys)
    return old.unionByName(once.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def delete_children(old: DataFrame, ids: DataFrame, parent: str) -> DataFrame:
    """Rows whose parent isn't among ``ids`` (one column of the same name)."""
    return old.join(ids.select(parent).distinct(), parent, "left_anti").select(*old.columns)


def replace_children(old: DataFrame, new: DataFrame, ids: DataFrame, parent: str) -> DataFrame:
    """All children of the ids go, the new ones come."""
    return delete_children(old, ids, parent).unionByName(new, allowMissingColumns=True)


def tail_of_path(rows: DataFrame, parents: list[tuple[DataFrame, str, str]], ids: DataFrame, kind: str = "left_semi") -> DataFrame:
    """Rows below the ids, some levels down: ``parents`` lead from the ids to the rows as (table, its key, its parent key)."""
    scope = ids
    for table, key, parent in parents:
        scope = table.join(scope.select(F.col(scope.columns[0]).alias(parent)).distinct(), parent, "left_semi").select(key)
    name = rows.columns[0]
    return rows.join(scope.select(F.col(scope.columns[0]).alias(name)).distinct(), name, kind)


class KeyViolation(ValueError):
    """A key that is null, repeated or without its parent."""


def key_report(df: DataFrame, keys: list[str], parent: DataFrame | None = None, foreign: str | None = None, parent_key: str = "id") -> DataFrame:
    """One row: rows with null keys, keys that stand more than once, and rows whose parent is missing. Keys are counted in one pass."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    out = counted.select(F.when(null, F.col("_n")).otherwise(0).alias("nulls"), F.when(~null & (F.col("_n") > 1), 1).otherwise(0).alias("repeated"), F.lit(0).alias("orphans"))
    if parent is not None and foreign:
        lost = df.where(F.col(foreign).isNotNull()).join(parent.select(F.col(parent_key).alias(foreign)), foreign, "left_anti")
        out = out.unionByName(lost.select(F.lit(0).alias("nulls"), F.lit(0).alias("repeated"), F.lit(1).alias("orphans")))
    return out.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("nulls", "repeated", "orphans")))


def validate_keys(df: DataFrame, keys: list[str], parent: DataFrame | None = None, foreign: str | None = None, parent_key: str = "id") -> dict[str, int]:
    """``key_report`` as numbers."""
    r = key_report(df, keys, parent, foreign, parent_key).first()
    return {"null": r.nulls, "repeated": r.repeated, "orphans": r.orphans}


def require_keys(df: DataFrame, keys: list[str], **more) -> DataFrame:
    found = {k: n for k, n in validate_keys(df, keys, **more).items() if n}
    if found:
        raise KeyViolation(f"{keys}: {found}")
    return df


# Refresh policies: true where the stored row needs no new visit ---------------------------------------------------------------


def skip_existing(rows: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Rows that aren't stored yet."""
    return rows.join(stored.select(key), key, "left_anti")


#: Event types that are refreshed however far ahead they are.
BIG_EVENTS = ["Pay Per View", "Premium Live Event"]


def skip_event(day: Column, has_results: Column, event_type: Column, today: datetime.date | Column, refresh_days: int = 1, far_days: int = 30) -> Column:
    """No date: skip what has results. Far ahead: skip all but big events. From ``refresh_days`` back up to there: never. Before: skip what has results."""
    ahead = F.datediff(day, today if isinstance(today, Column) else F.lit(today))
    big = F.coalesce(event_type.isin(BIG_EVENTS), F.lit(False))
    return F.when(day.isNull(), has_results).when(ahead > far_days, ~big).when(ahead >= -refresh_days, F.lit(False)).otherwise(has_results)


def skip_title(listed_status: Column, stored_status: Column) -> Column:
    """Skip only what is inactive by the listing, or else by the stored row."""
    return F.lower(F.coalesce(F.nullif(listed_status, F.lit("")), stored_status, F.lit(""))) == "inactive"


def enrich(rows: DataFrame, profiles: DataFrame, key: str) -> DataFrame:
    """List rows with their profile pages' fields, which win where they are set."""
    shared = [c for c in profiles.columns if c in rows.columns and c != key]
    more = [c for c in profiles.columns if c not in rows.columns]
    p = profiles.select(key, *(F.col(c).alias(f"_p_{c}") for c in shared), *more)
    return rows.join(p, key, "left").select(key, *(F.coalesce(f"_p_{c}", c).alias(c) if c in shared else F.col(c) for c in rows.columns if c != key), *more)


def carry_prev(df: DataFrame, partition: list[str], order: list[str], value: str, to: str) -> DataFrame:
    """``to`` gets the value of the row before; the first row of a partition stays open (null)."""
    return df.withColumn(to, F.lag(value).over(Window.partitionBy(*partition).orderBy(*order)))
