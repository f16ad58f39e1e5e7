"""Generators: nested lists to child rows, with the order of the list kept as a 0-based ``seq``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_child(df: DataFrame, keys: dict[str, Column | str], items: Column | str, fields: list[str] | None = None, seq: str = "seq", value: str = "value") -> DataFrame:
    """A row for each list element: the keys, its place, and its fields (or the element itself as ``value``).

    Null and empty lists give no rows.
    """
    items = F.col(items) if isinstance(items, str) else items
    rows = df.select(*((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in keys.items()), F.posexplode(items).alias(seq, "_item"))
    kept = [F.col(f"_item.{f}").alias(f) for f in fields] if fields else [F.col("_item").alias(value)]
    return rows.select(*keys, seq, *kept)


def explode_path(df: DataFrame, keys: dict[str, Column | str], path: list[tuple[str, str]], fields: list[str]) -> DataFrame:
    """Lists in lists: ``path`` names each level's list and its place column; fields are of the innermost elements."""
    rows = df.select(*((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in keys.items()), F.struct("*").alias("_item"))
    places: list[str] = []
    for name, place in path:
        rows = rows.select(*keys, *places, F.posexplode(F.col(f"_item.{name}")).alias(place, "_item"))
        places.append(place)
    return rows.select(*keys, *places, *(F.col(f"_item.{f}").alias(f) for f in fields))


def eav(df: DataFrame, key: dict[str, Column | str], attributes: dict[str, Column | str], name: str = "attr_type") -> DataFrame:
    """(key, attr_type, seq, value) of several scalar lists in one pass."""
    pairs = [x for a, c in attributes.items() for x in (F.lit(a), F.col(c) if isinstance(c, str) else c)]
    rows = df.select(*((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in key.items()), F.explode(F.create_map(*pairs)).alias(name, "_list"))
    return rows.select(*key, name, F.posexplode("_list").alias("seq", "value"))


def split_explode(df: DataFrame, keys: list[str], text: Column, separator: str) -> DataFrame:
    return df.select(*keys, F.explode(F.split(text, separator)).alias("value"))


def synthetic_key(*parts: Column | str) -> Column:
    """Parts joined by hyphens; a null part makes a null key."""
    out = []
    for p in parts:
        out += [F.lit("-"), (F.col(p) if isinstance(p, str) else p).cast("string")]
    return F.concat(*out[1:])


def normalised_sides(winners: Column, losers: Column, sides: Column) -> Column:
    """One list of (role, index, side) from a winner, a list of losers and a list of undecided sides."""

    def tagged(role: str, items: Column) -> Column:
        return F.transform(F.coalesce(items, F.array()), lambda x, i: F.struct(F.lit(role).alias("role"), i.cast("int").alias("idx"), x.alias("side")))

    winner = F.when(winners.isNotNull(), F.array(winners))
    return F.concat(tagged("winner", winner), tagged("loser", losers), tagged("side", sides))


def participants(df: DataFrame, key: dict[str, Column | str], side: Column, lists: dict[str, str]) -> DataFrame:
    """(key, participant_role, seq, id, name) of a side's several member lists in one pass."""
    pairs = [x for role, name in lists.items() for x in (F.lit(role), side[name])]
    rows = df.select(*((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in key.items()), F.explode(F.create_map(*pairs)).alias("participant_role", "_list"))
    return rows.select(*key, "participant_role", F.posexplode("_list").alias("seq", "_p")).select(*key, "participant_role", "seq", F.col("_p.id").alias("participant_id"), F.col("_p.name").alias("participant_name"))


def nest(df: DataFrame, keys: list[str], order: list[str], fields: list[str], name: str) -> DataFrame:
    """The inverse of ``explode_child``: children gathered in order."""
    item = F.struct(*order, *(f for f in fields if f not in order))
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias(name))
    return rows.withColumn(name, F.transform(name, lambda x: F.struct(*(x[f].alias(f) for f in fields))))
