"""Each landed source to its flat tables, one pass a table, list order kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.operators.nested import eav, explode_child, normalised_sides, participants, synthetic_key
from skeinworks.plans.schemas import TABLES

#: Attribute names by the list that they come from, and lists that are tables.
A_ATTRIBUTES = {"sport_background": "background_in_sports", "alter_ego": "alter_egos", "nickname": "nicknames", "signature_move": "signature_moves", "wrestling_style": "wrestling_style", "trainer": "trainers", "active_role": "active_roles", "website": "websites"}
B_ATTRIBUTES = {"nickname": "nicknames", "finisher": "finishers"}
B_CHILDREN = ["name_history", "promotions", "roles", "alignments", "images", "career_awards", "hall_of_fames", "title_wins"]


def columns(table: str) -> list[str]:
    return [part.split()[0] for part in TABLES[table].ddl.split(", ")]


def shaped(df: DataFrame, table: str) -> DataFrame:
    return df.select(*(F.col(p.split()[0]).cast(p.split()[1]) for p in TABLES[table].ddl.split(", ")))


def role_id(wrestler: Column, seq: Column) -> Column:
    """A key for a role that is the same at every load."""
    return F.xxhash64(wrestler, seq)


def promotions(raw: DataFrame) -> dict[str, DataFrame]:
    return {"promotions": raw, "promotion_name_history": explode_child(raw, {"promotion_id": "id"}, "name_history", ["name", "from_date", "to_date"])}


def wrestlers(raw: DataFrame) -> dict[str, DataFrame]:
    roles = explode_child(raw, {"wrestler_id": "id"}, "roles", ["role", "date_ranges"]).withColumn("id", role_id(F.col("wrestler_id"), F.col("seq")))
    return {
        "wrestlers": raw,
        "wrestler_promotions": explode_child(raw, {"wrestler_id": "id"}, "promotions", value="promotion_id"),
        "wrestler_attributes": eav(raw, {"wrestler_id": "id"}, A_ATTRIBUTES),
        "wrestler_roles": roles,
        "wrestler_role_date_ranges": explode_child(roles.drop("seq"), {"wrestler_role_id": "id"}, "date_ranges", ["from_date", "to_date"]),
    }


def _champions(reigns: DataFrame) -> DataFrame:
    rows = explode_child(reigns.drop("seq"), {"title_reign_id": "id"}, "champions", ["id", "name", "title_reign_count"])
    return rows.select("title_reign_id", "seq", F.col("id").alias("wrestler_id"), F.col("name").alias("wrestler_name"), F.col("title_reign_count").alias("reign_count"))


def titles(raw: DataFrame) -> dict[str, DataFrame]:
    r = raw.select(F.col("id").alias("title_id"), F.explode("reigns").alias("r")).select("title_id", "r.*")
    r = r.withColumn("id", synthetic_key("title_id", "reign_number")).withColumns({"team_id": F.col("team.id"), "team_name": F.col("team.name"), "team_reign_count": F.col("team.title_reign_count")})
    return {"titles": raw, "title_reigns": r, "title_reign_champions": _champions(r)}


def matches(raw: DataFrame) -> dict[str, DataFrame]:
    # Of bouts with one index the first counts; its children then have keys of their own.
    once = F.filter("matches", lambda x, i: ~F.exists(F.slice("matches", F.lit(1), i), lambda y: y["match_index"].eqNullSafe(x["match_index"])))
    m = raw.select(F.col("id").alias("event_id"), F.explode(once).alias("m")).select("event_id", "m.*").withColumn("id", synthetic_key("event_id", "match_index"))
    s = m.select(F.col("id").alias("match_id"), F.explode(normalised_sides(F.col("winners"), F.col("losers"), F.col("sides"))).alias("s"))
    s = s.select("match_id", F.col("s.role").alias("side_role"), F.col("s.idx").alias("side_index"), F.col("s.side").alias("side"))
    s = s.withColumns({"id": synthetic_key("match_id", "side_role", "side_index"), "is_champion": F.col("side.is_champion")})
    speakers = explode_child(raw, {"event_id": "id"}, "commentators", ["id", "name"])
    return {
        "events": raw,
        "event_commentators": speakers.select("event_id", "seq", F.col("id").alias("wrestler_id"), F.col("name").alias("wrestler_name")),
        "matches": m,
        "match_notes": explode_child(m, {"match_id": "id"}, "notes", value="note"),
        "match_sides": s,
        "match_side_participants": participants(s, {"match_side_id": "id"}, F.col("side"), {"wrestler": "wrestlers", "team": "teams", "valet": "valets"}),
    }


def b_titles(raw: DataFrame) -> dict[str, DataFrame]:
    r = raw.select(F.col("id").alias("title_id"), F.posexplode("reigns").alias("seq", "r")).select("title_id", "seq", "r.*").withColumn("id", synthetic_key("title_id", "seq"))
    return {"b_titles": raw, "b_title_name_history": explode_child(raw, {"title_id": "id"}, "name_history", ["name", "from_date", "to_date", "image_url"]), "b_title_reigns": r, "b_title_reign_champions": _champions(r)}


def b_wrestlers(raw: DataFrame) -> dict[str, DataFrame]:
    out = {"b_wrestlers": raw, "b_wrestler_attributes": eav(raw, {"wrestler_id": "id"}, B_ATTRIBUTES)}
    for name in B_CHILDREN:
        table = f"b_wrestler_{name}"
        out[table] = explode_child(raw, {"wrestler_id": "id"}, name, [c for c in columns(table) if c not in ("wrestler_id", "seq")])
    return out | {"b_wrestler_accomplishments": explode_child(raw, {"wrestler_id": "id"}, "accomplishments")}


FLATTENERS: dict[str, Callable[[DataFrame], dict[str, DataFrame]]] = {"promotions": promotions, "wrestlers": wrestlers, "titles": titles, "matches": matches, "b_titles": b_titles, "b_wrestlers": b_wrestlers}


def flatten(source: str, raw: DataFrame) -> dict[str, DataFrame]:
    """Flat tables of one source's records (newest of each id already), with their exact columns and types."""
    return {name: shaped(df, name) for name, df in FLATTENERS[source](raw).items()}
