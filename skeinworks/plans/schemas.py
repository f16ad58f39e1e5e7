"""The data model: read schemas of the six landed sources, and the flat tables that they fill.

Sources and tables of the second site are marked ``b_``. Every list element is explicit, and no schema is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

_DATED = "from_date:string,to_date:string"
_REF = "array<struct<id:string,name:string>>"
_SIDE = f"struct<wrestlers:{_REF},teams:{_REF},valets:{_REF},is_champion:boolean>"
_CHAMPION = "struct<id:string,name:string,title_reign_count:int>"

#: Read schemas.
SOURCES = {
    "promotions": f"id string, name string, profile_url string, location string, active_year_start int, active_year_end int, rating double, votes int, name_history array<struct<name:string,{_DATED}>>",
    "wrestlers": "id string, name string, profile_url string, promotions array<string>, gender string, birthday string, birthplace string, age int, height_cm int, weight_kg int, "
    "background_in_sports array<string>, alter_egos array<string>, nicknames array<string>, signature_moves array<string>, wrestling_style array<string>, trainers array<string>, active_roles array<string>, "
    f"roles array<struct<role:string,date_ranges:array<struct<{_DATED}>>>>, career_start string, career_end string, career_experience_years int, websites array<string>, "
    "current_promotion string, current_brand string, roster_rating double, roster_votes int, career_shows int",
    "titles": f"id string, name string, promotion string, reigns array<struct<reign_number:int,champions:array<{_CHAMPION}>,team:{_CHAMPION},{_DATED},duration_days:int,location:string>>",
    "matches": "id string, name string, profile_url string, promotion string, date string, location string, event_rating double, event_votes int, event_type string, arena string, broadcast_type string, "
    f"broadcast_date string, tv_network string, commentators {_REF}, matches array<struct<match_index:int,match_type:string,title_id:string,title_name:string,title_change:boolean,duration:string,"
    f"result:string,finish_note:string,winners:{_SIDE},losers:array<{_SIDE}>,sides:array<{_SIDE}>,match_rating:double,match_votes:int,won_rating:string,notes:array<string>>>",
    "b_titles": "id string, name string, profile_url string, promotion string, brand string, gender string, date_established string, current_champion string, territory string, title_type string, image_url string, "
    f"name_history array<struct<name:string,{_DATED},image_url:string>>, reigns array<struct<reign_number:int,champions:array<{_CHAMPION}>,{_DATED},duration_days:int,location:string,event_name:string,event_url:string,notes:string,is_vacant:boolean>>",
    "b_wrestlers": "id string, name string, profile_url string, real_name string, gender string, birthday string, age int, nationality string, birthplace string, billed_from string, height_cm int, weight_kg int, image_url string, "
    f"nicknames array<string>, finishers array<string>, name_history array<struct<name:string,{_DATED}>>, promotions array<struct<promotion:string,brand:string,{_DATED}>>, roles array<struct<role:string,{_DATED}>>, "
    f"alignments array<struct<alignment:string,details:string,{_DATED}>>, images array<struct<label:string,image_url:string>>, career_awards array<struct<name:string,url:string,image_url:string>>, "
    "hall_of_fames array<struct<name:string,category:string,year:int,url:string,image_url:string>>, title_wins array<struct<promotion:string,title:string,times:int,details:string,title_url:string,image_url:string,source:string>>, accomplishments array<string>",
}


@dataclass(frozen=True)
class Table:
    """``parent``: the table whose ``id`` the column ``foreign`` holds. ``strict``: a null or repeated key among new rows is an error."""

    ddl: str
    key: list[str]
    source: str | None = None
    parent: str | None = None
    foreign: str | None = None
    strict: bool = False


def _child(parent: str, source: str, columns: str, key: str = "seq", foreign: str | None = None) -> Table:
    fk = foreign or f"{parent.removeprefix('b_').removesuffix('s')}_id"
    return Table(f"{fk} string, seq int, {columns}", [fk, *key.split(",")], source, parent, fk)


#: The flat tables, parents before children.
TABLES = {
    "promotions": Table("id string, name string, profile_url string, location string, active_year_start int, active_year_end int, rating double, votes int", ["id"], "promotions"),
    "promotion_name_history": _child("promotions", "promotions", "name string, from_date string, to_date string"),
    "promotion_abbr": Table("promotion_id string, abbreviation string", ["promotion_id"]),
    "wrestlers": Table("id string, name string, profile_url string, gender string, birthday string, birthplace string, age int, height_cm int, weight_kg int, career_start string, career_end string, career_experience_years int, current_promotion string, current_brand string, roster_rating double, roster_votes int, career_shows int", ["id"], "wrestlers"),
    "wrestler_promotions": Table("wrestler_id string, promotion_id string, seq int", ["wrestler_id", "seq"], "wrestlers", "wrestlers", "wrestler_id"),
    "wrestler_attributes": Table("wrestler_id string, attr_type string, seq int, value string", ["wrestler_id", "attr_type", "seq"], "wrestlers", "wrestlers", "wrestler_id"),
    "wrestler_roles": Table("id long, wrestler_id string, seq int, role string", ["id"], "wrestlers", "wrestlers", "wrestler_id"),
    "wrestler_role_date_ranges": Table("wrestler_role_id long, seq int, from_date string, to_date string", ["wrestler_role_id", "seq"], "wrestlers", "wrestler_roles", "wrestler_role_id"),
    "titles": Table("id string, name string, promotion string", ["id"], "titles"),
    "title_reigns": Table("id string, title_id string, reign_number int, from_date string, to_date string, duration_days int, location string, team_id string, team_name string, team_reign_count int", ["id"], "titles", "titles", "title_id", True),
    "title_reign_champions": Table("title_reign_id string, seq int, wrestler_id string, wrestler_name string, reign_count int", ["title_reign_id", "seq"], "titles", "title_reigns", "title_reign_id"),
    "events": Table("id string, name string, profile_url string, promotion string, date string, location string, event_rating double, event_votes int, event_type string, arena string, broadcast_type string, broadcast_date string, tv_network string", ["id"], "matches"),
    "event_commentators": Table("event_id string, seq int, wrestler_id string, wrestler_name string", ["event_id", "seq"], "matches", "events", "event_id"),
    "matches": Table("id string, event_id string, match_index int, match_type string, title_id string, title_name string, title_change boolean, duration string, result string, finish_note string, match_rating double, match_votes int, won_rating string", ["id"], "matches", "events", "event_id"),
    "match_notes": Table("match_id string, seq int, note string", ["match_id", "seq"], "matches", "matches", "match_id"),
    "match_sides": Table("id string, match_id string, side_role string, side_index int, is_champion boolean", ["id"], "matches", "matches", "match_id"),
    "match_side_participants": Table("match_side_id string, participant_role string, seq int, participant_id string, participant_name string", ["match_side_id", "participant_role", "seq"], "matches", "match_sides", "match_side_id"),
    "b_titles": Table("id string, name string, profile_url string, promotion string, brand string, gender string, date_established string, current_champion string, territory string, title_type string, image_url string", ["id"], "b_titles"),
    "b_title_name_history": _child("b_titles", "b_titles", "name string, from_date string, to_date string, image_url string"),
    "b_title_reigns": Table("id string, title_id string, seq int, reign_number int, from_date string, to_date string, duration_days int, location string, event_name string, event_url string, notes string, is_vacant boolean", ["id"], "b_titles", "b_titles", "title_id"),
    "b_title_reign_champions": Table("title_reign_id string, seq int, wrestler_id string, wrestler_name string, reign_count int", ["title_reign_id", "seq"], "b_titles", "b_title_reigns", "title_reign_id"),
    "b_wrestlers": Table("id string, name string, profile_url string, real_name string, gender string, birthday string, age int, nationality string, birthplace string, billed_from string, height_cm int, weight_kg int, image_url string", ["id"], "b_wrestlers"),
    "b_wrestler_attributes": Table("wrestler_id string, attr_type string, seq int, value string", ["wrestler_id", "attr_type", "seq"], "b_wrestlers", "b_wrestlers", "wrestler_id"),
    "b_wrestler_name_history": _child("b_wrestlers", "b_wrestlers", "name string, from_date string, to_date string"),
    "b_wrestler_promotions": _child("b_wrestlers", "b_wrestlers", "promotion string, brand string, from_date string, to_date string"),
    "b_wrestler_roles": _child("b_wrestlers", "b_wrestlers", "role string, from_date string, to_date string"),
    "b_wrestler_alignments": _child("b_wrestlers", "b_wrestlers", "alignment string, details string, from_date string, to_date string"),
    "b_wrestler_images": _child("b_wrestlers", "b_wrestlers", "label string, image_url string"),
    "b_wrestler_career_awards": _child("b_wrestlers", "b_wrestlers", "name string, url string, image_url string"),
    "b_wrestler_hall_of_fames": _child("b_wrestlers", "b_wrestlers", "name string, category string, year int, url string, image_url string"),
    "b_wrestler_title_wins": _child("b_wrestlers", "b_wrestlers", "promotion string, title string, times int, details string, title_url string, image_url string, source string"),
    "b_wrestler_accomplishments": _child("b_wrestlers", "b_wrestlers", "value string"),
    "wrestler_crosswalk": Table("a_id string, b_id string, match_method string, confidence double", ["a_id", "b_id"]),
    "title_crosswalk": Table("a_id string, b_id string, match_method string, confidence double", ["a_id", "b_id"]),
}
#: Kept by hand, so neither loaded nor published.
UNMANAGED = {"promotion_abbr"}
