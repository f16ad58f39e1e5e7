import json

import pytest
from pyspark.sql import functions as F

from skeinworks.functions import dates, dom
from skeinworks.functions import text as T
from skeinworks.functions.settings import Settings
from skeinworks.operators import linkage, merge
from skeinworks.plans.schemas import SOURCES, TABLES, UNMANAGED
from skeinworks.plans.database import swap
from skeinworks.plans.warehouse import Warehouse, conformed
from skeinworks.sources import landing
from skeinworks.streaming import incremental

MATCH = {"match_index": 1, "result": "decisive", "winners": {"wrestlers": [{"id": "1", "name": "A"}], "is_champion": True}, "losers": [{"wrestlers": [{"id": "2", "name": "B"}], "valets": [{"id": "3", "name": "V"}]}], "notes": ["n"]}
DRAW = {"match_index": 2, "result": "no_decision", "sides": [{"wrestlers": [{"id": "1", "name": "A"}]}, {"teams": [{"id": "9", "name": "T"}]}]}


def lines(path, *records):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
    return str(path)


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"{tmp_path}/w")


def test_children_keep_order_and_absent_lists_are_none(spark, warehouse, tmp_path):
    path = lines(tmp_path / "p.jsonl", {"id": "1", "name": "P", "votes": "7", "name_history": [{"name": "x"}, {"name": "y", "to_date": "t"}]}, {"id": "2", "name": "Q"})
    assert warehouse.load("promotions", path) == 2
    assert {(r.id, r.votes) for r in warehouse.table("promotions").collect()} == {("1", 7), ("2", None)}
    assert rows(warehouse.table("promotion_name_history"), "promotion_id", "seq", "name") == [("1", 0, "x"), ("1", 1, "y")]


def test_attributes_and_roles(warehouse, tmp_path):
    path = lines(tmp_path / "w.jsonl", {"id": "1", "name": "W", "nicknames": ["n"], "trainers": ["a", "b"], "roles": [{"role": "R", "date_ranges": [{"from_date": "2010"}]}]})
    warehouse.load("wrestlers", path)
    assert rows(warehouse.table("wrestler_attributes"), "attr_type", "seq", "value") == [("nickname", 0, "n"), ("trainer", 0, "a"), ("trainer", 1, "b")]
    ranges = warehouse.table("wrestler_role_date_ranges").join(warehouse.table("wrestler_roles").select(F.col("id").alias("wrestler_role_id"), "role"), "wrestler_role_id")
    assert [(r.role, r.from_date, r.to_date) for r in ranges.collect()] == [("R", "2010", None)]


def test_sides_newest_line_and_stale_children(warehouse, tmp_path):
    path = lines(tmp_path / "m.jsonl", {"id": "e1", "matches": [DRAW]}, {"id": "e1", "matches": [MATCH, DRAW], "commentators": [{"id": "5", "name": "C"}]}, '{"id": "brok')
    assert warehouse.load("matches", path) == 1
    assert rows(warehouse.table("match_sides"), "id") == [("e1-1-loser-0",), ("e1-1-winner-0",), ("e1-2-side-0",), ("e1-2-side-1",)]
    assert rows(warehouse.table("match_side_participants"), "match_side_id", "participant_role", "seq", "participant_id") == [("e1-1-loser-0", "valet", 0, "3"), ("e1-1-loser-0", "wrestler", 0, "2"), ("e1-1-winner-0", "wrestler", 0, "1"), ("e1-2-side-0", "wrestler", 0, "1"), ("e1-2-side-1", "team", 0, "9")]
    before = rows(warehouse.table("match_sides"), "id")
    warehouse.load("matches", path)
    assert rows(warehouse.table("match_sides"), "id") == before
    warehouse.load("matches", lines(tmp_path / "m2.jsonl", {"id": "e1", "matches": [DRAW]}))
    assert rows(warehouse.table("match_sides"), "id") == [("e1-2-side-0",), ("e1-2-side-1",)]
    assert warehouse.table("match_notes").count() == warehouse.table("event_commentators").count() == 0


def test_missing_file_and_export(warehouse, tmp_path):
    assert warehouse.load("titles", f"{tmp_path}/none.jsonl") == 0
    assert len(warehouse.export(f"{tmp_path}/out")) == len(TABLES) - len(UNMANAGED) == 33


def _people(spark, a, b, aliases=(), rings=()):
    an = spark.createDataFrame([(i, n, True) for i, n, _ in a] + [(i, n, False) for i, n in aliases], "id string, name string, is_primary boolean")
    bn = spark.createDataFrame([(i, n, True) for i, n, _ in b] + [(i, n, False) for i, n in rings], "id string, name string, is_primary boolean")
    day = "id string, day string"
    out = linkage.person_crosswalk(an, bn, spark.createDataFrame([(i, d) for i, _, d in a], day), spark.createDataFrame([(i, d) for i, _, d in b], day))
    return {(r.a_id, r.b_id, r.match_method, r.confidence) for r in out.collect()}


def test_person_links(spark):
    assert _people(spark, [("1", "Rex Tide", "03.04.1981")], [("r", "Rex  Tídé", "April 3, 1981")]) == {("1", "r", "name_and_birthday", 1.0)}
    assert _people(spark, [("1", "Lone", "05.06.1983")], [("l", "Lone", "June 7, 1983")]) == {("1", "l", "name_birthday_mismatch", 0.7)}
    assert _people(spark, [("1", "Una Ray", "08.09.1985")], [("d", "Duo Bay", "March 4, 1979")], [("1", "Both")], [("d", "Both")]) == set()
    assert _people(spark, [("1", "Una Ray", "8.9.1985")], [("d", "Duo Bay", "September 8, 1985")], [("1", "Both")], [("d", "Both")]) == {("1", "d", "alias_and_birthday", 0.9)}
    assert _people(spark, [("1", "Dock Hand", None)], [("a", "Abel Moor", None)], [("1", "Abel Moor")]) == {("1", "a", "alias", 0.6)}
    assert _people(spark, [("9", "Pat Quay", None), ("10", "Pat Quay", None)], [("q", "Pat Quay", None)]) == {("10", "q", "name", 0.8)}
    assert _people(spark, [("1", "Pat Quay", "01.02.1980"), ("2", "Pat Quay", "03.05.1991")], [("q", "Pat Quay", "May 3, 1991")]) == {("2", "q", "name_and_birthday", 1.0)}


def test_title_links(spark):
    slugs = spark.createDataFrame([("1", "wwe"), ("2287", "aew")], "promotion string, slug string")
    a = spark.createDataFrame([("61", "Pier Team", "1"), ("62", "WWE World  Mast Title", "1"), ("63", "Pier Team", "2287"), ("64", "World Championship", "1"), ("65", None, "1")], "id string, name string, promotion string")
    b = spark.createDataFrame([("wwe/pier", "Pier Team"), ("aew/pier", "Pier Team"), ("wwe/mast", "Mast Championship"), ("aew/w", "World Championship")], "id string, name string")
    assert {(r.a_id, r.b_id, r.match_method) for r in linkage.title_crosswalk(a, b, slugs).collect()} == {("61", "wwe/pier", "name"), ("63", "aew/pier", "name"), ("62", "wwe/mast", "name_fuzzy")}


def test_mutual_best_with_ties_and_nulls(spark):
    rows = [("a", "x", 0.5), ("a", "y", 0.5), ("b", "x", 0.9), ("c", "y", None), ("c", "z", None), ("d", "w", 0.1)]
    got = linkage.mutual_best(spark.createDataFrame(rows, "a_id string, b_id string, confidence double")).collect()
    assert {(r.a_id, r.b_id) for r in got} == {("b", "x"), ("d", "w")}


def test_parts_of_a_compound_name_are_primary(spark, warehouse, tmp_path):
    warehouse.load("wrestlers", lines(tmp_path / "w.jsonl", {"id": "1", "name": "Rex Tide", "birthday": "03.04.1981"}))
    for day, method in (("April 1, 1981", "name_birthday_mismatch"), (None, "name"), ("April 3, 1981", "name_and_birthday")):
        warehouse.load("b_wrestlers", lines(tmp_path / "b.jsonl", {"id": "rex", "name": "Rex Tide / Old Salt", "birthday": day}))
        warehouse.link()
        assert rows(warehouse.table("wrestler_crosswalk"), "a_id", "b_id", "match_method") == [("1", "rex", method)]


def test_link_views_and_publication(spark, warehouse, tmp_path):
    warehouse.load("wrestlers", lines(tmp_path / "w.jsonl", {"id": "1", "name": "Rex Tide", "birthday": "03.04.1981"}, {"id": "2", "name": "Other"}))
    warehouse.load("b_wrestlers", lines(tmp_path / "b.jsonl", {"id": "rt", "name": "Tide / Rex Tide", "birthday": "April 3, 1981", "images": [{"label": "l", "image_url": "u"}]}))
    assert warehouse.link() == {"wrestler_crosswalk": 1, "title_crosswalk": 0}
    warehouse.views()
    assert [(r.a_name, r.match_method) for r in spark.table("v_wrestlers_matched").collect()] == [("Rex Tide", "name_and_birthday")]
    target = Warehouse(spark, f"{tmp_path}/t")
    assert warehouse.mirror(target)["wrestlers"] == 2
    warehouse.load("b_wrestlers", lines(tmp_path / "b2.jsonl", {"id": "rt", "name": "Rex Tide", "accomplishments": ["x"]}))
    warehouse.load("wrestlers", lines(tmp_path / "w2.jsonl", {"id": "2", "name": "Unpublished"}))
    moved = warehouse.mirror_changes(target, {"b_wrestlers": spark.createDataFrame([("rt",)], "id string")})
    assert moved["b_wrestler_accomplishments"] == 1 and moved["b_wrestler_images"] == 0
    assert target.table("b_wrestler_images").count() == 0 and rows(target.table("wrestlers"), "name") == [("Other",), ("Rex Tide",)]
    warehouse.clear("b_wrestlers", spark.createDataFrame([("rt",)], "id string"))
    assert warehouse.table("b_wrestler_accomplishments").count() == 0 and warehouse.table("b_wrestlers").count() == 1


def test_a_load_writes_the_buckets_of_its_records_alone(spark, warehouse, tmp_path):
    match = [{"match_index": k, "result": "unknown", "sides": [{"wrestlers": [{"id": "1", "name": "A"}]}], "notes": ["n"]} for k in (1, 2)]
    warehouse.load("matches", lines(tmp_path / "m.jsonl", *({"id": f"e{i}", "matches": match} for i in range(60))))
    before = warehouse._folders()
    warehouse.load("matches", lines(tmp_path / "n.jsonl", {"id": "e7", "matches": match[:1]}))
    after = warehouse._folders()
    for name in ("events", "matches", "match_sides", "match_side_participants", "match_notes"):
        assert sum(before[name][b] != after[name].get(b) for b in before[name]) == 1 and len(before[name]) > 5
    one = spark.createDataFrame([("e7",), ("e8",)], "id string")
    assert warehouse.subtree("match_side_participants", one).count() == 3 and warehouse.table("match_side_participants").count() == 119


def test_reigns_with_one_number_are_an_error(warehouse, tmp_path):
    for numbers in ((1, 1), (1, None)):
        path = lines(tmp_path / "t.jsonl", {"id": "5", "name": "T", "reigns": [{"reign_number": n} for n in numbers]})
        with pytest.raises(merge.KeyViolation):
            warehouse.load("titles", path)
    assert warehouse.table("titles").count() == 0  # nothing was made visible
    warehouse.load("titles", lines(tmp_path / "u.jsonl", {"id": "5", "name": "T", "reigns": [{"reign_number": 2, "champions": [{"id": "1", "name": "A"}]}, {"reign_number": 1}]}))
    assert rows(warehouse.table("title_reigns"), "id") == [("5-1",), ("5-2",)]


def test_of_bouts_with_one_index_the_first_counts(warehouse, tmp_path):
    again = {"match_index": 1, "result": "unknown", "notes": ["later"], "sides": [{}]}
    warehouse.load("matches", lines(tmp_path / "m.jsonl", {"id": "e", "matches": [MATCH, again, DRAW]}))
    assert rows(warehouse.table("matches"), "id", "result") == [("e-1", "decisive"), ("e-2", "no_decision")] and rows(warehouse.table("match_notes"), "note") == [("n",)]


def test_columns_added_later_are_null_in_older_files(spark, warehouse, tmp_path):
    warehouse.load("promotions", lines(tmp_path / "p.jsonl", {"id": "1", "name": "P", "votes": 3}))
    held = warehouse.table("promotions").drop("votes")
    warehouse.replace({"promotions": held})
    assert [(r.id, r.votes) for r in warehouse.table("promotions").collect()] == [("1", None)]
    warehouse.load("promotions", lines(tmp_path / "q.jsonl", {"id": "2", "name": "Q", "votes": 4}))
    assert {(r.id, r.votes) for r in warehouse.table("promotions").collect()} == {("1", None), ("2", 4)}
    got = conformed(spark.createDataFrame([("7", "x")], "id string, extra string"), "promotions")
    assert got.columns == warehouse.table("promotions").columns and got.first().id == "7"
    sql = swap(["matches", "events", "match_notes"])
    assert [x.split()[2] for x in sql if x.startswith("DELETE")] == ["match_notes", "matches", "events"] and [x.split()[2] for x in sql if x.startswith("INSERT")] == ["events", "matches", "match_notes"]


def test_nightly_gate_and_manifest(spark, warehouse, tmp_path):
    cursor, manifest = landing.Cursor(f"{tmp_path}/c.json"), landing.Manifest(spark, f"{tmp_path}/changes")
    path = tmp_path / "p.jsonl"

    def night():
        return incremental.nightly(spark, warehouse, {"promotions": str(path), "titles": f"{tmp_path}/none"}, cursor, manifest)

    lines(path, {"id": "old", "name": "o"})
    assert night() == {"promotions": 1} and night() == {}
    manifest.clear()
    lines(path, {"id": "old", "name": "o"}, "", {"id": "new-1", "name": "n"}, "bad", " ", {"id": "new-2", "name": "n"})
    night()
    assert rows(manifest.load(), "source", "id") == [("promotions", "new-1"), ("promotions", "new-2")]
    target = Warehouse(spark, f"{tmp_path}/t")
    assert incremental.publish_changes(spark, warehouse, target, manifest)["promotions"] == 2
    assert manifest.parts() == [] and incremental.publish_changes(spark, warehouse, target, manifest) == {}
    lines(path, {"id": "old", "name": "o"}, "", {"id": "new-1", "name": "changed"}, "bad", " ", {"id": "new-2", "name": "n"})  # as many lines
    assert night() == {"promotions": 3}
    assert rows(manifest.load(), "id") == [("new-1",), ("new-2",), ("old",)]  # old lines changed, so all ids count
    assert landing.Cursor(f"{tmp_path}/none.json").lines("x") == (0, "0")


def test_lines_are_numbered_over_files_and_tasks(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text("".join(f'{{"id": "{i}"}}\n' + "\n" * (i % 3) for i in range(200)))
    df = landing.read_lines(spark, str(tmp_path / "l.jsonl"))
    got = sorted((r._n, json.loads(r.value)["id"]) for r in landing.numbered_lines(df).collect())
    assert got == [(i, str(i)) for i in range(200)] and landing.count_lines(spark, str(tmp_path / "l.jsonl")) == 200
    assert sorted(int(r.id) for r in landing.ids_in(df, 190).collect()) == list(range(190, 200))
    assert landing.line_mark(df)[0] == 200 and landing.line_mark(df, 5)[0] == 5 and landing.line_mark(df.limit(0)) == (0, "0")


def test_written_lines_are_read_again(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", 5), ("2", None, None)], "id string, name string, votes int")
    landing.write_lines(df, f"{tmp_path}/out")
    landing.write_lines(df.where("id = '2'").withColumn("name", F.lit("later")), f"{tmp_path}/out", append=True)
    got = landing.read_source(spark, f"{tmp_path}/out", SOURCES["promotions"])
    assert rows(got, "id") == [("1",), ("2",), ("2",)] and rows(landing.existing_ids(got), "id") == [("1",), ("2",)]
    assert landing.read_source(spark, f"{tmp_path}/none", SOURCES["promotions"]).count() == 0


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    docs = [f"<sitemapindex {ns}><sitemap><loc>https://s/map-1.xml</loc></sitemap></sitemapindex>", f"<?xml version='1.0'?><urlset {ns}><url><loc> https://s/p/a/ </loc></url><url><loc>https://s/p/a</loc></url></urlset>", "<urlset><url><loc>https://s/p/b</loc></url><url><loc/></url></urlset>", "<urlset><loc>", "", None]
    df = spark.createDataFrame([(d,) for d in docs], "xml string")
    assert rows(landing.sitemap_locations(df, parent="sitemap"), "url") == [("https://s/map-1.xml",)]
    assert rows(landing.sitemap_locations(df, pattern="/p/"), "url") == [("https://s/p/a",), ("https://s/p/b",)]


def test_settings(tmp_path):
    (tmp_path / ".env").write_text("# x\nSKEINWORKS_MATCHES_REFRESH_DAYS=3\nSKEINWORKS_PROMOTION_IDS='7, 8'\nOTHER=1\n")
    s = Settings.load({"SKEINWORKS_MATCHES_REFRESH_DAYS": "5"}, str(tmp_path / ".env"))
    assert s.matches_refresh_days == 5 and s.promotion_id_list() == ["7", "8"] and s.matches_far_future_days == 30 and s.b_promotion_slug_list() == ["wwe", "aew"]
    assert Settings.load({"SKEINWORKS_PROMOTION_IDS": ""}).promotion_id_list() is None
    with pytest.raises(ValueError):
        Settings.load({"SKEINWORKS_MATCHES_SINCE_YEAR": "soon"})


def test_stream_loads_each_file_once(spark, warehouse, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines(folder / "a.jsonl", {"id": "1", "name": "a"})
    for more in (None, {"id": "2", "name": "b"}):
        if more:
            lines(folder / "b.jsonl", more)
        q = incremental.stream_loads(spark, warehouse, "promotions", str(folder), f"{tmp_path}/ck")
        q.awaitTermination(120)
    assert rows(warehouse.table("promotions"), "id") == [("1",), ("2",)]


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def test_scalar_parsers(spark):
    years = {x: tuple(one(spark, x, T.active_years)) for x in ("1951-", "2003-2011", "1987", "", "2000-2005-2010", "-1990", "19x9", " 1970 - 1980 ")}
    assert years == {"1951-": (1951, None), "2003-2011": (2003, 2011), "1987": (1987, 1987), "": (None, None), "2000-2005-2010": (2000, None), "-1990": (None, 1990), "19x9": (None, None), " 1970 - 1980 ": (1970, 1980)}
    assert one(spark, "8.25", T.try_double) == 8.25 and one(spark, "n/a", T.try_double) is None and one(spark, "1234", T.try_int) == 1234
    assert str(one(spark, "17.08.2019", T.parse_event_date)) == "2019-08-17" and one(spark, "7.8.2019", T.parse_event_date) is None and one(spark, "31.02.2019", T.parse_event_date) is None
    assert tuple(one(spark, "a - today", T.date_range)) == ("a", None) and tuple(one(spark, "x", T.date_range)) == ("x", "x") and tuple(one(spark, "today", T.date_range)) == ("today", None)
    assert one(spark, "a (b, c - today)\nd\ne (once) (f)", T.role_entries) == [("a", [("b", "b"), ("c", None)]), ("d", []), ("e", [("once) (f", "once) (f")])]
    assert tuple(one(spark, "June 9, 1991 (age 28)", T.born)) == ("June 9, 1991", 28) and tuple(one(spark, "1991 (age 28) or so", T.born)) == ("1991 (age 28) or so", None)
    assert one(spark, " Present ", T.normalize_date) is None and one(spark, " a \n b", T.clean_text) == "a b"
    assert one(spark, "100+", T.duration_days) == 100 and one(spark, "1x", T.duration_days) is None
    past = {x: one(spark, x, T.name_history_line) for x in ("Old (1.1.2000 - today)", "Old (1.1.2000-today)", "Old (1.1.2000 - 2001)", "none")}
    assert [tuple(v) if v else None for v in past.values()] == [("Old", "1.1.2000", None), ("Old", "1.1.2000", None), ("Old", "1.1.2000", "2001"), None]
    assert one(spark, "<div>a &amp; b<br/> <b>c</b><br></div>", T.br_list) == ["a & b", "c"] and one(spark, " <b>x &lt; y</b> ", T.strip_tags) == "x < y"
    kind = one(spark, '<a href="?id=5&amp;nr=31">Pier Title</a> Tag Match', T.match_type)
    assert tuple(kind) == ("31", "Pier Title", "Tag Match")
    assert tuple(one(spark, "Matchguide Rating: 7.25 based on 18 votes", T.match_rating)) == (7.25, 18) and tuple(one(spark, "Rating: 7.25 based on 18 votes", T.match_rating)) == (None, None)
    assert one(spark, "https://s/title-history/wwe/x/", lambda c: T.title_path(c, "title-history")) == "wwe/x" and one(spark, "https://s/title-history/wwe/x/extra", lambda c: T.title_path(c, "title-history")) is None
    links = {x: one(spark, x, lambda c: T.absolute_url(c, "https://s.example/a/b")) for x in ("../c/d", "/e", "//t/f", "http://u/g", "h?i#j", " ")}
    assert links == {"../c/d": "https://s.example/c/d", "/e": "https://s.example/e", "//t/f": "https://t/f", "http://u/g": "http://u/g", "h?i#j": "https://s.example/a/h?i#j", " ": None}
    found = one(spark, '<a class=x href="?id=2&amp;nr=3&amp;n">A &amp; <b>B</b></a><a href="/x">C</a><a>C</a>', dom.entity_links)
    assert [tuple(x) for x in found] == [("2", "3", "A & B")] and one(spark, "<a> C </a><a>C</a><a>D</a>", dom.link_texts) == ["C", "D"]


def test_dates_and_policies(spark):
    from datetime import date, datetime

    now = datetime(2031, 3, 2, 9)
    assert dates.resolve_on_dates("03.03.2031,today , 2031-02-27,tomorrow", now=now) == [date(2031, 2, 27), date(2031, 3, 2), date(2031, 3, 3)]
    from zoneinfo import ZoneInfo

    late = datetime(2031, 3, 3, 3, tzinfo=ZoneInfo("UTC"))  # still the day before in New York
    assert dates.resolve_on_dates("today", now=late) == [date(2031, 3, 2)] and dates.resolve_on_dates("today", "UTC", late) == [date(2031, 3, 3)]
    for bad in ("", "soon"):
        with pytest.raises(ValueError):
            dates.resolve_on_dates(bad, now=now)
    assert dates.id_list("1, 2,,") == ["1", "2"] and dates.id_list("") is None
    cases = [(-400, False, "TV", False), (-400, True, "TV", True), (0, True, "TV", False), (-3, True, "TV", True), (5, False, "TV", False), (5, True, "TV", False), (20, True, "TV", False), (30, True, "TV", False), (-1, True, "TV", False), (-2, True, "TV", True), (45, False, "TV", True), (45, False, "Premium Live Event", False), (45, False, None, True)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, ahead int, results boolean, kind string, want boolean")
    df = df.withColumn("day", F.date_add(F.lit(date(2026, 1, 1)), F.col("ahead")))
    got = df.withColumn("skip", merge.skip_event(F.col("day"), F.col("results"), F.col("kind"), date(2026, 1, 1)))
    assert all(r.skip == r.want for r in got.collect())


def test_key_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "id string, n int")
    assert merge.validate_keys(df, ["id"]) == {"null": 1, "repeated": 1, "orphans": 0}
    with pytest.raises(merge.KeyViolation):
        merge.require_keys(df, ["id"])
    assert merge.require_keys(df.limit(0), ["id"]).count() == 0


def test_people_are_linked_as_all_pairs_would_be(spark):
    """Random people with shared names, aliases and days, against every labelled pair."""
    import itertools
    import random

    rng = random.Random(7)
    days = [f"{d:02d}.04.1981" for d in range(1, 5)]
    for size in (6, 30, 60):
        def side(prefix, size=size):
            return {f"{prefix}{i}": (rng.choice([None, *days]), {(rng.choice("uvw"), rng.random() < 0.6) for _ in range(rng.randint(1, 3))}) for i in range(size)}

        a, b = side("a"), side("b")
        scored = {}
        for (i, (x, m)), (j, (y, n)) in itertools.product(a.items(), b.items()):
            shared = [(p, q) for (k, p), (o, q) in itertools.product(m, n) if k == o]
            prime = any(p and q for p, q in shared)
            other = bool(x and y and x != y)
            if shared and not (other and not prime):
                scored[i, j] = 1.0 if x and x == y and prime else 0.9 if x and x == y else 0.7 if prime and other else 0.8 if prime else 0.6
        first = {}
        for (i, j), s in scored.items():
            first[i] = min(first.get(i, (0, "")), (-s, j))
            first[j] = min(first.get(j, (0, "")), (-s, i))
        want = {(i, j, s) for (i, j), s in scored.items() if first[i][1] == j and first[j][1] == i}
        an, bn = (spark.createDataFrame([(i, f"{k} name", p) for i, (_, m) in rows_.items() for k, p in m], "id string, name string, is_primary boolean") for rows_ in (a, b))
        ad = spark.createDataFrame([(i, d) for i, (d, _) in a.items()], "id string, day string")
        bd = spark.createDataFrame([(i, d and f"April {int(d[:2])}, 1981") for i, (d, _) in b.items()], "id string, day string")
        assert {(r.a_id, r.b_id, r.confidence) for r in linkage.person_crosswalk(an, bn, ad, bd).collect()} == want


def test_one_name_of_many_people_makes_no_pairs(spark):
    n = 100_000  # ten thousand million pairs
    ids = spark.range(n).select(F.format_string("%06d", "id").alias("id"), F.lit("Pat Quay").alias("name"), F.lit(True).alias("is_primary"))
    day = F.expr("date_add(date'1900-01-01', cast(id as int) % 40000)")
    a_days, b_days = (ids.select("id", F.date_format(day, form).alias("day")) for form in ("dd.MM.yyyy", "MMMM d, yyyy"))
    got = linkage.person_crosswalk(ids, ids, a_days, b_days)
    assert [tuple(r) for r in got.groupBy("match_method").count().collect()] == [("name_and_birthday", 40_000)]


def test_accents_are_folded_in_the_jvm(spark):
    import unicodedata

    def plain(x):
        return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c)[0] != "M"))

    texts = ["Éé Ñandú Øre", "éx̣y", "Ǻ ẞ ﬁ Ⅳ", "한글 漢字 ά ώ й", "".join(map(chr, range(0xC0, 0x250))), "".join(map(chr, range(0x1E00, 0x2000))), "", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r.y for r in df.select(T.strip_accents(F.col("x")).alias("y")).collect()] == [t and plain(t) for t in texts]
    assert T.register_sql(spark) == ["strip_accents", "norm_name", "fuzzy_key"]
    df.createOrReplaceTempView("accents")
    told = spark.sql("select x, strip_accents(x) as bare, norm_name(x) as n, fuzzy_key('wwe title x') as f from accents")
    assert [(r.bare, r.n, r.f) for r in told.collect()] == [tuple(r) for r in df.select(T.strip_accents(F.col("x")), T.norm_name(F.col("x")), F.lit("x")).collect()]
    people = linkage.person_crosswalk(*(df.select(F.col("x").alias("id"), F.col("x").alias("name"), F.lit(True).alias("is_primary")) for _ in "ab"), *(df.select(F.col("x").alias("id"), F.lit("1.1.2000").alias("day")) for _ in "ab"))
    assert "Python" not in people._jdf.queryExecution().toString() and "Python" not in told._jdf.queryExecution().toString()
