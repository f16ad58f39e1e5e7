"""Page extraction on invented pages: one test for each kind of page and each rule that pages need."""

import pytest
from pyspark.sql import functions as F

from skeinworks.functions import dom
from skeinworks.sources import pages as P

A, B = "https://a.example", "https://b.example"
KINDS = P.extractors(A, B)


def records(kind, html, url):
    return list(KINDS[kind].parse(dom.tree(html), url))


def a(section, nr, name):
    return f'<a href="?id={section}&amp;nr={nr}&amp;name=x">{name}</a>'


def box(label, inner):
    return f'<div class="InformationBoxTitle">{label}</div>\n<div class="InformationBoxContents">{inner}</div>'


def bout(results, kind="Singles Match", more=""):
    return f'<div class="Match"><div class="MatchType">{kind}</div><div class="MatchResults">{results}</div>{more}</div>'


CARD = "".join(
    [
        box("Type:", "Weekly Show"),
        box("Arena:", "Harbour Hall"),
        box("Broadcast type:", "Taped"),
        box("Broadcast date:", "04.02.2031"),
        box("TV station/network:", "Channel 9"),
        box("Commentary by:", f"{a(2, 71, 'Ida Fox')}, {a(28, 5, 'The Pack')} &amp; {a(2, 72, 'Bo Lund')}"),
        bout(f"{a(2, 1, 'Ann Oak')} (w/{a(2, 9, 'Val Reed')}) defeats {a(2, 2, 'Bea Elm')} (c) and {a(2, 3, 'Cy Ash')} (12:55) - <span class=\"MatchTitleChange\">TITLE CHANGE !!!</span>", f"{a(5, 20, 'Harbour Title')} Three Way Match", '<div class="MatchRecommendedLine">Matchguide Rating: 6.45 based on 21 votes <span class="starRating">***1/2</span></div><div class="MatchNotes">- Ann &amp; Bea out (1:00)<br>- Cy out<br/></div>'),
        '<div class="Match"><div class="MatchType">Dark Match</div></div>',
        bout(f"{a(2, 4, 'Dee')} vs. {a(2, 5, 'Eve')} (1:08:50) - Double Count Out"),
        bout(f"{a(29, 8, 'Kings and Queens')} ({a(2, 6, 'Flo')} &amp; {a(2, 7, 'Gus')}) defeat {a(2, 8, 'Hal')} by DQ - Run-in"),
        bout("Exhibition"),
    ]
)


def test_event_card():
    (card,) = records("event_card", CARD, f"{A}/?id=1&nr=77")
    assert {k: card[k] for k in ("id", "event_type", "arena", "broadcast_type", "broadcast_date", "tv_network")} == {"id": "77", "event_type": "Weekly Show", "arena": "Harbour Hall", "broadcast_type": "Taped", "broadcast_date": "04.02.2031", "tv_network": "Channel 9"}
    assert card["commentators"] == [{"id": "71", "name": "Ida Fox"}, {"id": "72", "name": "Bo Lund"}]
    assert [m["match_index"] for m in card["matches"]] == [1, 3, 4, 5]  # a block without results counts
    first, draw, teams, none = card["matches"]
    assert (first["result"], first["duration"], first["title_change"], first["finish_note"]) == ("decisive", "12:55", True, None)
    assert (first["title_id"], first["title_name"], first["match_type"]) == ("20", "Harbour Title", "Three Way Match")
    assert first["winners"] == {"wrestlers": [{"id": "1", "name": "Ann Oak"}], "valets": [{"id": "9", "name": "Val Reed"}]}
    assert first["losers"] == [{"wrestlers": [{"id": "2", "name": "Bea Elm"}], "is_champion": True}, {"wrestlers": [{"id": "3", "name": "Cy Ash"}]}]
    assert (first["match_rating"], first["match_votes"], first["won_rating"]) == (6.45, 21, "***1/2")
    assert first["notes"] == ["- Ann & Bea out (1:00)", "- Cy out"]
    assert (draw["result"], draw["duration"], draw["finish_note"], draw["title_change"]) == ("no_decision", "1:08:50", "Double Count Out", False)
    assert draw["sides"] == [{"wrestlers": [{"id": "4", "name": "Dee"}]}, {"wrestlers": [{"id": "5", "name": "Eve"}]}] and "winners" not in draw
    assert teams["winners"] == {"teams": [{"id": "8", "name": "Kings and Queens"}], "wrestlers": [{"id": "6", "name": "Flo"}, {"id": "7", "name": "Gus"}]}
    assert len(teams["losers"]) == 1 and teams["finish_note"] == "Run-in"
    assert none["result"] == "unknown" and none["sides"] == [{}]
    assert records("event_card", "", "x") == [{"id": None, "matches": []}]


def table(*rows, caption=""):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f'{caption}<table class="TBase"><tr><td>head</td></tr>{body}</table>'


def link(section, nr, name):
    return f'<a href="?id={section}&nr={nr}">{name}</a>'


def test_event_list():
    html = table(["1", "05.02.2031", "", link(1, 301, "Night <b>One</b>"), "Port Town", "Card", "", "6.5", "12"], ["2", "06.02.2031", "", link(1, 302, "Night Two"), "Elsewhere", "", "", "", "n/a"], ["3", "x", "", link(1, 301, "again")], ["4", "y", link(1, 303, " ")], ["no link"])
    got = records("event_list", html, f"{A}/?id=8&nr=44&page=4&s=0")
    assert got[0] == {"id": "301", "name": "Night One", "profile_url": f"{A}/?id=1&nr=301", "promotion": "44", "date": "05.02.2031", "event_rating": 6.5, "event_votes": 12, "location": "Port Town"}
    assert [(r["id"], r["event_rating"], r["event_votes"]) for r in got] == [("301", 6.5, 12), ("302", None, None)]
    assert records("event_list", "<p>no table", "x") == []


def test_roster_tabs():
    cur = table(["1", link(2, 11, "Nia"), "Singles, Trainer", "Blue", "7.1", "30"], ["2", link(2, 12, "Odo"), "", "6", "4"], ["3", link(28, 13, "Team"), "", "", ""])
    got = records("roster", cur, f"{A}/?id=8&nr=44&page=15")
    assert [(r["id"], r["active_roles"], r.get("current_brand"), r["roster_rating"], r["roster_votes"], r["promotions"]) for r in got] == [("11", ["Singles", "Trainer"], "Blue", 7.1, 30, ["44"]), ("12", [], None, 6.0, 4, ["44"])]
    old = records("roster", table(["1", link(2, 14, "Pam"), "210"], ["2", link(2, 14, "Pam"), "3"]), f"{A}/?id=8&nr=44&page=16")
    assert old == [{"id": "14", "name": "Pam", "profile_url": f"{A}/?id=2&nr=14", "promotions": ["44"], "career_shows": 210}]


def test_person_profile():
    html = box("Age:", "41 years") + box("Birthday:", "02.03.1990") + box("Height:", "6' 1\" (185 cm)") + box("Weight:", "unknown") + box("Background in sports:", "Judo, Rowing") + box("WWW:", '<a href=" https://x.example ">x</a>')
    html += box("Alter egos:", f"{a(2, 1, 'Red')}<br>{a(2, 1, 'Red')}<br>{a(2, 2, 'Blue')}") + box("Roles:", "Ring Announcer (1999 - 2009, 2011 - today)<br>Guest (once) (2015)<br>Coach") + box("Nicknames:", '"The Wall"<br>"Big B"') + box("Signature moves:", "Flip<br>Flop")
    html += box("In-ring experience:", "12 years") + box("Wrestling style:", "Technician, Brawler") + box("Trainer:", "<a>Moe</a>") + box("Gender:", "female") + box("Gender:", "male")
    (got,) = records("person_profile", html, f"{A}/?id=2&nr=5")
    assert got["age"] == 41 and got["height_cm"] == 185 and got["weight_kg"] is None and got["gender"] == "male"
    assert got["background_in_sports"] == ["Judo", "Rowing"] and got["websites"] == ["https://x.example"] and got["alter_egos"] == ["Red", "Blue"] and got["trainers"] == ["Moe"]
    assert got["roles"] == [
        {"role": "Ring Announcer", "date_ranges": [{"from_date": "1999", "to_date": "2009"}, {"from_date": "2011", "to_date": None}]},
        {"role": "Guest", "date_ranges": [{"from_date": "once) (2015", "to_date": "once) (2015"}]},
        {"role": "Coach", "date_ranges": []},
    ]
    assert got["nicknames"] == ["The Wall", "Big B"] and got["signature_moves"] == ["Flip", "Flop"] and got["career_experience_years"] == 12
    assert "birthplace" not in got


def test_promotions():
    html = table(["1", "", link(8, 501, "Tide Pro"), "Port Town", "1988-", "8.1", "77"], ["2", "", link(8, 502, "Old Pro"), "Elsewhere", "1950", "", ""], ["3", "", link(8, 503, "Odd"), "", "2000-2005-2010", "", ""])
    got = records("promotion_list", html, f"{A}/?id=8&view=promotions")
    assert [(r["id"], r["location"], r["active_year_start"], r["active_year_end"], r["rating"], r["votes"]) for r in got] == [("501", "Port Town", 1988, None, 8.1, 77), ("502", "Elsewhere", 1950, 1950, None, None), ("503", "", 2000, None, None, None)]
    only = P.extractors(A, B, ["502"])["promotion_list"]
    assert [r["id"] for r in only.parse(dom.tree(html), "u")] == ["502"]
    (got,) = records("promotion_profile", box("Names:", "Tide (01.01.1988-31.12.1999)<br>Tide Pro (2000 - today)<br>no dates"), f"{A}/?id=8&nr=501")
    assert got == {"id": "501", "name_history": [{"name": "Tide", "from_date": "01.01.1988", "to_date": "31.12.1999"}, {"name": "Tide Pro", "from_date": "2000", "to_date": None}]}


def test_titles_and_reigns():
    html = table(["1", link(5, 601, "Tide Title"), "Nia", "01.01.2031", "5.5", "9"], caption='<div class="Caption">Active Titles</div>') + table(["1", link(5, 602, "Old Title"), "-"], caption='<div class="Caption">Inactive Titles</div>')
    got = records("title_list", html, f"{A}/?id=8&nr=501&page=9")
    assert [(r["id"], r["status"], r.get("champion_since"), r.get("rating"), r.get("votes"), r["promotion"]) for r in got] == [("601", "active", "01.01.2031", 5.5, 9, "501"), ("602", "inactive", None, None, None, "501")]

    def holder(*lines):
        return f'<div class="ChampionDetailsText">{"<br>".join(lines)}</div>'

    html = holder("#3", f'<span class="TextBold">{a(2, 11, "Nia")} (2)</span>', "01.01.2031 - today (&lt;1 day)", a(5, 1, "Matches"), "Port Town")
    html += holder("#2", f'<span class="TextBold">{a(28, 40, "Duo")} ({a(2, 12, "Odo")} &amp; {a(2, 13, "Pip")}) (4)</span>', "01.01.2029 - 31.12.2030 (729 Tage)", "-")
    html += holder("#1", f'<span class="TextBold">{a(2, 14, "Pam")}</span>', "03.1990 - 1991", "Matches") + holder("no number")
    (got,) = records("title_profile", html, f"{A}/?id=5&nr=601")
    solo, team, first = got["reigns"]
    assert solo == {"reign_number": 3, "champions": [{"id": "11", "name": "Nia", "title_reign_count": 2}], "duration_days": 0, "from_date": "01.01.2031", "to_date": None, "location": "Port Town"}
    assert team["team"] == {"id": "40", "name": "Duo", "title_reign_count": 4} and team["champions"] == [{"id": "12", "name": "Odo"}, {"id": "13", "name": "Pip"}]
    assert team["duration_days"] == 729 and "location" not in team
    assert first["champions"] == [{"id": "14", "name": "Pam"}] and (first["from_date"], first["to_date"]) == ("03.1990", "1991") and "location" not in first


def entry(name, inner):
    return f'<li class="field-entry {name}"><span class="field-label">{name}</span><div class="field-value">{inner}</div></li>'


def part(name, inner):
    return f'<div class="field-entry {name}"><div class="field-value">{inner}</div></div>'


def dated(value, since="", until="", first="first"):
    return f'<li><ul>{entry(first, value)}{entry("from-date", since)}{entry("to-date", until)}</ul></li>'


def listed(name, *items):
    return entry(name, f'<ul class="fields-container">{"".join(items)}</ul>')


def test_b_title_page():
    url = f"{B}/title-history/tide/tide-title"
    champ = '<a href="/wrestlers/nia">Nia</a>'

    def row(n, champion, since, days="", event=""):
        return f'<tr class="title-reign"><td class="reign-number">{n}</td><td class="reign-info"><h3 class="contentheading">{champion}</h3><span class="from-date">{since}</span><span class="location">Port  Town</span>{event}</td><td class="days-held"><div>{days}</div></td></tr>'

    html = '<meta property="og:image" content="/images/belt.png"><h1> Tide <i>x</i></h1><ul>' + entry("promotions", "Tide Pro") + entry("date-established", "May 1,  1988")
    html += '<li class="field-entry"><span class="field-label">Current Champion</span><div class="field-value">Nia</div></li>'
    html += entry("title-variants", f'<ul><li>{part("name", "Tide Title")}{part("from-date", "1988")}{part("to-date", "Present")}{part("picture", "<a data-modals href=/full.png><img src=/small.avif></a>")}</li></ul>') + "</ul>"
    html += "<table class=title-reigns>" + row("3", f'{champ}<span class="badge">2</span>', "Jan 1, 2031", "10+", '<div class="event"><a href="/events/1">Night One</a></div>') + row("", '<a href="/wrestlers/vacant">VACANT</a>', "Dec 1, 2030") + row("2", f'{champ} &amp; <a href="/wrestlers/odo/">Odo</a><span class="badge">2</span>', "Jan 1, 2030", "x") + row("1", "Vacant", "Present") + "</table>"
    (got,) = records("b_title_page", html, url)
    assert (got["name"], got["promotion"], got["brand"], got["date_established"], got["current_champion"], got["image_url"]) == ("Tide", "Tide Pro", None, "May 1, 1988", "Nia", f"{B}/images/belt.png")
    assert got["name_history"] == [{"name": "Tide Title", "from_date": "1988", "to_date": None, "image_url": f"{B}/full.png"}]
    newest, empty, pair, oldest = got["reigns"]
    assert newest["champions"] == [{"id": "nia", "name": "Nia", "title_reign_count": 2}] and (newest["reign_number"], newest["duration_days"], newest["to_date"], newest["location"], newest["event_name"], newest["event_url"]) == (3, 10, None, "Port Town", "Night One", f"{B}/events/1")
    assert empty["is_vacant"] and empty["champions"] == [] and empty["reign_number"] is None and empty["to_date"] == "Jan 1, 2031"
    assert pair["champions"] == [{"id": "nia", "name": "Nia"}, {"id": "odo", "name": "Odo"}] and pair["duration_days"] is None and pair["to_date"] == "Dec 1, 2030"
    assert oldest["is_vacant"] and oldest["from_date"] is None and oldest["to_date"] == "Jan 1, 2030"
    assert records("b_title_page", "", url)[0]["name"] == "tide-title"
    with pytest.raises(ValueError):
        records("b_title_page", html, f"{B}/elsewhere")


def test_b_person_page():
    html = "<h1>Nia Tide</h1><ul>" + entry("real-name", "Nia  T.") + entry("born", "March 2, 1990 (age 41)") + entry("height", "6'1\" (185 CM)") + entry("nicknames", "The Wall; Big N;")
    html += listed("weight", dated("200 lbs (91 kg)"), dated("190 lbs (86 kg)").replace("<li>", '<li class="present">', 1)) + listed("ring-names", dated("Nia", "2010", "Present"), dated("")) + listed("finishers", dated("Flip"), dated("Flop", "2012")) + listed("roles", dated("Coach", "2020", "2021")) + listed("billed-from", dated("Port Town"))
    html += f'<li class="field-entry companies"><div class="field-value"><table class="fields-container"><tbody><tr><td><ul>{entry("promotion", "Tide Pro")}{entry("brands", "Blue")}</ul></td><td><ul>{entry("from-date", "2010")}{entry("to-date", "Current")}</ul></td></tr></tbody></table></div></li>'
    html += f'<li class="field-entry alignments"><div class="field-value"><table class="fields-container"><tbody><tr><td><div class="field-value">Face</div></td><td><div class="field-value">Debut</div></td><td><ul>{entry("from-date", "2010")}</ul></td></tr></tbody></table></div></li>'
    html += entry("images", '<div class="roster_section"><div class="roster"><img src="/i/1.png"><span class="roster_name">Apr  2031</span></div><div class="roster"></div></div>')
    html += entry("career-awards", '<ul><li><a href="/awards/1"><img class="field-value-icon" src="/i/a.png"><span>Rookie</span></a></li></ul>')
    html += listed("hall-of-fames", f'<li><a href="/hof/1"></a><ul>{entry("first", "Harbour Hall")}{entry("kind", "Individual")}{entry("year", "2030")}</ul></li>')
    html += entry("titles-auto", '<ul><li>early</li></ul><h3>Tide Pro</h3><ul class="unstyled"><li><img class="field-value-icon" src="/i/t.png"><a href="/title-history/tide/t"><strong>x3</strong> / Tide Title</a><span class="article-info">(with Odo)</span></li></ul>')
    html += entry("titles", "<h3>Small Pro</h3><ul><li>2 Cup (2012, 2013)</li><li>Trophy</li></ul>") + entry("accomplishments", "<ul><li>First  to win</li><li> </li></ul>") + "</ul>"
    (got,) = records("b_person_page", html, f"{B}/wrestlers/nia-tide/?x=1")
    assert (got["id"], got["name"], got["profile_url"], got["real_name"], got["birthday"], got["age"], got["height_cm"], got["weight_kg"], got["billed_from"]) == ("nia-tide", "Nia Tide", f"{B}/wrestlers/nia-tide", "Nia T.", "March 2, 1990", 41, 185, 86, "Port Town")
    assert got["nicknames"] == ["The Wall", "Big N"] and got["finishers"] == ["Flip", "Flop"] and got["accomplishments"] == ["First to win"]
    assert got["name_history"] == [{"name": "Nia", "from_date": "2010", "to_date": None}] and got["roles"] == [{"role": "Coach", "from_date": "2020", "to_date": "2021"}]
    assert got["promotions"] == [{"promotion": "Tide Pro", "brand": "Blue", "from_date": "2010", "to_date": None}]
    assert got["alignments"] == [{"alignment": "Face", "details": "Debut", "from_date": "2010", "to_date": None}]
    assert got["images"] == [{"label": "Apr 2031", "image_url": f"{B}/i/1.png"}]
    assert got["career_awards"] == [{"name": "Rookie", "url": f"{B}/awards/1", "image_url": f"{B}/i/a.png"}]
    assert got["hall_of_fames"] == [{"name": "Harbour Hall", "category": "Individual", "year": 2030, "url": f"{B}/hof/1", "image_url": None}]
    assert [(w["promotion"], w["title"], w["times"], w["details"], w["source"]) for w in got["title_wins"]] == [("Tide Pro", "Tide Title", 3, "(with Odo)", "auto"), ("Small Pro", "Cup", 2, "(2012, 2013)", "manual"), ("Small Pro", "Trophy", None, None, "manual")]
    assert records("b_person_page", "<h1></h1><li class='field-entry born'><div class='field-value'>1990 (age 41) maybe</div></li>", f"{B}/wrestlers/x")[0]["birthday"] == "1990 (age 41) maybe"
    with pytest.raises(ValueError):
        records("b_person_page", html, f"{B}/people/nia")


def test_tree_and_selectors(spark):
    t = dom.tree('<div class="a b"><ul><li class=x>one<li class="x y">two <b>bold</b></ul><table><tr><td>1<td>2<tr><td>3</table></div></p>')
    assert [n.joined() for n in t.select("li.x")] == ["one", "two bold"] and [n.joined() for n in t.select("div.a > ul > li.y b")] == ["bold"] and t.select("div > li") == []
    assert [len(r.select("td")) for r in t.select("tr")] == [2, 1] and t.text("ul li") == "onetwo bold"
    for path in ("", "a:hover", "a + b"):
        with pytest.raises(ValueError):
            t.select(path)
    df = spark.createDataFrame([(1, CARD), (2, None), (3, "<a href=x>q</a><a>r</a>")], "i int, html string")
    got = {r.i: r for r in df.select("i", dom.info_boxes(F.col("html")).alias("b"), dom.select_texts(F.col("html"), "div.MatchType").alias("t"), dom.select_attrs(F.col("html"), "a", "href").alias("h"), dom.html_text(F.col("html")).alias("x")).collect()}
    assert got[1].b["Arena:"] == "Harbour Hall" and got[1].t[0] == "Harbour Title  Three Way Match" and got[2].b is None is got[2].t and got[3].h == ["x"] and got[3].x == "q r"


def test_extraction_over_a_table(spark):
    rows = [(f"{A}/?id=1&nr=77", CARD, 1), (f"{A}/?id=1&nr=78", None, 2), (f"{A}/?id=1&nr=79", "<div class=Match><div class=MatchResults>x", 3)]
    pages = spark.createDataFrame(rows, "url string, html string, seq int")
    got = {r.id: r for r in P.extract(pages, KINDS["event_card"]).collect()}
    assert len(got["77"].matches) == 4 and got["77"].matches[0].winners.valets[0].id == "9" and got["78"].matches == [] and got["79"].matches[0].result == "unknown"
    bad = spark.createDataFrame([("nowhere", "<p>"), (f"{B}/wrestlers/ok", "")], "url string, html string")
    assert [r.id for r in P.extract(bad, KINDS["b_person_page"]).collect()] == ["ok"] and [r.url for r in P.failed_pages(bad, KINDS["b_person_page"]).collect()] == ["nowhere"]
    assert P.extract(bad.limit(0), KINDS["b_person_page"]).count() == 0


def test_lists_profiles_and_visits(spark):
    one, two = table(["1", link(2, 11, "Nia"), "Coach", "7", "3"]), table(["1", link(2, 11, "Nia"), "210"], ["2", link(2, 12, "Odo"), "5"])
    pages = spark.createDataFrame([(f"{A}/?id=8&nr=4&page=15", one), (f"{A}/?id=8&nr=4&page=16", two)], "url string, html string")
    listed = P.first_sightings(P.extract(pages, KINDS["roster"]), ["url"])
    assert {(r.id, r.career_shows, r.roster_votes) for r in listed.collect()} == {("11", None, 3), ("12", 5, None)}
    profile = spark.createDataFrame([(f"{A}/?id=2&nr=11", box("Gender:", "female") + box("Active Roles:", "Manager"))], "url string, html string")
    full = {r.id: r for r in P.with_profiles(listed, P.extract(profile, KINDS["person_profile"])).collect()}
    assert full["11"].gender == "female" and full["11"].active_roles == ["Manager"] and full["11"].name == "Nia" and full["12"].gender is None
    events = P.extract(spark.createDataFrame([("u?nr=4", table(["1", "05.02.2031", "", link(1, 1, "N")], ["2", "06.02.2001", "", link(1, 2, "O")], ["3", "07.02.2001", "", link(1, 3, "P")]))], "url string, html string"), KINDS["event_list"])
    from datetime import date

    assert [r.id for r in P.on_dates(events, [date(2001, 2, 6)]).collect()] == ["2"] and P.on_dates(events, []).count() == 3
    stored = events.where("id <> '3'").withColumn("matches", F.expr("array(named_struct('match_index', 1))"))
    assert sorted(r.id for r in P.to_visit(events, stored, KINDS["event_list"]).collect()) == ["3"]  # far ahead without a big type, and complete
    empty = stored.withColumn("matches", F.expr("cast(null as array<struct<match_index:int>>)"))
    assert sorted(r.id for r in P.to_visit(events, empty, KINDS["event_list"]).collect()) == ["2", "3"]
    titles = P.extract(spark.createDataFrame([("u?nr=4", table(["1", link(5, 1, "T")]))], "url string, html string"), KINDS["title_list"])
    assert P.to_visit(titles, titles, KINDS["title_list"]).count() == 1 and P.to_visit(titles, titles, KINDS["b_title_page"]).count() == 1
    assert P.to_visit(titles, titles, KINDS["promotion_list"]).count() == 0
