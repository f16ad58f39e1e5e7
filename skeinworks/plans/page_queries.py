"""Registered queries of landing and page extraction.

The driver's tables hold no such pages, so pages and lines are made from their rows by the DataFrame API, and what is read from them
must be the rows again: the SQL says what these are.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skeinworks.functions import dom
from skeinworks.functions import text as T
from skeinworks.functions.files import shared_folder
from skeinworks.operators import linkage, merge, nested
from skeinworks.plans import flatten
from skeinworks.plans.queries import Tables, query
from skeinworks.plans.schemas import SOURCES
from skeinworks.sources import landing, pages, tail

_A, _B = "https://a.example", "https://b.example"
_KINDS = pages.extractors(_A, _B)


def _html(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _link(section: int, nr: Column, name: Column) -> Column:
    return _html(f'<a href="?id={section}&amp;nr=', nr, '&amp;name=x">', name, "</a>")


def _box(label: str, inner: Column) -> Column:
    return _html(f'<div class="InformationBoxTitle">{label}</div><div class="InformationBoxContents">', inner, "</div>")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt to as many tasks as the session's exchanges have, and to all cores at least: small rows' file is one task's, however large the pages are
    that are made of them."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), key)


def _joined(rows: DataFrame, key: str, order: list[str], piece: Column, name: str = "html") -> DataFrame:
    """(key, html): the pieces of each key on end."""
    return _dealt(rows, key).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, piece.alias("_piece")))), lambda x: x["_piece"]), "").alias(name))


# Lines ----------------------------------------------------------------------------------------------------------------------


def _lines(t: Tables) -> DataFrame:
    """Orders as landed lines of customers, in order of their keys; every 17th line is cut off, every 19th is blank."""
    o = t.orders
    record = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("n"), "o_orderkey").alias("name"), F.col("o_orderkey").cast("string").alias("votes"), F.array(F.struct(F.col("o_orderstatus").alias("name"))).alias("name_history")))
    value = F.when(F.col("o_orderkey") % 19 == 0, F.lit(" ")).when(F.col("o_orderkey") % 17 == 0, F.substring(record, 1, 9)).otherwise(record)
    return o.select(value.alias("value"), F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("o_orderkey").alias("at")).alias("_line"))


_GOOD = "o_orderkey % 19 <> 0 AND o_orderkey % 17 <> 0"


@query(f"SELECT o_custkey::VARCHAR AS id, 'n' || o_orderkey AS name, o_orderkey::INT AS votes, o_orderstatus AS past FROM orders WHERE {_GOOD} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def landed_newest(t):
    rows = landing.latest_lines(_lines(t), StructType.fromDDL(SOURCES["promotions"]))
    return rows.select("id", "name", "votes", F.col("name_history")[0]["name"].alias("past"))


@query(f"SELECT CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS night, o_custkey::VARCHAR AS id, o_orderkey::INT AS votes FROM orders WHERE {_GOOD}")
def tail_nights(t):
    """Two nights' lines of a growing folder, each read from where the night before ended."""
    folder, at, out = shared_folder(t.spark), None, None
    for night in (1, 2):
        _lines(t).where((F.col("_line.at") % 3 == 0) == (night == 2)).select("value").write.mode("append").text(folder)
        new, at = tail.tail(t.spark, folder, at)
        rows = landing.latest_lines(new, StructType.fromDDL("id string, votes int"), key=None).select(F.lit(night).alias("night"), "id", "votes")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 19 <> 0")
def landed_corrupt(t):
    return landing.corrupt_lines(_lines(t)).agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT o_custkey::VARCHAR AS id FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders WHERE o_orderkey % 19 <> 0) WHERE n >= 100 AND {_GOOD}")
def ids_after_line(t):
    return landing.ids_in(_lines(t).orderBy("_line"), 100)


@query("""SELECT count(*) AS n, sum(n * (o_orderkey % 1000))::BIGINT AS placed, count(DISTINCT n) AS places FROM
(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders WHERE o_orderkey % 19 <> 0)""")
def line_count(t):
    """How many lines there are, and that each has its place."""
    lines = _lines(t).withColumn("value", F.concat(F.rpad(F.col("value"), 1, " "), F.when(F.trim("value") != "", F.col("_line.at").cast("string")).otherwise(F.lit(""))))
    rows = landing.numbered_lines(lines.orderBy("_line"))
    key = F.substring(F.regexp_extract("value", r"(\d+)$", 1), -3, 3).cast("long")
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("_n") * key).cast("long").alias("placed"), F.count_distinct("_n").alias("places"))


@query("SELECT n_name, k.tag FROM nation JOIN (VALUES (0, 'a'), (2, 'b'), (99, 'c')) AS k(region, tag) ON n_regionkey = k.region")
def inline_values(t):
    return t.nation.join(landing.inline(t.spark, [(0, "a"), (2, "b"), (99, "c")], "n_regionkey int, tag string"), "n_regionkey").select("n_name", "tag")


def _sitemaps(t: Tables) -> DataFrame:
    """A sitemap index, a document without a namespace for each region, and one that is no XML."""
    urls = _joined(t.nation, "n_regionkey", ["n_nationkey"], _html("<url><loc> https://s.example/people/", F.lower("n_name"), "/</loc></url>"), "xml").select(_html("<urlset>", F.col("xml"), "</urlset>").alias("xml"))
    index = t.region.agg(F.array_join(F.array_sort(F.collect_list(_html("<sitemap><loc>https://s.example/sitemap-", F.col("r_regionkey"), ".xml</loc></sitemap>"))), "").alias("xml"))
    index = index.select(_html('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', F.col("xml"), "</sitemapindex>").alias("xml"))
    return urls.unionByName(index).unionByName(t.region.limit(1).select(F.lit("<urlset><loc>").alias("xml")))


@query("SELECT 'https://s.example/people/' || lower(n_name) AS url FROM nation")
def sitemap_pages(t):
    return landing.sitemap_locations(_sitemaps(t), pattern="^https://s[.]example/people/[^/#?]+/?$", parent="url")


@query("SELECT '<urlset><loc>' AS xml UNION ALL SELECT '<urlset>' || n_name FROM nation")
def sitemaps_broken(t):
    return landing.broken_sitemaps(_sitemaps(t).unionByName(t.nation.select(F.concat(F.lit("<urlset>"), "n_name").alias("xml"))))


@query("SELECT 'https://s.example/sitemap-' || r_regionkey || '.xml' AS url FROM region")
def sitemap_shards(t):
    return landing.sitemap_locations(_sitemaps(t), parent="sitemap")


# Scalar functions ----------------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, 'a & ' || p_name AS plain, [p_name, p_brand] AS parts FROM part")
def tags_and_breaks(t):
    return t.part.select("p_partkey", T.strip_tags(_html(" <b class=x>a &amp; ", F.col("p_name"), "</b> ")).alias("plain"), T.br_list(_html("<div>", F.col("p_name"), "<br/> <br><i>", F.col("p_brand"), "</i></div>")).alias("parts"))


@query("SELECT p_partkey, p_name || '  ' || p_brand AS joined, p_type AS kind, [p_name, p_brand] AS picked, ['/' || p_partkey] AS hrefs FROM part")
def selected_text(t):
    html = _html("<div class='a k'><p>", F.col("p_name"), " </p> <p class=q>", F.col("p_brand"), "</p></div><ul><li><a href='/", F.col("p_partkey"), "'>", F.col("p_type"), "</a></ul>")
    whole = F.regexp_replace(dom.html_text(F.regexp_extract(html, "(<div.*</div>)", 1)), " +", "  ")
    found = dom.read(html, kinds=dom.texts("ul li a[href^='/']"), picked=dom.texts("div.a.k > p"), hrefs=dom.attrs("a", "href"))
    return _dealt(t.part, "p_partkey").select("p_partkey", F.regexp_replace(whole, r"^(\S+)  (\S+)  ", "$1 $2  ").alias("joined"), found["kinds"][0].alias("kind"), F.transform(found["picked"], lambda x: F.trim(x)).alias("picked"), found["hrefs"].alias("hrefs"))


@query("SELECT s_suppkey, s_name AS arena, 'later ' || s_nationkey AS type FROM supplier")
def boxes(t):
    html = _html(_box("Type:", F.lit("first")), _box("Arena:", F.col("s_name")), _box("Type:", _html("<i>later</i>", F.col("s_nationkey"))), '<div class="InformationBoxTitle">Alone:</div>')
    b = dom.info_boxes(html)
    return _dealt(t.supplier, "s_suppkey").select("s_suppkey", b["Arena:"].alias("arena"), b["Type:"].alias("type"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '2' AS section, l_suppkey::VARCHAR AS nr, 'S & ' || l_suppkey AS text, ['P' || l_partkey, 'S & ' || l_suppkey] AS texts FROM lineitem")
def entity_links(t):
    html = _html("<p><a href='/elsewhere'>P", F.col("l_partkey"), "</a>", _link(2, F.col("l_suppkey"), _html("S &amp; ", F.col("l_suppkey"))), "<a>P", F.col("l_partkey"), "</a>")
    found = dom.read(html, links=dom.LINKS, texts=dom.LINK_TEXTS)
    first = found["links"][0]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", first["section"].alias("section"), first["nr"].alias("nr"), first["text"].alias("text"), found["texts"].alias("texts"))


@query("SELECT o_orderkey, year(o_orderdate)::INT AS start_year, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE year(o_orderdate)::INT + CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END END AS end_year FROM orders")
def year_ranges(t):
    y = F.year("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "F", _html(y, "-")).when(F.col("o_orderstatus") == "O", _html(y, " - ", y + 2)).otherwise(_html(" ", y))
    found = T.active_years(text)
    return t.orders.select("o_orderkey", found["start"].alias("start_year"), found["end"].alias("end_year"))


@query("SELECT c_custkey, c_name AS name, '1.1.' || (1990 + c_nationkey) AS from_date, CASE WHEN c_custkey % 2 = 0 THEN '2.2.2020' END AS to_date, c_custkey % 5 = 0 AS other FROM customer")
def names_over_time(t):
    k = F.col("c_custkey")
    found = T.name_history_line(_html(F.col("c_name"), " (1.1.", 1990 + F.col("c_nationkey"), F.when(k % 3 == 0, "-").otherwise(" - "), F.when(k % 2 == 0, "2.2.2020").otherwise("Today"), ")"))
    none = T.name_history_line(F.when(k % 5 != 0, _html(F.col("c_name"), " (1 - 2)")).otherwise(F.col("c_name")))
    return t.customer.select("c_custkey", *(found[c].alias(c) for c in ("name", "from_date", "to_date")), none.isNull().alias("other"))


@query("SELECT s_suppkey, 'R' || s_nationkey AS role, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 2 END AS n, CASE WHEN s_suppkey % 3 <> 0 THEN '199' || (s_suppkey % 10) END AS since, s_suppkey % 3 <> 0 AS open FROM supplier")
def roles_over_time(t):
    s = F.col("s_suppkey")
    text = _html("R", F.col("s_nationkey"), F.when(s % 3 == 0, "").otherwise(_html(" (199", s % 10, " - 2001, 2003 - today)")))
    one = T.role_entries(text)[0]
    return t.supplier.select("s_suppkey", one["role"].alias("role"), F.size(one["date_ranges"]).alias("n"), F.get(one["date_ranges"], 0)["from_date"].alias("since"), F.coalesce(F.get(one["date_ranges"], 1)["to_date"].isNull() & (F.size(one["date_ranges"]) > 1), F.lit(False)).alias("open"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d.%m.%Y') END AS ended FROM orders")
def strict_dates(t):
    d = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, " dd.MM.yyyy ")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", T.parse_event_date(text).alias("day"), T.normalize_date(F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, " dd.MM.yyyy")).otherwise(F.lit(" Ongoing "))).alias("ended"))


@query("SELECT p_partkey, p_size::VARCHAR AS title_id, p_brand AS title_name, 'Match ' || p_type AS match_type, p_size::DOUBLE AS rating, p_partkey::INT AS votes FROM part")
def match_type_and_rating(t):
    kind = T.match_type(_html(_link(5, F.col("p_size"), F.col("p_brand")), " Match ", F.col("p_type")))
    rated = T.match_rating(_html("Matchguide Rating: ", F.col("p_size"), " based on ", F.col("p_partkey"), " votes"))
    return t.part.select("p_partkey", kind["title_id"].alias("title_id"), kind["title_name"].alias("title_name"), kind["match_type"].alias("match_type"), rated["rating"].alias("rating"), rated["votes"].alias("votes"))


@query("SELECT c_custkey, 'Day ' || c_nationkey AS born, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS age, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS days FROM customer")
def born_and_days(t):
    n = F.col("c_nationkey")
    b = T.born(_html("Day  ", n, F.when(F.col("c_custkey") % 2 == 0, _html(" (age ", n, ")")).otherwise("")))
    return t.customer.select("c_custkey", b["date"].alias("born"), b["age"].alias("age"), T.duration_days(F.when(F.col("c_custkey") % 3 == 0, _html(n, "+")).otherwise(_html(n, " days"))).alias("days"))


@query("""SELECT s_suppkey, 'https://s.example/b/' || s_suppkey AS address, 'p-' || s_suppkey AS slug, CASE WHEN s_suppkey % 2 = 0 THEN 'wwe/t' || s_nationkey END AS title, 'https://s.example/i.png?x=' || s_suppkey AS image,
['a' || s_suppkey, 'b'] AS nicks, CASE WHEN s_suppkey % 2 = 0 THEN 200 END AS next FROM supplier""")
def addresses(t):
    k = F.col("s_suppkey")
    html = _html('<head><meta content="https://s.example/i.png?x=', k, '" property="og:image"></head>')
    title = _html("https://s.example/title-history/wwe/t", F.col("s_nationkey"), F.when(k % 2 == 0, "/").otherwise("/more"))
    return _dealt(t.supplier, "s_suppkey").select("s_suppkey", T.absolute_url(_html(" ../b/", k), "https://s.example/a/c").alias("address"), T.slug_after(_html("/wrestlers/p-", k, "?x=1"), "wrestlers").alias("slug"), T.title_path(title, "title-history").alias("title"), dom.og_image(html).alias("image"), T.nicknames_list(_html("a", k, "; ;b")).alias("nicks"), T.next_page_offset(F.when(k % 2 == 0, 100).otherwise(99), F.lit(100)).alias("next"))


# Cards, lists and profiles -----------------------------------------------------------------------------------------------------------

_WHOLE_CARD = "SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)::INT AS k FROM lineitem"
_CARD = f"{_WHOLE_CARD} WHERE l_orderkey % 5 = 0"
_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def _fifth(t: Tables) -> DataFrame:
    return t.lineitem.where("l_orderkey % 5 = 0")


def _cards(lines: DataFrame) -> DataFrame:
    """Orders as events, their lines as bouts: returned ones are decisive, accepted ones undecided with a note, the others have no results."""
    flag, p, s = F.col("l_returnflag"), F.col("l_partkey"), F.col("l_suppkey")
    clock = _html(" (", F.col("l_quantity").cast("int"), ":05)")
    won = _html(_link(2, p, _html("P &amp; ", p)), " (w/", _link(2, F.lit(7), F.lit("Seven")), ") defeats ", _link(2, s, _html("S", s)), " (c) and ", _link(28, F.lit(9), F.lit("This and That")), clock, ' - <span class="MatchTitleChange">TITLE CHANGE</span>')
    drawn = _html(_link(2, p, _html("P", p)), " vs. ", _link(2, s, _html("S", s)), clock, " - Double Count Out")
    results = F.when(flag == "R", _html('<div class="MatchResults">', won, "</div>")).when(flag == "A", _html('<div class="MatchResults">', drawn, "</div>")).otherwise("")
    more = _html('<div class="MatchRecommendedLine">Matchguide Rating: ', F.col("l_quantity").cast("int"), ' based on 3 votes <span class="starRating">**</span></div><div class="MatchNotes">- one<br>- two</div>')
    bout = _html('<div class="Match"><div class="MatchType">', _link(5, s, F.lit("Cup")), " Match</div>", results, more, "</div>")
    cards, key = _joined(lines, "l_orderkey", _ORDER, bout), F.coalesce(F.col("l_orderkey").cast("string"), F.lit(""))
    return cards.select(_html(_A, "/?id=1&nr=", key).alias("url"), _html(_box("Type:", F.lit("TV-Show")), _box("Commentary by:", _html(_link(2, key, F.lit("Ann")), " &amp; ", _link(8, F.lit(1), F.lit("x")))), F.col("html")).alias("html"))


def _bouts(lines: DataFrame) -> DataFrame:
    return pages.extract(_cards(lines), _KINDS["event_card"]).select(F.col("id").alias("event_id"), F.explode("matches").alias("m")).select("event_id", "m.*")


@query(f"""SELECT l_orderkey::VARCHAR AS event_id, k AS match_index, l_suppkey::VARCHAR AS title_id, 'Cup' AS title_name, 'Match' AS match_type, l_returnflag = 'R' AS title_change, l_quantity::INT || ':05' AS duration,
CASE l_returnflag WHEN 'R' THEN 'decisive' ELSE 'no_decision' END AS result, CASE l_returnflag WHEN 'A' THEN 'Double Count Out' END AS finish_note, l_quantity AS match_rating, 3 AS match_votes, '**' AS won_rating FROM ({_WHOLE_CARD}) WHERE l_returnflag <> 'N'""")
def card_results(t):
    return _bouts(t.lineitem).select("event_id", "match_index", "title_id", "title_name", "match_type", "title_change", "duration", "result", "finish_note", "match_rating", "match_votes", "won_rating")


@query(f"""WITH c AS ({_CARD}) SELECT l_orderkey::VARCHAR AS event_id, k AS match_index, 'winner' AS side, l_partkey::VARCHAR AS id, 'P & ' || l_partkey AS name, '7' AS valet, NULL AS team, false AS champion FROM c WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey::VARCHAR, k, 'loser', l_suppkey::VARCHAR, 'S' || l_suppkey, NULL, NULL, true FROM c WHERE l_returnflag = 'R' UNION ALL SELECT l_orderkey::VARCHAR, k, 'loser', NULL, NULL, NULL, 'This and That', false FROM c WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey::VARCHAR, k, 'side', l_partkey::VARCHAR, 'P' || l_partkey, NULL, NULL, false FROM c WHERE l_returnflag = 'A' UNION ALL SELECT l_orderkey::VARCHAR, k, 'side', l_suppkey::VARCHAR, 'S' || l_suppkey, NULL, NULL, false FROM c WHERE l_returnflag = 'A'""")
def card_sides(t):
    sides = _bouts(_fifth(t)).select("event_id", "match_index", F.explode(nested.normalised_sides(F.col("winners"), F.col("losers"), F.col("sides"))).alias("s"))
    first = F.get("s.side.wrestlers", 0)
    return sides.select("event_id", "match_index", F.col("s.role").alias("side"), first["id"].alias("id"), first["name"].alias("name"), F.get("s.side.valets", 0)["id"].alias("valet"), F.get("s.side.teams", 0)["name"].alias("team"), F.coalesce("s.side.is_champion", F.lit(False)).alias("champion"))


@query(f"SELECT l_orderkey::VARCHAR AS id, 'TV-Show' AS event_type, l_orderkey::VARCHAR AS speaker, 1 AS speakers, count(*) FILTER (l_returnflag <> 'N')::INT AS matches, ['- one', '- two'] AS notes FROM ({_CARD}) GROUP BY l_orderkey HAVING count(*) FILTER (l_returnflag <> 'N') > 0")
def card_info(t):
    rows = pages.extract(_cards(_fifth(t)), _KINDS["event_card"]).where(F.size("matches") > 0)
    return rows.select("id", "event_type", F.col("commentators")[0]["id"].alias("speaker"), F.size("commentators").alias("speakers"), F.size("matches").alias("matches"), F.col("matches")[0]["notes"].alias("notes"))


@query(f"SELECT l_orderkey::VARCHAR || '-' || k AS id, l_orderkey::VARCHAR AS event_id FROM ({_CARD}) WHERE l_returnflag <> 'N'")
def card_positional_ids(t):
    return flatten.flatten("matches", pages.extract(_cards(_fifth(t)), _KINDS["event_card"]).drop("url", "seq"))["matches"].select("id", "event_id")


def _table(rows: DataFrame, key: str, order: list[str], cells: list[Column | str], page: Column) -> DataFrame:
    """List pages (url, html): a row for each row of a key."""
    row = _html("<tr>", *(x for c in cells for x in ("<td>", c, "</td>")), "</tr>")
    return _joined(rows, key, order, row).select(page.alias("url"), _html("<table class=TBase><tr><td>head</td></tr>", F.col("html"), "</table>").alias("html"))


def _event_pages(t: Tables) -> DataFrame:
    o = t.orders.where("o_orderkey % 4 = 0")
    cells = [F.col("o_orderkey"), F.date_format("o_orderdate", "dd.MM.yyyy"), "", _html('<a href="?id=1&nr=', F.col("o_orderkey"), '">E', F.col("o_orderkey"), "</a>"), F.col("o_orderpriority"), "Card", "", F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_custkey").cast("string")), F.col("o_custkey")]
    return _table(o, "o_custkey", ["o_orderkey"], cells, _html(_A, "/?id=8&nr=", F.col("o_custkey"), "&page=4&s=0"))


@query("""SELECT o_orderkey::VARCHAR AS id, 'E' || o_orderkey AS name, 'https://a.example/?id=1&nr=' || o_orderkey AS profile_url, o_custkey::VARCHAR AS promotion, strftime(o_orderdate, '%d.%m.%Y') AS date, o_orderpriority AS location,
CASE WHEN o_orderstatus <> 'F' THEN o_custkey::DOUBLE END AS event_rating, o_custkey::INT AS event_votes FROM orders WHERE o_orderkey % 4 = 0""")
def event_lists(t):
    return pages.extract(_event_pages(t), _KINDS["event_list"]).select("id", "name", "profile_url", "promotion", "date", "location", "event_rating", "event_votes")


@query("SELECT o_orderkey::VARCHAR AS id FROM orders WHERE o_orderkey % 4 = 0 AND o_orderdate::DATE IN (DATE '1996-06-01', DATE '1996-06-02', DATE '1997-01-15')")
def events_on_dates(t):
    days = [datetime.date(1996, 6, 1), datetime.date(1996, 6, 2), datetime.date(1997, 1, 15)]
    return pages.on_dates(pages.extract(_event_pages(t), _KINDS["event_list"]), days).select("id")


def _rosters(t: Tables) -> DataFrame:
    """Suppliers as people: each nation's curated tab, and one of all times with other columns and other people, too."""
    s = t.supplier
    link = _html('<a href="?id=2&nr=', F.col("s_suppkey"), '">', F.col("s_name"), "</a>")
    now = _table(s.where("s_suppkey % 3 <> 0"), "s_nationkey", ["s_suppkey"], [F.col("s_suppkey"), link, "Singles, Coach", "Blue", "5.5", F.col("s_suppkey")], _html(_A, "/?id=8&nr=", F.col("s_nationkey"), "&page=15"))
    return now.unionByName(_table(s, "s_nationkey", ["s_suppkey"], [F.col("s_suppkey"), link, F.col("s_suppkey") + 1], _html(_A, "/?id=8&nr=", F.col("s_nationkey"), "&page=16")))


@query("""SELECT s_suppkey::VARCHAR AS id, s_name AS name, [s_nationkey::VARCHAR] AS promotions, CASE WHEN s_suppkey % 3 <> 0 THEN ['Singles', 'Coach'] END AS active_roles, CASE WHEN s_suppkey % 3 <> 0 THEN 'Blue' END AS current_brand,
CASE WHEN s_suppkey % 3 <> 0 THEN 5.5::DOUBLE END AS roster_rating, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey::INT END AS roster_votes, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::INT + 1 END AS career_shows FROM supplier""")
def rosters(t):
    rows = pages.first_sightings(pages.extract(_rosters(t), _KINDS["roster"]), [F.col("url").endswith("page=16")])
    return rows.select("id", "name", "promotions", "active_roles", "current_brand", "roster_rating", "roster_votes", "career_shows")


def _people(t: Tables) -> DataFrame:
    c = _dealt(t.customer, "c_custkey")
    k = F.col("c_custkey")
    html = _html(_box("Age:", _html(F.col("c_nationkey"), " years")), _box("Birthday:", _html("01.02.19", 70 + F.col("c_nationkey") % 20)), _box("Height:", _html("6' (", 150 + F.col("c_nationkey"), " cm)")), _box("Weight:", F.lit("?")), _box("Alter egos:", _html(_link(2, k, F.col("c_name")), "<br>", _link(2, k, F.col("c_name")), "<br>", _link(2, k, F.lit("Other")))))
    html = _html(html, _box("Roles:", _html("Fighter (1999 - 2005, ", 2006 + F.col("c_nationkey"), " - today)<br>Coach")), _box("Nicknames:", _html('"The ', F.col("c_mktsegment"), '"<br>"Z"')), _box("WWW:", F.lit('<a href=" https://w.example ">w</a>')), _box("Signature moves:", F.lit("Flip<br/>Flop")), _box("Trainer:", _html("<a>", F.col("c_mktsegment"), "</a>")))
    return c.select(_html(_A, "/?id=2&nr=", k).alias("url"), html.alias("html"))


@query("""SELECT c_custkey::VARCHAR AS id, c_nationkey AS age, '01.02.19' || (70 + c_nationkey % 20) AS birthday, 150 + c_nationkey AS height_cm, CAST(NULL AS INT) AS weight_kg, [c_name, 'Other'] AS alter_egos, ['The ' || c_mktsegment, 'Z'] AS nicknames,
['https://w.example'] AS websites, ['Flip', 'Flop'] AS signature_moves, [c_mktsegment] AS trainers, (2006 + c_nationkey)::VARCHAR AS since, 2 AS n_roles FROM customer""")
def person_profiles(t):
    rows = pages.extract(_people(t), _KINDS["person_profile"])
    return rows.select("id", "age", "birthday", "height_cm", "weight_kg", "alter_egos", "nicknames", "websites", "signature_moves", "trainers", F.col("roles")[0]["date_ranges"][1]["from_date"].alias("since"), F.size("roles").alias("n_roles"))


def _promotion_pages(t: Tables) -> DataFrame:
    n = t.nation
    cells = [F.col("n_nationkey"), "", _html('<a href="?id=8&nr=', F.col("n_nationkey"), '">', F.col("n_name"), "</a>"), F.lit("Port"), _html(1950 + F.col("n_nationkey"), "-"), "7.5", F.col("n_nationkey")]
    return _table(n, "n_regionkey", ["n_nationkey"], cells, _html(_A, "/?id=8&view=promotions&s=", F.col("n_regionkey")))


@query("SELECT n_nationkey::VARCHAR AS id, n_name AS name, 'Port' AS location, 1950 + n_nationkey AS active_year_start, CAST(NULL AS INT) AS active_year_end, 7.5::DOUBLE AS rating, n_nationkey AS votes FROM nation")
def promotion_lists(t):
    return pages.extract(_promotion_pages(t), _KINDS["promotion_list"]).select("id", "name", "location", "active_year_start", "active_year_end", "rating", "votes")


@query("SELECT n_nationkey::VARCHAR AS id FROM nation WHERE n_nationkey IN (1, 7, 20)")
def promotions_of_some_ids(t):
    return pages.extract(_promotion_pages(t), pages.extractors(_A, _B, ["1", "7", "20"])["promotion_list"]).select("id")


@query("""SELECT n_nationkey::VARCHAR AS promotion_id, 0 AS seq, n_name || ' Old' AS name, '1.1.1980' AS from_date, '2.2.1990' AS to_date FROM nation UNION ALL SELECT n_nationkey::VARCHAR, 1, n_name, '1990', NULL FROM nation""")
def promotion_profiles(t):
    html = _box("Names:", _html(F.col("n_name"), " Old (1.1.1980 - 2.2.1990)<br>no dates<br>", F.col("n_name"), " (1990-today)"))
    rows = pages.extract(t.nation.select(_html(_A, "/?id=8&nr=", F.col("n_nationkey")).alias("url"), html.alias("html")), _KINDS["promotion_profile"])
    return nested.explode_child(rows, {"promotion_id": "id"}, "name_history", ["name", "from_date", "to_date"])


@query("""SELECT p_partkey::VARCHAR AS id, p_name AS name, p_brand AS promotion, CASE WHEN p_size % 2 = 0 THEN 'active' ELSE 'inactive' END AS status, '01.01.2001' AS champion_since, p_size::DOUBLE AS rating, p_partkey::INT AS votes FROM part""")
def title_lists(t):
    cells = [F.col("p_partkey"), _html('<a href="?id=5&nr=', F.col("p_partkey"), '">', F.col("p_name"), "</a>"), "x", "01.01.2001", F.col("p_size"), F.col("p_partkey")]
    row = _html("<tr>", *(x for c in cells for x in ("<td>", c, "</td>")), "</tr>")
    halves = [_joined(t.part.where(f"p_size % 2 = {k}"), "p_brand", ["p_partkey"], row, name) for k, name in ((0, "now"), (1, "past"))]
    both = halves[0].join(halves[1], "p_brand", "full_outer").na.fill("", ["now", "past"])
    html = _html("<div class=Caption>Active Titles</div><table class=TBase><tr></tr>", F.col("now"), "</table><div class='Caption x'>Inactive Titles</div><table class=TBase><tr></tr>", F.col("past"), "</table>")
    rows = pages.extract(both.select(_html(_A, "/?id=8&nr=", F.col("p_brand").substr(7, 9), "&page=9").alias("url"), html.alias("html")), _KINDS["title_list"])
    return rows.select("id", "name", F.concat(F.lit("Brand#"), "promotion").alias("promotion"), "status", "champion_since", "rating", "votes")


def _reign_pages(t: Tables) -> DataFrame:
    """Orders as reigns of customers' titles: some by teams, some still open."""
    o = t.orders.where("o_custkey % 3 = 0")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    solo = _html(_link(2, k, _html("W", k)), " (2)")
    team = _html(_link(29, c, F.lit("Duo")), " (", _link(2, k, _html("W", k)), " &amp; ", _link(2, k + 1, F.lit("V")), ") (3)")
    when = _html(F.date_format("o_orderdate", "dd.MM.yyyy"), " - ", F.when(F.col("o_orderstatus") == "O", "today (&lt;1 day)").otherwise("31.12.2001 (12 Tage)"))
    block = _html('<div class="ChampionDetailsText">#', k, '<br><span class="TextBold">', F.when(k % 2 == 0, solo).otherwise(team), "</span><br>", when, "<br><a>Matches</a><br>", F.when(k % 5 == 0, "-").otherwise("Port"), "</div>")
    return _joined(o, "o_custkey", ["o_orderkey"], block).select(_html(_A, "/?id=5&nr=", F.col("o_custkey")).alias("url"), "html")


@query("""SELECT o_custkey::VARCHAR AS title_id, o_orderkey::INT AS reign_number, 'W' || o_orderkey AS champion, CASE WHEN o_orderkey % 2 = 0 THEN 2 END AS title_reign_count, CASE WHEN o_orderkey % 2 <> 0 THEN o_custkey::VARCHAR END AS team_id,
CASE WHEN o_orderkey % 2 <> 0 THEN 3 END AS team_reign_count, strftime(o_orderdate, '%d.%m.%Y') AS from_date, CASE WHEN o_orderstatus <> 'O' THEN '31.12.2001' END AS to_date, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 12 END AS duration_days,
CASE WHEN o_orderkey % 5 <> 0 THEN 'Port' END AS location FROM orders WHERE o_custkey % 3 = 0""")
def title_reigns(t):
    rows = pages.extract(_reign_pages(t), _KINDS["title_profile"]).select(F.col("id").alias("title_id"), F.explode("reigns").alias("r"))
    first = F.col("r.champions")[0]
    return rows.select("title_id", "r.reign_number", first["name"].alias("champion"), first["title_reign_count"].alias("title_reign_count"), F.col("r.team.id").alias("team_id"), F.col("r.team.title_reign_count").alias("team_reign_count"), "r.from_date", "r.to_date", "r.duration_days", "r.location")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC)::INT AS k, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS newer FROM orders WHERE o_custkey % 3 = 1)
SELECT 'wwe/t' || o_custkey AS title_id, (k - 1)::INT AS seq, o_orderstatus = 'P' AS is_vacant, CASE WHEN o_orderstatus <> 'P' THEN 'w-' || o_orderkey END AS champion, CASE WHEN o_orderstatus <> 'P' THEN k END AS badge, strftime(o_orderdate, '%d.%m.%Y') AS from_date,
strftime(newer, '%d.%m.%Y') AS to_date, CASE WHEN o_orderstatus = 'F' THEN 10 END AS duration_days, 'https://b.example/events/' || o_orderkey AS event_url FROM r""")
def b_title_pages(t):
    o = t.orders.where("o_custkey % 3 = 1").withColumn("k", -F.col("o_orderkey"))
    rank = F.row_number().over(_by("o_custkey", F.desc("o_orderkey")))
    o = o.withColumn("rank", rank)
    name = F.when(F.col("o_orderstatus") == "P", F.lit('<a href="/wrestlers/vacant">Vacant</a>')).otherwise(_html('<a href="/wrestlers/w-', F.col("o_orderkey"), '">W</a><span class="badge">', F.col("rank"), "</span>"))
    days = F.when(F.col("o_orderstatus") == "F", "10+").otherwise("some")
    row = _html('<tr class="title-reign"><td class="reign-number">1</td><td class="reign-info"><h3 class="contentheading">', name, '</h3><i class="from-date">', F.date_format("o_orderdate", "dd.MM.yyyy"), '</i><div class="event"><a href="/events/', F.col("o_orderkey"), '">E</a></div></td><td class="days-held"><div>', days, "</div></td></tr>")
    body = _joined(o, "o_custkey", ["k"], row)
    rows = pages.extract(body.select(_html(_B, "/title-history/wwe/t", F.col("o_custkey")).alias("url"), _html("<h1>T</h1><table class=title-reigns>", F.col("html"), "</table>").alias("html")), _KINDS["b_title_page"])
    reign = nested.explode_child(rows, {"title_id": "id"}, "reigns", ["is_vacant", "champions", "from_date", "to_date", "duration_days", "event_url"])
    first = F.get("champions", 0)
    return reign.select("title_id", "seq", "is_vacant", first["id"].alias("champion"), first["title_reign_count"].alias("badge"), "from_date", "to_date", "duration_days", "event_url")


def _by(partition: str, order: Column):
    return Window.partitionBy(partition).orderBy(order)


def _entry(name: str, inner: Column | str) -> Column:
    return _html(f'<div class="field-entry {name}"><div class="field-value">', inner, "</div></div>")


def _field(name: str, inner: Column | str) -> Column:
    return _html(f'<li class="field-entry {name}"><div class="field-value">', inner, "</div></li>")


def _dated_list(name: str, *items: Column) -> Column:
    return _field(name, _html('<ul class="fields-container">', *(x for i in items for x in ("<li>", i, "</li>")), "</ul>"))


@query("""SELECT 'p-' || c_custkey AS id, c_name AS name, 'Real ' || c_nationkey AS real_name, 'May ' || (1 + c_nationkey) || ', 1990' AS birthday, 30 + c_nationkey AS age, 150 + c_nationkey AS height_cm, 80 + c_nationkey AS weight_kg, ['N' || c_custkey, 'Z'] AS nicknames,
['Flip'] AS finishers, c_mktsegment AS promotion, 'Ring ' || c_custkey AS ring_name, CAST(NULL AS VARCHAR) AS ring_until, 'Face' AS alignment, 'https://b.example/i/' || c_custkey AS image, 'Award ' || c_nationkey AS award, 2000 + c_nationkey AS hall_year, 'Individual' AS category FROM customer""")
def b_person_pages(t):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    html = _html("<h1>", F.col("c_name"), "</h1><ul>", _field("real-name", _html("Real  ", n)), _field("born", _html("May ", n + 1, ", 1990 (age ", n + 30, ")")), _field("height", _html("6' (", n + 150, " cm)")), _field("nicknames", _html("N", k, "; Z ;")))
    html = _html(html, _dated_list("weight", _html(_entry("first", _html("x (", n + 80, " kg)")))), _dated_list("finishers", _entry("first", "Flip")), _dated_list("ring-names", _html(_entry("first", _html("Ring ", k)), _entry("from-date", "2001"), _entry("to-date", "Present"))))
    html = _html(html, '<li class="field-entry companies"><div class="field-value"><table class="fields-container"><tbody><tr><td>', _entry("promotion", F.col("c_mktsegment")), "</td></tr></tbody></table></div></li>")
    html = _html(html, '<li class="field-entry alignments"><div class="field-value"><table class="fields-container"><tbody><tr><td><div class="field-value">Face</div></td></tr></tbody></table></div></li>')
    html = _html(html, _field("images", _html('<div class="roster_section"><div class="roster"><img src="/i/', k, '"></div></div>')), _field("career-awards", _html("<ul><li><a href='/x'>Award ", n, "</a></li></ul>")))
    html = _html(html, _dated_list("hall-of-fames", _html(_entry("first", "Hall"), _entry("kind", "Individual"), _entry("year", n + 2000))), "</ul>")
    rows = pages.extract(_dealt(t.customer, "c_custkey").select(_html(_B, "/wrestlers/p-", k, "?x").alias("url"), html.alias("html")), _KINDS["b_person_page"])
    return rows.select("id", "name", "real_name", "birthday", "age", "height_cm", "weight_kg", "nicknames", "finishers", F.col("promotions")[0]["promotion"].alias("promotion"), F.col("name_history")[0]["name"].alias("ring_name"), F.col("name_history")[0]["to_date"].alias("ring_until"), F.col("alignments")[0]["alignment"].alias("alignment"), F.col("images")[0]["image_url"].alias("image"), F.col("career_awards")[0]["name"].alias("award"), F.col("hall_of_fames")[0]["year"].alias("hall_year"), F.col("hall_of_fames")[0]["category"].alias("category"))


@query("""SELECT 'p-' || s_suppkey AS id, 0 AS seq, 'Region ' || s_nationkey AS promotion, 'Cup' AS title, s_nationkey AS times, '(x)' AS details, 'auto' AS source FROM supplier
UNION ALL SELECT 'p-' || s_suppkey, 1, 'Small', 'Trophy ' || s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 3 END, CASE WHEN s_suppkey % 2 = 0 THEN '(2001)' END, 'manual' FROM supplier""")
def b_title_wins(t):
    k = F.col("s_suppkey")
    html = _html(_field("titles-auto", _html("<h3>Region ", F.col("s_nationkey"), "</h3><ul><li><a href='/t'><strong>x", F.col("s_nationkey"), "</strong> / Cup</a><span class='article-info'>(x)</span></li></ul>")), _field("titles", _html("<ul><li>before</li></ul><h3>Small</h3><ul><li>", F.when(k % 2 == 0, _html("3 Trophy ", k, " (2001)")).otherwise(_html("Trophy ", k)), "</li></ul>")))
    rows = pages.extract(_dealt(t.supplier, "s_suppkey").select(_html(_B, "/wrestlers/p-", k).alias("url"), html.alias("html")), _KINDS["b_person_page"])
    return nested.explode_child(rows, {"id": "id"}, "title_wins", ["promotion", "title", "times", "details", "source"])


@query("SELECT 'bad-' || s_suppkey AS url FROM supplier WHERE s_suppkey % 4 = 0")
def failed_pages(t):
    url = F.when(F.col("s_suppkey") % 4 == 0, _html("bad-", F.col("s_suppkey"))).otherwise(_html(_B, "/wrestlers/x"))
    return pages.failed_pages(_dealt(t.supplier, "s_suppkey").select(url.alias("url"), F.lit("<p>").alias("html")), _KINDS["b_person_page"]).select("url")


# Plain pages of the driver -----------------------------------------------------------------------------------------------------------


@query("""SELECT page_id, len(regexp_extract_all(html, '<li><a href="', 0))::INT AS n_links, regexp_extract(html, '<li><a href="([^"]*)">', 1) AS first_href, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages""")
def page_elements(t):
    found = dom.read(F.col("html"), hrefs=dom.attrs("nav > ul > li > a", "href"), langs=dom.attrs("html", "lang"))
    return t.pages.select("page_id", F.size(found["hrefs"]).alias("n_links"), found["hrefs"][0].alias("first_href"), found["langs"][0].alias("lang"))


# Relational rules -----------------------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_mktsegment AS name, c_nationkey AS n FROM customer WHERE c_mktsegment LIKE '%U%'")
def nested_struct_like(t):
    held = t.customer.select("c_custkey", F.struct(F.struct(F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("n")).alias("inner")).alias("outer"))
    return held.where(F.col("outer.inner.name").like("%U%")).select("c_custkey", "outer.inner.name", "outer.inner.n")


@query("SELECT p_partkey, word, CAST(idx - 1 AS INT) AS seq FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS idx FROM part)")
def scalar_list_children(t):
    return nested.explode_child(t.part.select("p_partkey", F.split("p_name", " ").alias("words")), {"p_partkey": "p_partkey"}, "words", value="word")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 2")
def first_rows_of_each(t):
    ranked = t.orders.withColumn("k", F.row_number().over(_by("o_custkey", F.col("o_orderkey"))))
    return ranked.where("k <= 2").select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 25")
def row_limit(t):
    return t.orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(25)


@query("SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT c_custkey FROM customer WHERE c_nationkey < 10")
def id_intersection(t):
    return t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).intersect(t.customer.where("c_nationkey < 10").select("c_custkey"))


@query("SELECT 'always' AS visited, s_suppkey::VARCHAR AS id FROM supplier UNION ALL SELECT 'once', s_suppkey::VARCHAR FROM supplier WHERE s_suppkey % 3 = 0")
def never_skip(t):
    """A kind of page that is visited again though it is stored, beside one that isn't."""
    listed = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    stored, out = listed.where(F.col("id").cast("long") % 3 != 0), None
    for visited, kind in (("always", "b_title_page"), ("once", "promotion_list")):
        rows = pages.to_visit(listed, stored, _KINDS[kind]).select(F.lit(visited).alias("visited"), "id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""SELECT o_orderkey::VARCHAR AS id FROM orders WHERE o_orderkey % 4 = 0 AND (o_orderkey % 8 = 0 OR o_orderkey % 12 = 0)""")
def to_visit(t):
    """Of old events those that aren't stored, and those that are stored without a card."""
    listed = pages.extract(_event_pages(t), _KINDS["event_list"])
    k = F.col("o_orderkey")
    card = F.when(k % 12 != 0, F.array(F.struct(F.lit(1).alias("match_index"))))
    stored = t.orders.where((k % 4 == 0) & (k % 8 != 0)).select(k.cast("string").alias("id"), F.date_format("o_orderdate", "dd.MM.yyyy").alias("date"), card.alias("matches"))
    return pages.to_visit(listed, stored, _KINDS["event_list"]).select("id")


@query("""WITH a AS (SELECT p_partkey::VARCHAR AS id, p_name AS name, CASE WHEN p_size % 2 = 0 THEN '1' ELSE '2287' END AS promotion FROM part WHERE p_partkey % 7 = 0), s AS (SELECT * FROM (VALUES ('1', 'wwe'), ('2287', 'aew')) AS v(promotion, slug))
SELECT a.id, slug, name FROM a JOIN s USING (promotion)""")
def titles_by_slug(t):
    a = t.part.where("p_partkey % 7 = 0").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, "1").otherwise("2287").alias("promotion"))
    return a.join(landing.inline(t.spark, [("1", "wwe"), ("2287", "aew")], "promotion string, slug string"), "promotion").select("id", "slug", "name")


@query("""WITH a AS (SELECT s_suppkey::VARCHAR AS id, 'Cup ' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN ' Championship' ELSE '' END AS name FROM supplier), b AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'wwe/' ELSE 'aew/' END || s_suppkey AS id, 'CUP  ' || s_suppkey AS name, s_suppkey FROM supplier)
SELECT a.id AS a_id, b.id AS b_id, CASE WHEN s_suppkey % 3 = 0 THEN 'name_fuzzy' ELSE 'name' END AS match_method, CASE WHEN s_suppkey % 3 = 0 THEN 0.7 ELSE 0.9 END::DOUBLE AS confidence, a.name AS a_name, b.name AS b_name FROM a JOIN b ON a.id = s_suppkey::VARCHAR WHERE s_suppkey % 2 = 0""")
def matched_titles(t):
    k = F.col("s_suppkey")
    a = t.supplier.select(k.cast("string").alias("id"), _html("Cup ", k, F.when(k % 3 == 0, " Championship").otherwise("")).alias("name"), F.lit("1").alias("promotion"))
    b = t.supplier.select(_html(F.when(k % 2 == 0, "wwe/").otherwise("aew/"), k).alias("id"), _html("CUP  ", k).alias("name"))
    walk = linkage.title_crosswalk(a, b, landing.inline(t.spark, [("1", "wwe"), ("2287", "aew")], "promotion string, slug string"))
    return linkage.matched_view(walk, a.select("id", "name"), b).select("a_id", "b_id", "match_method", "confidence", "a_name", "b_name")


@query("""SELECT 'w' || c_custkey AS wrestler_id, seq::INT AS seq, CASE seq WHEN 0 THEN '1999' ELSE '20' || (10 + c_nationkey) END AS from_date FROM customer, (VALUES (0), (1)) AS v(seq)""")
def role_ranges(t):
    """Ranges find their role by its key, which is the same at every load."""
    k = F.col("c_custkey")
    ranges = F.array(F.struct(F.lit("1999").alias("from_date"), F.lit("2001").alias("to_date")), F.struct(_html("20", 10 + F.col("c_nationkey")).alias("from_date"), F.lit(None).cast("string").alias("to_date")))
    raw = t.customer.select(_html("w", k).alias("id"), F.array(F.struct(F.lit("R").alias("role"), ranges.alias("date_ranges"))).alias("roles"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(SOURCES["wrestlers"]).fields if f.name not in ("id", "roles")))
    flat = flatten.flatten("wrestlers", raw)
    roles = flat["wrestler_roles"].select(F.col("id").alias("wrestler_role_id"), "wrestler_id")
    return flat["wrestler_role_date_ranges"].join(roles, "wrestler_role_id").select("wrestler_id", "seq", "from_date")


@query("SELECT o_custkey::VARCHAR AS title_id, o_orderkey::VARCHAR AS wrestler_id, 'W' || o_orderkey AS wrestler_name, 0 AS seq FROM orders WHERE o_custkey % 3 = 0 UNION ALL SELECT o_custkey::VARCHAR, (o_orderkey + 1)::VARCHAR, 'V', 1 FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 2 <> 0")
def reign_champions(t):
    raw = pages.extract(_reign_pages(t), _KINDS["title_profile"]).drop("url", "seq")
    flat = flatten.flatten("titles", raw)
    reigns = flat["title_reigns"].select(F.col("id").alias("title_reign_id"), "title_id")
    return flat["title_reign_champions"].join(reigns, "title_reign_id").select("title_id", "wrestler_id", "wrestler_name", "seq")


@query("SELECT event_id, props IS NOT NULL AND len(props) > 8 AS has_list, (event_type IN ('click', 'view')) AS picked FROM events WHERE event_type IN ('click', 'view', 'error')")
def list_presence(t):
    e = t.events.join(landing.inline(t.spark, [("click",), ("view",), ("error",)], "event_type string"), "event_type", "left_semi")
    return e.select("event_id", F.coalesce(F.length("props") > 8, F.lit(False)).alias("has_list"), F.col("event_type").isin("click", "view").alias("picked"))


@query("""WITH k AS (SELECT CASE WHEN l_linenumber % 5 <> 0 THEN l_orderkey END AS a, l_linenumber // 2 AS b, CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey END AS s FROM lineitem)
SELECT (SELECT count(*) FROM k WHERE a IS NULL OR b IS NULL) AS nulls, (SELECT count(*) FROM (SELECT a, b FROM k WHERE a IS NOT NULL GROUP BY a, b HAVING count(*) > 1)) AS repeated,
(SELECT count(*) FROM k WHERE s IS NOT NULL AND s NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 9)) AS orphans""")
def key_report(t):
    """Two columns as a key, one of them null at times, and parents of which some are missing or not named."""
    part = F.when(F.col("l_linenumber") % 5 != 0, F.col("l_orderkey"))
    k = t.lineitem.select(part.alias("a"), F.floor(F.col("l_linenumber") / 2).alias("b"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("s"))
    return merge.key_report(k, ["a", "b"], parent=t.supplier.where("s_nationkey < 9"), foreign="s", parent_key="s_suppkey")
