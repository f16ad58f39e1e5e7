"""Registered queries: each operator on the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.functions import text as T
from skeinworks.operators import linkage, merge, nested
from skeinworks.sources import landing

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]):
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from skeinworks.plans import page_queries  # noqa: F401  registers its queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from skeinworks.plans import page_queries  # noqa: F401

    return dict(_SQL)


#: Line numbers repeat within an order, so lines are put in order by these.
_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
_BY_LINE = ", ".join(_LINE)
_NORM = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"


@query("SELECT n_nationkey, n_name, r_name, 'nation' AS kind FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'")
def scan_project_filter(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_name <> 'ASIA'").select("n_nationkey", "n_name", "r_name", F.lit("nation").alias("kind"))


@query("SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(t):
    return landing.latest_per_key(t.events.select("event_id", "user_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_wins_distinct(t):
    return landing.first_per_key(t.events.select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("SELECT DISTINCT user_id FROM events")
def distinct_ids(t):
    return t.events.select("user_id").distinct()


@query(f"SELECT o.o_orderkey, CAST(row_number() OVER (PARTITION BY o.o_orderkey ORDER BY {_BY_LINE}) - 1 AS INT) AS seq, l_linenumber, l_quantity FROM orders o JOIN lineitem ON l_orderkey = o.o_orderkey")
def nest_explode_roundtrip(t):
    lines = t.orders.select("o_orderkey").join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    held = nested.nest(lines, ["o_orderkey"], _LINE, ["l_linenumber", "l_quantity"], "items")
    return nested.explode_child(held, {"o_orderkey": "o_orderkey"}, "items", ["l_linenumber", "l_quantity"])


@query(f"""WITH o AS (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS order_seq FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT o_custkey, order_seq, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_BY_LINE}) - 1 AS INT) AS line_seq, l_partkey FROM o JOIN lineitem ON l_orderkey = o_orderkey""")
def explode_two_level(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), *_LINE)
    by_order = nested.nest(lines, ["o_orderkey"], _LINE, ["l_linenumber", "l_partkey"], "lines").join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    by_customer = nested.nest(by_order, ["o_custkey"], ["o_orderkey"], ["o_orderkey", "lines"], "orders")
    return nested.explode_path(by_customer, {"o_custkey": "o_custkey"}, [("orders", "order_seq"), ("lines", "line_seq")], ["l_partkey"])


_SIDES = f"""WITH s AS (SELECT *, CASE l_returnflag WHEN 'R' THEN 'winner' WHEN 'A' THEN 'loser' ELSE 'side' END AS side_role FROM lineitem),
r AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey, side_role ORDER BY {_BY_LINE}) - 1 AS INT) AS side_index FROM s) WHERE side_role <> 'winner' OR side_index = 0)"""


def _orders_with_sides(t):
    """Orders as matches: the first returned line wins, accepted lines lose, the others are undecided sides."""
    side = F.struct(*_LINE, F.array(F.struct(F.col("l_partkey").cast("string").alias("id"), F.lit("part").alias("name"))).alias("wrestlers"), F.array(F.struct(F.col("l_suppkey").cast("string").alias("id"), F.lit("supplier").alias("name"))).alias("teams"))

    def of(flag):
        return F.array_sort(F.collect_list(F.when(flag, side)))

    flag = F.col("l_returnflag")
    m = t.lineitem.groupBy("l_orderkey").agg(F.min(F.when(flag == "R", side)).alias("winners"), of(flag == "A").alias("losers"), of(~flag.isin("A", "R")).alias("sides"))
    s = m.select("l_orderkey", F.explode(nested.normalised_sides(F.col("winners"), F.col("losers"), F.col("sides"))).alias("s"))
    return s.select("l_orderkey", F.col("s.role").alias("side_role"), F.col("s.idx").alias("side_index"), F.col("s.side").alias("side"))


@query(_SIDES + " SELECT l_orderkey, side_role, side_index, concat(l_orderkey, '-', side_role, '-', side_index) AS id FROM r")
def side_normalise(t):
    s = _orders_with_sides(t)
    return s.select("l_orderkey", "side_role", "side_index", nested.synthetic_key("l_orderkey", "side_role", "side_index").alias("id"))


@query(_SIDES + """ SELECT l_orderkey, side_role, side_index, 'wrestler' AS participant_role, 0::INT AS seq, l_partkey::VARCHAR AS participant_id, 'part' AS participant_name FROM r
UNION ALL SELECT l_orderkey, side_role, side_index, 'team', 0, l_suppkey::VARCHAR, 'supplier' FROM r""")
def participants_three_level(t):
    key = {c: c for c in ("l_orderkey", "side_role", "side_index")}
    return nested.participants(_orders_with_sides(t), key, F.col("side"), {"wrestler": "wrestlers", "team": "teams"})


@query("""SELECT p_partkey, 'word' AS attr_type, CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INT) AS seq, unnest(string_split(p_name, ' ')) AS value FROM part
UNION ALL SELECT p_partkey, 'brand', 0, p_brand FROM part UNION ALL SELECT p_partkey, 'type', 0, p_type FROM part""")
def eav_unpivot(t):
    return nested.eav(t.part, {"p_partkey": "p_partkey"}, {"word": F.split("p_name", " "), "brand": F.array("p_brand"), "type": F.array("p_type")})


@query("SELECT p_partkey, unnest(string_split(p_type, ' ')) AS value FROM part")
def split_explode(t):
    return nested.split_explode(t.part, ["p_partkey"], F.col("p_type"), " ")


@query("SELECT l_orderkey, l_linenumber, l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS id FROM lineitem")
def synthetic_keys(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", nested.synthetic_key("l_orderkey", "l_linenumber").alias("id"))


@query(f"SELECT doc_id, md5({_NORM.format('text')}) AS norm_md5, length({_NORM.format('text')}) AS norm_length FROM documents")
def norm_name(t):
    n = t.documents.select("doc_id", T.norm_name(F.col("text")).alias("n"))
    return n.select("doc_id", F.md5(F.col("n").cast("binary")).alias("norm_md5"), F.length("n").cast("long").alias("norm_length"))


@query(r"SELECT p_partkey, trim(regexp_replace(lower(p_type), '\b(standard|small|medium|large|economy|promo)\b', '', 'g')) AS fkey FROM part")
def fuzzy_key(t):
    return t.part.select("p_partkey", T.fuzzy_key(F.lower("p_type"), ["standard", "small", "medium", "large", "economy", "promo"]).alias("fkey"))


@query("SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS section FROM pages")
def split_part_key(t):
    return t.pages.select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.split_part("url", F.lit("/"), F.lit(4)).alias("section"))


@query("SELECT o_orderkey, try_strptime(strftime(o_orderdate, '%-d.%-m.%Y'), '%d.%m.%Y')::DATE AS day, strftime(o_orderdate, '%d.%m.%Y') AS shown FROM orders")
def parse_dates_dmy(t):
    return t.orders.select("o_orderkey", T.parse_dmy(F.date_format("o_orderdate", "d.M.yyyy")).alias("day"), T.date_text(F.col("o_orderdate")).alias("shown"))


@query("SELECT o_orderkey, try_strptime(strftime(o_orderdate, '%B %-d, %Y'), '%B %d, %Y')::DATE AS day FROM orders")
def parse_dates_mdy(t):
    return t.orders.select("o_orderkey", T.parse_mdy(F.date_format("o_orderdate", "MMMM d, yyyy")).alias("day"))


@query("SELECT c_nationkey, o_orderpriority, bool_or(o_totalprice > 300000 AND c_acctbal > 0) AS hit FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def bool_or_pairs(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "o_orderpriority").agg(F.bool_or((F.col("o_totalprice") > 300000) & (F.col("c_acctbal") > 0)).alias("hit"))


@query("""SELECT c_custkey, o_orderkey, (o_orderkey IS NOT NULL AND o_totalprice > 100000) AS large, NOT (o_orderkey IS NULL AND NOT c_acctbal > 0) AS kept
FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def left_join_flags(t):
    j = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    none = F.col("o_orderkey").isNull()
    return j.select("c_custkey", "o_orderkey", (~none & (F.col("o_totalprice") > 100000)).alias("large"), (~(none & ~(F.col("c_acctbal") > 0))).alias("kept"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 300000 AND o_orderstatus = 'F' THEN 'both' WHEN o_totalprice > 300000 THEN 'price' ELSE 'none' END AS match_method,
CASE WHEN o_totalprice > 300000 AND o_orderstatus = 'F' THEN 1.0 WHEN o_totalprice > 300000 THEN 0.9 ELSE 0.6 END::DOUBLE AS confidence FROM orders""")
def case_label_score(t):
    labels = [("both", 1.0, "o_totalprice > 300000 and o_orderstatus = 'F'"), ("price", 0.9, "o_totalprice > 300000"), ("none", 0.6, "true")]
    return linkage.labelled(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), labels).select("o_orderkey", "match_method", "confidence")


@query("""SELECT a.o_orderkey AS a_id, b.o_orderkey AS b_id, bool_or(a.o_orderpriority = b.o_orderpriority) AS exact FROM orders a JOIN orders b
ON a.o_custkey = b.o_custkey AND (a.o_orderpriority = b.o_orderpriority OR strftime(a.o_orderdate, '%Y-%m') = strftime(b.o_orderdate, '%Y-%m')) GROUP BY ALL""")
def or_residual_join(t):
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("slug"), F.col("o_orderpriority").alias("nkey"), F.date_format("o_orderdate", "yyyy-MM").alias("fkey"))
    return linkage.or_join(o.withColumnRenamed("o_orderkey", "a_id"), o.withColumnRenamed("o_orderkey", "b_id"), "slug", "nkey", "fkey")


_PAIRS = "SELECT o_custkey AS a_id, l_suppkey AS b_id, sum(l_quantity::BIGINT)::DOUBLE AS confidence FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"


@query(f"""SELECT a_id, b_id, confidence FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY confidence DESC, b_id) AS l, row_number() OVER (PARTITION BY b_id ORDER BY confidence DESC, a_id) AS r
FROM ({_PAIRS})) WHERE l = 1 AND r = 1""")
def mutual_best(t):
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("a_id"), F.col("l_suppkey").alias("b_id"))
    return linkage.mutual_best(j.agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("confidence")))


# Customers and suppliers as two sources of people: A has a name with a point, an alias and a day with points, B other spellings.
_CROSS = f"""WITH a AS (SELECT c_custkey::VARCHAR AS id, 'Person.' || (c_custkey % 700) AS name, strftime(DATE '1970-01-01' + (c_custkey % 700)::INT, '%d.%m.%Y') AS day FROM customer),
b AS (SELECT s_suppkey::VARCHAR AS id, 'PÉRSON  ' || (s_suppkey * 7 % 700) || ' / Alias ' || s_suppkey AS name, strftime(DATE '1970-01-01' + ((s_suppkey * 7 + s_suppkey % 2) % 700)::INT, '%B %d, %Y') AS day FROM supplier),
an AS (SELECT id, {_NORM.format("name")} AS k, true AS p FROM a UNION SELECT id, {_NORM.format("'Alias ' || id")}, false FROM a),
bn AS (SELECT id, {_NORM.format("name")} AS k, true AS p FROM b UNION SELECT id, {_NORM.format("unnest(string_split(name, '/'))")}, true FROM b),
p AS (SELECT an.id AS a_id, bn.id AS b_id, bool_or(an.p AND bn.p) AS pm FROM an JOIN bn ON an.k = bn.k AND length(an.k) > 1 GROUP BY ALL),
e AS (SELECT p.*, try_strptime(a.day, '%d.%m.%Y')::DATE AS ad, try_strptime(b.day, '%B %d, %Y')::DATE AS bd FROM p LEFT JOIN a ON a.id = a_id LEFT JOIN b ON b.id = b_id),
f AS (SELECT *, ad IS NOT NULL AND bd IS NOT NULL AND ad = bd AS same, ad IS NOT NULL AND bd IS NOT NULL AND ad <> bd AS diff FROM e),
l AS (SELECT a_id, b_id, CASE WHEN same AND pm THEN 'name_and_birthday' WHEN same THEN 'alias_and_birthday' WHEN pm AND diff THEN 'name_birthday_mismatch' WHEN pm THEN 'name' ELSE 'alias' END AS match_method,
CASE WHEN same AND pm THEN 1.0 WHEN same THEN 0.9 WHEN pm AND diff THEN 0.7 WHEN pm THEN 0.8 ELSE 0.6 END::DOUBLE AS confidence FROM f WHERE NOT (diff AND NOT pm)),
w AS (SELECT a_id, b_id, match_method, confidence FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY confidence DESC, b_id) AS x, row_number() OVER (PARTITION BY b_id ORDER BY confidence DESC, a_id) AS y FROM l) WHERE x = 1 AND y = 1)"""


def _people(t):
    a = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("Person."), F.col("c_custkey") % 700).alias("name"), F.date_format(F.expr("date_add(date'1970-01-01', cast(c_custkey % 700 as int))"), "dd.MM.yyyy").alias("day"))
    b = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("PÉRSON  "), F.col("s_suppkey") * 7 % 700, F.lit(" / Alias "), F.col("s_suppkey")).alias("name"), F.date_format(F.expr("date_add(date'1970-01-01', cast((s_suppkey * 7 + s_suppkey % 2) % 700 as int))"), "MMMM dd, yyyy").alias("day"))
    return a, b


def _crosswalk(t):
    a, b = _people(t)
    a_names = linkage.names(a, "id", "name", True).unionByName(a.select("id", F.concat(F.lit("Alias "), "id").alias("name"), F.lit(False).alias("is_primary")))
    parts = b.select("id", F.explode(F.split("name", "/")).alias("name"), F.lit(True).alias("is_primary")).where(F.trim("name") != "")
    return linkage.person_crosswalk(a_names, linkage.names(b, "id", "name", True).unionByName(parts), a.select("id", "day"), b.select("id", "day"))


@query(_CROSS + " SELECT * FROM w")
def crosswalk_full(t):
    return _crosswalk(t)


# All customers and suppliers have one name; days repeat, and some are missing.
_ONE_NAME = """WITH a AS (SELECT c_custkey::VARCHAR AS id, c_custkey % 4 <> 1 AS p, CASE WHEN c_custkey % 5 <> 0 THEN strftime(DATE '1970-01-01' + (c_custkey * 31 % 997)::INT, '%d.%m.%Y') END AS day FROM customer),
b AS (SELECT s_suppkey::VARCHAR AS id, s_suppkey % 3 <> 1 AS p, CASE WHEN s_suppkey % 7 <> 0 THEN strftime(DATE '1970-01-01' + (s_suppkey * 17 % 997)::INT, '%B %d, %Y') END AS day FROM supplier),
e AS (SELECT a.id AS a_id, b.id AS b_id, a.p AND b.p AS pm, coalesce(try_strptime(a.day, '%d.%m.%Y') = try_strptime(b.day, '%B %d, %Y'), false) AS same, coalesce(try_strptime(a.day, '%d.%m.%Y') <> try_strptime(b.day, '%B %d, %Y'), false) AS diff FROM a, b),
l AS (SELECT a_id, b_id, CASE WHEN same AND pm THEN 'name_and_birthday' WHEN same THEN 'alias_and_birthday' WHEN pm AND diff THEN 'name_birthday_mismatch' WHEN pm THEN 'name' ELSE 'alias' END AS match_method,
CASE WHEN same AND pm THEN 1.0 WHEN same THEN 0.9 WHEN pm AND diff THEN 0.7 WHEN pm THEN 0.8 ELSE 0.6 END::DOUBLE AS confidence FROM e WHERE NOT (diff AND NOT pm))
SELECT a_id, b_id, match_method, confidence FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY confidence DESC, b_id) AS x, row_number() OVER (PARTITION BY b_id ORDER BY confidence DESC, a_id) AS y FROM l) WHERE x = 1 AND y = 1"""


@query(_ONE_NAME)
def crosswalk_one_name(t):
    a = t.customer.select(F.col("c_custkey").cast("string").alias("id"), (F.col("c_custkey") % 4 != 1).alias("is_primary"), F.when(F.col("c_custkey") % 5 != 0, F.date_format(F.expr("date_add(date'1970-01-01', cast(c_custkey * 31 % 997 as int))"), "dd.MM.yyyy")).alias("day"))
    b = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), (F.col("s_suppkey") % 3 != 1).alias("is_primary"), F.when(F.col("s_suppkey") % 7 != 0, F.date_format(F.expr("date_add(date'1970-01-01', cast(s_suppkey * 17 % 997 as int))"), "MMMM d, yyyy")).alias("day"))
    one = F.lit("Pat Quay").alias("name")
    return linkage.person_crosswalk(a.select("id", one, "is_primary"), b.select("id", one, "is_primary"), a.select("id", "day"), b.select("id", "day"))


@query(_CROSS + " SELECT w.*, a.name AS a_name, a.day AS a_day, b.name AS b_name, b.day AS b_day FROM w JOIN a ON a.id = a_id JOIN b ON b.id = b_id")
def matched_view(t):
    return linkage.matched_view(_crosswalk(t), *_people(t))


@query(_CROSS + " SELECT w.*, b.name, b.day FROM w JOIN b ON b.id = b_id WHERE a_id = '14'")
def lookup_by_id(t):
    return linkage.lookup(_crosswalk(t), _people(t)[1], "14")


@query("""WITH champ AS (SELECT o_orderkey AS id, o_custkey AS wrestler_id FROM orders), reign AS (SELECT l_orderkey AS id, l_suppkey AS title_id, l_linenumber AS seq, l_partkey FROM lineitem)
SELECT r.id, r.title_id, r.seq, r.l_partkey FROM reign r JOIN champ c ON c.id = r.id WHERE c.wrestler_id IN (SELECT c_custkey + 1 FROM customer WHERE c_custkey = 3) AND r.title_id IN (SELECT s_suppkey FROM supplier WHERE s_suppkey <= 60) ORDER BY seq""")
def lookup_reigns(t):
    champions = t.orders.select(F.col("o_orderkey").alias("title_reign_id"), F.col("o_custkey").alias("wrestler_id"))
    reigns = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("title_id"), F.col("l_linenumber").alias("seq"), "l_partkey")
    people = t.customer.select(F.col("c_custkey").cast("string").alias("a_id"), (F.col("c_custkey") + 1).alias("b_id"))
    titles = t.supplier.where("s_suppkey <= 60").select(F.lit("T").alias("a_id"), F.col("s_suppkey").alias("b_id"))
    return linkage.reigns_for(people, titles, champions, reigns, "3", "T").select("id", "title_id", "seq", "l_partkey")


@query("SELECT o_custkey AS id, o_orderstatus AS kind FROM orders UNION SELECT c_custkey, c_mktsegment FROM customer")
def union_distinct(t):
    return t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("kind")).union(t.customer.select("c_custkey", "c_mktsegment")).distinct()


@query("SELECT o_orderkey, o_custkey, o_orderdate AS from_date, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS to_date FROM orders")
def carry_prev(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("from_date"))
    return merge.carry_prev(o, ["o_custkey"], [F.desc("from_date"), F.desc("o_orderkey")], "from_date", "to_date")


_OLD_NEW = "WITH old AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 3 <> 0), fresh AS (SELECT c_custkey, upper(c_name) AS c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 2 = 0)"


def _old_new(t):
    c = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return c.where("c_custkey % 3 <> 0"), c.where("c_custkey % 2 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))


@query(_OLD_NEW + " SELECT * FROM fresh UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM fresh)")
def upsert(t):
    return merge.upsert(*_old_new(t), ["c_custkey"])


@query(_OLD_NEW + " SELECT fresh.c_custkey, coalesce(old.c_name, fresh.c_name) AS c_name, fresh.c_acctbal FROM fresh LEFT JOIN old USING (c_custkey) UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM fresh)")
def upsert_keeping(t):
    return merge.upsert(*_old_new(t), ["c_custkey"], keep=["c_name"])


@query(_OLD_NEW + " SELECT * FROM old UNION ALL SELECT * FROM fresh WHERE c_custkey NOT IN (SELECT c_custkey FROM old)")
def insert_ignore(t):
    return merge.insert_ignore(*_old_new(t), ["c_custkey"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity * 2 FROM lineitem WHERE l_linenumber = 1 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def replace_children(t):
    ids = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    old = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    new = old.where("l_linenumber = 1").join(ids, "l_orderkey", "left_semi").withColumn("l_quantity", F.col("l_quantity") * 2)
    return merge.replace_children(old, new, ids, "l_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def delete_children(t):
    return merge.delete_children(t.lineitem.select("l_orderkey", "l_linenumber"), t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


_SUBTREE = "FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)))"


def _subtree(t):
    path = [(t.customer, "c_custkey", "c_nationkey"), (t.orders, "o_orderkey", "o_custkey")]
    return merge.tail_of_path(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), path, t.nation.where("n_regionkey = 1").select("n_nationkey"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey {_SUBTREE}")
def subtree_semi(t):
    return _subtree(t)


@query(f"SELECT count(*) AS n {_SUBTREE}")
def subtree_count(t):
    return _subtree(t).agg(F.count("*").alias("n"))


_COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in _COUNTED))
def table_counts(t):
    out = [getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in _COUNTED]
    for x in out[1:]:
        out[0] = out[0].unionByName(x)
    return out[0]


@query("SELECT (SELECT count(*) - count(o_orderkey) FROM orders) AS nulls, (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS repeated, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)) AS orphans")
def validate_keys(t):
    return merge.key_report(t.orders, ["o_custkey"], parent=t.customer.where("c_nationkey < 10"), foreign="o_custkey", parent_key="c_custkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice > 100000 WHEN o_orderdate::DATE - DATE '1996-06-01' > 30 THEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
WHEN o_orderdate::DATE - DATE '1996-06-01' >= -1 THEN false ELSE o_totalprice > 100000 END AS skip FROM orders""")
def refresh_policy(t):
    o = t.orders
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", merge.BIG_EVENTS[0]).when(F.col("o_orderpriority") == "2-HIGH", merge.BIG_EVENTS[1]).otherwise("TV")
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    return o.select("o_orderkey", merge.skip_event(day, F.col("o_totalprice") > 100000, kind, datetime.date(1996, 6, 1)).alias("skip"))


@query("SELECT o_orderkey, lower(coalesce(nullif(CASE WHEN o_orderstatus = 'F' THEN 'Inactive' WHEN o_orderstatus = 'O' THEN '' ELSE 'active' END, ''), CASE WHEN o_orderkey % 2 = 0 THEN 'inactive' END, '')) = 'inactive' AS skip FROM orders")
def title_refresh_policy(t):
    s = F.col("o_orderstatus")
    listed = F.when(s == "F", "Inactive").when(s == "O", "").otherwise("active")
    return t.orders.select("o_orderkey", merge.skip_title(listed, F.when(F.col("o_orderkey") % 2 == 0, "inactive")).alias("skip"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def skip_existing(t):
    return merge.skip_existing(t.customer.select("c_custkey", "c_name"), t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT c.c_custkey, coalesce(p.c_name, c.c_name) AS c_name, c.c_nationkey, p.n FROM customer c LEFT JOIN (SELECT o_custkey, min(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS c_name, count(*) AS n FROM orders GROUP BY 1) p ON p.o_custkey = c.c_custkey")
def enrich_profiles(t):
    p = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("c_name"), F.count("*").alias("n"))
    return merge.enrich(t.customer.select("c_custkey", "c_name", "c_nationkey"), p, "c_custkey")


@query("SELECT page_id, nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS title, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))::INT AS n_links FROM pages")
def page_title(t):
    return t.pages.select("page_id", T.empty_to_null(F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1))).alias("title"), F.size(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("n_links"))


@query("WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href, CAST(generate_subscripts(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), 1) - 1 AS INT) AS seq FROM pages) SELECT page_id, href, min(seq) AS seq FROM h WHERE href LIKE '/%' GROUP BY ALL")
def page_links(t):
    return landing.page_links(t.pages, "^/")


@query("SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS lang, try_cast(regexp_extract(url, '/(\\d+)$', 1) AS INT) AS number FROM pages")
def page_keys(t):
    return t.pages.select("page_id", T.first_match(F.col("url"), r"^https?://[^/]+/([^/?#]+)").alias("lang"), T.first_match(F.col("url"), r"/(\d+)$").try_cast("int").alias("number"))


@query("SELECT event_id, try_cast(nullif(regexp_extract(props, '(\\d+)', 1), '') AS INT) AS k, try_cast(event_type AS DOUBLE) AS none FROM events")
def try_numeric(t):
    return t.events.select("event_id", T.first_match(F.col("props"), r"(\d+)").try_cast("int").alias("k"), T.try_double(F.col("event_type")).alias("none"))


@query("SELECT c_custkey, array_to_string([trim(x) FOR x IN string_split(c_name || ', ,' || c_mktsegment, ',') IF trim(x) <> ''], '|') AS parts FROM customer")
def comma_list(t):
    return t.customer.select("c_custkey", F.array_join(T.comma_list(F.concat("c_name", F.lit(", ,"), "c_mktsegment")), "|").alias("parts"))


@query("SELECT p_partkey, p_size AS cm, p_size * 2 AS kg, p_size AS years FROM part")
def parse_measures(t):
    p = F.col("p_size")
    return t.part.select("p_partkey", T.height_cm(F.concat(F.lit("6' ("), p, F.lit(" cm)"))).alias("cm"), T.weight_kg(F.concat(F.lit("200 lbs ("), p * 2, F.lit(" kg)"))).alias("kg"), T.int_prefix(F.concat(p, F.lit(" years"))).alias("years"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS from_date, CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%d.%m.%Y') END AS to_date FROM orders")
def parse_ranges(t):
    d = T.date_text(F.col("o_orderdate"))
    r = T.date_range(F.concat(d, F.lit(" - "), F.when(F.col("o_orderstatus") == "O", F.lit("today")).otherwise(d)))
    return t.orders.select("o_orderkey", r["from_date"].alias("from_date"), r["to_date"].alias("to_date"))


@query("SELECT conv_id, turn, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') AS cleaned FROM conversations")
def clean_text(t):
    return t.conversations.select("conv_id", "turn", T.clean_text(F.col("text")).alias("cleaned"))
