"""Record linkage: candidate pairs by name keys, evidence, labels with scores, and mutually best pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.functions.text import fuzzy_key, norm_name, parse_dmy, parse_mdy


def names(df: DataFrame, key: str, name: str, primary: bool) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(name).alias("name"), F.lit(primary).alias("is_primary"))


def name_keys(rows: DataFrame) -> DataFrame:
    """(id, nkey, is_primary), distinct."""
    return rows.where("name is not null").select("id", norm_name(F.col("name")).alias("nkey"), "is_primary").distinct()


def name_pairs(left: DataFrame, right: DataFrame, least: int = 2) -> DataFrame:
    """Pairs that share a name key of ``least`` characters or more; primary if both sides' names are so once."""
    a = left.where(F.length("nkey") >= least).select("nkey", F.col("id").alias("a_id"), F.col("is_primary").alias("_a"))
    b = right.where(F.length("nkey") >= least).select("nkey", F.col("id").alias("b_id"), F.col("is_primary").alias("_b"))
    return a.join(b, "nkey").groupBy("a_id", "b_id").agg(F.bool_or(F.col("_a") & F.col("_b")).alias("primary_match"))


def birthday_evidence(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Adds whether both birthdays are known and equal, or known and different. Inputs: (a_id, a_day), (b_id, b_day)."""
    both = pairs.join(left, "a_id", "left").join(right, "b_id", "left")
    known = F.col("a_day").isNotNull() & F.col("b_day").isNotNull()
    return both.withColumn("same_day", known & F.coalesce(F.col("a_day") == F.col("b_day"), F.lit(False))).withColumn("other_day", known & F.coalesce(F.col("a_day") != F.col("b_day"), F.lit(False)))


#: Evidence labels with their scores, the first that holds.
PERSON_LABELS = [
    ("name_and_birthday", 1.0, "same_day and primary_match"),
    ("alias_and_birthday", 0.9, "same_day"),
    ("name_birthday_mismatch", 0.7, "primary_match and other_day"),
    ("name", 0.8, "primary_match"),
    ("alias", 0.6, "true"),
]
TITLE_LABELS = [("name", 0.9, "exact"), ("name_fuzzy", 0.7, "true")]


def labelled(pairs: DataFrame, labels: list[tuple[str, float, str]]) -> DataFrame:
    method: Column = F.lit(None).cast("string")
    score: Column = F.lit(None).cast("double")
    for label, value, condition in reversed(labels):
        method = F.when(F.expr(condition), F.lit(label)).otherwise(method)
        score = F.when(F.expr(condition), F.lit(value)).otherwise(score)
    return pairs.withColumns({"match_method": method, "confidence": score.cast("double")})


def mutual_best(pairs: DataFrame, left: str = "a_id", right: str = "b_id", score: str = "confidence") -> DataFrame:
    """Pairs that are each other's first by score, ties by the other's id; a loser of its best partner stays alone.

    Each side's first pair is an aggregate with map-side combining, so that only one pair a key travels on, never all pairs of a block.
    """
    pair = F.struct(*pairs.columns)
    firsts = []
    for mine, other in ((left, right), (right, left)):
        # Null scores come last, as in a descending order.
        best = pairs.groupBy(mine).agg(F.min_by(pair, F.struct(F.col(score).isNull(), -F.col(score), F.col(other))).alias("_best"))
        firsts.append(best.select("_best.*"))
    return firsts[0].join(firsts[1].select(left, right), [left, right], "left_semi").select(*pairs.columns)


def best_partners(mine: DataFrame, others: DataFrame) -> DataFrame:
    """(id, other, confidence): each id's first partner by score, ties by the other's id. Both sides: (id, nkey, is_primary, day).

    No pair is made: of a block, a row can only choose the least id of a kind of evidence (same day or not known, both primary or not), so each row
    meets one row a block. These rows are aggregates with map-side combining, one a key, and one a key and day. A pair's score is reached in the block that
    gives its best evidence; in other blocks it is no better. Where the least primary id of a known day has the row's own day, that row has a better choice.
    """
    known = F.col("day").isNotNull()
    days = others.groupBy("nkey", "day").agg(F.min("id").alias("same_any"), F.min(F.when(F.col("is_primary"), F.col("id"))).alias("same_prime"))
    block = days.groupBy("nkey").agg(
        F.min("same_any").alias("any"),
        F.min("same_prime").alias("prime"),
        F.min(F.when(~known, F.col("same_any"))).alias("unknown_any"),
        F.min(F.when(~known, F.col("same_prime"))).alias("unknown_prime"),
        F.min(F.when(known & F.col("same_prime").isNotNull(), F.struct("same_prime", "day"))).alias("first"),
    )
    rows = mine.join(block, "nkey").join(days.where(known), ["nkey", "day"], "left")
    prime = F.col("is_primary")
    score = {label: value for label, value, _ in PERSON_LABELS}
    choices = [
        ("name_and_birthday", prime, F.col("same_prime")),
        ("alias_and_birthday", F.lit(True), F.col("same_any")),
        ("name", prime, F.when(known, F.col("unknown_prime")).otherwise(F.col("prime"))),
        ("name_birthday_mismatch", prime & (F.col("first.day") != F.col("day")), F.col("first.same_prime")),
        ("alias", F.lit(True), F.when(known, F.col("unknown_any")).otherwise(F.col("any"))),
    ]
    held = F.array(*(F.struct(F.lit(-score[label]).alias("score"), F.when(holds, other).alias("other")) for label, holds, other in choices))
    best = rows.select("id", F.array_min(F.filter(held, lambda x: x["other"].isNotNull())).alias("best")).where("best is not null")
    return best.groupBy("id").agg(F.min("best").alias("best")).select("id", "best.other", (-F.col("best.score")).alias("confidence"))


def _dated(names_: DataFrame, days: DataFrame, least: int) -> DataFrame:
    return name_keys(names_).where((F.length("nkey") >= least) & F.col("id").isNotNull()).join(days, "id", "left")


def person_crosswalk(a_names: DataFrame, b_names: DataFrame, a_days: DataFrame, b_days: DataFrame, least: int = 2) -> DataFrame:
    """(a_id, b_id, match_method, confidence). Names: (id, name, is_primary). Days: (id, day text); A's with points, B's in words.

    Pairs that are each other's first, as ``mutual_best`` of all labelled pairs would give them, in time that grows with the names however many share one.
    """
    a = _dated(a_names, a_days.select("id", parse_dmy(F.col("day")).alias("day")), least)
    b = _dated(b_names, b_days.select("id", parse_mdy(F.col("day")).alias("day")), least)
    left = best_partners(a, b).select(F.col("id").alias("a_id"), F.col("other").alias("b_id"), "confidence")
    right = best_partners(b, a).select(F.col("other").alias("a_id"), F.col("id").alias("b_id"))
    method = F.lit(None).cast("string")
    for label, value, _ in PERSON_LABELS:
        method = F.when(F.col("confidence") == value, F.lit(label)).otherwise(method)
    return left.join(right, ["a_id", "b_id"]).select("a_id", "b_id", method.alias("match_method"), "confidence")


def title_keys(df: DataFrame) -> DataFrame:
    """Adds nkey and fkey to rows; rows without a name have null keys."""
    keyed = df.withColumn("nkey", norm_name(F.col("name")))
    return keyed.withColumn("fkey", fuzzy_key(F.col("nkey")))


def or_join(left: DataFrame, right: DataFrame, block: str, exact: str, loose: str, left_id: str = "a_id", right_id: str = "b_id", least: int = 2) -> DataFrame:
    """Pairs of a block whose exact keys agree, or whose loose keys do if they have ``least`` characters; exact tells which.

    Two equi-joins and a union: no block is compared all against all, as a disjunction inside one join would.
    """
    r = right.select(block, exact, loose, F.col(right_id))
    by_exact = left.select(block, exact, F.col(left_id)).join(r.select(block, exact, right_id), [block, exact]).select(left_id, right_id, F.lit(True).alias("exact"))
    by_loose = left.where(F.length(loose) >= least).select(block, loose, F.col(left_id)).join(r.select(block, loose, right_id), [block, loose]).select(left_id, right_id, F.lit(False).alias("exact"))
    return by_exact.unionByName(by_loose).groupBy(left_id, right_id).agg(F.bool_or("exact").alias("exact"))


def title_crosswalk(a_titles: DataFrame, b_titles: DataFrame, promotions: DataFrame) -> DataFrame:
    """(a_id, b_id, match_method, confidence). A: (id, name, promotion); B: (id ``slug/name``, name); promotions: (promotion, slug)."""
    a = title_keys(a_titles.join(promotions, "promotion")).withColumnRenamed("id", "a_id")
    b = title_keys(b_titles.withColumn("slug", F.split_part("id", F.lit("/"), F.lit(1)))).withColumnRenamed("id", "b_id")
    return mutual_best(labelled(or_join(a, b, "slug", "nkey", "fkey"), TITLE_LABELS)).select("a_id", "b_id", "match_method", "confidence")


def matched_view(crosswalk: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Linked rows side by side, columns marked by their source."""
    left = a.select(*(F.col(c).alias("a_id" if c == "id" else f"a_{c}") for c in a.columns))
    right = b.select(*(F.col(c).alias("b_id" if c == "id" else f"b_{c}") for c in b.columns))
    return crosswalk.join(left, "a_id").join(right, "b_id")


def lookup(crosswalk: DataFrame, b: DataFrame, a_id: str) -> DataFrame:
    """B's row for one of A's ids."""
    return crosswalk.where(F.col("a_id") == a_id).join(b.withColumnRenamed("id", "b_id"), "b_id")


def reigns_for(person_walk: DataFrame, title_walk: DataFrame, champions: DataFrame, reigns: DataFrame, a_person: str, a_title: str) -> DataFrame:
    """B's reigns of A's person with A's title, in order."""
    p = person_walk.where(F.col("a_id") == a_person).select(F.col("b_id").alias("wrestler_id"))
    t = title_walk.where(F.col("a_id") == a_title).select(F.col("b_id").alias("title_id"))
    held = champions.join(p, "wrestler_id", "left_semi").select(F.col("title_reign_id").alias("id"))
    return reigns.join(held, "id", "left_semi").join(t, "title_id", "left_semi").orderBy("seq")
