"""Scalar text functions as Column expressions; Python only where Spark has no built-in (HTML entities)."""

from __future__ import annotations

import functools
import html
import sys
import unicodedata
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Python's strip() sees it, which includes the no-break space.
SPACE = r"(?U)\s"


@functools.cache
def accent_folds() -> tuple[str, str]:
    """All characters with marks, and the same without, by the Unicode decompositions that Python knows: two strings of equal length."""
    folded = {}
    for c in map(chr, (i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)):
        if unicodedata.decomposition(c)[:1] not in ("", "<") and unicodedata.category(c)[0] != "M":
            folded[c] = unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x)[0] != "M"))
    kept = {c: plain for c, plain in folded.items() if len(plain) == 1 and plain != c}
    return "".join(kept), "".join(kept.values())


def strip_accents(c: Column) -> Column:
    """Letters without their marks, in the JVM: characters that hold marks by a table, then marks of their own. Nothing else changes, so loose parts of Hangul syllables aren't joined."""
    return F.regexp_replace(F.translate(c, *accent_folds()), r"\p{M}+", "")


@F.pandas_udf(StringType())
def unescape_html(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


def norm_name(c: Column) -> Column:
    """Lower case without accents; every run of other characters than a-z and 0-9 becomes one space."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(c)), "[^a-z0-9]+", " "))


def register_sql(spark: SparkSession) -> list[str]:
    """Functions of the same names for SQL text, as expressions that Spark plans like its own; returns their names."""
    marked, plain = accent_folds()
    bare = f"regexp_replace(translate(value, '{marked}', '{plain}'), '[\\\\p{{M}}]+', '')"
    made = {"strip_accents": bare, "norm_name": f"trim(regexp_replace({bare.replace('value', 'lower(value)')}, '[^a-z0-9]+', ' '))", "fuzzy_key": rf"trim(regexp_replace(value, '\\b({'|'.join(TITLE_NOISE)})\\b', ''))"}
    for name, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {body}")
    return [*made]


#: Words that carry no identity in a title's name.
TITLE_NOISE = ["wwe", "wwf", "aew", "championship", "title", "world", "undisputed"]


def fuzzy_key(c: Column, noise: list[str] = TITLE_NOISE) -> Column:
    """The normalised name without noise words; spaces inside are kept as they are."""
    return F.trim(F.regexp_replace(c, rf"\b({'|'.join(noise)})\b", ""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null (not empty) without one."""
    return empty_to_null(F.regexp_extract(c, pattern, group))


def trim_wide(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_text(c: Column) -> Column:
    """White space collapsed and trimmed; nothing left is null."""
    return empty_to_null(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def try_int(c: Column) -> Column:
    return trim_wide(c).try_cast("int")


def try_double(c: Column) -> Column:
    return trim_wide(c).try_cast("double")


def int_prefix(c: Column) -> Column:
    return first_match(c, r"^\s*(\d+)").try_cast("int")


def height_cm(c: Column) -> Column:
    return first_match(c, r"(?i)\((\d+)\s*cm\)").try_cast("int")


def weight_kg(c: Column) -> Column:
    return first_match(c, r"(?i)\((\d+)\s*kg\)").try_cast("int")


def split_list(c: Column, separator: str) -> Column:
    """Trimmed parts, empty ones dropped."""
    return F.filter(F.transform(F.split(c, separator), trim_wide), lambda x: x != "")


def comma_list(c: Column) -> Column:
    return split_list(c, ",")


def nicknames_list(c: Column) -> Column:
    return split_list(c, ";")


#: Words for a period that has not ended.
OPEN_ENDS = ["present", "current", "today", "ongoing"]


def normalize_date(c: Column) -> Column:
    c = clean_text(c)
    return F.when(F.lower(c).isin(OPEN_ENDS), F.lit(None)).otherwise(c)


def active_years(c: Column) -> Column:
    """struct<start, end> of ``a-b``, ``a-`` (still open) or ``a`` (one year); what isn't all digits is null."""
    t = trim_wide(c)
    first, second = F.regexp_extract(t, r"^([^-]*)", 1), first_match(t, r"^[^-]*-([\s\S]*)$")

    def year(x: Column) -> Column:
        return F.when(trim_wide(x).rlike(r"^\d+$"), try_int(x))

    return F.struct(year(first).alias("start"), F.when(t.contains("-"), year(second)).otherwise(year(first)).alias("end"))


def date_range(c: Column) -> Column:
    """struct<from_date, to_date> of ``a - b``; one date stands for both ends; ``today`` ends nothing."""
    parts = F.split(trim_wide(c), r"\s+-\s+", 2)
    first = trim_wide(F.get(parts, 0))
    last = F.coalesce(trim_wide(F.get(parts, 1)), first)
    return F.struct(empty_to_null(first).alias("from_date"), F.when(F.lower(last) != "today", empty_to_null(last)).alias("to_date"))


def role_entries(c: Column) -> Column:
    """array<struct<role, date_ranges>> of ``role (range, range)`` lines; the first parenthesis begins the ranges, if the line ends with one."""
    lines = F.filter(F.transform(F.split(c, r"\n"), trim_wide), lambda x: x != "")

    def entry(x: Column) -> Column:
        inner = F.regexp_extract(x, r"^[^(]*\((.+)\)$", 1)
        ranges = F.when(inner != "", F.transform(F.split(inner, ","), date_range)).otherwise(F.array().cast("array<struct<from_date:string,to_date:string>>"))
        return F.struct(trim_wide(F.when(inner != "", F.regexp_extract(x, r"^([^(]*)", 1)).otherwise(x)).alias("role"), ranges.alias("date_ranges"))

    return F.transform(lines, entry)


def born(c: Column) -> Column:
    """struct<date, age> of ``date (age N)`` and nothing after it; other text is the date."""
    t = clean_text(c)
    pattern = r"(?i)^(.+?)\s*\(age\s+(\d+)\)$"
    age = first_match(t, pattern, 2).try_cast("int")
    return F.struct(F.when(age.isNotNull(), clean_text(first_match(t, pattern))).otherwise(t).alias("date"), age.alias("age"))


def duration_days(c: Column) -> Column:
    return first_match(trim_wide(c), r"^(\d+)\+?$").try_cast("int")


def name_history_line(c: Column) -> Column:
    """struct<name, from_date, to_date> of ``name (from - to)``; null for other lines."""
    t = trim_wide(c)
    pattern = r"^(.*?)\s*\((.*?)\s*-\s*(.*?)\)$"
    end = trim_wide(F.regexp_extract(t, pattern, 3))
    return F.when(t.rlike(pattern), F.struct(F.regexp_extract(t, pattern, 1).alias("name"), empty_to_null(F.regexp_extract(t, pattern, 2)).alias("from_date"), F.when(F.lower(end) != "today", empty_to_null(end)).alias("to_date")))


# Dates -------------------------------------------------------------------------------------------------------------


def _date(c: Column, form: str) -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit(form)))


def parse_dmy(c: Column) -> Column:
    """Day, month and year with points; single digits are accepted."""
    return _date(F.trim(c), "d.M.yyyy")


def parse_mdy(c: Column) -> Column:
    """``Month d, yyyy`` with any spacing inside."""
    return _date(F.trim(F.regexp_replace(c, r"\s+", " ")), "MMMM d, yyyy")


def parse_event_date(c: Column) -> Column:
    """Strict ``dd.MM.yyyy``, else null."""
    return F.when(F.trim(c).rlike(r"^\d{2}\.\d{2}\.\d{4}$"), _date(F.trim(c), "dd.MM.yyyy"))


def date_text(c: Column) -> Column:
    return F.date_format(c, "dd.MM.yyyy")


# HTML in a column ----------------------------------------------------------------------------------------------------


def strip_tags(c: Column) -> Column:
    return trim_wide(unescape_html(F.regexp_replace(c, "<[^>]+>", "")))


def br_list(c: Column) -> Column:
    """Lines of a block by its line breaks, without tags or empty lines."""
    inner = F.regexp_replace(c, r"(?is)^\s*<div[^>]*>|</div>\s*$", "")
    joined = unescape_html(F.regexp_replace(F.regexp_replace(inner, r"(?i)<br\s*/?>", "\u0001"), "<[^>]+>", ""))
    return F.filter(F.transform(F.split(joined, "\u0001"), trim_wide), lambda x: x != "")


#: Fixed value: a link to an entity by its section and number.
LINK = r'<a\b[^>]*?href="\?id=(\d+)&amp;nr=(\d+)[^"]*"[^>]*>(.*?)</a>'


def match_type(c: Column) -> Column:
    """struct<title_id, title_name, match_type>: the first title link, and the text without its name's first occurrence."""
    name = first_match(c, LINK, 3)
    text = clean_text(F.regexp_replace(c, "<[^>]+>", ""))
    place = F.when(name.isNotNull(), F.instr(text, name)).otherwise(0)
    rest = F.when(place > 0, F.concat(F.substring(text, F.lit(1), place - 1), F.substring(text, place + F.length(name), F.length(text)))).otherwise(text)
    return F.struct(first_match(c, LINK, 2).alias("title_id"), name.alias("title_name"), clean_text(rest).alias("match_type"))


def match_rating(c: Column) -> Column:
    """struct<rating, votes> of ``Matchguide Rating: 6.45 based on 21 votes``; other ratings don't count."""
    pattern = r"Matchguide Rating:\s*([\d.]+)\s*based on\s*(\d+)\s*votes"
    return F.struct(first_match(c, pattern, 1).try_cast("double").alias("rating"), first_match(c, pattern, 2).try_cast("int").alias("votes"))


def absolute_url(c: Column, base: str) -> Column:
    """The address that a link means on a page of ``base``; null and blank links stay null."""

    @F.pandas_udf(StringType())
    def joined(values: pd.Series) -> pd.Series:
        return values.map(lambda x: urljoin(base, x), na_action="ignore")

    return joined(clean_text(c))


def slug_after(c: Column, section: str) -> Column:
    """The path part after ``/<section>/``."""
    return first_match(c, rf"/{section}/([^/?#]+)")


def title_path(c: Column, section: str) -> Column:
    """The two path parts after ``/<section>/`` as ``promotion/slug``; the address must end there."""
    return first_match(c, rf"/{section}/([^/]+/[^/#?]+)/?$")


def next_page_offset(rows: Column, offset: Column, page: int = 100) -> Column:
    """The next list page's offset if this one is full."""
    return F.when(rows >= page, offset + page)
