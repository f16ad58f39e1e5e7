"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's symbols are its words in pieces of three characters (the last may be shorter); characters of scripts that
set no space between words are symbols by themselves. Of its k-mers (``K`` symbols) those are chosen whose least inner s-mer (``S``
symbols) by hash lies at the first or last place: a closed syncmer. The choice needs no context, so equal passages choose equal k-mers
wherever they stand. ``anchors`` gives the chosen k-mers with their places. They are matched by position: a text's *elements* are its
anchors, each together with the distance to the next one, which is the same wherever the passage stands. Likeness is the Jaccard
index of all elements of both texts; the printed fingerprint holds the ``PRINTED`` least of them.

Defined cases: a null text is empty; a text without symbols has the empty fingerprint; texts with fewer than K symbols, or
none of whose k-mers is chosen, have the hash of all their symbols; two empty fingerprints are alike (1), an empty and
another aren't (0); rows that repeat an id follow each other by their texts' hashes, from the greatest on; a null id comes after all others; the next
document of a single row is itself; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S, PRINTED = 6, 2, 32
#: Ranges of ids into which documents are dealt to find each one's next: bytes of text in each, and for each shuffle partition at least.
RANGE_BYTES, RANGES_A_PARTITION = 64 << 20, 2
#: Up to so many ranges are cut in one step.
ONE_STEP = 256
#: Blocks of scripts without spaces between words (Thai to Tibetan, Myanmar, Khmer, kana, ideographs). Ranges are tested many times
#: faster than script names.
_UNSPACED = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{323AF}"
_SYMBOL = rf"[^\s{_UNSPACED}]{{1,3}}|[{_UNSPACED}]"
_PLACE = 1 << 31


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once: lambdas would compute an inlined expression anew for each element."""
    return F.transform(F.array(value), f)[0]


def symbols(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_SYMBOL), F.lit(0))


def _inner(symbols_: Column) -> Column:
    """Hashes of the s-mers of two symbols."""
    hashes = F.transform(symbols_, lambda w: F.xxhash64(w))
    return _let(hashes, lambda h: F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b)))


def _short(hash_: Column) -> Column:
    return F.shiftrightunsigned(hash_, 32)


def _chosen(g: Column) -> Column:
    """Each closed syncmer as hash and place in one number. The s-mers at 0, 2 and 4 hold all six symbols."""
    span = K - S
    starts = F.slice(g, 1, F.greatest(F.size(g) - span, F.lit(0)))

    def one(x: Column, i: Column) -> Column:
        last = F.get(g, i + span)
        middle = F.least(*(F.get(g, i + j) for j in range(1, span)))
        return F.when((x <= F.least(middle, last)) | (last <= F.least(middle, x)), _short(F.xxhash64(x, F.get(g, i + 2), last)) * F.lit(_PLACE) + i)

    return F.filter(F.transform(starts, one), lambda x: x.isNotNull())


def anchors(text: Column) -> Column:
    """array<struct<place, hash>>: the closed syncmers and the symbols at which they start (from 0)."""
    found = _let(_inner(symbols(F.coalesce(text, F.lit("")))), _chosen)
    return F.transform(found, lambda x: F.struct((x % _PLACE).cast("int").alias("place"), F.shiftright(x, 31).alias("hash")))


def elements(text: Column) -> Column:
    """The text's anchors, each with the distance to the next (0 after the last), as distinct numbers of 32 bits."""

    def tied(a: Column) -> Column:
        def gap(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(a, i + 1) % _PLACE - x % _PLACE, F.lit(0))

        return F.array_distinct(F.transform(a, lambda x, i: _short(F.xxhash64(F.shiftright(x, 31), gap(x, i)))))

    def of(found: Column) -> Column:
        whole = F.array(_short(F.xxhash64(F.array_join(found, "\n"))))
        return _let(_let(_inner(found), _chosen), lambda c: F.when(F.size(found) == 0, F.array().cast("array<bigint>")).when(F.size(c) == 0, whole).otherwise(tied(c)))

    return _let(symbols(text), of)


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return _let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(n / (F.size(a) + F.size(b) - n)))


def told(found: Column) -> Column:
    return F.lower(F.array_join(F.transform(F.slice(F.sort_array(found), 1, PRINTED), lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def _below(cuts: Column, key: Column) -> Column:
    return F.size(F.filter(cuts, lambda c: c <= key))


def range_count(rows: DataFrame, text: str) -> int:
    """How many ranges the texts are dealt into: some ``RANGE_BYTES`` in each, and several for each shuffle partition."""
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(RANGES_A_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))


def in_ranges(rows: DataFrame, key: str, text: str, n: int | None = None) -> DataFrame:
    """Adds ``_range``, a number that rises with the key and, where one key fills several ranges, with the text's hash; there are some ``n`` of them.

    Many ranges are cut in two steps, the square root of their number in each, so that no list of cuts grows with the table.
    """
    k = F.col(key)
    n = n or range_count(rows, text)
    first = n if n <= ONE_STEP else math.isqrt(n) + 1
    each = -(-n // first)

    def times(cuts: Column) -> Column:
        """At how many cuts a key stands: so many ranges it fills, if there are several."""
        return F.size(F.filter(cuts, lambda c: c == k))

    found = rows.select(k.cast("double").alias(key)).approxQuantile(key, [i / first for i in range(1, first)], 0.2 / first)
    cuts = F.array(*(F.lit(int(x)) for x in found)).cast("array<bigint>")
    cut = rows.withColumn("_range", _below(cuts, k).cast("long"))
    parts = F.when(times(cuts) > 1, times(cuts) * each)
    if first < n:
        shares = F.array(*(F.lit(i / first) for i in range(1, first)))
        fine = cut.groupBy("_range").agg(F.percentile_approx(key, shares, 20 * first).alias("_cuts"))
        fine = F.broadcast(fine.select(F.col("_range").alias("_coarse"), "_cuts"))  # some isqrt(n) rows of as many numbers
        cut = cut.join(fine, F.col("_range") == F.col("_coarse")).withColumn("_range", F.col("_range") * first + _below(F.col("_cuts"), k))
        parts = parts.when(times(F.col("_cuts")) > 1, times(F.col("_cuts")))
    # Hashes as unsigned numbers from the least on, in even parts; the keys after a key that fills several ranges have a part behind them all.
    share = F.least((F.xxhash64(text).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64), F.lit(1 - 2.0**-40))
    behind = first * each
    part = F.coalesce(F.floor(share * parts).cast("long"), F.lit(behind).cast("long"))
    return cut.withColumn("_range", F.col("_range") * (behind + 1) + part).drop("_coarse", "_cuts")


def with_next(rows: DataFrame, key: str, text: str, more: dict[str, Column]) -> DataFrame:
    """Adds the columns ``more`` of each row, and of text and them ``next_<column>`` of the row with the next lower key (of the first row after the
    last; rows of one key follow each other by their texts' hashes), without a global sort: rows are dealt into ranges, and each range also gets a copy of the first row of
    the range below it. Texts travel once; ``more`` is computed where they arrive.
    """
    n = range_count(rows, text)
    dealt = in_ranges(rows, key, text, n).withColumn("_h", F.xxhash64(text))
    place = F.struct(key, "_h")
    tops = dealt.groupBy("_range").agg(F.max(place).alias("_top"))
    # A row a range: few, whatever the size of the table.
    order = Window.orderBy("_range")
    tops = tops.select("_range", "_top", F.coalesce(F.lead("_range").over(order), F.first("_range").over(order)).alias("_to"))
    heads = dealt.join(tops.withColumnRenamed("_range", "_from"), (F.col("_range") == F.col("_from")) & (place == F.col("_top")))
    heads = heads.groupBy("_from", "_to").agg(F.max(F.struct(key, "_h", text)).alias("h")).select(F.col("_to").alias("_range"), F.lit(1).alias("_copy"), f"h.{key}", "h._h", f"h.{text}")
    both = dealt.withColumn("_copy", F.lit(0)).unionByName(heads, allowMissingColumns=True)
    w = Window.partitionBy("_range").orderBy("_copy", F.desc(key), F.desc("_h"), F.desc(text))
    computed = both.repartition(n, "_range").withColumns(more)  # as many tasks as ranges: none grows with the table
    return computed.withColumns({f"next_{c}": F.lead(c).over(w) for c in (text, *more)}).where("_copy = 0").drop("_range", "_copy", "_h")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with the second half taken from the next document, and their likeness."""
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), F.coalesce("text", F.lit("")).alias("t"))
    out = with_next(rows, "k", "t", {"s": elements(F.col("t"))})
    half = F.floor(F.length("t") / 2).cast("int")
    out = out.withColumn("n_chars", F.length("t").cast("long"))
    out = out.withColumn("e", F.concat(F.expr("left(t, length(t) - cast(floor(length(t) / 2) as int))"), F.substring(F.col("next_t"), F.lit(1), half)))
    out = out.select("doc_id", "n_chars", F.sha2(F.col("e").cast("binary"), 256).alias("edited_sha256"), "s", "next_s", elements(F.col("e")).alias("es"))
    return out.select("doc_id", "n_chars", "edited_sha256", told(F.col("s")).alias("fingerprint"), told(F.col("es")).alias("edited_fingerprint"), likeness(F.col("s"), F.col("es")).cast("double").alias("near_edited"), likeness(F.col("s"), F.col("next_s")).cast("double").alias("near_next"))
