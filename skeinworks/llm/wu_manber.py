"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The benchmark's windows (13 consecutive words; an item with fewer words is one window) are grouped by length. For each
length a shift table over blocks of two words says how far a scan may jump without missing a window; where the shift
is nought, the bucket of the windows that end in that block (and of these, those that begin with the right one) is compared word by word. Documents
stream through; nothing about them is gathered. Windows are broadcast in shards of a bounded number of words, and a
benchmark of several shards is scanned shard by shard, so no broadcast grows with the benchmark.

Defined cases: null or wordless texts have no words and no hits; a null or wordless item has no windows; items that
repeat an id or a text count once for each distinct id; a null item id is ignored; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from operator import eq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch, extended, lean

WINDOW = 13
#: Words of benchmark items in one broadcast shard.
SHARD_WORDS = 400_000
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: A-Z in lower case; only letters a-z, digits and everything beyond ASCII belong to words."""
    return text.encode().translate(_FOLD).split() if text else []


class WuManber:
    """Windows of one length m, searched by blocks of b words."""

    def __init__(self, m: int, windows: dict[tuple[bytes, ...], tuple[int, ...]]):
        self.m, self.b, self.windows = m, min(2, m), windows
        self.most = m - self.b + 1
        self.shift: dict = {}
        #: Windows by their last block, then by their first.
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        for w in windows:
            for end in range(self.b, m + 1):
                block = self._block(w, end)
                self.shift[block] = min(self.shift.get(block, self.most), m - end)
            self.buckets[self._block(w, m)][self._block(w, self.b)].append(w)

    def _block(self, words, end: int):
        return words[end - 1] if self.b == 1 else (words[end - 2], words[end - 1])

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """Start of each occurrence, and the items it belongs to."""
        m, most, shift, n = self.m, self.most, self.shift, len(words)
        end = m
        while end <= n:
            block = words[end - 1] if self.b == 1 else (words[end - 2], words[end - 1])
            jump = shift.get(block, most)
            if jump:
                end += jump
                continue
            for w in self.buckets[block].get(self._block(words, end - m + self.b), ()):
                if all(map(eq, w, words[end - m : end])):
                    yield end - m, self.windows[w]
                    break
            end += 1


def compile_items(items: list[tuple[int, str | None]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
    for item_id, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            by_length[m][tuple(words[i : i + m])].add(item_id)
    return [WuManber(m, {w: tuple(sorted(x)) for w, x in ws.items()}) for m, ws in sorted(by_length.items())]


def _scan(shared, window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = compile_items(shared.value, window)
        for batch in batches:
            n_words, spans, items = [], [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                words, found = words_of(text), set()
                hits: list[tuple[int, int]] = []
                for s in searches:
                    for at, ids in s.search(words):
                        found.update(ids)
                        hits.append((at, at + s.m))
                hits.sort()
                merged: list[list[int]] = []
                for a, b in hits:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                n_words.append(len(words))
                spans.append([{"a": a, "b": b} for a, b in merged])
                items.append(sorted(found))
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(items, pa.list_(pa.int64()))], names=[*batch.schema.names, "n_words", "spans", "items"])

    return rows


_FOUND = "n_words long, spans array<struct<a:long,b:long>>, items array<long>"


def find_items(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """``keep`` and text of each row with n_words, spans (merged, in words) and items (sorted ids).

    With several shards the rows are numbered and the shards' findings merged by row.
    """
    spark = docs.sparkSession
    size = F.expr("length(text) div 2 + 1")  # at least the item's words
    cols = keep if "text" in keep else [*keep, "text"]
    lines = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    total = lines.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    if shards == 1:
        shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in lines.collect()])
        rows = docs.select(*cols)
        return rows.mapInArrow(lean(_scan(shared, window)), extended(rows, _FOUND))
    scratch = Scratch(spark, "benchmark")
    numbered = scratch.write(docs.select(*cols).withColumn("_number", F.monotonically_increasing_id()), "docs")
    found = None
    for k in range(shards):
        part = lines.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k)
        shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in part.toLocalIterator()])
        one = numbered.select("_number", "text").mapInArrow(_scan(shared, window), f"_number long, text string, {_FOUND}").drop("text")
        one = scratch.write(one.where("size(spans) > 0"), f"found{k}")
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("_number").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    shared = spark.sparkContext.broadcast([])
    counts = numbered.mapInArrow(_scan(shared, window), extended(numbered, _FOUND)).drop("spans", "items")
    return counts.join(merged, "_number", "left").withColumns({"spans": F.coalesce("spans", F.array().cast("array<struct<a:long,b:long>>")), "items": F.coalesce("items", F.array().cast("array<long>"))}).drop("_number")


def _tallied(spans: Column) -> Column:
    """Words in any of the spans (which may overlap)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def more(sum_: Column, x: Column) -> Column:
        return F.struct((sum_["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], sum_["end"]))).alias("n"), F.greatest(sum_["end"], x["b"]).alias("end"))

    return F.aggregate(F.array_sort(spans), start, more)["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """``keep`` (doc_id) of each row with n_words, n_hit, n_items, items_sha256 and contaminated (a twentieth of its words is hit)."""
    keep = keep or ["doc_id"]
    found = find_items(docs, benchmark, keep, window)
    found = found if "text" in keep else found.drop("text")
    told = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    out = found.withColumns({"n_hit": _tallied(F.col("spans")), "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(told.cast("binary"), 256)}).drop("spans", "items")
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
