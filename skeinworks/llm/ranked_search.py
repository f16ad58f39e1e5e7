"""Ranked lexical search by Fagin's threshold algorithm over a document-partitioned index.

One scan writes a forward index: each document's length, and how often each term of the queries occurs in it. From it follow the
statistics of all documents. Then each task takes its part of the index in blocks of bounded size, sorts each term's postings by impact (weight
times saturated frequency, integers throughout), and answers every query on the block: the lists are read in turn, some places at a
time; each document met is scored whole from the forward index; and once the sum of the impacts last read falls strictly below the k-th best
score, no document that is left can enter (nor tie). The best of a block stay the bar for the task's next one. A list is never
longer than a block, so a term that stands in a third of all documents is spread over all tasks like any other.

Queries are searched in blocks of at most some ``QUERY_TERMS`` terms, which bounds what is broadcast; texts are read once for each. The tasks' best are
merged in two steps, so that no task gathers all tasks' rows of a query.

Defined cases: null texts and texts without terms are no documents and match nothing; rows that share an id are documents of their own (equal
scores go by id, null ids last, so only rows of one id can change places); queries that share an id are one with all their terms; queries without an
id are left out; those without terms, or that match nothing, give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch, lean

K = 10
#: Terms of the queries in one block (expected), postings of a block of documents, places of each list read at first and at most.
QUERY_TERMS, POSTINGS, STEP, STEP_MOST = 200_000, 2_000_000, 16, 1024
#: Groups of tasks whose best are merged first.
GROUPS = 256
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: str | None) -> list[bytes]:
    """Terms as UTF-8: only A-Z are lower-cased; letters, digits and everything beyond ASCII belong to terms."""
    return text.encode().translate(_FOLD).split() if text else []


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, term), distinct."""
    found = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    rows = queries.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.explode(found).alias("term"))
    return rows.distinct()


def _indexed(shared):
    """Each document's length and the queries' terms in it: number of the term, occurrences."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            n, ends, terms, often, kept = [], [0], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                kept.append(i)
                n.append(len(words))
                for term, k in Counter(words).items():
                    if (at := number.get(term)) is not None:
                        terms.append(at)
                        often.append(k)
                ends.append(len(terms))
            lists = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, often))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "often"])

    return rows


def forward_index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, often) of each document with a term, written to the shared folder."""
    shared = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(terms)})
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_indexed(shared)), "doc_id long, n long, terms array<int>, often array<int>")
    return Scratch(docs.sparkSession, "search").write(found, "index")


class Block:
    """Some documents' postings: by term in order of impact, and by document."""

    def __init__(self, ids: np.ndarray, nameless: np.ndarray, ends: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids, self.nameless, self.ends, self.terms, self.impact = ids, nameless, ends, terms, impact
        docs = np.repeat(np.arange(len(ids)), np.diff(ends))
        order = np.lexsort((docs, -impact, terms))
        self.docs, self.impacts = docs[order], impact[order]
        self.lists = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def whole(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores of some documents from the forward index; ``wanted`` marks the query's terms."""
        sizes = self.ends[docs + 1] - self.ends[docs]
        of = np.repeat(np.arange(len(docs)), sizes)
        at = np.arange(len(of)) + np.repeat(self.ends[docs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        kept = wanted[self.terms[at]]
        return np.bincount(of[kept], weights=self.impact[at[kept]], minlength=len(docs)).astype(np.int64)  # exact: far below 2 ** 53


class Best:
    """A query's best documents so far, best first; ties by id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids, self.nameless = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        held = (score > 0) & (score >= self.bar())
        score, ids, nameless = (np.concatenate([a, b[held]]) for a, b in ((self.score, score), (self.ids, ids), (self.nameless, nameless)))
        order = np.lexsort((ids, nameless, -score))[: self.k]
        self.score, self.ids, self.nameless = score[order], ids[order], nameless[order]

    def bar(self) -> int:
        """The k-th score, or 0 while there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0


def search_block(block: Block, terms: np.ndarray, best: Best, n_terms: int, step: int | None = None) -> int:
    """The threshold algorithm for one query's terms; returns how many places were read."""
    starts, ends = block.lists[terms], block.lists[terms + 1]
    starts, ends = starts[ends > starts], ends[ends > starts]
    wanted, seen = np.zeros(n_terms, dtype=bool), np.zeros(len(block.ids), dtype=bool)
    wanted[terms] = True
    step, read = step or STEP, 0
    while len(starts):
        stops = np.minimum(starts + step, ends)
        met = np.unique(np.concatenate([block.docs[a:b] for a, b in zip(starts, stops, strict=True)]))
        met = met[~seen[met]]
        seen[met] = True
        best.add(block.whole(met, wanted), block.ids[met], block.nameless[met])
        read += int((stops - starts).sum())
        threshold = int(block.impacts[stops - 1][stops < ends].sum())  # a list at its end holds no document that is left
        if threshold < best.bar() or not threshold:
            break
        starts, ends = stops[stops < ends], ends[stops < ends]
        step = min(2 * step, STEP_MOST)
    return read


def _searched(shared, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight, count, total = shared.value
        best = {q: Best(k) for q in queries}
        held: list[tuple] = []

        def answer() -> None:
            if not held:
                return
            ids, nameless, m, sizes, terms, impact = (np.concatenate(x) for x in zip(*held, strict=True))
            block = Block(ids, nameless, np.concatenate([[0], np.cumsum(sizes)]), terms, impact, len(weight))
            for q, at in queries.items():
                search_block(block, at, best[q], len(weight))
            held.clear()

        size = 0
        for batch in batches:
            ids, lists, often = batch.column(0), batch.column(2), batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            terms = lists.flatten().to_numpy(zero_copy_only=False)
            # Python's integers: lengths times documents may pass 64 bits.
            m = np.array([10 + 90 * n * count // total for n in batch.column(1).to_pylist()], dtype=np.int64)
            impact = weight[terms] * (1_000_000_000 * often // (1000 * often + 8 * np.repeat(m, sizes)))
            nameless = ids.is_null().to_numpy(zero_copy_only=False)
            held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), nameless, m, sizes, terms, impact))
            size += len(terms)
            if size >= POSTINGS:
                answer()
                size = 0
        answer()
        found = [(q, s, None if none else i) for q, b in best.items() for s, i, none in zip(b.score.tolist(), b.ids.tolist(), b.nameless.tolist(), strict=True)]
        cols = list(zip(*found, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["item_id", "score", "doc_id"])

    return rows


def _search(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The tasks' best of one block of queries (item_id, term): item_id, score, doc_id."""
    spark = docs.sparkSession
    rows = asked.collect()  # some QUERY_TERMS
    terms = sorted({r.term for r in rows})
    number = {t: i for i, t in enumerate(terms)}
    index = forward_index(docs, terms)
    told = index.agg(F.count("*").alias("count"), F.sum("n").alias("total")).first()
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    share = F.lit(float(2 * told["count"] + 2)) / (2 * F.col("df") + 1)
    weight = np.zeros(len(terms), dtype=np.int64)
    for r in held.select("term", F.floor(1000 * F.log(share)).alias("w")).collect():  # a row a term of the block
        weight[r.term] = r.w
    queries: dict[int, list[int]] = {}
    for r in rows:
        queries.setdefault(r.item_id, []).append(number[r.term])
    shared = spark.sparkContext.broadcast(({q: np.array(sorted(x)) for q, x in queries.items()}, weight, told["count"], told["total"]))
    return index.mapInArrow(lean(_searched(shared, k)), "item_id long, score long, doc_id long")


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score of each query's ``k`` best documents with a score above 0. Queries: (item_id, text)."""
    spark = docs.sparkSession
    asked = Scratch(spark, "search").write(query_terms(queries), "queries")
    blocks = max(1, -(-asked.count() // QUERY_TERMS))
    out = None
    for b in range(blocks):
        one = _search(docs, asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), k)
        out = one if out is None else out.unionByName(one)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    first = out.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "_group").orderBy(*order))).where(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return last.select("item_id", "rank", "doc_id", "score")
