"""Ranked search against scores of all documents, and the threshold algorithm's early end."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from test_llm import AWKWARD, CLASHING, IDS

from pyspark.sql import functions as F
from skeinworks.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def ranked_by_brute_force(rows, queries, k=10):
    held = [(i, Counter(t)) for i, t in ((i, terms(t)) for i, t in rows) if t]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, text in queries:
        if i is not None:
            asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k]) if x[0] < 0]
    return sorted(out, key=str)


@pytest.mark.parametrize("postings, step, query_terms", [(2_000_000, 16, 200_000), (1, 1, 5), (60, 2, 40)])
def test_search(spark, monkeypatch, postings, step, query_terms):
    for name, value in (("POSTINGS", postings), ("STEP", step), ("QUERY_TERMS", query_terms)):
        monkeypatch.setattr(ranked_search, name, value)
    rng = np.random.default_rng(2)
    rows = [*zip(IDS, AWKWARD, strict=True), *((100 + i, " ".join(f"T{min(x, 40)}" for x in rng.geometric(0.08, 3 + i % 30))) for i in range(90)), *([(7, "same t1 t2")] * 4), *([(None, "t3 t3 nobody")] * 3)]
    asked = [(1, "t1 t2, T3 & t30"), (2, AWKWARD[5]), (2, "t5"), (3, None), (4, ""), (5, "nothing there"), (None, "t1"), (6, "é A b\x0bc"), *((10 + i, " ".join(f"t{x}" for x in rng.integers(1, 41, 6))) for i in range(8))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(7) for c in [*CLASHING, "rank", "terms", "item_id"] if c not in ("doc_id", "text")})
    queries = spark.createDataFrame([(i, t, 3) for i, t in asked], "item_id long, text string, doc_id int")
    got = ranked_search.search(df, queries)
    assert sorted(map(tuple, got.collect()), key=str) == ranked_by_brute_force(rows, asked)
    assert ranked_search.search(df.limit(0), queries).count() == 0 == ranked_search.search(df, queries.limit(0)).count()


def test_search_ends_early_and_misses_no_tie():
    """Documents hold one term each way; reading ends once nothing that is left can enter, and an equal score with a smaller id still does."""
    n = 4000
    impact = np.concatenate([np.full(11, 900), np.arange(n - 11, 0, -1) % 500 + 1])
    order = np.random.default_rng(1).permutation(n)
    block = ranked_search.Block(np.arange(n)[order], np.zeros(n, bool), np.arange(n + 1), np.zeros(n, np.int32), impact[order].astype(np.int64), 2)
    best = ranked_search.Best(10)
    read = ranked_search.search_block(block, np.array([0, 1]), best, 2, step=4)
    assert best.ids.tolist() == list(range(10)) and set(best.score.tolist()) == {900} and 11 < read < 40
    assert ranked_search.search_block(block, np.array([0]), best, 2, step=4) <= 40  # the bar of the block before ends it as soon
