"""Personal data: the rules against their patterns as they stand, reliabilities against simulated votes, and added spans against planted ones."""

import hashlib
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from test_llm import AWKWARD, CLASHING, IDS

from pyspark.sql import functions as F
from skeinworks.llm import personal_data
from skeinworks.llm.personal_data import BASE, KINDS, SpanModel

SF = Path("/root/testdata/sf0.1")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    "mail a.b+c@d-e.co.uk, x@y, @z.com; a@b.c@d.e a@b@c.d +d@e.f.", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 1.2.3 10.0.0.255x",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 41111111111111110 6011 0009 9013 9424", "+1 (017) 555-7713 +12 34 +1234567 +49 30 1234 5678 901234567 +1 () 5", "é+4930123456é ü@ü.de a@ü.de 12٠34", "9" * 50,
]


def base_by_brute_force(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.findall("[0-9]", m[0])
            odd = sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(reversed(d)))
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 16 <= len(d) <= 19 and odd % 10 == 0 or kind == "phone" and 8 <= len(d) <= 15:
                out.append((m.start(), m.end(), kind))
    return out


def test_rules_are_their_patterns():
    rng = np.random.default_rng(4)
    texts = [*ODD, *("".join(rng.choice(list("ab@..-+1 ()04"), 60)) for _ in range(3000)), *("".join(rng.choice(list("4111 -25"), 40)) for _ in range(500))]
    for t in texts:
        assert personal_data.rule_matches(t)[0] == base_by_brute_force(t), t


def test_long_runs_take_linear_time():
    import time

    began = time.time()
    for t in ("x" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "1 " * 200_000, "(12) " * 80_000, "A" * 400_000, "1:" * 200_000, "a@b." * 100_000):
        personal_data.spans_of(f"{t} (at) (dot) Mr.", SpanModel([]))
    assert time.time() - began < 60


def test_estimated_reliabilities_are_those_of_simulated_votes():
    rng = np.random.default_rng(6)
    right, wrong, n = np.array([0.95, 0.9, 0.85, 0.7, 0.9, 0.5]), np.array([0.9, 0.95, 0.8, 0.7, 0.6, 0.5]), 40_000
    truth = rng.random(n) < 0.35
    votes = np.where(truth[:, None], np.where(rng.random((n, 6)) < right, 1, -1), np.where(rng.random((n, 6)) < wrong, -1, 1))
    votes[rng.random((n, 6)) < 0.3] = 0
    model = SpanModel([])
    p = model.estimate(votes, np.zeros(n, int), np.ones(n), np.zeros(n, bool))
    assert abs(model.share[0] - 0.35) < 0.03 and np.abs(model.right[0] - right).max() < 0.05 and np.abs(model.wrong[0] - wrong).max() < 0.05
    plain = (votes.sum(axis=1) > 0) == truth
    assert ((p > 0.5) == truth).mean() > plain.mean() + 0.02  # labelers are weighed, not counted


def planted(rng, n):
    """(text, spans that are personal data beyond the rules); as many texts hold numbers and words that only look like it."""
    filler = ["the", "ered", "shand", "tion", "reing", "is", "of", "anat", "hend"]
    out = []
    for i in range(n):
        d = "".join(map(str, rng.integers(0, 10, 30)))
        good = [f"call ({d[:3]}) 555-{d[3:7]}", f"tel 0{d[:3]} 555 {d[3:7]}", f"email {rng.choice(filler)}.{d[:2]} (at) mail{d[3]} (dot) com", "card ssn 123-45-6789", "iban DE89 3704 0044 0532 0130 00", "contact Mr. Peter Shandre"][i % 6]
        bad = [f"order 0{d[:3]} 555 {d[3:7]}", f"version {d[:2]}.{d[2:4]}.999.{d[5]}", f"sku#{d[:3]}-{d[3:5]}-{d[5:9]}", f"lot 9{d[:2]}-00-{d[5:9]}", f"ref 4000{d[:11]}", "DE00 1111 2222 3333 4444 55", "we met at dot one of them", "isbn 978-3-16-148410-0"][i % 8]
        rule = [f"phone +1 ({d[9:12]}) 555-{d[12:16]}", f"mail {d[9]}x@mail.example.com", f"host 10.{d[9]}.{d[10]}.7", "card 4111 1111 1111 1111"][i % 4]
        words = [" ".join(rng.choice(filler, 30)) for _ in range(5)]
        true = re.sub(r"^(call|tel|email|card ssn|iban|contact) ", "", good)
        text = f"{words[0]}. {good} {words[1]} {bad} {words[2]}"
        out.append((f"{text}. {rule} {words[4]}" if i % 3 else text, (text.index(true), text.index(true) + len(true))))
    return out


def test_added_spans_are_the_planted_ones(spark):
    rows = planted(np.random.default_rng(8), 480)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in personal_data.scan(df).collect()}
    right = wrong = 0
    for i, (text, (a, b)) in enumerate(rows):
        base, spans = base_by_brute_force(text), [s.split(":") for s in got[i].spans.split(",") if s]
        assert {(int(x), int(y), k) for k, x, y in spans if k in BASE} == set(base)
        more = {(int(x), int(y)) for k, x, y in spans if k not in BASE}
        right, wrong = right + ((a, b) in more), wrong + len(more - {(a, b)})
    assert right >= 0.8 * len(rows) and wrong <= 0.02 * right, (right, wrong)
    model = personal_data.train(personal_data.find_candidates(df))
    told = model.report()
    assert told["call"]["cue"][1] > 0.8 and min(x for t in told.values() for pair in t.values() for x in pair) > 0
    texts = [r.text for r in personal_data.redact(df, model).orderBy("doc_id").collect()]
    assert all(t == personal_data.redacted(x, personal_data.spans_of(x, model)) for t, (x, _) in zip(texts, rows, strict=True))
    assert "[email]" in texts[1] and "@" not in texts[1]


def test_scan_of_awkward_rows(spark):
    long = "w " * 100_000 + "a@b.cd"
    texts, ids = [*AWKWARD, *ODD, long, ODD[0], None], [*IDS, *range(100, 106), 7, 7, None]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").withColumns({c: F.lit(7) for c in [*CLASHING, "base", "found", "votes"] if c not in ("doc_id", "text")})
    got = personal_data.scan(df).collect()
    want = []
    for i, t in zip(ids, texts, strict=True):
        base = sorted(base_by_brute_force(t), key=lambda s: (KINDS.index(s[2]), s[0]))
        n = Counter(s[2] for s in base)
        want.append((i, *(n[k] for k in BASE), hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert sorted(map(str, got)) == sorted(map(str, personal_data.scan(df).collect()))
    assert personal_data.scan(df.limit(0)).count() == 0
    assert personal_data.redact(df).columns == df.columns


@pytest.mark.skipif(not SF.exists(), reason="no driver tables here")
def test_whole_table(spark):
    """All base spans, and none beyond them in texts that hold no other form of personal data."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in personal_data.scan(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        base = sorted(base_by_brute_force(r.text), key=lambda s: (KINDS.index(s[2]), s[0]))
        assert got[r.doc_id].spans == ",".join(f"{k}:{a}:{b}" for a, b, k in base), r.doc_id
