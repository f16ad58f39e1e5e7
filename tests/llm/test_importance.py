"""Hashed word runs and importance resampling against a plain version, on texts that are awkward for whole-buffer steps."""

import hashlib
import math
import re
import zlib

import pyarrow as pa
import pytest
from test_llm import AWKWARD, CLASHING, IDS

from pyspark.sql import functions as F
from skeinworks.llm import byte_words, importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
EDGES = ["a", "b", "Ünd ÄB", "x" * 64, "y" * 65 + " " + "z" * 63, "q" * 5000, "p1", "", "2p", "A-b_c\x7fd", "\x00n", "日本 語", "end ", " start"]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def runs(text):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def drawn_by_brute_force(rows, target, percent=5, least=20):
    hashed = [[zlib.crc32(x.encode()) % 10000 for x in runs(t)] for _, t in rows]
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, hashed), (t, [[zlib.crc32(x.encode()) % 10000 for x in runs(x)] for x in target])):
        for text in texts:
            for b in text:
                counts[b] += 1
    gains = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10000) / ((x + 1) * (sum(t) + 10000)))) for x, y in zip(s, t, strict=True)]
    out = []
    for (id_, text), buckets in zip(rows, hashed, strict=True):
        h = int(hashlib.sha256(f"42:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        weight = sum(gains[b] for b in buckets)
        out.append([id_, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = place + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("chunk", [1, 40, 4 << 20])
def test_hashes_of_runs(monkeypatch, chunk):
    monkeypatch.setattr(byte_words, "CHUNK_BYTES", chunk)
    texts = [*EDGES, None, *AWKWARD, *EDGES[::-1]]
    for column, held in ((pa.array(texts), texts), (pa.array(texts).slice(3, 20), texts[3:23]), (pa.array([None, ""], pa.string()), [None, ""]), (pa.array([], pa.string()), [])):
        got = [[] for _ in held]
        for first, end, found in byte_words.chunks(column):
            assert found.counts().tolist() == [len(words(t)) for t in held[first:end]]
            for rows, crc in byte_words.run_hashes(found, 3):
                for r, c in zip(rows.tolist(), crc.tolist(), strict=True):
                    got[first + r].append(c)
        assert [sorted(x) for x in got] == [sorted(zlib.crc32(x.encode()) for x in runs(t)) for t in held]


@pytest.mark.parametrize("range_rows", [3, 1_000_000])
def test_draws(spark, monkeypatch, range_rows):
    monkeypatch.setattr(importance, "RANGE_ROWS", range_rows)
    rows = [*zip(IDS, AWKWARD, strict=True), *((100 + i, " ".join(f"w{(i * j) % 17}" for j in range(15 + i))) for i in range(40)), *([(7, "same words here " * 9)] * 5), *([(None, "no id " * 12)] * 4)]
    target = ["w3 w6 w9 and more", None, "", "same words"]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in CLASHING if c not in ("doc_id", "text")})
    bench = spark.createDataFrame([(i, t, 5) for i, t in enumerate(target)], "item_id long, text string, bucket int")
    for percent in (5, 40):
        got = importance.resample(df, bench, percent)
        assert sorted(map(tuple, got.collect()), key=str) == drawn_by_brute_force(rows, target, percent)
    assert sorted(r.rank for r in got.where("rank is not null").collect()) == list(range(1, 40 * sum(len(words(t)) >= 20 for _, t in rows) // 100 + 1))
    assert importance.resample(df.limit(0), bench).count() == 0
    assert sorted(map(tuple, importance.resample(df, bench.limit(0)).collect()), key=str) == drawn_by_brute_force(rows, [])


def test_draws_lean_to_the_target(spark):
    """A fifth of the documents is written in the target's words; they are most of those drawn."""
    rows = [(i, " ".join(f"{'t' if i % 5 == 0 else 'g'}{(i * 7 + j * j) % 30}" for j in range(40))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(1, " ".join(f"t{(j * j) % 30}" for j in range(60)))], "item_id long, text string")
    drawn = [r.doc_id for r in importance.resample(df, target).where("rank is not null").collect()]
    assert len(drawn) == 20 and sum(i % 5 == 0 for i in drawn) >= 18
