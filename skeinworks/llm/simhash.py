"""SimHash fingerprints, linked within a Hamming distance by sharded vantage-point trees.

Fingerprints of equal texts coincide, so only distinct fingerprints are searched. They are partitioned by their Hamming
distances from a vantage point, taken over several disjoint groups of bits: the vector of these distances is a
fingerprint's shard. By the triangle inequality a pair within distance r has vectors whose differences sum to r at
most, so each fingerprint is also sent as a query to the shards whose boundary it overlaps so far, and to no others.
A shard builds a vantage-point tree over its own and visiting fingerprints: each node splits at the median distance
from its vantage point, and a branch pair is pruned when the triangle bound excludes it; leaves compare exactly. A
shard returns a spanning set of its links, never all pairs of a clump, and components are found on executors.

The number of groups follows the number of distinct fingerprints, so that a shard has some ``OWN`` of its own at any number of them. A shard
that still has more than ``SHARD`` is split by its members' distances from a further vantage point, each member visiting the ``r`` parts after its own.

Defined cases: a null text is an empty one; a text without words has fingerprint zero and is linked like any other;
fewer than three words make one shingle; repeated rows share a component; a null id never becomes a component's id
unless all its ids are null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch, lean
from skeinworks.llm.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
LEAF = 192
#: Own fingerprints that a shard is planned for, members from which on it is split, and the vantage points for that.
OWN, SHARD, FURTHER = 256, 200_000, (0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x00FF00FF00FF00FF)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def majority(hashes: bytes) -> int:
    """Of 64-bit hashes (big-endian, on end) the bits that are set in over half."""
    n = len(hashes) // 8
    total = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65536):
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8, offset=8 * i, count=8 * min(65536, n - i)).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Bit b is set if it is set in over half the hashes of the text's k-word shingles, repeats included."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    if len(words) <= k:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_digest
    return majority(b"".join([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist(), strict=False)]))


def _prints(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, k) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "print"])

    return rows


def _near(a: np.ndarray, b: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    step = max(1, 4_000_000 // max(len(b), 1))
    out = [np.nonzero(np.bitwise_count(a[i : i + step, None] ^ b[None, :]) <= r) for i in range(0, len(a), step)]
    x = np.concatenate([o[0] + i for o, i in zip(out, range(0, len(a), step), strict=True)]) if out else np.zeros(0, dtype=np.int64)
    return x, np.concatenate([o[1] for o in out]) if out else x


class _Forest:
    """Union-find over places; ``tie`` keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.kept: list[tuple[int, int]] = []

    def top(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def tie(self, xs: np.ndarray, ys: np.ndarray) -> None:
        for x, y in zip(xs.tolist(), ys.tolist(), strict=True):
            a, b = self.top(x), self.top(y)
            if a != b:
                self.up[max(a, b)] = min(a, b)
                self.kept.append((x, y))


def vantage_links(prints: np.ndarray, r: int = RADIUS, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Places of a spanning set of the pairs of ``prints`` (distinct) within distance r, by a vantage-point tree."""
    forest = _Forest(len(prints))
    # Work items: one set against itself, or two sets against each other.
    todo: list[tuple[np.ndarray, np.ndarray | None]] = [(np.arange(len(prints)), None)]
    while todo:
        a, b = todo.pop()
        if b is not None and len(b) > len(a):
            a, b = b, a
        small = len(a) <= leaf if b is None else len(a) * len(b) <= leaf * leaf
        point = None
        if not small:
            # The vantage point that spreads the set best, of a few evenly spaced ones.
            for p in prints[a[:: max(1, len(a) // 5)]]:
                da = np.bitwise_count(prints[a] ^ p).astype(np.int16)
                cut = int(np.median(da))
                gain = min((da <= cut).sum(), (da > cut).sum())
                if point is None or gain > point[0]:
                    point = (gain, p, da, cut)
        if small or point[0] < max(1, len(a) // 50):
            x, y = _near(prints[a], prints[a if b is None else b], r)
            if b is None:
                x, y = x[keep := x < y], y[keep]
            forest.tie(a[x], (a if b is None else b)[y])
            continue
        _, p, da, cut = point
        inner, outer = a[da <= cut], a[da > cut]
        if b is None:
            todo += [(inner, None), (outer, None), (a[(da <= cut) & (da > cut - r)], a[(da > cut) & (da <= cut + r)])]
        else:
            db = np.bitwise_count(prints[b] ^ p).astype(np.int16)
            # Triangle bounds: an inner point's partners lie within cut + r, an outer point's beyond cut - r.
            todo += [(inner, b[db <= cut + r]), (outer, b[db > cut - r])]
        todo = [(x, y) for x, y in todo if len(x) and (y is None or len(y))]
    return forest.kept


def _steps(masks: int, r: int) -> list[tuple[int, ...]]:
    """Difference vectors that sum to r at most, their first difference positive: one of each pair of shards visits the other."""
    out = []
    for n in range(1, r + 1):
        for places in itertools.combinations_with_replacement(range(masks), n):
            for signs in itertools.product((1, -1), repeat=n):
                v = [0] * masks
                for p, s in zip(places, signs, strict=True):
                    v[p] += s
                if (first := next((x for x in v if x), 0)) > 0:
                    out.append(tuple(v))
    return sorted(set(out))


def _widths(masks: int) -> list[int]:
    """64 bits in even groups."""
    return [64 * (i + 1) // masks - 64 * i // masks for i in range(masks)]


def masks_for(n: int) -> int:
    """The least number of groups whose distance vectors deal ``n`` even fingerprints into shards of some ``OWN``."""
    for masks in range(1, 33):
        shares = [[math.comb(w, d) / 2**w for d in range(w + 1)] for w in _widths(masks)]
        if n <= OWN * 2 ** -sum(p * math.log2(p) for x in shares for p in x):
            return masks
    return 32


def _shards(masks: int, r: int):
    """Each fingerprint to its own shard, and as a visitor to those that its boundary overlaps."""
    widths = np.array(_widths(masks), dtype=np.int64)
    starts = np.cumsum(widths) - widths
    steps = np.array(_steps(masks, r), dtype=np.int64)
    weights = np.cumprod(np.concatenate([[1], widths[:-1] + 1]))
    groups = np.array([((1 << int(w)) - 1) << int(a) for a, w in zip(starts, widths, strict=True)], dtype=np.uint64)
    vantage = np.uint64(0x5555555555555555)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(prints), 2048):
                p = prints[i : i + 2048]
                d = np.bitwise_count((p[:, None] ^ vantage) & groups).astype(np.int64)
                near = d[:, None, :] + steps
                ok = ((near >= 0) & (near <= widths)).all(axis=2)
                who, which = np.nonzero(ok)
                shard = np.concatenate([d @ weights, near[who, which] @ weights])
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.concatenate([p, p[who]]).view(np.int64)), pa.array(np.concatenate([np.ones(len(p), dtype=bool), np.zeros(len(who), dtype=bool)]))], names=["shard", "print", "own"])

    return rows


def _parted(vantage: int, r: int):
    """Members of large shards to the part of their distance from the vantage point and to the ``r`` parts after it: the closer of a pair meets the other there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            d = np.bitwise_count(prints.view(np.uint64) ^ np.uint64(vantage)).astype(np.int64)
            for step in range(r + 1):
                # Parts that happen to get one number are searched together, which loses nothing.
                part = (shard * 67 + d + step).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), *(batch.column(i) for i in (1, 2))], names=["shard", "print", "own"])

    return rows


def _link_shards(r: int):
    """Shards arrive sorted; each is searched when it is whole. Only shards with members of their own can hold links."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        owns, now = False, None

        def search() -> pa.RecordBatch | None:
            if not owns or sum(map(len, held)) < 2:
                return None
            prints = np.unique(np.concatenate(held))
            links = vantage_links(prints.view(np.uint64), r)
            if not links:
                return None
            x, y = np.array(links).T
            return pa.RecordBatch.from_arrays([pa.array(prints[x]), pa.array(prints[y])], names=["u", "v"])

        for batch in batches:
            shard, prints, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in itertools.pairwise(edges):
                if a == b:
                    continue
                if shard[a] != now:
                    if (out := search()) is not None:
                        yield out
                    held, owns, now = [], False, shard[a]
                held.append(prints[a:b])
                owns = owns or bool(own[a:b].any())
        if (out := search()) is not None:
            yield out

    return rows


def link_prints(prints: DataFrame, scratch: Scratch, r: int = RADIUS) -> DataFrame:
    """Links (u, v) that span every clump of the distinct ``print`` values within distance r."""
    n = prints.count()
    form = "shard long, print long, own boolean"
    dealt = prints.select("print").mapInArrow(_shards(masks_for(n), r), form)
    parts = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 20_000)
    for k, vantage in enumerate(FURTHER if n > SHARD else ()):  # a shard holds a fingerprint once
        dealt = scratch.write(dealt, f"dealt{k}")  # counted and searched, but made once
        if k:
            scratch.drop(f"dealt{k - 1}")
        big = dealt.groupBy("shard").count().where(F.col("count") > SHARD).select("shard")
        big = scratch.write(big, f"big{k}")
        if big.isEmpty():
            break
        dealt = dealt.join(big, "shard", "left_anti").unionByName(dealt.join(big, "shard", "left_semi").mapInArrow(_parted(vantage, r), form))
    return dealt.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(lean(_link_shards(r)), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, r: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (least doc_id reachable) of each row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    prints = scratch.write(rows.mapInArrow(lean(_prints(shingle)), "doc_id long, print long"), "prints")
    distinct = scratch.write(prints.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct")
    links = scratch.write(link_prints(distinct, scratch, r), "links")
    found = components(links, scratch)
    # Components are named by their least fingerprint; the least document of all their fingerprints is what is asked for.
    joined = distinct.join(found, distinct["print"] == found["node"], "left").select("print", "first_id", F.coalesce("root", "print").alias("root"))
    joined = scratch.write(joined, "joined")
    named = scratch.write(joined.groupBy("root").agg(F.min("first_id").alias("component_id")), "roots")
    named = scratch.write(joined.select("print", "root").join(named, "root").select("print", "component_id"), "named")
    out = prints.join(named, "print")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
