"""Near copies by SimHash, and by an exact similarity join for the rest: texts whose sets of five-word shingles have a Jaccard index of 0.8 or more.

Texts with the same set of shingles are one class, and only classes are compared. Vantage-point trees over the classes' SimHash fingerprints
first give the pairs within ``RADIUS`` bits, of which those with the index asked for are links: they join most near copies cheaply. Two sets
with that index often differ in more bits, so an exact join finds the pairs that are not in one component yet. Every shingle's classes are counted.
A class can have a partner only if others hold at least ``SIMILAR`` of its shingles, and such a pair shares one of
the rarest shingles of both (prefix filter), so all pairs are found; each is confirmed on the whole sets. Shingles travel
packed by hash, so texts with common lines meet only where these are among their rarest. Of the classes
that share a rare shingle the first few are compared with all others. Where that leaves several components, the classes of that shingle come together with
their sets, in cells of two blocks of bounded size, and each cell compares those that aren't of one component yet: it gives no pairs but links, fewer than it has classes.

Defined cases: a null text is an empty one; texts without words are one class; fewer than five words make one shingle;
repeated rows share a component; a null id never becomes a component's id unless all its ids are null; rows that agree in all
columns to keep are either all a component's first or none; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skeinworks.llm.common import Scratch, lean
from skeinworks.llm.components import components
from skeinworks.llm.simhash import RADIUS, link_prints, majority

#: Words of a shingle, and the least Jaccard index as a fraction.
SHINGLE, SIMILAR, SEED = 5, (4, 5), 42
#: Shingles of a packed part, classes of a rare shingle compared with all others at first, and classes in one block of those compared whole (expected).
PART, PIVOTS, BLOCK = 200_000, 8, 1000
#: Passes over the shingles at most, each with a share of them, and shingles that are worth one more: bounds what lies on disk at once. Texts packed at a time bound memory.
PASSES, PASS, TEXTS = 4, 16_000_000, 500
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the text's k-word shingles, ascending."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.int64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[min(k, len(words)) - 1 :].tolist(), strict=False)])
    return np.unique(np.frombuffer(raw, dtype=np.int64))


def _sets(k: int):
    """The row itself, its class, the class's size, fingerprint and shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, TEXTS) for b in batches for i in range(0, len(b), TEXTS)):
            found = [shingles(t, k) for t in batch.column(1).to_pylist()]
            keys, prints = (np.array(x, dtype=np.uint64).view(np.int64) for x in ([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in found], [majority(s.byteswap().tobytes()) for s in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys), pa.array([len(s) for s in found], pa.int64()), pa.array(prints), pa.array([s.tobytes() for s in found], pa.binary())], names=["row", "key", "n", "print", "shingles"])

    return rows


def _packed(by: np.ndarray, parts: int, *columns: np.ndarray) -> pa.RecordBatch:
    """One row for each part (``by`` modulo ``parts``) with its slices of the columns."""
    part = (by.view(np.uint64) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
    cut = [[c[a:b].tobytes() for a, b in itertools.pairwise(edges)] for c in (c[order] for c in columns)]
    return pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]], pa.int64()), *(pa.array(c, pa.binary()) for c in cut)], names=["part", *"abc"[: len(columns)]])


PACKED = "part long, a binary, b binary"


def _by_shingle(parts: int, share: int, passes: int):
    """Shingles of one pass: their hashes modulo ``passes`` are ``share``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, TEXTS) for b in batches for i in range(0, len(b), TEXTS)):
            keys, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            hashes = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.int64)
            mine = hashes.view(np.uint64) % np.uint64(passes) == share
            if mine.any():
                hashes = hashes[mine]
                yield _packed(hashes.view(np.uint64) // np.uint64(passes), parts, np.repeat(keys, n)[mine], hashes)

    return rows


def _by_class(parts: int):
    """Each class's size, marked by a count of -1."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if len(keys):
                yield _packed(keys, parts, keys, n, np.full(len(keys), -1, dtype=np.int64))

    return rows


def _each_part(of: Callable[..., pa.RecordBatch | None]):
    """Packed rows arrive sorted by part; ``of`` gets the whole columns of each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((r[0], r[1:]) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for _, group in itertools.groupby(parts, key=lambda x: x[0]):
            out = of(*(np.frombuffer(b"".join(c), dtype=np.int64) for c in zip(*(x[1] for x in group), strict=True)))
            if out is not None:
                yield out

    return rows


def _shared(parts: int):
    def of(keys: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch | None:
        order = np.lexsort((keys, hashes))
        keys, hashes = keys[order], hashes[order]
        once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (hashes[1:] != hashes[:-1])])  # copies of a class
        keys, hashes = keys[once], hashes[once]
        _, at, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        counts = counts[at].astype(np.int64)
        keep = counts > 1
        return _packed(keys[keep], parts, keys[keep], hashes[keep], counts[keep]) if keep.any() else None

    return of


def _postings(keys: np.ndarray, values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch | None:
    """The rarest shared shingles of each class that may have a partner."""
    sized = counts < 0
    names, first = np.unique(keys[sized], return_index=True)
    size = values[sized][first]
    keys, hashes, counts = keys[~sized], values[~sized], counts[~sized]
    order = np.lexsort((hashes, counts, keys))
    at = np.searchsorted(names, keys[order])
    m = np.bincount(at, minlength=len(names))
    rank = np.arange(len(at)) - (np.cumsum(m) - m)[at]
    least = -(-SIMILAR[0] * size // SIMILAR[1])
    # Of the size - least + 1 rarest, the shingles that no other class holds come first.
    keep = rank < (m - least + 1)[at]
    if not keep.any():
        return None
    return pa.RecordBatch.from_arrays([pa.array(hashes[order][keep]), pa.array(keys[order][keep]), pa.array(size[at][keep])], names=["shingle", "key", "n"])


def _pairs(pivots: int):
    """Pairs of the classes of a shingle: the first ones with all after them, if of other components and near in size."""

    def of(shingle: np.ndarray, keys: np.ndarray, n: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
        first = np.repeat(starts, np.diff(np.append(starts, len(shingle))))
        place = np.arange(len(shingle)) - first
        out, at = [np.zeros((0, 2), dtype=np.int64)], np.arange(len(shingle))
        for i in range(pivots):
            at = at[place[at] > i]
            if not len(at):
                break
            x = first[at] + i
            ok = (SIMILAR[0] * np.maximum(n[at], n[x]) <= SIMILAR[1] * np.minimum(n[at], n[x])) & (roots[at] != roots[x])
            out.append(np.stack([keys[x[ok]], keys[at[ok]]], axis=1))
        found = np.unique(np.concatenate(out), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if not len(columns[0]):
                continue
            now = columns[0][-1]
            # A shingle's classes are compared when all are there.
            if held and held[-1][0][-1] == now:
                held.append(columns)
                continue
            whole = [np.concatenate(c) for c in zip(*held, columns, strict=True)]
            last = int(np.searchsorted(whole[0], now))
            held = [[c[last:] for c in whole]]
            if last:
                yield of(*(c[:last] for c in whole))
        if held:
            yield of(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return rows


def cell_links(keys: np.ndarray, roots: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join all classes of a cell with the index asked for: of one block, or between two. Classes of one component, or joined before, aren't compared."""
    order = np.argsort([len(x) for x in sets], kind="stable")
    keys, roots, blocks, sets = keys[order], roots[order], blocks[order], [sets[i] for i in order]
    n = np.array([len(x) for x in sets], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(n)])
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark, out, one = np.zeros(len(words), dtype=bool), [], (blocks == blocks[0]).all()
    for i in range(len(keys) - 1):
        # Sets are in order of size, so those that are near in size stand together.
        end = int(np.searchsorted(n, SIMILAR[1] * n[i] // SIMILAR[0], side="right"))
        other = np.flatnonzero((roots[i + 1 : end] != roots[i]) & (one | (blocks[i + 1 : end] != blocks[i]))) + i + 1
        if not len(other):
            continue
        mark[flat[starts[i] : starts[i + 1]]] = True
        a = starts[other[0]]
        both = np.add.reduceat(mark[flat[a : starts[other[-1] + 1]]], starts[other[0] : other[-1] + 1] - a, dtype=np.int64)[other - other[0]]
        mark[flat[starts[i] : starts[i + 1]]] = False
        for j in other[SIMILAR[1] * both >= SIMILAR[0] * (n[i] + n[other] - both)].tolist():
            if roots[j] != roots[i]:
                out.append((int(keys[i]), int(keys[j])))
                roots[roots == roots[j]] = roots[i]
    return out


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by cell (shingle and two blocks); each cell is compared when it is whole."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for _, cell in itertools.groupby(rows, key=lambda r: r[:3]):
        held = list(cell)
        keys, roots, blocks = (np.array([r[i] for r in held], dtype=np.int64) for i in (3, 4, 5))
        if len(held) > 1 and (roots != roots[0]).any():
            links = cell_links(keys, roots, blocks, [np.frombuffer(r[6], dtype=np.int64) for r in held])
            if links:
                u, v = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets have the Jaccard index asked for."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(a, dtype=np.int64), np.frombuffer(b, dtype=np.int64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _print_pairs(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (u, v) of classes that vantage-point trees find within ``RADIUS`` bits: a spanning set of them."""
    one = scratch.write(classes.groupBy("print").agg(F.min("key").alias("least")), "prints")
    same = classes.join(one, "print").where("key <> least").select(F.col("least").alias("u"), F.col("key").alias("v"))
    links = scratch.write(link_prints(one, scratch, RADIUS), "print-links")
    ends = links.join(one.select(F.col("print").alias("u"), F.col("least").alias("a")), "u").join(one.select(F.col("print").alias("v"), F.col("least").alias("b")), "v")
    return same.unionByName(ends.select(F.col("a").alias("u"), F.col("b").alias("v")))


def near_duplicates(docs: DataFrame, keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` (doc_id first) of each row, component_id (least doc_id reachable), and first: whether it is the one row of its
    component with the least id and then the least further columns."""
    keep = keep or ["doc_id"]
    spark = docs.sparkSession
    scratch = Scratch(spark, "shingle-join")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col("text").cast("string"))
    sets = scratch.write(rows.mapInArrow(lean(_sets(shingle)), StructType([rows.schema["row"], *StructType.fromDDL("key long, n long, print long, shingles binary").fields])), "sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    passes = max(1, min(PASSES, -(-total // PASS)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (passes * PART))

    def dealt(packed: DataFrame) -> DataFrame:
        return packed.repartition(parts, "part").sortWithinPartitions("part")

    classes = scratch.write(sets.select("key", "n", "print").distinct(), "classes")
    packs = classes.select("key", "n").mapInArrow(lean(_by_class(parts)), f"{PACKED}, c binary")
    for share in range(passes):
        dealt_out = dealt(sets.select("key", "n", "shingles").mapInArrow(lean(_by_shingle(parts, share, passes)), PACKED))
        packs = packs.union(scratch.write(dealt_out.mapInArrow(lean(_each_part(_shared(parts))), f"{PACKED}, c binary"), f"shared{share}"))
    postings = scratch.write(dealt(packs).mapInArrow(lean(_each_part(_postings)), "shingle long, key long, n long"), "postings")
    scratch.drop(*(f"shared{share}" for share in range(passes)))
    alive = scratch.write(postings.select("key").distinct(), "alive")  # its size on disk tells Spark how to join
    held = scratch.write(sets.join(alive, "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles")), "held")
    ids = scratch.write(sets.select("row", "key"), "ids")
    scratch.drop("sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.join(held.select(F.col("key").alias("u"), F.col("shingles").alias("x")), "u").join(held.select(F.col("key").alias("v"), F.col("shingles").alias("y")), "v")
        return scratch.write(both.select("u", "v", "x", "y").mapInArrow(lean(_similar), "u long, v long"), name)

    def labelled(links: DataFrame, more_than: int, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Components; postings with them; and the shingles that more than so many classes share, of several components."""
        found = components(links, Scratch(spark, "shingle-join-round"))
        rows = postings.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        sizes = rows.groupBy("shingle").agg(F.count("*").alias("size"), F.min("root").alias("a"), F.max("root").alias("b"))
        return found, rows, scratch.write(sizes.where((F.col("size") > more_than) & (F.col("a") < F.col("b"))).select("shingle", "size"), name)

    found, rows, open_ = labelled(confirmed(_print_pairs(classes, scratch), "links"), 1, "open0")
    if not open_.isEmpty():
        ordered = rows.join(open_, "shingle", "left_semi").select("shingle", "key", "n", "root").repartition(parts, "shingle").sortWithinPartitions("shingle", "key")
        pairs = scratch.write(ordered.mapInArrow(lean(_pairs(PIVOTS)), "u long, v long").distinct(), "pairs0")
        links = found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(confirmed(pairs, "links0"))  # components say as much as their links
        found, rows, open_ = labelled(links, PIVOTS + 1, "open1")
    if not open_.isEmpty():
        block = F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / BLOCK))
        cells = F.transform(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / BLOCK) - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("a"), F.greatest(j, F.col("block")).alias("b")))
        dealt_cells = rows.join(open_, "shingle").withColumn("block", block).select("shingle", "key", "root", "block", F.explode(cells).alias("cell"))
        whole = dealt_cells.join(held, "key").select("shingle", "cell.a", "cell.b", "key", "root", "block", "shingles")
        whole = whole.repartition(parts, "shingle", "a", "b").sortWithinPartitions("shingle", "a", "b", "key")
        links = found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(scratch.write(whole.mapInArrow(lean(_cells), "u long, v long"), "links1"))
        found = components(links, Scratch(spark, "shingle-join-round"))
    # Rows by id, those without one last, then by the other columns.
    order = F.struct(F.col("row.doc_id").isNull(), "row")
    joined = ids.groupBy("key").agg(F.min(order).alias("least")).join(found, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    joined = scratch.write(joined, "joined")
    named = scratch.write(joined.groupBy("root").agg(F.min("least").alias("one")), "named")
    named = scratch.write(joined.join(named, "root").select("key", "one"), "ones")
    out = ids.join(named, "key")
    return out.select("row.*", F.col("one.row.doc_id").alias("component_id"), order.eqNullSafe(F.col("one")).alias("first"))
