"""Best-fit packing with a swap-based local search.

Documents become token ids plus one end id; those longer than ``capacity`` are cut into full pieces, of which the
first may be shorter. Full pieces are sequences by themselves. All other pieces are dealt into blocks; within a block
they go, longest first, to the fullest sequence with room, then a local search exchanges pieces (one for one, two for
one, or a plain move) between underfull sequences. Each step raises the sum of squared fills, so the emptiest
sequences drain until they are gone. What is still underfull in its block goes to a next round over fewer blocks,
until one block is left. The number of blocks follows the data; the last round holds a few sequences of each block.

Defined cases: a null text is empty, and an empty text is the end id alone; a document of exactly ``capacity`` ids is
one full piece; repeated rows are packed like any other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch, lean
from skeinworks.llm.tokens import Encoder, default_tokenizer

CAPACITY, BLOCK = 2048, 40_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` ids; the remainder comes first."""
    head = n % capacity
    return [(0, head)] * bool(head) + [(i, capacity) for i in range(head, n, capacity)]


def _pieces(tokenizer: str, capacity: int, end: int, keep_ids: bool):
    tail = end.to_bytes(4, "little")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text) + tail
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    out.append((doc_id, k, start, length, zlib.crc32(part), *[part] * keep_ids))
            if out:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
                names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return rows


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in ``lengths``: longest first, each to the fullest bin with room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what is left
    some = 0  # bit r: a bin with r left
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        above = some >> n
        if above:
            left = n + (above & -above).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                some &= ~(1 << left)
            bins[b].append(i)
        else:
            left, b = capacity, len(bins)
            bins.append([i])
        left -= n
        room[left].append(b)
        some |= 1 << left
    return bins


def _by_length(items: list[int], lengths: list[int]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i in items:
        out.setdefault(lengths[i], []).append(i)
    return out


def _best_step(small: list[int], fill: int, others: dict[int, list[int]], fills: dict[int, int], lengths: list[int], capacity: int):
    """The step out of ``small`` into another underfull bin that raises the squared fills most: (gain, bin, given, taken).

    Pieces of one length are alike. A bin has less than the root of twice its capacity of different lengths, so all its pairs are few, however
    many pieces it holds.
    """
    best = None
    mine = _by_length(small, lengths)
    own = sorted(mine)
    pairs = {x + y: (mine[x][0], mine[y][-1]) for k, x in enumerate(own) for y in own[: k + 1] if x != y or len(mine[x]) > 1}
    singles, doubles = [(n, (mine[n][0],)) for n in own], sorted(pairs.items())
    for b, items in others.items():
        room, f = capacity - fills[b], fills[b]
        for base, got in ((0, None), *((n, x[0]) for n, x in _by_length(items, lengths).items())):
            for options in (singles, doubles if got is not None else []):
                at = bisect.bisect_right(options, base + room, key=lambda x: x[0])  # after the largest that fits
                if not at:
                    continue
                d = options[at - 1][0] - base
                gain = 2 * d * (f - fill + d)
                if d > 0 and gain > 0 and (best is None or gain > best[0]):
                    best = (gain, b, options[at - 1][1], got)
    return best


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Drain the emptiest underfull bins into the others; stops at the bound of ceil(sum / capacity) or when no step gains."""
    least = -(-sum(lengths) // capacity)
    fills = {b: sum(lengths[i] for i in x) for b, x in enumerate(bins)}
    under = {b: list(bins[b]) for b in fills if fills[b] < capacity}
    whole = [bins[b] for b in fills if fills[b] >= capacity]
    stuck: list[list[int]] = []
    while under and len(whole) + len(stuck) + len(under) > least:
        b = min(under, key=lambda b: (fills[b], b))
        small = under.pop(b)
        while small and (step := _best_step(small, fills[b], under, fills, lengths, capacity)):
            _, to, given, got = step
            moved = sum(lengths[i] for i in given) - (lengths[got] if got is not None else 0)
            small = [i for i in small if i not in given] + ([got] if got is not None else [])
            under[to] = [i for i in under[to] if i != got] + list(given)
            fills[b] -= moved
            fills[to] += moved
            if fills[to] == capacity:
                whole.append(under.pop(to))
        if small:
            stuck.append(small)
    return whole + stuck + list(under.values())


def _pack_block(capacity: int, round_: int, last: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        lengths = table.column("length").to_pylist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        base = (round_ << 56) + (TaskContext.get().partitionId() << 28)
        sequence, offset, open_ = [0] * len(lengths), [0] * len(lengths), [False] * len(lengths)
        for k, items in enumerate(bins):
            at, under = 0, sum(lengths[i] for i in items) < capacity and not last
            for i in items:
                sequence[i], offset[i], open_[i] = base + k, at, under
                at += lengths[i]
        out = table.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64())).append_column("open", pa.array(open_, pa.bool_()))
        yield from out.to_batches(max_chunksize=10000)

    return rows


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0, block: int = BLOCK, keep_ids: bool = False) -> DataFrame:
    """One row for each piece of each document: where it starts there, and its sequence and place in it.

    ``keep_ids`` adds the piece's ids as little-endian unsigned 32-bit integers in ``ids``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    form = PIECES + ", ids binary" * keep_ids
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(_pieces(tokenizer or default_tokenizer(), capacity, end_id, keep_ids)), form)
    pieces = scratch.write(rows, "pieces")
    done = [pieces.where(F.col("length") == capacity).select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest, n, round_ = pieces.where(F.col("length") < capacity), 0, 0
    while True:
        round_ += 1
        count = rest.count()
        blocks = max(1, -(-count // block))
        last = blocks == 1 or round_ > 1 and blocks >= n  # no fewer blocks than before: every piece is final
        packed = rest.drop("sequence_id", "offset", "open").repartition(blocks).mapInArrow(lean(_pack_block(capacity, round_, last)), form + ", sequence_id long, offset long, open boolean")
        packed = scratch.write(packed, f"round{round_}")
        done.append(packed.where("not open").drop("open"))
        if last:
            break
        rest, n = packed.where("open"), blocks
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out
