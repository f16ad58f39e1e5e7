"""Substring deduplication by repeated-phrase automata.

A passage is a run of words that occurs more than once; a window is ``WINDOW`` consecutive words of one
document. Every word that some window covers is removed if that window's word sequence also starts earlier
(smaller document id, or the same document at an earlier word).

The steps, each a DataFrame stage written to the shared folder:

1. Every window is represented by its *anchor*, the smallest hash among its inner five-word grams. Equal windows
   have equal anchors, so only anchors that recur can hold repeated windows. Anchors are counted with map-side
   combining; texts never travel here.
2. Documents with recurring anchors are cut into *segments* (runs of windows with one anchor). Equal segments collapse
   to their first place and their number, with map-side combining, so a passage that a third of all documents hold is
   one row. Where an anchor has more than ``SEGMENTS_A_GROUP`` different segments, these are cut further at the next
   smallest gram hash, again and again until no group is larger: no group is copied, capped or held by one task.
3. Segments are dealt into shards by anchor: a document streams past an automaton as those of its segments that can match there, as no document can
   pass all automata. A shard *confirms* recurring passages, first by counts of windows, then word by word to the longest runs that always stand
   together. It *compiles* these into an Aho-Corasick automaton over an alphabet of words, and *streams* all its segments through it. The matches alone
   tell where passages stand and which place is a passage's first; at all others the words are removed.
4. What was found in a segment holds for all its places, which get it by a join on the segment.

Defined cases: a null text has no words; a null id sorts after all others; rows with the same text collapse before
step 1 (later ids lose every word that a window covers); rows that repeat an id and a text are kept alike, as
neither is earlier; rows that share an id but not a text are told apart by a window's starting word alone (at the same
word neither is earlier). Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch

WINDOW, GRAM = 20, 5
LAST = (1 << 63) - 1
#: Different segments of one anchor that stay together, and segments from which on one automaton is compiled for them.
SEGMENTS_A_GROUP, SEGMENTS_AN_AUTOMATON = 20_000, 4000
#: Segments whose words a task remembers to have written.
WRITTEN = 200_000
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15
_M = 1 << 64
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES[_SPACE] = 0
_INSIDE = ~_SPACE
#: Powers of the base and of its inverse are kept for texts up to so many bytes, and made anew for longer ones.
KEPT_POWERS = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base % _M, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


_UP, _DOWN = _powers(_BASE, KEPT_POWERS), _powers(pow(_BASE, -1, _M), KEPT_POWERS)


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash for each word of ``data`` (words end at ASCII white space).

    Letters are weighted by their place in the text; the inverse power of a word's start makes its hash independent of it.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = _INSIDE[raw]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    starts = np.flatnonzero(edge)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(raw)
    up, down = (_UP[:n], _DOWN) if n <= KEPT_POWERS else (_powers(_BASE, n), _powers(pow(_BASE, -1, _M), n))
    h = np.add.reduceat(_BYTES[raw] * up, starts) * down[starts]
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` neighbours, by doubling."""
    out, done, at = None, 0, 0
    piece, width, base = h, 1, _BASE
    while True:
        if n & width:
            size = len(h) - n + 1
            part = piece[at : at + size]
            out = part.copy() if out is None else out * np.uint64(pow(_BASE, width, _M)) + part
            at += width
        done += n & width
        if done == n:
            return out
        piece = piece[:-width] * np.uint64(base) + piece[width:]
        base = base * base % _M
        width *= 2


def _slid_min(g: np.ndarray, n: int) -> np.ndarray:
    width = 1
    while width * 2 <= n:
        g = np.minimum(g[:-width], g[width:])
        width *= 2
    return np.minimum(g[: len(g) - (n - width)], g[n - width :]) if n > width else g


def _grams(h: np.ndarray) -> np.ndarray:
    g = _rolled(h, GRAM) * _MIX
    return g ^ (g >> np.uint64(32))


def windows_of(data: bytes, window: int = WINDOW, hashed: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash (if wanted) and anchor of each window of the text."""
    h = word_hashes(data)
    if len(h) < window:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    return _rolled(h, window) if hashed else h[:0], _slid_min(_grams(h), window - GRAM + 1)


def _runs(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    return np.concatenate([[0], edge]), np.append(edge, len(anchors))


def _ids(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _anchor_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids, many = [], [], []
            for id_, text in zip(_ids(batch, "id"), _ids(batch, "text"), strict=True):
                if not text:
                    continue
                w, a = windows_of(text.encode(), window)
                if not len(a):
                    continue
                values = np.unique(a[_runs(a)[0]])
                ordered = np.sort(w)
                twice = ordered[1:][ordered[1:] == ordered[:-1]]
                found.append(values.view(np.int64))
                ids.append(np.full(len(values), id_, dtype=np.int64))
                many.append(np.isin(values, a[np.isin(w, twice)]) if len(twice) else np.zeros(len(values), dtype=bool))  # anchors of windows that the document repeats itself
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, ids, many)], names=["anchor", "id", "many"])

    return rows


def _picked(a: np.ndarray, wanted: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of windows whose anchor is wanted, as first and end window."""
    starts, ends = _runs(a)
    keep = np.isin(a[starts].view(np.int64), np.array(wanted, dtype=np.int64))
    yield from zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)


def _digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


PIECES = {"anchor": pa.int64(), "segment": pa.binary(), "id": pa.int64(), "key": pa.binary(), "start": pa.int64(), "words": pa.binary()}
_PIECES = "anchor long, segment binary, id long, key binary, start long, words binary"


def _batch(out: list[tuple], form: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), form.values(), strict=True)], names=list(form))


def _segment_rows(window: int):
    """Segments of candidate documents; a task writes the words of each once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written: set[bytes] = set()
        for batch in batches:
            out: list[tuple] = []
            for id_, key, text, wanted in zip(*(_ids(batch, n) for n in ("id", "key", "text", "anchors")), strict=True):
                data = text.encode()
                _, a = windows_of(data, window, False)
                if not len(a):  # another row with this id has windows
                    continue
                words = data.split()
                for s, e in _picked(a, wanted):
                    piece = b" ".join(words[s : e + window - 1])
                    digest = _digest(piece)
                    if digest in written:
                        piece = None
                    else:
                        if len(written) >= WRITTEN:
                            written.clear()
                        written.add(digest)
                    out.append((int(a[s].view(np.int64)), digest, id_, key, s, piece))
                if len(out) > 20000:
                    yield _batch(out, PIECES)
                    out = []
            if out:
                yield _batch(out, PIECES)

    return rows


def _nth_least(grams: np.ndarray, width: int, level: int) -> np.ndarray:
    """Of each ``width`` neighbours the least ``level`` values, mixed to one."""
    least = np.sort(np.lib.stride_tricks.sliding_window_view(grams, width), axis=1)[:, :level]
    return _rolled(least.ravel(), level)[::level] if level > 1 else least[:, 0]


CHILDREN = {"segment": pa.binary(), "anchor": pa.int64(), "child": pa.binary(), "place": pa.int64(), "words": pa.binary()}
_CHILDREN = "segment binary, anchor long, child binary, place long, words binary"


def _narrower(window: int, level: int):
    """Segments of a hot anchor cut into runs of windows that agree in their ``level`` least gram hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for segment, data in zip(_ids(batch, "segment"), _ids(batch, "words"), strict=True):
                words, a = data.split(), _nth_least(_grams(word_hashes(data)), window - GRAM + 1, level)
                for s, e in zip(*(x.tolist() for x in _runs(a)), strict=True):
                    piece = b" ".join(words[s : e + window - 1])
                    out.append((segment, int(a[s].view(np.int64)), _digest(piece), s, piece))
            if out:
                yield _batch(out, CHILDREN)

    return rows


def _flat_runs(at: list[int]) -> list[int]:
    """First and last of each run of ascending numbers, flat."""
    out: list[int] = []
    for i in at:
        if out and out[-1] == i - 1:
            out[-1] = i
        else:
            out += (i, i)
    return out


def _passages(coded: list[str], often: list[int], window: int) -> set[str]:
    """The maximal recurring passages of some lines (two letters a word; ``often``: how many equal lines one stands for).

    Windows are counted first. Of those that recur, two that follow each other belong to one passage if neither ever stands without the other:
    wherever a passage begins, the whole of it stands, and each recurring window is in exactly one passage.
    """
    size, count = 2 * window, Counter()
    for line, n in zip(coded, often, strict=True):
        if len(line) >= size:
            held = Counter(line[i : i + size] for i in range(0, len(line) - size + 1, 2))
            count.update(held if n == 1 else {w: 2 * k for w, k in held.items()})
    after: dict[str, str | None] = {}
    before: dict[str, str | None] = {}

    def beside(known: dict[str, str | None], w: str, other: str | None) -> None:
        if known.setdefault(w, other) != other:
            known[w] = None

    runs: list[list[str]] = []
    for line in coded:
        run: list[str] = []
        for i in range(0, len(line) - size + 1, 2):
            w = line[i : i + size]
            if count[w] > 1:
                run.append(w)
            elif run:
                runs.append(run)
                run = []
        if run:
            runs.append(run)
    for run in runs:
        for x, y in itertools.pairwise([None, *run, None]):
            if x is not None:
                beside(after, x, y)
            if y is not None:
                beside(before, y, x)
    out: set[str] = set()
    for run in runs:
        first = 0
        for i in range(1, len(run) + 1):
            if i == len(run) or after[run[i - 1]] != run[i] or before[run[i]] != run[i - 1]:
                out.add(run[first] + "".join([w[-2:] for w in run[first + 1 : i]]))
                first = i
    return out


def _matches(automaton, line: str) -> Iterator[tuple[int, str]]:
    """Where passages begin in a line, in words."""
    return (((end + 1 - len(passage)) // 2, passage) for end, passage in automaton.iter(line))


def _located(held: list[tuple], window: int) -> Iterator[tuple]:
    """Confirms the passages of some whole groups, compiles them, and streams the segments past the automaton: its matches are all that tells where they stand."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    lines = [[numbers.setdefault(w, len(numbers)) for w in words.split()] for *_, words in held]
    # A word is two letters from alphabets of their own: a node then has few children to search (it searches them one by one), and no passage is found inside a word.
    base = math.isqrt(len(numbers)) + 1
    letters = [chr(1 + n // base) + chr(1 + base + n % base) for n in range(len(numbers))]
    coded = ["".join([letters[n] for n in line]) for line in lines]
    passages = _passages(coded, [n for *_, n, _ in held], window)
    if not passages:
        return
    automaton = ahocorasick.Automaton()
    for passage in passages:
        automaton.add_word(passage, passage)
    automaton.make_automaton()
    found = [list(_matches(automaton, line)) for line in coded]
    first: dict[str, tuple[int, int]] = {}
    for (_, id_, _, start, _, _), matches in zip(held, found, strict=True):
        for at, passage in matches:
            place = (id_, start + at)
            if place < first.get(passage, (place[0], place[1] + 1)):
                first[passage] = place
    for (segment, id_, key, start, n, _), matches in zip(held, found, strict=True):
        if matches:
            windows = [(range(at, at + len(passage) // 2 - window + 1), first[passage] != (id_, start + at)) for at, passage in matches]
            every = sorted(i for x, _ in windows for i in x)
            yield segment, id_, key, start, n, _flat_runs(every), _flat_runs(sorted(i for x, later in windows if later for i in x))


LOCATED = {"segment": pa.binary(), "id": pa.int64(), "key": pa.binary(), "start": pa.int64(), "n": pa.int64(), "all": pa.list_(pa.int32()), "later": pa.list_(pa.int32())}
_LOCATED = "segment binary, id long, key binary, start long, n long, all array<int>, later array<int>"


def _locate(window: int):
    """Segments arrive sorted by anchor. ``all``: runs of windows that recur; ``later``: those not at their first place."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        now = None

        def settle() -> None:
            # A segment of its own recurs only within itself, and then repeats words.
            if len(group) > 1 or group and (group[0][4] > 1 or len(set(words := group[0][5].split())) < len(words)):
                held.extend(group)
            group.clear()

        for batch in batches:
            for anchor, *rest in zip(*(_ids(batch, n) for n in ("anchor", "segment", "id", "key", "start", "n", "words")), strict=True):
                if anchor != now:
                    settle()
                    now = anchor
                    if len(held) >= SEGMENTS_AN_AUTOMATON:
                        if out := list(_located(held, window)):
                            yield _batch(out, LOCATED)
                        held = []
                group.append(tuple(rest))
        settle()
        if out := list(_located(held, window)):
            yield _batch(out, LOCATED)

    return rows


def _kept(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, key, text, spans in zip(*(_ids(batch, n) for n in ("id", "key", "text", "spans")), strict=True):
                words = text.encode().split()
                keep = np.ones(len(words), dtype=bool)
                for x in spans:
                    at, runs = x["start"], x["runs"]
                    for a, b in zip(runs[::2], runs[1::2], strict=True):
                        keep[at + a : at + b + window] = False
                kept = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
                out.append((id_, key, int(len(words) - keep.sum()), kept.decode()))
            if out:
                yield _batch(out, {"id": pa.int64(), "key": pa.binary(), "n_cut": pa.int64(), "cut_text": pa.string()})

    return rows


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, sha = [], []
        for text in _ids(batch, "text"):
            words = (text or "").encode().split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("id")), batch.column(batch.schema.get_field_index("key")), pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "id", "key", "n_words", "all_sha256"])


def _keyed(docs: DataFrame) -> DataFrame:
    id_: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select("doc_id", id_.alias("id"), F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("key"), "text")


def find_repeats(docs: DataFrame, scratch: Scratch, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Candidate documents ``(id, key, text, anchors)`` and the windows to remove ``(id, key, start, runs)``: first and last of each run, from ``start``."""
    spark = docs.sparkSession
    source = _keyed(docs.select("doc_id", "text"))
    firsts = scratch.write(source.groupBy("key").agg(F.min("id").alias("id")), "firsts")
    anchors = scratch.write(source.select("id", "text").mapInArrow(_anchor_rows(window), "anchor long, id long, many boolean"), "anchors")
    seen = anchors.groupBy("anchor").agg(F.count("*").alias("n"), F.max("many").alias("many"))
    recurring = scratch.write(seen.where("n > 1 or many").select("anchor"), "recurring")
    wanted = anchors.join(recurring, "anchor").join(firsts.select("id"), "id", "left_semi")
    wanted = scratch.write(wanted.groupBy("id").agg(F.collect_set("anchor").alias("anchors")), "wanted")
    scratch.drop("anchors", "recurring")
    # Only the first copy of a text is read on; the window test needs at least one anchor.
    texts = source.select("id", "key", "text").join(wanted, "id").join(firsts, ["key", "id"], "left_semi").dropDuplicates(["id", "key"])
    candidates = scratch.write(texts, "candidates")
    scratch.drop("wanted")

    pieces = scratch.write(candidates.mapInArrow(_segment_rows(window), _PIECES), "pieces1")
    spans, level = None, 0
    while True:
        level += 1
        place = F.min(F.struct("id", "start", "key")).alias("place")
        distinct = pieces.groupBy("segment").agg(place, F.first("anchor").alias("anchor"), F.count("*").alias("n"), F.max("words").alias("words"))
        distinct = scratch.write(distinct.select("anchor", "segment", "place.id", "place.key", "place.start", "n", "words"), f"distinct{level}")
        # Windows that agree in all gram hashes are equal, so that the last level has no large group.
        hot = distinct.groupBy("anchor").count().where(F.col("count") > SEGMENTS_A_GROUP).select("anchor")
        hot = scratch.write(hot if level < window - GRAM + 1 else hot.limit(0), f"hot{level}")
        narrow = hot.isEmpty()
        rest = distinct if narrow else distinct.join(hot, "anchor", "left_anti")
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), distinct.count() // (4 * SEGMENTS_AN_AUTOMATON))
        located = scratch.write(rest.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(_locate(window), _LOCATED), f"located{level}")
        own = located.where("size(later) > 0").select("id", "key", "start", F.col("later").alias("runs"))
        others = located.where("n > 1").select("segment", F.struct("id", "start", "key").alias("place"), F.col("all").alias("runs"))
        shared = pieces.select("segment", "id", "key", "start").join(others, "segment").where(F.struct("id", "start", "key") != F.col("place"))
        found = own.unionByName(shared.select("id", "key", "start", "runs"))
        spans = found if spans is None else spans.unionByName(found)
        if narrow:
            break
        wide = distinct.join(hot, "anchor", "left_semi").select("segment", "words")
        children = scratch.write(wide.mapInArrow(_narrower(window, level + 1), _CHILDREN), f"children{level}")
        # A child's words go with the first place of its segment alone.
        owners = distinct.select("segment", F.struct("id", "start", "key").alias("owner"))
        moved = pieces.select("segment", "id", "key", "start").join(children, "segment").join(owners, "segment")
        words = F.when(F.struct("id", "start", "key") == F.col("owner"), F.col("words"))
        pieces = scratch.write(moved.select("anchor", F.col("child").alias("segment"), "id", "key", (F.col("start") + F.col("place")).alias("start"), words.alias("words")), f"pieces{level + 1}")
    return candidates, spans


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 of what stays, and cut_text (null if unchanged)."""
    if window < GRAM + 1:
        raise ValueError(f"window must be over {GRAM}")
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    candidates, spans = find_repeats(docs, scratch, window)
    by_doc = spans.groupBy("id", "key").agg(F.collect_list(F.struct("start", "runs")).alias("spans"))
    cut = candidates.select("id", "key", "text").join(by_doc, ["id", "key"])
    cut = scratch.write(cut.mapInArrow(_kept(window), "id long, key binary, n_cut long, cut_text string"), "cut")
    scratch.drop(*scratch.names - {"firsts", "cut"})
    firsts = scratch.read("firsts").withColumnRenamed("id", "first_id")
    counted = _keyed(docs.select("doc_id", "text")).mapInArrow(_counts, "doc_id long, id long, key binary, n_words long, all_sha256 string")
    rows = counted.join(firsts, "key", "left").join(cut, ["id", "key"], "left")
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= window)
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).when(F.col("cut_text").isNotNull(), F.sha2(F.col("cut_text").cast("binary"), 256)).otherwise(F.col("all_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("cut_text")).alias("cut_text"),
    )
