"""Language identification by cross-parsing entropy.

Each language's labelled running text (letters in lower case, every run of other characters one space) forms a suffix
automaton. A text is parsed greedily into longest matches of each automaton; a match is a phrase. A phrase points to
one of the automaton's n states and so costs log2(n) bits, which makes samples of different sizes comparable (a sample that repeats
itself has no more states for it); a letter that the sample lacks costs a character code besides. The language whose normalised phrases need the fewest bits wins.

Automata are built once, packed into arrays (rows of transitions displaced into one table) and broadcast. A batch of
texts is cut into chunks of ``CHUNK`` characters, and all chunks advance together, a character at a time, in numpy.

Training reads a bounded hash sample of ``PIECE``-character pieces from all places of all labelled texts: expected
``CHARS_A_LANGUAGE`` characters a language, and ``CHARS_IN_ALL`` together (with very many languages each gets its even
share; none is left out). Every text is predicted as a whole.

Defined cases: a null text, or one without a letter (Unicode category L), is ``und`` with score 0; ties go to the language with more
labelled rows, then to the first by name; a language whose texts hold no letter isn't learned; without any learned language every text is
``und``; repeated rows are predicted alike; extra columns are ignored by training and kept by prediction.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import extended, lean

#: Bounds of the training sample: expected characters of each language and of all, and characters of a piece.
CHARS_A_LANGUAGE, CHARS_IN_ALL, PIECE = 60_000, 2_000_000, 400
#: Characters that are parsed on end, chunks that advance together, and characters of a text that are read at a time.
CHUNK, TOGETHER, SLICE = 512, 2048, 1 << 18
#: Bits of a letter that a sample lacks.
LITERAL = 21.0
UNKNOWN = "und"
_SPACE = 32
_RANDOM = 1_000_000_007


@functools.cache
def _is_letter() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    for m in regex.finditer(r"\p{L}+", "".join(map(chr, range(0x110000)))):
        table[m.start() : m.end()] = True
    return table


def running(text: str) -> np.ndarray:
    """Code points of the letters in lower case; each run of other characters, and either end, is one space. Empty without a letter."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _is_letter()[codes]
    if not letter.any():
        return codes[:0]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    return np.where(letter, codes, _SPACE)[keep]


class SuffixAutomaton:
    """All substrings of the given sequences, as a minimal automaton."""

    def __init__(self, sequences: Iterable[Iterable[int]]):
        nxt: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        self.next = nxt
        for sequence in sequences:
            last = 0
            for c in sequence:
                q = nxt[last].get(c)
                if q is not None and length[q] == length[last] + 1:
                    last = q
                    continue
                cur, at = -1, last
                if q is None:
                    cur = len(nxt)
                    nxt.append({})
                    length.append(length[last] + 1)
                    link.append(0)
                    while at >= 0 and c not in nxt[at]:
                        nxt[at][c] = cur
                        at = link[at]
                    if at < 0:
                        last = cur
                        continue
                    q = nxt[at][c]
                if length[q] == length[at] + 1:
                    link[cur] = q
                    last = cur
                    continue
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[at] + 1)
                link.append(link[q])
                while at >= 0 and nxt[at].get(c) == q:
                    nxt[at][c] = copy
                    at = link[at]
                link[q] = copy
                if cur >= 0:
                    link[cur] = copy
                last = cur if cur >= 0 else copy


class PackedAutomaton:
    """An automaton's transitions in one table: that of state s by symbol c stands at ``base[s] + c`` if ``check`` says s there."""

    def __init__(self, automaton: SuffixAutomaton, symbols: int):
        nxt = automaton.next
        total = sum(map(len, nxt))
        slots = 1 << (2 * total + symbols).bit_length()
        mask, base, check, to = slots - 1, [0] * len(nxt), [-1] * slots, [0] * slots
        for s in sorted(range(1, len(nxt)), key=lambda s: -len(nxt[s])):
            b = s * 0x9E3779B1 & mask
            while any(check[b + c & mask] >= 0 for c in nxt[s]):
                b = b + 0x61C89 & mask
            base[s] = b
            for c, x in nxt[s].items():
                check[b + c & mask], to[b + c & mask] = s, x
        self.mask, self.bits = mask, math.log2(len(nxt) + 1)
        self.base, self.check, self.to = (np.array(x, dtype=np.int32) for x in (base, check, to))
        self.root = np.full(symbols, -1, dtype=np.int32)
        self.root[list(nxt[0])] = list(nxt[0].values())

    def parse(self, columns: np.ndarray, active: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and unseen letters of each column; at step t the first ``active[t]`` columns have a symbol."""
        state = np.zeros(columns.shape[1], dtype=np.int32)
        phrases, unseen = np.zeros((2, columns.shape[1]), dtype=np.int64)
        base, check, to, root, mask = self.base, self.check, self.to, self.root, self.mask
        for t, m in enumerate(active):
            c, s = columns[t, :m], state[:m]
            at = base[s] + c & mask
            found = np.where(check[at] == s, to[at], -1)
            miss = np.flatnonzero(found < 0)
            if len(miss):
                phrases[miss] += s[miss] != 0
                first = root[c[miss]]
                unseen[miss] += first < 0
                found[miss] = np.maximum(first, 0)
            state[:m] = found
        return phrases + (state != 0), unseen


class CrossParser:
    """``pieces``: code points of each language's sample, the likelier language first."""

    def __init__(self, pieces: dict[str, list[np.ndarray]]):
        pieces = {x: p for x, p in pieces.items() if any(map(len, p))}
        self.langs = list(pieces)
        known = np.unique(np.concatenate([np.array([_SPACE], dtype=np.uint32), *(q for p in pieces.values() for q in p)]))
        self.codes = known
        self.automata = [PackedAutomaton(SuffixAutomaton([np.searchsorted(known, q).tolist() for q in p]), len(known) + 1) for p in pieces.values()]

    def symbols(self, text: str) -> np.ndarray:
        """Places of the text's characters in the alphabet; its length stands for all letters beyond."""
        codes = running(text)
        at = np.searchsorted(self.codes, codes)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != codes] = len(self.codes)
        return at.astype(np.int32)

    def _chunks(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        for i, text in enumerate(texts):
            for a in range(0, len(text or ""), SLICE):
                line = self.symbols(text[a : a + SLICE])
                for k in range(0, len(line), CHUNK):
                    yield i, line[k : k + CHUNK]

    def costs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text (row) by each language, and its parsed characters."""
        bits, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=np.int64)
        held: list[tuple[int, np.ndarray]] = []

        def settle() -> None:
            held.sort(key=lambda x: -len(x[1]))
            owner, lengths = np.array([x[0] for x in held]), np.array([len(x[1]) for x in held])
            columns = np.zeros((lengths[0], len(held)), dtype=np.int32)
            for j, (_, line) in enumerate(held):
                columns[: len(line), j] = line
            active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").tolist()
            np.add.at(size, owner, lengths)
            for k, a in enumerate(self.automata):
                phrases, unseen = a.parse(columns, active)
                np.add.at(bits[:, k], owner, phrases * a.bits + unseen * (a.bits + LITERAL))
            held.clear()

        for chunk in self._chunks(texts):
            held.append(chunk)
            if len(held) == TOGETHER:
                settle()
        if held:
            settle()
        return bits, size

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score from 0 to 1, and bits a character of the language."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        bits, size = self.costs(texts)
        best, some = bits.argmin(axis=1), size > 0
        least = bits[np.arange(len(bits)), best]
        weights = (least[:, None] / np.where(bits > 0, bits, 1)) ** 8
        score = np.where(some, 1 / np.where(some, weights.sum(axis=1), 1), 0.0)
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)], score, least / np.maximum(size, 1)


def train(docs: DataFrame, training: Column, chars: int = CHARS_A_LANGUAGE, in_all: int = CHARS_IN_ALL) -> CrossParser:
    """Automata from a bounded hash sample of pieces of the labelled rows."""
    rows = docs.where(training & F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size")).orderBy(F.desc("n"), "lang").collect()  # a row a language
    if not found:
        return CrossParser({})
    share = min(chars, max(1, in_all // len(found)))
    rates = docs.sparkSession.createDataFrame([(r.lang, min(1.0, share / r["size"])) for r in found], "lang string, rate double")
    places = F.filter(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int")), lambda k: F.pmod(F.xxhash64("hash", k), F.lit(_RANDOM)) / _RANDOM < F.col("rate"))
    # The rates are a row a language, and were collected above. A piece goes with one character on either side, which tells whether it begins and ends inside a word.
    # Pieces are drawn by their text and place there, whatever the ids: copies are drawn together, and count once.
    hashed = rows.withColumn("hash", F.xxhash64("text")).join(F.broadcast(rates), "lang")
    pieces = hashed.select("lang", "hash", "text", F.explode(places).alias("k"))
    start = F.col("k") * PIECE
    pieces = pieces.select("lang", "hash", "k", F.substring(F.col("text"), F.greatest(start, F.lit(1)), F.when(F.col("k") > 0, PIECE + 2).otherwise(PIECE + 1)).alias("piece")).distinct()
    sample: dict[str, list[np.ndarray]] = {r.lang: [] for r in found}
    letter = _is_letter()
    for r in sorted(pieces.collect(), key=lambda r: (r.hash, r.k, r.piece)):  # the bounded sample
        before, body = (r.piece[0], r.piece[1:]) if r.k else (" ", r.piece)
        line = running(body[:PIECE])
        if len(line):
            line = line[1:] if letter[ord(before)] and letter[ord(body[0])] else line
            line = line[:-1] if len(body) > PIECE and letter[ord(body[PIECE])] and letter[ord(body[PIECE - 1])] else line
        sample[r.lang].append(line)
    return CrossParser(sample)


def _predict(shared, at: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, bits = shared.value.predict(batch.column(at).to_pylist())
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())], names=[*batch.schema.names, "lang_pred", "score", "bits"])

    return rows


def identify(docs: DataFrame, parser: CrossParser, keep: list[str]) -> DataFrame:
    """``keep`` (with text) of each row, lang_pred, score and bits (a character, by the predicted language)."""
    shared = docs.sparkSession.sparkContext.broadcast(parser)
    rows = docs.select(*keep)
    return rows.mapInArrow(lean(_predict(shared, keep.index("text"))), extended(rows, "lang_pred string, score double, bits double"))


def held_out(folds: int, fold: int) -> Column:
    """crc32 of the id as text, by its remainder; a null id counts as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")), F.lit(folds)) == fold
