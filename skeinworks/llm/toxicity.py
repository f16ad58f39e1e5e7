"""Toxicity by Levenshtein automata over a learned lexicon trie, with context windows.

The lexicon is learned from labelled rows, of which near copies of one text count once (the one with the least id): words and stems (word
beginnings with several endings) that stand in toxic texts far more often than chance allows among all words tested (stems: in texts with several such words), and with
a precision whose lower confidence bound is high. Both tests are the same at every size of the sample. Its trie is intersected with the Levenshtein automaton of one edit: a state is a set of trie nodes
with the edits spent, made when it is first reached, so a token costs a table look-up a letter and most tokens die
after a few letters. A token one edit from an entry that stands in other texts of the sample is an ordinary word, not a misspelling. Hits are counted by kind (exact, stem, one edit) and by context: a hit inside a pair of quotation marks
that lies within a window around it counts as quotation, any other as abuse. A logistic model of these counts gives the
score. It is fitted on hits by lexicons that didn't see the text: each half of the sample is counted with the other half's lexicon.

Training reads a bounded hash sample of the labelled rows (``SAMPLE`` rows expected), which also bounds its words; every word and stem that passes both tests is
an entry. All texts are scored whole.

Defined cases: a null or empty text has no hits and gets the score of such texts; null labels are left out, and several
labels of one id count as their greatest; of texts that share an id the least is learned from; without labels of both kinds every score is the share of toxic labels (0
without any label); repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch
from skeinworks.llm.logistic import Logistic

#: Bound of the sample: labelled rows (expected).
SAMPLE = 20_000
PREFIXES = range(3, 8)
#: An entry's lower confidence bound of precision (at so many standard errors), the chance of any false entry, and the endings of a stem.
PRECISION, ERRORS, CHANCE, ENDINGS = 0.6, 1.28, 0.05, 4
#: Entries of this length may be misspelled by one edit.
FUZZY_FROM = 5
CONTEXT = 80
#: Least shingle hashes that tell near copies among the sample.
SKETCH = 16
#: Words that a shorter text counts as in rates.
SHORT = 50
STATES = 200_000
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W_]+")
#: Digits that stand for letters.
_LETTERS = str.maketrans("013457", "oieast")
_OPEN, _CLOSE = "\"“«„", "\"”»“"


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class LexiconAutomaton:
    """``find(token)``: "exact", "stem" (a stem and more), "fuzzy" or None."""

    def __init__(self, words: list[str], stems: list[str], covered: list[str] | None = None, ordinary: Iterable[str] = ()):
        """``covered``: words that begin with a stem; as they are they count as the stem, misspelled as fuzzy. ``ordinary``: no misspellings."""
        self.ordinary = frozenset(ordinary)
        self.children: list[dict[str, int]] = [{}]
        self.word: dict[int, int] = {}
        self.stem: set[int] = set()
        for entry in [*words, *(covered or [])]:
            self.word[self._add(entry)] = len(entry)
        for entry in stems:
            self.stem.add(self._add(entry))
        self._reset()

    def _add(self, entry: str) -> int:
        n = 0
        for c in entry:
            if c not in self.children[n]:
                self.children[n][c] = len(self.children)
                self.children.append({})
            n = self.children[n][c]
        return n

    def _reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.says: list[str | None] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """Also the nodes reached by leaving out a letter of the lexicon's."""
        out = dict(nodes)
        for n, e in nodes.items():
            if e == 0:
                for m in self.children[n].values():
                    out[m] = min(out.get(m, 2), 1)
        return out

    def _state(self, nodes: dict[int, int] | None) -> int:
        """The state of nodes with edits spent; a whole stem is one by itself, and with anything after it (no nodes) another."""
        at = () if nodes is None else [n for n, e in nodes.items() if e == 0 and n in self.stem]
        key = ("stem",) if nodes is None else ("bare", any(n in self.word for n in at)) if at else tuple(sorted(nodes.items()))
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            if key == ("stem",):
                said = "stem"
            elif key[:1] == ("bare",):
                said = "exact" if key[1] else None
            elif any(e == 0 and n in self.word for n, e in key):
                said = "exact"
            elif any(self.word.get(n, 0) >= FUZZY_FROM for n, _ in key):
                said = "fuzzy"
            else:
                said = None
            self.says.append(said)
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        """The state after one more letter; -1 is dead."""
        key = self.sets[state]
        if key[:1] in (("stem",), ("bare",)):
            return self._state(None)
        nodes: dict[int, int] = {}
        for n, e in key:
            same = self.children[n].get(c)
            if same is not None:
                nodes[same] = min(nodes.get(same, 2), e)
            if e == 0:
                nodes[n] = min(nodes.get(n, 2), 1)
                for m in self.children[n].values():
                    nodes[m] = min(nodes.get(m, 2), 1)
        return self._state(self._closed(nodes)) if nodes else -1

    def find(self, token: str) -> str | None:
        if len(self.sets) > STATES:
            self._reset()
        state, moves = self.start, self.moves
        for c in token:
            to = moves[state].get(c)
            if to is None:
                to = moves[state][c] = self._move(state, c)
            if to < 0:
                return None
            state = to
        said = self.says[state]
        return None if said == "fuzzy" and token in self.ordinary else said


FEATURES = 10


def features(text: str | None, automaton: LexiconAutomaton) -> list[float]:
    """Counts of hits by kind and context, and their rate."""
    if not text:
        return [0.0] * FEATURES
    low = text.lower()
    find = automaton.find
    words = _WORD.findall(low)
    kinds = [(w, k) for w in set(words) if (k := find(w) or (find(w.translate(_LETTERS)) if not w.isalpha() else None))]
    if not kinds:
        return [0.0] * FEATURES
    kind = dict(kinds)
    counts = dict.fromkeys(("exact", "stem", "fuzzy"), 0)
    quoted = abuse = 0
    for m in _WORD.finditer(low):
        k = kind.get(m[0])
        if k is None:
            continue
        counts[k] += 1
        before, after = low[max(0, m.start() - CONTEXT) : m.start()], low[m.end() : m.end() + CONTEXT]
        inside = any(before.count(o) % 2 == 1 if o == c else before.rfind(o) > before.rfind(c) for o, c in zip(_OPEN, _CLOSE, strict=True)) and any(c in after for c in _CLOSE)
        quoted += inside
        abuse += not inside and k != "stem"  # a single word that begins like an insult isn't one yet
    log = np.log1p
    rates = (100 * n / max(len(words), SHORT) for n in (counts["exact"] + counts["fuzzy"], counts["stem"]))
    return [float(x) for x in (log(counts["exact"]), log(counts["stem"]), log(counts["fuzzy"]), abuse > 0, log(abuse), log(quoted), counts["fuzzy"] > 0, counts["stem"] > 1, *rates)]


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each word, each word beginning (marked by a caret), and two words or more with a beginning (by a plus): other
    and toxic ones of half 0, then of half 1."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array(c, pa.int64()) for c in zip(*counts.values(), strict=True))], names=["entry", "c0", "t0", "c1", "t1"])
        counts.clear()
        return out

    for batch in batches:
        for text, label, half in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("text", "label", "half")), strict=True):
            words = Counter(w for w in tokens(text) if len(w) >= 3)
            begun: Counter = Counter()
            for w, k in words.items():
                for n in PREFIXES:
                    if len(w) > n:
                        begun[w[:n]] += k
            for entry in (*words, *(f"^{b}" for b in begun), *(f"+{b}" for b, k in begun.items() if k > 1)):
                counts[entry][2 * half + label] += 1
            if len(counts) > 300_000:
                yield flush()
    if counts:
        yield flush()


def telling(toxic: int, clean: int, base: float, tested: int) -> bool:
    """Whether an entry of so many toxic and other texts is precise, and not by chance one of ``tested`` entries at a toxic share of ``base``."""
    n = toxic + clean
    if not toxic or not 0 < base < 1:
        return False
    p, z = toxic / n, ERRORS
    lower = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    gain = p * math.log(p / base) + ((1 - p) * math.log((1 - p) / (1 - base)) if clean else 0.0)
    return lower >= PRECISION and p > base and n * gain >= math.log(max(tested, 1) / CHANCE)


class Model:
    def __init__(self, words: list[str], stems: list[str], fit: Logistic | None, base: float, covered: list[str] | None = None):
        self.words, self.stems, self.fit, self.base, self.covered = words, stems, fit, base, covered
        self.ordinary: list[str] = []

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def ready(self) -> LexiconAutomaton:
        if "automaton" not in self.__dict__:
            self.automaton = LexiconAutomaton(self.words, self.stems, self.covered, self.ordinary)
        return self.automaton

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.fit is None:
            return np.full(len(texts), self.base)
        automaton = self.ready()
        return self.fit.prob(np.array([features(t, automaton) for t in texts], dtype=float).reshape(-1, FEATURES))


def _features_of(models: tuple[Model, Model]):
    """Features of each text by the lexicon that the other half gave."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [m.ready() for m in models]
        for batch in batches:
            texts, halves = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("text", "half"))
            found = [features(t, automata[1 - h]) for t, h in zip(texts, halves, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(batch.schema.get_field_index("label"))], names=["f", "label"])

    return rows


def _ordinary(models: list[Model]):
    """Words of other texts that one edit makes an entry, and whether they stand in such texts of half 0, of half 1."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [m.ready() for m in models]
        for batch in batches:
            near = [any(a.find(w) == "fuzzy" for a in automata) for w in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(near, pa.bool_()))

    return rows


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the ``SKETCH`` least hashes of the text's five-word shingles."""
    for batch in batches:
        found = []
        for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
            words = (text or "").encode().lower().split()
            found.append(sorted({zlib.crc32(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))})[:SKETCH])
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), *batch.columns], names=["sketch", *batch.schema.names])


def without_near_copies(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, label, text) and the half of each. Of texts that share their least shingle hash, those that share a good part of the sketch
    of the one with the least id go; others, which share a line, stay. Copies are always of one half."""
    keyed = rows.mapInArrow(_keyed, "sketch array<long>, doc_id long, label int, text string").withColumn("key", F.col("sketch")[0])
    first = keyed.groupBy("key").agg(F.min(F.struct("doc_id", "sketch")).alias("first"))
    shared = F.size(F.array_intersect("sketch", "first.sketch"))
    kept = keyed.join(first, "key").where((F.col("doc_id") == F.col("first.doc_id")) | (shared * 4 < F.greatest(F.size("sketch"), F.size("first.sketch"))))
    return kept.select("label", "text", F.pmod("key", F.lit(2)).cast("int").alias("half"))


def lexicon(found: dict[str, int], endings: Iterable[str]) -> Model:
    """Words and stems of the telling entries; ``found`` has their toxic documents, beginnings marked by a caret or a plus.

    A stem is a telling beginning of several of the words ``endings``, as long as its longer form covers nearly the same documents.
    """
    sure = [e for e in found if e[0] not in "^+"]
    begun: dict[str, int] = {}
    for e, n in found.items():
        if e[0] in "^+":
            begun[e[1:]] = max(n, begun.get(e[1:], 0))
    endings = set(endings)
    stems: list[str] = []
    for entry in sorted(begun, key=lambda e: (len(e), e)):
        if any(entry.startswith(x) or x.startswith(entry) for x in stems):
            continue
        while longer := [e for e in begun if len(e) == len(entry) + 1 and e.startswith(entry) and begun[e] >= 0.9 * begun[entry]]:
            entry = longer[0]
        if sum(w.startswith(entry) for w in endings) >= ENDINGS:
            stems.append(entry)
    words = [e for e in sure if not e.startswith(tuple(stems))] if stems else sure
    return Model(words, stems, None, 0.0, [e for e in sure if stems and e.startswith(tuple(stems))])


def train(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> Model:
    rows = labels.select("doc_id", "toxic").where(training & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
    picked = rows.where(place < min(1.0, sample / max(rows.count(), 1)))
    labelled = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # the sample's ids
    single = labelled.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))
    one = Scratch(docs.sparkSession, "toxicity").write(without_near_copies(single), "sample")
    sizes = {(r.half, r.label): r["count"] for r in one.groupBy("half", "label").count().collect()}
    n, toxic = sum(sizes.values()), sum(c for (_, label), c in sizes.items() if label)
    base = toxic / n if n else 0.0
    if not 0 < base < 1:
        return Model([], [], None, base)
    stats = one.mapInArrow(_stats, "entry string, c0 long, t0 long, c1 long, t1 long").groupBy("entry").agg(*(F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")))
    stats = Scratch(docs.sparkSession, "toxicity").write(stats, "stats")
    tested = stats.where("c0 + t0 + c1 + t1 > 1").count()
    # What is telling in one half, or in all, has mostly toxic texts there.
    able = stats.where("t0 + t1 >= 2 and (t0 > c0 or t1 > c1 or t0 + t1 > c0 + c1)").orderBy(F.desc(F.col("t0") + F.col("t1")), "entry").collect()  # words of the sample
    models = []
    for halves in ((0,), (1,), (0, 1)):
        here = sum(c for (h, _), c in sizes.items() if h in halves)
        share = sum(c for (h, label), c in sizes.items() if h in halves and label) / max(here, 1)
        counts = {r.entry: (sum(r[f"t{h}"] for h in halves), sum(r[f"c{h}"] for h in halves)) for r in able}
        models.append(lexicon({e: t for e, (t, c) in counts.items() if telling(t, c, share, tested)}, [e for e, (t, c) in counts.items() if t > c and e[0] not in "^+"]))
    plain = stats.where("c0 + c1 > 0 and left(entry, 1) not in ('^', '+')").selectExpr("entry", "c0 > 0 as c0", "c1 > 0 as c1")
    for r in plain.mapInArrow(_ordinary(models), "entry string, c0 boolean, c1 boolean").collect():  # a part of the sample's words
        for model, here in zip(models, (r.c0, r.c1, True), strict=True):
            if here:
                model.ordinary.append(r.entry)
    for model in models:
        model.__dict__.pop("automaton", None)
    sampled = one.mapInArrow(_features_of(tuple(models[:2])), "f array<double>, label int").toPandas()
    model = models[2]
    model.base, model.fit = base, Logistic(np.array(sampled["f"].tolist(), dtype=float), sampled["label"].to_numpy(dtype=float))
    return model


def _score(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return rows


def score(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_score(shared), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
