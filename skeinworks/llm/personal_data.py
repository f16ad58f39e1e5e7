"""Personal data by rules, and by weak supervision where the rules end.

Four rules (email, ip, card, phone) give the base spans. The method adds spans that no rule describes: addresses written out, numbers to
call without a country code, account numbers, hosts of eight groups, titled names. Every candidate, the rules' own matches (kept or dropped)
included, is judged by labelers of three sorts: regular expressions (form, checksum), gazetteers, and its context (cue words before it, what
touches it, personal data near it). Each votes for, against, or not at all. Expectation-maximisation estimates from all candidates' votes how far each
labeler can be trusted in each topic; rules' spans are known to be personal data, all others are not known. A logistic model of votes and shape is then fitted
to the estimated probabilities, and what it gives ``LEAST`` or more is added where it overlaps nothing found before.

Votes and shapes are small numbers, so all candidates are told by how many there are of each combination: the counts are taken over all
documents and only the combinations pass through the driver. Of more than ``COMBINATIONS`` a hash sample is used for fitting; every candidate is scored.

Offsets are code points, ends exclusive. Defined cases: a null text is empty and has no spans; repeated rows and ids are scanned alike; a
table without candidates adds nothing; extra columns are ignored. Matching takes time in proportion to the text, however long its runs.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch, lean
from skeinworks.llm.logistic import Logistic

BASE = ("email", "ip", "card", "phone")
#: Topic of each kind; those behind the rules' kinds are added by the method.
TOPIC = {"email": "mail", "ip": "host", "card": "account", "phone": "call", "mail": "mail", "call": "call", "account": "account", "host": "host", "person": "person"}
KINDS, TOPICS = tuple(TOPIC), tuple(dict.fromkeys(TOPIC.values()))
#: Least probability of an added span, combinations that models are fitted to, characters of context.
LEAST, COMBINATIONS, BEFORE, NEAR = 0.9, 20_000, 40, 80

#: The rules' patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: What else may be personal data.
_CALL = re.compile(r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{2,5}\)[\x20.-]?|[0-9]{2,5}[\x20./-])[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,4}(?![0-9A-Za-z])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_SOCIAL = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_HOST = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_WRITTEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z0-9-]{2,63}){1,4}(?![A-Za-z0-9])")
#: Forms of address.
TITLES = ["Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame"]
_PERSON = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, TITLES))})\x20[^\W\d_a-z][^\W\d_A-Z]+(?:\x20[^\W\d_a-z][^\W\d_A-Z]+){{0,2}}")

#: Gazetteers of endings of addresses, calling codes, card issuers' first digits, countries of account numbers, and given names.
DOMAINS = frozenset("com org net edu gov info io de fr es uk it eu us".split())
CALLING = ("+1", "+33", "+34", "+39", "+44", "+49")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "65")
COUNTRIES = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "ES": 24, "FR": 27, "GB": 22, "IT": 27, "NL": 18, "PT": 25}
GIVEN = frozenset("James Mary John Linda Robert Susan Michael Karen William Nancy Hans Peter Klaus Sabine Monika Petra Pierre Jean Marie Claire Sophie Carlos José Juan Carmen Lucía Pilar Thomas Anna Paul Laura".split())
#: Cue words by topic, and words that tell other kinds of numbers.
CUES = {
    "mail": "mail email e-mail mailto contact write reach correo courriel adresse",
    "host": "ip host server client address adresse dirección peer",
    "account": "card iban account ssn visa mastercard konto karte cuenta tarjeta compte carte social security",
    "call": "phone tel telephone call mobile cell fax whatsapp teléfono telefon téléphone handy móvil",
    "person": "name named contact patient customer signed regards nombre nom kunde",
}
OTHERWISE = frozenset("version release build isbn issn order invoice item sku chapter section page figure table lot part serial ticket doi commit sha id ref".split())
_CUES = {topic: frozenset(words.split()) for topic, words in CUES.items()}
_WORDS = re.compile(r"[^\W\d_][\w-]*")

Span = tuple[int, int, str]


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def octets(address: str) -> bool:
    """Whether all parts are 255 at most, however many noughts they begin with."""
    return all(len(x) <= 3 and int(x or 0) <= 255 for x in (part.lstrip("0") for part in address.split(".")))


def mod97(account: str) -> bool:
    """Whether an account number's own check holds: its first four characters moved behind, letters as numbers from 10, modulo 97 is 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The rule's matches, found from their at-signs: a local part goes back as far as it can, but not into the match before."""
    end = 0
    for m in _DOMAIN.finditer(text):
        a = m.start()
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            yield a, m.end()
            end = m.end()


def rule_matches(text: str | None) -> tuple[list[Span], list[Span]]:
    """The rules' spans by kind as listed, then start; and their matches that failed."""
    kept: list[Span] = []
    failed: list[Span] = []
    if not text:
        return kept, failed
    if "@" in text:
        kept += [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            (kept if octets(m[0]) else failed).append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                if 13 <= len(digits) <= 19:
                    (kept if len(digits) >= 16 and luhn(digits) else failed).append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                (kept if 8 <= len(_digits(m[0])) <= 15 else failed).append((*m.span(), "phone"))
    return kept, failed


def _proposed(text: str) -> Iterator[Span]:
    """Spans beyond the rules that may be personal data."""
    if _DIGIT.search(text):
        for pattern, kind in ((_SOCIAL, "account"), (_IBAN, "account"), (_CALL, "call")):
            yield from ((*m.span(), kind) for m in pattern.finditer(text))
        if text.count(":") >= 7:
            yield from ((*m.span(), "host") for m in _HOST.finditer(text))
    if "(at)" in text or "[at]" in text or (" at " in text and " dot " in text):
        yield from ((*m.span(), "mail") for m in _WRITTEN.finditer(text))
    if any(t in text for t in TITLES):
        yield from ((*m.span(), "person") for m in _PERSON.finditer(text) if all(w[0].isupper() for w in m[0].split(" ")[1:]))


# Labelers: each says 1, -1 or, without an opinion, 0 -------------------------------------------------------------------------------


def _form(text: str, a: int, b: int, kind: str, near: bool) -> int:
    """Regular expressions: whether the form is one that such data mostly has."""
    said = text[a:b]
    if kind == "call":
        return 1 if said[0] == "(" or 9 <= len(_digits(said)) <= 13 else -1
    if kind == "mail":
        return 1 if "(" in said or "[" in said or " dot " in said else -1
    if kind == "person":
        return 1 if said.count(" ") >= 2 else -1
    return 0


def _check(text: str, a: int, b: int, kind: str, near: bool) -> int:
    """Regular expressions with arithmetic: checksums and ranges."""
    said = text[a:b]
    if kind == "card":
        return 1 if luhn(_digits(said)) else -1
    if kind == "ip":
        return 1 if octets(said) else -1
    if kind == "account":
        if said[0].isalpha():
            return 1 if mod97(said.replace(" ", "")) else -1
        return -1 if said[:3] in ("000", "666") or said[0] == "9" or said[4:6] == "00" or said[7:] == "0000" else 1
    return 0


def _gazetteer(text: str, a: int, b: int, kind: str, near: bool) -> int:
    said = text[a:b]
    if kind in ("email", "mail"):
        return 1 if re.split(r"[^A-Za-z0-9]+", said.rstrip(")]"))[-1].lower() in DOMAINS else -1
    if kind == "phone":
        return 1 if said.startswith(CALLING) else 0
    if kind == "card":
        return 1 if said.startswith(ISSUERS) else -1
    if kind == "account" and said[0].isalpha():
        return 1 if COUNTRIES.get(said[:2]) == len(said.replace(" ", "")) else -1
    if kind == "person":
        return 1 if any(w in GIVEN for w in said.split(" ")[1:]) else 0
    return 0


def _cue(text: str, a: int, b: int, kind: str, near: bool) -> int:
    """Context: the topic's words shortly before, or words that tell another kind of number."""
    words = [w.lower() for w in _WORDS.findall(text[max(0, a - BEFORE) : a])]
    if OTHERWISE.intersection(words[-2:]):
        return -1
    return 1 if _CUES[TOPIC[kind]].intersection(words) else 0


def _edges(text: str, a: int, b: int, kind: str, near: bool) -> int:
    """Context: whether the span stands by itself or inside something longer."""
    before, after = text[a - 1 : a], text[b : b + 1]
    inside = before.isalnum() or after.isalnum() or before in ("=", "/", "#", "_", "$", "€") and before or after in ("/", "_", "%", "=") and after
    return -1 if inside else 1


def _company(text: str, a: int, b: int, kind: str, near: bool) -> int:
    """Context: personal data that a rule found, close by."""
    return 1 if near else 0


LABELERS: dict[str, Callable[[str, int, int, str, bool], int]] = {"form": _form, "checksum": _check, "gazetteer": _gazetteer, "cue": _cue, "edges": _edges, "company": _company}


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if not c.isalnum() else 3


def candidates(text: str | None, kept: list[Span], failed: list[Span]) -> list[tuple[Span, str]]:
    """Each candidate with its votes and shape as one word; the rules' spans are marked as known."""
    if not text:
        return []
    ends = sorted((a, b) for a, b, _ in kept)
    starts = [a for a, _ in ends]
    covered = [b for _, b in ends]
    for i in range(1, len(covered)):
        covered[i] = max(covered[i], covered[i - 1])

    def near(a: int, b: int, gap: int, itself: bool) -> bool:
        """Whether a rule's span (another one, if this is one itself) lies within ``gap`` characters."""
        first, last = bisect_left(covered, a - gap + 1), bisect_left(starts, b + gap)
        return sum((x, y) != (a, b) or not itself for x, y in ends[first : min(last, first + 3)]) > 0

    free = [s for s in (*failed, *_proposed(text)) if not near(s[0], s[1], 0, False)]
    out = []
    for known, spans in ((True, kept), (False, free)):
        for a, b, kind in spans:
            votes = "".join("-0+"[1 + f(text, a, b, kind, near(a, b, NEAR, known))] for f in LABELERS.values())
            said = text[a:b]
            shape = (min(len(_DIGIT.findall(said)), 20), min(len(re.findall(r"[\x20().:-]+", said)), 6), _side(text[a - 1 : a] if a else ""), _side(text[b : b + 1]))
            out.append(((a, b, kind), f"{int(known)} {kind} {votes} {' '.join(map(str, shape))}"))
    return out


class SpanModel:
    """Reliabilities of the labelers by topic, and the classifier fitted to the probabilities that follow from them."""

    #: Weight of what is taken for granted at first: the share of personal data among candidates, votes for given that it is, votes against given that it isn't.
    STRENGTH, SHARE, FOR, AGAINST = 20.0, 0.3, 0.8, 0.7

    def __init__(self, combinations: list[tuple[str, int]]):
        self.fit: Logistic | None = None
        self.prob = functools.lru_cache(100_000)(self._prob)
        n = np.array([k for _, k in combinations], dtype=float)
        known = np.array([c[0] == "1" for c, _ in combinations], dtype=bool)
        votes, topic = self._votes([c for c, _ in combinations])
        p = self.estimate(votes, topic, n, known)
        if len(n) and 0 < (n * p).sum() < n.sum():
            x = np.array([self.features(c) for c, _ in combinations])
            y = np.repeat([1.0, 0.0], len(n))
            self.fit = Logistic(np.vstack([x, x]), y, sample_weight=np.concatenate([n * p, n * (1 - p)]))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "prob"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.prob = functools.lru_cache(100_000)(self._prob)

    @staticmethod
    def _votes(combinations: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [c.split(" ") for c in combinations]
        votes = np.array([["-0+".index(v) - 1 for v in p[2]] for p in parts], dtype=int).reshape(-1, len(LABELERS))
        return votes, np.array([TOPICS.index(TOPIC[p[1]]) for p in parts], dtype=int)

    def estimate(self, votes: np.ndarray, topic: np.ndarray, n: np.ndarray, known: np.ndarray, rounds: int = 200) -> np.ndarray:
        """Probability that each combination is personal data; sets ``share``, ``right`` (votes for, of what is) and ``wrong`` (votes against, of what isn't)."""
        shape = (len(TOPICS), votes.shape[1])
        self.share, self.right, self.wrong = np.full(len(TOPICS), self.SHARE), np.full(shape, self.FOR), np.full(shape, self.AGAINST)
        ayes, noes, p = votes > 0, votes < 0, np.where(known, 1.0, self.SHARE)
        for _ in range(rounds):
            a, b = self.right[topic], self.wrong[topic]
            odds = np.log(self.share / (1 - self.share))[topic] + np.where(ayes, np.log(a / (1 - b)), 0).sum(axis=1) + np.where(noes, np.log((1 - a) / b), 0).sum(axis=1)
            new = np.where(known, 1.0, 1 / (1 + np.exp(-np.clip(odds, -500, 500))))
            moved, p = np.abs(new - p).max(initial=0.0), new
            for t in range(len(TOPICS)):
                here = topic == t
                w, free = n[here] * p[here], here & ~known
                self.share[t] = (self.STRENGTH * self.SHARE + (n * p)[free].sum()) / (self.STRENGTH + n[free].sum())
                self.right[t] = (self.STRENGTH * self.FOR + w @ ayes[here]) / (self.STRENGTH + w @ (ayes | noes)[here])
                w = n[here] * (1 - p[here])
                self.wrong[t] = (self.STRENGTH * self.AGAINST + w @ noes[here]) / (self.STRENGTH + w @ (ayes | noes)[here])
            if moved < 1e-9:
                break
        return p

    @staticmethod
    def features(combination: str) -> list[float]:
        _, kind, votes, digits, groups, before, after = combination.split(" ")
        out = [0.0] * (len(TOPICS) * len(LABELERS))
        for j, v in enumerate(votes):
            out[TOPICS.index(TOPIC[kind]) * len(LABELERS) + j] = "-0+".index(v) - 1.0
        return [*out, *(float(TOPIC[kind] == t) for t in TOPICS), math.log1p(int(digits)), float(groups), *(float(int(s) == k) for s in (before, after) for k in (0, 1, 2))]

    def _prob(self, combination: str) -> float:
        return float(self.fit.prob(np.array([self.features(combination)]))[0]) if self.fit else 0.0

    def report(self) -> dict[str, dict[str, tuple[float, float]]]:
        """By topic and labeler: how often it votes for what is personal data, and against what isn't, when it votes."""
        return {t: {name: (float(self.right[i, j]), float(self.wrong[i, j])) for j, name in enumerate(LABELERS)} for i, t in enumerate(TOPICS)}


def added_spans(found: list[tuple[Span, str]], model: SpanModel) -> list[Span]:
    """Candidates that are likely enough, the likeliest first, without those that overlap one before."""
    likely = sorted((-p, s) for s, c in found if c[0] == "0" and (p := model.prob(c)) >= LEAST)
    out: list[Span] = []
    for _, (a, b, kind) in likely:
        if not any(a < y and x < b for x, y, _ in out):
            out.append((a, b, {"card": "account", "ip": "host", "phone": "call"}.get(kind, kind)))
    return out


def told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (KINDS.index(s[2]), s)))


_FOUND = "doc_id long, base array<struct<a:int,b:int,kind:string>>, found array<struct<a:int,b:int,kind:string,votes:string>>"
_SPAN = [("a", pa.int32()), ("b", pa.int32()), ("kind", pa.string())]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, found = [], []
        for text in batch.column(1).to_pylist():
            kept, failed = rule_matches(text)
            base.append([{"a": a, "b": b, "kind": k} for a, b, k in kept])
            found.append([{"a": a, "b": b, "kind": k, "votes": c} for (a, b, k), c in candidates(text, kept, failed)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(pa.struct(_SPAN))), pa.array(found, pa.list_(pa.struct([*_SPAN, ("votes", pa.string())])))], names=["doc_id", "base", "found"])


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id, the rules' spans and all candidates with their votes, written to the shared folder; texts are read once."""
    return Scratch(docs.sparkSession, "personal").write(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_scanned), _FOUND), "found")


def train(found: DataFrame) -> SpanModel:
    """The model from the candidates of all documents."""
    counts = Scratch(found.sparkSession, "personal").write(found.select(F.explode("found.votes").alias("votes")).groupBy("votes").agg(F.count("*").alias("n")), "votes")
    rate = min(1.0, COMBINATIONS / max(counts.count(), 1))
    kept = counts.where(F.pmod(F.xxhash64("votes"), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0) < rate)
    return SpanModel(sorted((r.votes, r.n) for r in kept.toLocalIterator()))


def _told(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for base, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept = [(s["a"], s["b"], s["kind"]) for s in base]
                n = Counter(k for _, _, k in kept)
                more = added_spans([((s["a"], s["b"], s["kind"]), s["votes"]) for s in found], shared.value)
                out.append((*(n[k] for k in BASE), hashlib.sha256(told(kept).encode()).hexdigest(), told(kept + more)))
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(cols))], names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return rows


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the rules' spans by kind, their digest, and all spans as text."""
    found = find_candidates(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train(found))
    return found.mapInArrow(lean(_told(shared)), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def spans_of(text: str | None, model: SpanModel) -> list[Span]:
    """All spans of a text by their place."""
    kept, failed = rule_matches(text)
    return sorted(kept + added_spans(candidates(text, kept, failed), model))


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping ones the first names all. Null stays null."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """The same rows and columns with personal data replaced in the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(find_candidates(docs)))
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [redacted(t, spans_of(t, shared.value)) for t in batch.column(at).to_pylist()]
            cols = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return docs.mapInArrow(lean(rows), docs.schema)
