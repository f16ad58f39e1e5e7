"""Secret scan by rules and character Markov models.

Three rules find assignments, access keys and long hexadecimal runs. The method adds to them: two character Markov
models (first order, backed off to single characters), one of random strings and one of ordinary identifiers, score every
token of a secret's alphabet from ``SHORTEST`` characters on by its log-likelihood ratio. The ratio is a sum over the token, so a
short one must be stranger than a long one; what its letters are doesn't matter otherwise.

Both models are trained from labelled samples: the values that the rules found in all texts against the other tokens of
a bounded sample of different texts (``SAMPLE_DOCS`` expected). A token's shape is which sorts of characters it has (small letters, capitals, digits, others; letters of both cases count as one sort with digits). Of each sort of label
and each shape some ``TOKENS`` different tokens are taken by hash, so that rare shapes, as shouted words are, stand beside the common ones. A quarter of the labelled tokens is
held back to fit a threshold for each shape: the least ratio that so few ordinary tokens of that shape exceed (``FALSE_SHARE``), and at least the odds against
a secret there. A shape that no labelled secret has is never a secret: nothing is known of secrets that look so. The share of held-back secrets that pass (rules off), and what share of all that pass are
secrets, stand in ``MarkovPair.report``, for the held-back tokens alone. Without labelled secrets nothing is added.

Offsets are code points, ends exclusive. Defined cases: a null text is empty; an empty text has no spans; repeated
rows are scanned alike; extra columns are ignored; of equal tokens with both labels the secret counts. Added spans never replace a
rule's span, and none is added that overlaps one. A table without texts adds nothing.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch, lean

KINDS = ("assign", "access", "hex", "markov")
#: Bounds of the training sample (texts, and tokens of a label and shape, both expected), the length from which a token is scored, and the share of ordinary tokens that may pass.
SAMPLE_DOCS, TOKENS, SHORTEST, FALSE_SHARE = 20_000, 20_000, 10, 1e-4
#: Scores that a task remembers.
MEMO = 100_000
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three rules by start, then kind as listed."""
    out = []
    low = text.lower()
    # Lower-casing may change lengths beyond ASCII, so it only tells whether the rule can match at all.
    if any(h in low for h in _HINTS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out


def _long_tokens(text: str, least: int) -> bool:
    return max(map(len, text.split()), default=0) >= least


def rule_spans(text: str | None) -> list[tuple[int, int, str]]:
    if not text:
        return []
    out = base_spans(text)
    if _long_tokens(text, 24):  # a hexadecimal run holds no white space
        out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


_SORTS = ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")


def shape(token: str) -> str:
    """Which sorts of characters a token has. Beside letters of both cases digits make no difference: without them too it is unlike a word."""
    found = "".join("01"[bool(re.search(sort, token))] for sort in _SORTS)
    return f"111{found[3]}" if found[:2] == "11" else found


class MarkovPair:
    """log P(token | random) - log P(token | ordinary) by two first-order models, and the threshold from which a token of a shape is a secret."""

    #: Characters of a secret's alphabet, and the weight of single characters against pairs.
    SIZE, BACK = 67, 8.0

    def __init__(self, secrets: list[str], ordinary: list[str]):
        self.thresholds: dict[str, float] = {}
        self.report = {"secrets": len(secrets), "ordinary": len(ordinary), "recall": 0.0, "precision": 0.0}
        fit, held = zip(*(self._halves(x) for x in (secrets, ordinary)), strict=True)
        if not fit[0] or not held[0]:
            self.ratio: dict[str, float] = {}
            return
        p1, p0 = (self._model(x) for x in fit)
        alphabet = sorted({c for x in fit for s in x for c in s})
        self.ratio = {c + d: math.log(p1(c, d)) - math.log(p0(c, d)) for c in ["^", *alphabet] for d in alphabet}
        by_shape: dict[str, list[float]] = {}
        for t in held[1]:
            by_shape.setdefault(shape(t), []).append(self.score(t))
        common = Counter(map(shape, ordinary))
        for kind, n in Counter(map(shape, secrets)).items():
            bad = sorted(by_shape.get(kind, ()))
            place = math.ceil((1 - FALSE_SHARE) * len(bad)) - 1
            self.thresholds[kind] = max(math.log(max(common[kind], 1) / n), bad[place] if bad else 0.0, 0.0)
        caught, wrong = (sum(map(self.secret, x)) for x in held)
        self.report |= {"recall": caught / len(held[0]), "precision": caught / max(caught + wrong, 1)}

    @staticmethod
    def _halves(tokens: list[str]) -> tuple[list[str], list[str]]:
        """Three quarters to fit the models, and a quarter held back."""
        return [t for t in tokens if zlib.crc32(t.encode()) % 4], [t for t in tokens if not zlib.crc32(t.encode()) % 4]

    @classmethod
    def _model(cls, tokens: list[str]):
        pairs = Counter(x for t in tokens for x in map("".join, zip(f"^{t}", t, strict=False)))
        before, single = Counter(), Counter()
        for g, k in pairs.items():
            before[g[0]] += k
            single[g[1]] += k
        total = sum(single.values())

        def chance(c: str, d: str) -> float:
            alone = (single[d] + 1) / (total + cls.SIZE)
            return (pairs[c + d] + cls.BACK * alone) / (before[c] + cls.BACK)

        return chance

    def score(self, token: str) -> float:
        get = self.ratio.get
        return sum(get(c + d, 0.0) for c, d in zip(f"^{token}", token, strict=False))

    def secret(self, token: str) -> bool:
        return self.score(token) > self.thresholds.get(shape(token), math.inf)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each text: the values that the rules found (1), and of the sample's texts all others (0)."""
    for batch in batches:
        out: dict[str, int] = {}
        for text, picked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            spans = rule_spans(text)
            for a, b, kind in spans:
                m = _ASSIGN.match(text, a) if kind == "assign" else None
                out[m[1] if m else text[a:b]] = 1
            for m in _TOKEN.finditer(text) if picked else ():
                if not any(a < m.end() and m.start() < b for a, b, _ in spans):
                    out.setdefault(m[0], 0)
        yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.string()), pa.array(out.values(), pa.int32())], names=["token", "label"])


def train(docs: DataFrame, sample: int = SAMPLE_DOCS, tokens: int = TOKENS) -> MarkovPair:
    """Both models and the thresholds, from the rules' values in all texts and the other tokens of a hash sample of different texts, read whole."""
    texts = docs.select("text").where("length(text) > 0").withColumn("hash", F.xxhash64("text"))
    rate = min(1.0, sample / max(texts.agg(F.approx_count_distinct("hash")).first()[0], 1))
    place = F.pmod(F.xxhash64("hash"), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
    found = texts.select("text", (place < rate).alias("picked")).mapInArrow(lean(_labelled), "token string, label int").groupBy("token").agg(F.max("label").alias("label"))
    kind = F.concat(*(F.col("token").rlike(sort).cast("int").cast("string") for sort in _SORTS))
    kind = F.when(kind.startswith("11"), F.concat(F.lit("111"), F.substring(kind, 4, 1))).otherwise(kind)
    found = Scratch(docs.sparkSession, "secrets").write(found.withColumn("shape", kind), "tokens")
    shares = found.groupBy("label", "shape").agg(F.least(F.lit(1.0), tokens / F.count("*")).alias("share"))  # two labels, 15 shapes
    kept = found.join(F.broadcast(shares), ["label", "shape"]).where(F.pmod(F.xxhash64("token"), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0) < F.col("share")).select("label", "token")
    rows = sorted((r.token, r.label) for r in kept.toLocalIterator())
    return MarkovPair([t for t, x in rows if x], [t for t, x in rows if not x])


def markov_spans(text: str | None, secret: Callable[[str], bool], taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    if not text or not _long_tokens(text, SHORTEST):
        return []
    return [(m.start(), m.end(), "markov") for m in _TOKEN.finditer(text) if secret(m[0]) and not any(a < m.end() and m.start() < b for a, b, _ in taken)]


def finder(model: MarkovPair) -> Callable[[str | None], list[tuple[int, int, str]]]:
    """All spans of a text by start, then kind as listed; tokens are scored once as long as they are remembered."""
    secret = functools.lru_cache(MEMO)(model.secret)

    def find(text: str | None) -> list[tuple[int, int, str]]:
        found = rule_spans(text)
        return sorted(found + markov_spans(text, secret, found), key=lambda x: (x[0], KINDS.index(x[2])))

    return find


def _told(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _scan(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(shared.value)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                spans = find(text)
                base = [x for x in spans if x[2] != "markov"]
                n = Counter(x[2] for x in base)
                out.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_told(base).encode()).hexdigest(), _told(spans)))
            cols = list(zip(*out, strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return rows


def scan(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """doc_id, counts of the rules' spans, the digest of these, and all spans as text."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_scan(shared)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None, spans: list[tuple[int, int, str]], mark: str = "[secret]") -> str | None:
    """The text with each span (overlapping ones merged) replaced by ``mark``; null stays null."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """The same rows and columns, with the text's secrets replaced and n_chars (if it is there) set anew."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(shared.value)
        for batch in batches:
            texts = [redacted(t, find(t)) for t in batch.column(at).to_pylist()]
            cols = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    out = docs.mapInArrow(lean(rows), docs.schema)
    changed = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out if changed is None else out.withColumn("n_chars", changed)
