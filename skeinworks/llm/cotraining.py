"""Quality classifier by co-training of a content view and a metadata view.

The content view sees the text only (its make-up of letters, symbols, words, lines and repetition); the metadata view
sees what is known about the page (source, language and recorded length), never the text. Both start from the labelled sample. In
each round each view labels the unlabelled pool, and its most confident rows of either class (``EXCHANGE`` of the pool, in the classes'
proportion) go to the other view's training set, weighted by how far the view's probability lies from its share of good rows: a view that
knows little teaches little. At the end each view is calibrated on a part of the labelled sample that it didn't see (``CALIBRATED``), and the calibrated log-odds are
combined by a small logistic model on it. ``Model.exchanged`` reports the labels that each view gave in each round, and ``Model.quality`` the area under the
curve of either view and of both on a part that is outside every fit (``REPORTED``; not a number where it lacks a class).

Training reads bounded hash samples (``LABELLED`` and ``POOL`` rows expected); all documents are scored.

Defined cases: a null text counts as empty, null metadata as their own value, unlike any string; a source or language that the sample
lacks counts as average; null labels are left out, several labels of one id count as their greatest, and of rows that share an id one
is learned from; without labels of both kinds every score is the share of good labels (0.5 without
any); repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.logistic import Logistic

LABELLED, POOL, ROUNDS, EXCHANGE = 6000, 6000, 4, 0.05
#: Shares of the labelled sample that calibration and mixture are fitted on, and that quality is told on.
CALIBRATED, REPORTED = 0.25, 0.1
#: Rows that the average counts as, beside those of a source or language.
PRIOR = 5.0
_SYMBOLS = re.compile(r"[^\w\s.,;:'\"!?()-]")
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))


def content_features(text: str | None) -> list[float]:
    text = text or ""
    data = text.encode()
    n = max(len(data), 1)
    words = text.split()
    m = max(len(words), 1)
    counts = Counter(words)
    lines = text.split("\n")
    ascii_letters = n - len(data.translate(None, bytes(range(65, 91)) + bytes(range(97, 123))))
    return [
        math.log1p(len(words)),
        len(data) / m,
        (n - len(data.translate(None, _UPPER))) / n,
        ascii_letters / n,
        (n - len(data.translate(None, _DIGIT))) / n,
        len(_SYMBOLS.findall(text)) / n,
        data.count(b"!") / m,
        data.count(b"|") / m,
        (data.count(b".") + data.count(b"?")) / m,
        data.count(b",") / m,
        len(counts) / m,
        sum(sorted(counts.values())[-3:]) / m,
        len(set(lines)) / len(lines),
        len(lines) / m,
        sum(len(w) > 15 for w in counts) / max(len(counts), 1),
        float(not words),
    ]


CONTENT = len(content_features(None))
Meta = tuple[str | None, str | None, int | None]


class MetadataView:
    """Features of (source, lang, n_chars): how good the rows of that source and language were, as log-odds, and the length."""

    def __init__(self, rows: list[Meta], labels: np.ndarray, weights: np.ndarray):
        total = max(weights.sum(), 1e-9)
        self.base = float(np.clip((weights * labels).sum() / total, 0.01, 0.99))
        self.sums: tuple[dict, dict] = ({}, {})
        for row, y, w in zip(rows, labels.tolist(), weights.tolist(), strict=True):
            for part, value in zip(self.sums, row, strict=False):
                s = part.setdefault(value, [0.0, 0.0])
                s[0] += w * y
                s[1] += w
        self.fit: Logistic | None = None
        # A row's own label is left out of its source's and language's, or these would only repeat it.
        self.fit = Logistic(self.features(rows, labels, weights), labels, sample_weight=weights)

    def features(self, rows: list[Meta], labels: np.ndarray | None = None, weights: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros((len(rows), 5))
        for i, row in enumerate(rows):
            y, w = (float(labels[i]), float(weights[i])) if labels is not None else (0.0, 0.0)
            for j, part in enumerate(self.sums):
                good, n = part.get(row[j], (0.0, 0.0)) if labels is None else part[row[j]]
                p = (good - y * w + PRIOR * self.base) / (n - w + PRIOR)
                out[i, j] = math.log(max(p, 1e-3) / max(1 - p, 1e-3))
            size = math.log1p(max(row[2] or 0, 0))
            out[i, 2:] = size, size * size, float(row[2] is None)
        return out

    def margin(self, rows: list[Meta]) -> np.ndarray:
        return self.fit.margin(self.features(rows))


class ContentView:
    def __init__(self, x: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        self.fit = Logistic(x, labels, sample_weight=weights)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.fit.margin(x)


def area(scores: np.ndarray, y: np.ndarray) -> float:
    """The chance that a good row scores above a bad one."""
    good, bad = scores[y == 1], np.sort(scores[y == 0])
    if not len(good) or not len(bad):
        return math.nan
    return float((np.searchsorted(bad, good, "left") + np.searchsorted(bad, good, "right")).mean() / (2 * len(bad)))


class Model:
    def __init__(self, views: tuple | None, cal: tuple[Logistic, Logistic] | None, mix: Logistic | None, base: float):
        self.views, self.cal, self.mix, self.base = views, cal, mix, base
        #: (round, view that gave, good labels, bad labels), and areas under the curve: content, metadata, both.
        self.exchanged: list[tuple[int, str, int, int]] = []
        self.quality: tuple[float, ...] = ()

    def scores(self, content: np.ndarray, meta: list[Meta]) -> np.ndarray:
        """Columns: content score, metadata score, combined score."""
        if self.views is None:
            return np.full((len(content), 3), self.base)
        odds = [np.clip(c.margin(v.margin(x)[:, None]), -12, 12) for v, c, x in zip(self.views, self.cal, (content, meta), strict=True)]
        return np.stack([*(1 / (1 + np.exp(-o)) for o in odds), self.mix.prob(np.stack(odds, axis=1))], axis=1)


def cotrain(content: np.ndarray, meta: list[Meta], y: np.ndarray, pool_content: np.ndarray, pool_meta: list[Meta], rounds: int = ROUNDS) -> Model:
    place = np.random.default_rng(4).random(len(y))
    held, own_rows, told = place < CALIBRATED, place >= CALIBRATED + REPORTED, (place >= CALIBRATED) & (place < CALIBRATED + REPORTED)
    if not len(y) or not all(k.any() and 0 < y[k].mean() < 1 for k in (held, own_rows)) or held.sum() < 20:
        return Model(None, None, None, float(y.mean()) if len(y) else 0.5)

    def part(rows, keep):
        return rows[keep] if isinstance(rows, np.ndarray) else [rows[i] for i in np.flatnonzero(keep).tolist()]

    own, pools, labels = [part(content, own_rows), part(meta, own_rows)], [pool_content, pool_meta], y[own_rows]
    base, exchanged = labels.mean(), []
    given: list[dict[int, tuple[float, float]]] = [{}, {}]  # pool rows that a view has been given: label and weight by place
    views: list = []
    for k in range(rounds + 1):
        views = []
        for v, make in enumerate((ContentView, MetadataView)):
            places = list(given[v])
            more = part(pools[v], np.isin(np.arange(len(pool_content)), places)) if places else None
            places.sort()
            rows = own[v] if more is None else (np.vstack([own[v], more]) if v == 0 else own[v] + more)
            taught = np.array([given[v][p] for p in places]).reshape(-1, 2)
            views.append(make(rows, np.concatenate([labels, taught[:, 0]]), np.concatenate([np.ones(len(labels)), taught[:, 1]])))
        if k == rounds or not len(pool_content):
            break
        for v, name in enumerate(("content", "metadata")):
            p = 1 / (1 + np.exp(-np.clip(views[v].margin(pools[v]), -30, 30)))
            order = np.argsort(p, kind="stable")
            n = max(2, int(EXCHANGE * len(p)))
            low = max(1, round(n * (1 - base)))
            counts = []
            for places, label in ((order[::-1][: max(1, n - low)], 1.0), (order[:low], 0.0)):
                sure = np.maximum((p[places] - base) / (1 - base) if label else (base - p[places]) / base, 0.0)
                new = {int(i): (label, float(w)) for i, w in zip(places, sure, strict=True) if w > 0 and int(i) not in given[1 - v]}
                given[1 - v] |= new
                counts.append(len(new))
            exchanged.append((k + 1, name, *counts))
    margins = [view.margin(part(x, held))[:, None] for view, x in zip(views, (content, meta), strict=True)]
    cal = [Logistic(m, y[held]) for m in margins]
    odds = np.stack([np.clip(c.margin(m), -12, 12) for c, m in zip(cal, margins, strict=True)], axis=1)
    model = Model(tuple(views), tuple(cal), Logistic(odds, y[held]), float(base))
    model.exchanged, model.quality = exchanged, tuple(area(s, y[told]) for s in model.scores(part(content, told), part(meta, told)).T) if told.any() else ()
    return model


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, list[Meta]]:
    cols = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("text", "source", "lang", "n_chars")]
    return np.array([content_features(t) for t in cols[0]], dtype=float).reshape(-1, CONTENT), list(zip(*cols[1:], strict=True))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [content_features(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        rest = ["source", "lang", "n_chars", "label"]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), *(batch.column(batch.schema.get_field_index(n)) for n in rest)], names=["c", *rest])


def train(docs: DataFrame, labels: DataFrame, training: Column) -> Model:
    def drawn(key: Column, expected: int, of: int) -> Column:
        return F.pmod(key, F.lit(1_000_000_007)) / F.lit(1_000_000_007.0) < min(1.0, expected / max(of, 1))

    rows = labels.select("doc_id", "quality").where(training & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    picked = rows.where(drawn(F.xxhash64("doc_id"), LABELLED, rows.count()))
    source = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars")).where("doc_id is not null")
    known = source.join(F.broadcast(picked), "doc_id")  # the sample's ids
    pool = source.where(drawn(F.xxhash64("doc_id", F.lit(4)), POOL, docs.count())).withColumn("label", F.lit(-1))
    form = "c array<double>, source string, lang string, n_chars long, label int"
    found = []
    for part in (known, pool):  # one row an id, so that a repeated id can't swell the sample
        one = part.groupBy("doc_id").agg(F.min(F.struct("text", "source", "lang", "n_chars", "label")).alias("row")).select("row.*")
        got = one.mapInArrow(_feature_rows, form).collect()
        got.sort(key=lambda r: (r.c, str(r.source), str(r.lang), r.n_chars or 0))
        found.append((np.array([r.c for r in got], dtype=float).reshape(-1, CONTENT), [(r.source, r.lang, r.n_chars) for r in got], np.array([r.label for r in got], dtype=float)))
    return cotrain(*found[0], *found[1][:2])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, content_score, metadata_score, score and predicted (1: good) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = shared.value.scores(*_views(batch))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[:, i]) for i in range(3))], names=["doc_id", "content_score", "metadata_score", "score"])

    source = docs.select(F.col("doc_id").cast("long"), "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    out = source.mapInArrow(rows, "doc_id long, content_score double, metadata_score double, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
