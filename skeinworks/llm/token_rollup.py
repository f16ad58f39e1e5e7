"""Delta-maintained token counts.

A rollup keeps additive totals of documents and tokens by source, language and tokenizer version. Batches carry signed
changes: an insert adds a document's count, a delete takes it away, a revision takes the old count away and adds the
new one. A batch is counted on executors, summed by key (with map-side combining, so a source with most rows is no hot
task), and its deltas are written to a folder of their own. The commit is a small file under the batch's id that can be put only once, so of
several writers of one id one counts, and a batch that died half-way is no batch. Committing an id again changes nothing.

Totals are maintained: ``compact`` adds the batches since the last snapshot to its totals, and puts a new snapshot with the ids that it adds. A
reader takes the newest snapshot and the batches that no snapshot contains. What a snapshot replaces stays until ``vacuum`` finds it replaced long enough ago,
so that totals read before a compaction can still be collected after it.

Defined cases: null texts have no tokens but count as documents; null sources and languages are keys of their own;
repeated rows count each; keys whose documents and tokens sum to nought are left out of the totals; extra columns are
ignored; a row whose sign is null is ignored; an empty batch is committed and changes nothing.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.functions.files import Files
from skeinworks.llm.common import Scratch, shared_dir
from skeinworks.llm.tokens import Encoder, default_tokenizer

KEY = ["source", "lang", "tokenizer"]
FORM = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
WORDS = "words-1"
BPE = "byte-bpe-50k-1"


def _counted(versions: dict[str, str | None]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {v: (lambda t, e=Encoder.of(path): e.count(t)) if path else (lambda t: len(t.encode().split()) if t else 0) for v, path in versions.items()}
        for batch in batches:
            sums: dict[tuple, list[int]] = {}
            for text, source, lang, sign in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for v, count in counters.items():
                    s = sums.setdefault((source, lang, v), [0, 0])
                    s[0] += sign
                    s[1] += sign * count(text)
            cols = list(zip(*((*k, *s) for k, s in sums.items()), strict=True)) or [()] * 5
            types = [pa.string()] * 3 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[*KEY, "n_docs", "n_tokens"])

    return rows


def deltas(changes: DataFrame, versions: dict[str, str | None]) -> DataFrame:
    """Signed sums by key of rows (text, source, lang, sign); ``versions``: tokenizer file by version, None for words."""
    rows = changes.select(F.col("text").cast("string"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("sign").cast("long")).where("sign is not null")
    return rows.mapInArrow(_counted(versions), FORM).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class TokenRollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def _put(self, name: str, rows: DataFrame, **more) -> bool:
        """Write rows to a new folder, then its name under ``name`` unless somebody was first; then the folder goes."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        if self.files.put_if_absent(name, json.dumps({"folder": folder, **more})):
            return True
        self.files.delete(folder)
        return False

    def _told(self, kind: str) -> dict[str, dict]:
        """What was put: batches by id, snapshots by number."""
        names = sorted(n for n in self.files.names(kind) if n.endswith(".json") and not n.startswith("."))
        return {n.removesuffix(".json"): json.loads(self.files.read(f"{kind}/{n}")) for n in names}

    def _state(self) -> tuple[str | None, dict[str, str], int]:
        """The newest snapshot's folder, the folders of the batches that no snapshot contains, and the number of snapshots. Snapshots are
        looked at first: a batch put meanwhile is in neither, and is one that came later."""
        snapshots = self._told("snapshots")
        held = {i for s in snapshots.values() for i in s["ids"]}
        batches = {n.removesuffix(".json") for n in self.files.names("batches") if n.endswith(".json") and not n.startswith(".")}
        folders = {i: json.loads(self.files.read(f"batches/{i}.json"))["folder"] for i in sorted(batches - held)}
        return (snapshots[max(snapshots)]["folder"] if snapshots else None), folders, len(snapshots)

    def committed(self) -> list[str]:
        return sorted(n.removesuffix(".json") for n in self.files.names("batches") if n.endswith(".json") and not n.startswith("."))

    def commit(self, batch_id: str, changes: DataFrame, versions: dict[str, str | None]) -> bool:
        """Apply a batch of signed rows; False if that id is committed already, by whomever."""
        if not re.fullmatch(r"\w[\w.-]*", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        return not self.files.exists(f"batches/{batch_id}.json") and self._put(f"batches/{batch_id}.json", deltas(changes, versions))

    def _sum(self, snapshot: str | None, batches: dict[str, str]) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in [*([snapshot] if snapshot else []), *batches.values()]]
        rows = self.spark.read.schema(FORM).parquet(*paths) if paths else self.spark.createDataFrame([], FORM)
        out = rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return out.where("n_docs <> 0 or n_tokens <> 0")

    def totals(self) -> DataFrame:
        return self._sum(*self._state()[:2])

    def compact(self) -> bool:
        """A new snapshot of the totals; False if there is nothing to add, or another compaction was first."""
        snapshot, batches, count = self._state()
        return bool(batches) and self._put(f"snapshots/{count + 1:012d}.json", self._sum(snapshot, batches), ids=sorted(batches))

    def vacuum(self, keep_seconds: float = 7 * 86400.0, now: float | None = None) -> list[str]:
        """Remove the folders that snapshots replaced so long ago, and folders as old that nobody put; returns their names."""
        oldest = ((time.time() if now is None else now) - keep_seconds) * 1000
        times, snapshots, batches = self.files.names("snapshots"), self._told("snapshots"), self._told("batches")
        kept, before = {x["folder"] for x in (*snapshots.values(), *batches.values())}, None
        for n in sorted(snapshots):
            if times[f"{n}.json"] < oldest:
                kept -= {batches[i]["folder"] for i in snapshots[n]["ids"]} | ({snapshots[before]["folder"]} if before else set())
            before = n
        gone = [f"data/{n}" for n, at in self.files.names("data").items() if at < oldest and f"data/{n}" not in kept]
        for name in gone:
            self.files.delete(name)
        return gone


def inserts(docs: DataFrame, sign: int = 1) -> DataFrame:
    return docs.select("text", "source", "lang", F.lit(sign).alias("sign"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Takes the old rows' counts away and adds the new rows'."""
    return inserts(old, -1).unionByName(inserts(new, 1))


def rollup_documents(docs: DataFrame, root: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """The token counts of all documents under word counts and a byte-pair tokenizer, maintained through a whole life:

    all documents are inserted as drafts (white space collapsed), the same batch is replayed, those that the final texts change are revised, later
    copies of a text are deleted and, as they belong to the table, inserted again. Between the batches the totals are compacted. The end
    is the counts of the table as it is. ``root`` holds the rollup; without one it is made for the call and goes at its end.
    """
    spark = docs.sparkSession
    rollup = TokenRollup(spark, root or f"{shared_dir(spark)}/token-rollup-{uuid.uuid4().hex}")
    versions = {WORDS: None, BPE: tokenizer or default_tokenizer()}
    rows = docs.select("doc_id", "text", "source", "lang")
    draft = F.trim(F.regexp_replace("text", r"\s+", " "))
    drafts = inserts(rows.withColumn("text", draft))
    rollup.commit("drafts", drafts, versions)
    rollup.commit("drafts", drafts, versions)
    rollup.compact()
    changed = rows.where(~draft.eqNullSafe(F.col("text")))
    rollup.commit("final", revisions(changed.withColumn("text", draft), changed), versions)
    hashed = rows.withColumn("hash", F.unhex(F.md5(F.col("text").cast("binary"))))
    first = hashed.where("hash is not null").groupBy("hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = Scratch(spark, "copies").write(hashed.join(first, "hash").where("doc_id > first").select("text", "source", "lang"), "copies")
    rollup.commit("copies", inserts(copies, -1), versions)
    rollup.compact()
    rollup.commit("copies-again", inserts(copies), versions)
    if root:
        return rollup.totals()
    out = Scratch(spark, "token-totals").write(rollup.totals(), "totals")
    rollup.files.delete()
    return out
