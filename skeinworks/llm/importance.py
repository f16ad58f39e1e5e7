"""Target-distribution importance resampling: documents whose hashed word runs look like the target's are drawn more often.

Features are all runs of one to three words, hashed into buckets by a vectorised byte automaton (``byte_words``). One scan counts the
buckets of all documents and one those of the target; a bucket's gain is the logarithm of the ratio of both smoothed shares, in
thousandths. A second scan adds the gains of each document's features. Adding Gumbel noise from a hash of the id and taking the highest
scores draws without replacement by weight. The rank is global without a global sort in one task: scores are dealt out by ranges,
each range numbers its rows, and the ranges' sizes (one number a range) say where each begins.

Only the gains (``BUCKETS`` numbers) and the ranges' sizes pass through the driver.

Defined cases: null texts have no features and weight 0; rows that share an id are rows like any other (ties between them go by their number of
features, then by their place); a null id hashes as an empty string and stands behind other ids in ties; an empty target or
table gives gains by the smoothing alone; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.byte_words import chunks, run_hashes
from skeinworks.llm.common import Scratch, lean

BUCKETS, LONGEST = 10_000, 3
#: Words of a document that can be drawn, and the percentage drawn.
LEAST_WORDS, PERCENT = 20, 5
#: Rows that one range of the ranking should have.
RANGE_ROWS = 1_000_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of all the task's texts by bucket."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, _, words in chunks(batch.column(0)):
            for _, crc in run_hashes(words, LONGEST):
                total += np.bincount(crc % BUCKETS, minlength=BUCKETS)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, name: str) -> DataFrame:
    """(bucket, ``name``) of a column of texts: the features that hash there, over all rows."""
    return texts.mapInArrow(lean(_counted), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(docs: DataFrame, target: DataFrame) -> list[int]:
    """Each bucket's gain in thousandths: the logarithm of its smoothed share in the target over that in the documents."""
    spark = docs.sparkSession
    s, t = bucket_counts(docs.select("text"), "s"), bucket_counts(target.select("text"), "t")
    held = s.join(t, "bucket", "full").na.fill(0)
    held = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(held, "bucket", "left").na.fill(0)
    held = Scratch(spark, "importance").write(held, "buckets")
    total = held.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1).cast("double") * (total.s + BUCKETS) / ((F.col("s") + 1).cast("double") * (total.t + BUCKETS))
    rows = held.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()  # BUCKETS rows
    return [r.gain for r in sorted(rows)]


def _weighed(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = np.array(shared.value, dtype=np.float64)
        for batch in batches:
            n = batch.num_rows
            n_words, n_features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for first, end, words in chunks(batch.column(1)):
                n_words[first:end] = words.counts()
                for at, crc in run_hashes(words, LONGEST):
                    n_features[first:end] += np.bincount(at, minlength=words.n_rows)
                    weight[first:end] += np.bincount(at, weights=gains[crc % BUCKETS], minlength=words.n_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (n_words, n_features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return rows


def weights(docs: DataFrame, gains: list[int]) -> DataFrame:
    """doc_id, n_words, n_features and weight (the sum of the features' gains) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_weighed(shared)), "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise in thousandths from a hash of the id."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column], count: int) -> DataFrame:
    """``rows`` (a stored table of ``count`` rows) in ``order`` with ``rank`` from 1; ranges of about ``RANGE_ROWS`` rows are numbered apart."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // RANGE_ROWS))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = Scratch(spark, "ranges").write(dealt, "ranges").withColumn("_range", F.shiftright("_at", 33))
    sizes = dict(dealt.groupBy("_range").count().collect())  # one row a range
    starts, before = [], 0
    for k in sorted(sizes):
        starts.append((k, before))
        before += sizes[k]
    held = spark.createDataFrame(starts, "_range long, _start long")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.join(F.broadcast(held), "_range").withColumn("rank", F.col("_start") + place + 1).drop("_range", "_start", "_at")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score, rank and n_words of each row; the drawn ones have a rank."""
    spark = docs.sparkSession
    scored = weights(docs, bucket_gains(docs, target)).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = Scratch(spark, "importance").write(scored.withColumn("_place", F.monotonically_increasing_id()), "scored")
    able = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("_place").asc()]
    count = scored.where(able).count()
    told = ranked(scored.where(able), order, count)
    told = told.withColumn("rank", F.when(F.col("rank") <= percent * count // 100, F.col("rank")))
    out = told.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
