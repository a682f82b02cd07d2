"""Quality selection by importance resampling.

Two generative models of hashed n-grams (words and word pairs, ``BUCKETS``
buckets, add-one smoothing): the target's, learned from texts labelled as
good, and the raw corpus's, counted over all documents.  A document's log
weight is the log ratio of its probability under the two.  Adding a Gumbel
variate, fixed by the document's id, to each log weight and taking the k
largest sums samples k documents without replacement in proportion to their
weights.

k is the share of good texts among the labelled ones times the number of
documents, unless given.  The k-th largest key is found exactly by narrowing
a histogram (``BINS`` sums a pass), so neither the driver nor a task holds
more than ``BINS`` keys.  The target is learned from at most ``SAMPLE``
labelled texts, the lowest by hash of doc_id; the raw model has no bound.

Defined results: null and empty texts have log weight 0; equal keys go to the
smaller doc_id; rows equal in doc_id and text are taken or left together;
without good labels both models are equal, and the sample is uniform; an
empty table gives an empty one; very long texts are read whole, in the task of
their row; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import column, map_batches, map_columns, mix64, staged, utf8
from tessera.llm.words import word_hashes

BUCKETS = 1 << 14
SAMPLE = 20_000
BINS = 4_096
SEED = 17


def features(texts: list[bytes | None], buckets: int = BUCKETS) -> list[np.ndarray]:
    """For each text the buckets of its words and word pairs."""
    out = []
    for h in word_hashes(texts):
        pairs = mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
        out.append((np.concatenate([h, pairs]) % np.uint64(buckets)).astype(np.int64))
    return out


def _counts(texts: DataFrame, buckets: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for f in features(utf8(b, "text"), buckets):
                total += np.bincount(f, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in map_batches(texts.select("text"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]  # one row a bucket
    return out


def log_ratio(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw)."""
    good = labels.filter("doc_id is not null and quality = 1").select(F.col("doc_id").alias("__doc")).distinct()
    good = F.broadcast(staged(good.orderBy(F.xxhash64("__doc"), "__doc").limit(sample), "good"))  # sample rows at most
    target = _counts(docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("__doc"), "left_semi"), buckets)
    raw = _counts(docs, buckets)
    if not target.sum():
        return np.zeros(buckets)
    return np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))


def kth_largest(rows: DataFrame, k: int) -> tuple[float, int] | None:
    """(key, doc_id) of the k-th row by key descending, doc_id ascending (null
    ids last)."""
    lo, hi = rows.agg(F.min("key"), F.max("key")).first()
    if lo is None or k <= 0:
        return None
    above = 0  # rows with keys over hi
    while True:
        inside = rows.filter((F.col("key") >= lo) & (F.col("key") <= hi))
        width = (hi - lo) / BINS
        n = inside.count()
        if n <= BINS or not width or lo + width <= lo:
            last = F.coalesce("doc_id", F.lit(2**63 - 1))
            at = inside.select("key", last.alias("i")).groupBy("key", "i").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("key"), "i")
            for r in at.limit(k - above).toLocalIterator():
                above += r["n"]
                if above >= k:
                    return r["key"], r["i"]
            return lo, 2**63 - 1
        bin_ = F.least(F.floor((F.col("key") - lo) / width), F.lit(BINS - 1))
        sums = inside.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        for r in sorted(sums.collect(), key=lambda r: -r["b"]):
            if above + r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]


def resample(
    docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = BUCKETS, sample: int = SAMPLE, seed: int = SEED
) -> DataFrame:
    """doc_id, log_weight, key (log weight plus Gumbel) and selected of every
    document row."""
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(log_ratio(docs, labels, buckets, sample))

    def run(b: pa.RecordBatch):
        ratio = shared.value
        return [pa.array([float(ratio[f].sum()) for f in features(utf8(b, "text"), buckets)], pa.float64())]

    chance = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), "text"))
    u = (F.shiftrightunsigned(chance, 11).cast("double") + 0.5) / float(2**53)
    scored = map_columns(
        docs.withColumn("__u", u), [T.StructField("log_weight", T.DoubleType())], run, drop=("text",)
    )
    rows = staged(
        scored.select("doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log("__u"))).alias("key")), "weights"
    )
    if k is None:
        share = labels.filter("quality is not null").agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        k = round(rows.count() * (1.0 if share is None else share))
    cut = kth_largest(rows, k)
    if cut is None:
        return rows.withColumn("selected", F.lit(False))
    key, last = cut
    level = (F.col("key") == key) & (F.coalesce("doc_id", F.lit(2**63 - 1)) <= last)
    return rows.withColumn("selected", (F.col("key") > key) | level)
