"""Filter interaction audit by a Gray-code walk over all subsets of filters.

What a pipeline of filters removes depends on their order.  All of it follows
from how many documents survive each subset of the filters:

1. Each document becomes a mask, one bit for each filter that it fails.
   Documents with the same part and mask are one cell, with its numbers of
   documents, of good ones and of toxic ones.
2. For each part the 2^k subsets are walked in Gray-code order: one filter is
   switched on or off at a time.  A cell keeps a counter of the active filters
   that it fails; where that counter leaves or reaches 0 the cell's numbers go
   from or to the running survivors.  The survivors of all 2^k states are kept.
3. A step of any order is the difference of two states.

The filters (``FILTERS``) look at a document alone, but for E, which compares
it with all others: it fails when a smaller doc_id anywhere in the table has
the same text.  All copies of a text fail the same other filters, so its rows
are counted together before they are shuffled; a text with any number of
copies is a few rows.

Defined results: a null text is an empty one; a null part is the empty string
(as is an empty one); a document without a label is neither good nor toxic, of
several labels one is enough; rows that repeat a doc_id count each, and are no
copies of each other; a null doc_id is no smaller than any, fails E never and
has no label; very long texts are counted whole; an empty table has no part
and gives no rows; only the named columns are read, so others may have any
name.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.common import column, map_batches, map_columns, utf8

MIN_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
_NOT_UPPER = bytes(c for c in range(256) if not 0x41 <= c <= 0x5A)
_CONTINUED = bytes(range(0x80, 0xC0))
_MARKS = re.compile(rb"[#$%&*|]")


def few_words(text: bytes, words: list[bytes]) -> bool:
    return len(words) < MIN_WORDS


def repetitive(text: bytes, words: list[bytes]) -> bool:
    return 100 * len(set(words)) < DISTINCT_PERCENT * len(words)


def shouting(text: bytes, words: list[bytes]) -> bool:
    return 100 * len(text.translate(None, _NOT_UPPER)) > UPPER_PERCENT * len(text.translate(None, _CONTINUED))


def marked(text: bytes, words: list[bytes]) -> bool:
    return _MARKS.search(text) is not None


#: filters of one document, by letter; each says whether a text (UTF-8) with
#: these words fails
FILTERS = {"A": few_words, "B": repetitive, "C": shouting, "D": marked}
#: the letter of the filter on copies
COPY = "E"
MEASURES = ("docs", "good", "toxic")


def masks(docs: DataFrame, filters: dict = FILTERS) -> DataFrame:
    """doc_id, part, mask (the document's own filters) and t1, t2, the 128-bit
    hash of the text."""
    checks = list(filters.values())

    def run(b: pa.RecordBatch):
        mask, t1, t2 = [], [], []
        for t in utf8(b, "text"):
            t = t or b""
            words = t.split()  # at [\x20\x09-\x0D], as bytes are
            mask.append(sum(1 << k for k, fails in enumerate(checks) if fails(t, words)))
            d = hashlib.blake2b(t, digest_size=16).digest()
            t1.append(int.from_bytes(d[:8], "little", signed=True)), t2.append(int.from_bytes(d[8:], "little", signed=True))
        return [pa.array(mask, pa.int32()), pa.array(t1, pa.int64()), pa.array(t2, pa.int64())]

    fields = [T.StructField("mask", T.IntegerType()), T.StructField("t1", T.LongType()), T.StructField("t2", T.LongType())]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), "text")
    return map_columns(rows, fields, run, drop=("text",))


def cells(docs: DataFrame, labels: DataFrame, filters: dict = FILTERS) -> DataFrame:
    """part, mask (all filters, the copies' bit last) and docs, good, toxic."""
    rows = masks(docs, filters)
    flags = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("g"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("x")
    )
    one = F.count(F.lit(1))
    # rows that repeat a doc_id and its text, then the rows of a text
    by_doc = rows.filter("doc_id is not null").groupBy("doc_id", "t1", "t2", "part", "mask").agg(one.alias("n"))
    labelled = by_doc.join(flags, "doc_id", "left").select(
        "doc_id", "t1", "t2", "part", "mask", "n", F.coalesce("g", F.lit(0)).alias("g"), F.coalesce("x", F.lit(0)).alias("x")
    )
    by_text = labelled.groupBy("t1", "t2", "part", "mask", "g", "x").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first")
    )
    # few rows a text: one for each part and label
    least = F.min("first.doc_id").over(Window.partitionBy("t1", "t2"))
    kept = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    told = by_text.withColumn("least", least).select("part", "mask", "n", "g", "x", kept.alias("kept"))
    copy = 1 << len(filters)
    both = told.select(
        "part", F.explode(F.array(F.struct("mask", F.col("kept").alias("docs")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("kept")).alias("docs")))).alias("c"), "g", "x"
    ).select("part", "c.mask", "c.docs", (F.col("c.docs") * F.col("g")).alias("good"), (F.col("c.docs") * F.col("x")).alias("toxic"))
    nobody = rows.filter("doc_id is null").groupBy("part", "mask").agg(one.alias("docs")).select(
        "part", "mask", "docs", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")
    )
    return both.unionByName(nobody).groupBy("part", "mask").agg(*(F.sum(m).alias(m) for m in MEASURES)).filter("docs > 0")


def gray_walk(mask: np.ndarray, measures: np.ndarray, k: int) -> np.ndarray:
    """Survivors of every subset of k filters, (2^k, measures), of cells given
    by their masks and measures."""
    states = np.zeros((1 << k, measures.shape[1]), np.int64)
    failures = np.zeros(len(mask), np.int64)  # active filters that a cell fails
    survivors = measures.sum(axis=0)
    states[0] = survivors
    subset = 0
    for step in range(1, 1 << k):
        bit = (step & -step).bit_length() - 1  # the one filter that the code toggles
        hit = (mask >> bit) & 1 == 1
        if subset >> bit & 1:
            failures[hit] -= 1
            survivors = survivors + measures[hit & (failures == 0)].sum(axis=0)
        else:
            survivors = survivors - measures[hit & (failures == 0)].sum(axis=0)
            failures[hit] += 1
        subset ^= 1 << bit
        states[subset] = survivors
    return states


def steps(states: np.ndarray, letters: str) -> list[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) of all orders, as differences of states."""
    k, out = len(letters), []
    everything = (1 << k) - 1
    gone = [int(states[0][0] - states[1 << f][0]) for f in range(k)]
    unique = [int(states[everything ^ 1 << f][0] - states[everything][0]) for f in range(k)]
    total = [0] * k
    for order in permutations(range(k)):
        before, name = 0, "".join(letters[f] for f in order)
        for place, f in enumerate(order):
            after = before | 1 << f
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            total[f] += removed
            out.append((name, place + 1, int(states[after][0]), removed, gone[f] - removed, unique[f], good, toxic, f))
            before = after
    return [(*r[:-1], total[r[-1]]) for r in out]


def audit(docs: DataFrame, labels: DataFrame, filters: dict = FILTERS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley of every order of the filters in every
    part."""
    letters = "".join(filters) + COPY
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    packed = cells(docs, labels, filters).groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))  # 2^k at most

    def run(batches):
        for b in batches:
            for part, found in zip(column(b, "part").to_pylist(), column(b, "cells").to_pylist()):
                mask = np.array([c["mask"] for c in found], np.int64)
                measures = np.array([[c[m] for m in MEASURES] for c in found], np.int64)
                rows = steps(gray_walk(mask, measures, len(letters)), letters)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                     *(pa.array([r[j] for r in rows], pa.int64()) for j in range(2, 9))],
                    names,
                )

    return map_batches(packed, run, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names[3:]))
