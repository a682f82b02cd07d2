"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are quantised to integers and seen as sparse rows: a dimension is a
term, its postings are the rows with a weight other than 0.  Queries and
candidates are dealt into blocks; in each pair of blocks a task keeps one
dense array of scores (queries x candidates) and works through the terms:
the queries that hold the term scatter weight times posting into the array.
A partition selection (``argpartition``) then leaves each query's k best of
the block, and a merge over the blocks the k best of all.

Scores are whole numbers, in 64 bits where the products surely fit, else in
unbounded integers; equal scores go to the smaller id.

Defined results: a vector that is null or holds a null, NaN or infinity
takes no part; an empty vector scores 0 with all; shorter vectors count as
padded with zeros; rows that repeat a vec_id are each a candidate of the
others and, where they are queries, each ask for themselves; a null vec_id
takes no part; without candidates there are no rows; an empty table gives an
empty result; only the columns vec_id and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import column, map_batches, staged

#: queries broadcast at a time (so many rows of doubles), and candidates
#: scored at a time
QUERY_BLOCK = 1_024
CAND_BLOCK = 4_096


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """A key of the row, vec_id and the vector as floor(scale * x), without the
    unusable rows."""
    as_double = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("__v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.filter("vec_id is not null and embedding is not null")
        .select(F.col("vec_id").cast("long").alias("vec_id"), as_double.alias("__v"))
        .filter(~bad)
        .select(
            F.monotonically_increasing_id().alias("row"), "vec_id",
            F.transform("__v", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"),
        )
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The vectors as rows, shorter ones padded with zeros."""
    at = vectors.offsets.to_numpy()
    flat, sizes = vectors.values.to_numpy(zero_copy_only=False), np.diff(at)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    of = np.repeat(np.arange(len(sizes)), sizes)
    out[of, np.arange(len(of)) - np.repeat(at[:-1] - at[0], sizes)] = flat[at[0] : at[-1]]
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense scores of integer-valued matrices, term at a time."""
    top = [np.abs(m).max(initial=0.0) for m in (queries, candidates)]
    if top[0] * top[1] * max(1, queries.shape[1]) < 2.0**62 and max(top) < 2.0**62:
        queries, candidates, kind = queries.astype(np.int64), candidates.astype(np.int64), np.int64
    else:
        queries, candidates = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (queries, candidates))
        kind = object
    scores = np.zeros((len(queries), len(candidates)), dtype=kind)
    for term in range(queries.shape[1]):
        holders, posting = np.flatnonzero(queries[:, term]), np.flatnonzero(candidates[:, term])
        if not len(holders) or not len(posting):
            continue
        weights = candidates[posting, term]
        if len(posting) == len(candidates):
            for q in holders:
                scores[q] += queries[q, term] * weights
        else:
            for q in holders:
                scores[q, posting] += queries[q, term] * weights
    return scores


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id; ``ids`` ascend."""
    if len(scores) <= k:
        return np.arange(len(scores))
    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > kth)
    level = np.flatnonzero(scores == kth)[: k - len(above)]
    return np.concatenate([above, level])


def _scan(candidates: DataFrame, block: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> DataFrame:
    """q, query_id, vec_id, score: each task's k best for each query."""
    shared = candidates.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        keys, names, queries = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in keys]  # (score, vec_id)

        def score(rows, ids, vectors):
            order = np.argsort(ids, kind="stable")
            rows, ids = rows[order], ids[order]
            scores = accumulate(*_same_width(queries, vectors[order]))
            own = {int(r): at for at, r in enumerate(rows)}
            for q, key in enumerate(keys):
                s, i, at = scores[q], ids, own.get(int(key))
                if at is not None:
                    s, i = np.delete(s, at), np.delete(i, at)
                best[q] += [(int(s[j]), int(i[j])) for j in select(s, i, k)]
                best[q] = sorted(best[q], key=lambda x: (-x[0], x[1]))[:k]

        for b in batches:
            for at in range(0, b.num_rows, CAND_BLOCK):
                part = b.slice(at, CAND_BLOCK)
                rows, ids = (column(part, c).to_numpy() for c in ("row", "vec_id"))
                score(rows, ids, _matrix(column(part, "v")))
        found = [(q, int(names[q]), i, s) for q, x in enumerate(best) for s, i in x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[j] for f in found], pa.int64()) for j in range(4)], ["q", "query_id", "vec_id", "score"]
        )

    return map_batches(candidates, run, "q long, query_id long, vec_id long, score long")


def search(vectors: DataFrame, query_ids, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best; ``query_ids`` is
    a condition on vec_id that marks the queries."""
    rows = staged(quantised(vectors, scale), "vectors")
    asked = rows.filter(F.coalesce(query_ids, F.lit(False)))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    out = None
    for n in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == n).toArrow().combine_chunks()
        keys, names = (block[c].to_numpy() for c in ("row", "vec_id"))
        queries = _matrix(pa.concat_arrays(block["v"].chunks)) if block.num_rows else np.zeros((0, 0))
        found = _scan(rows, (keys, names, queries), k).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found = found.select("query_id", "rank", "vec_id", "score")
        if blocks > 1:
            found = staged(found, "top-k")  # so that a block's broadcast is done with
        out = found if out is None else out.unionByName(found)
    return out
