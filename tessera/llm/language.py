"""Language identification by the nearest of several centroids per language.

A text is lower-cased, everything that is no letter becomes one space, and its
character 1- to 3-grams are counted in ``BUCKETS`` hashed features.  A vector
is (1 + log count) * idf, scaled to length 1; the document frequencies count
all training documents.  Each language's training vectors are clustered by
cosine into at most ``CENTROIDS`` centroids, since a language is written in
more than one manner.  A text gets the language of the nearest centroid; a
text farther from it than nearly all (``REJECT``) of the training vectors that
the centroid stands for is marked as rejected.

Training reads only documents with a language and a letter, outside the
held-out fold.  Clusters are fitted on at most ``SAMPLE`` documents of each
language, drawn by hash; that is the one bound.  All texts are read whole, in
slices.

Defined results: a null text, or one without a letter, is ``und`` with score
0; without training documents every text is; equal cosines go to the smaller
language; rows that repeat a doc_id are predicted by their own texts; a null
doc_id is never trained on nor held out; an empty table gives an empty one;
the columns lang and source are no inputs of a prediction, and of extra columns
those with the names of the result are replaced.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.common import column, map_batches, map_columns, mix64

BUCKETS = 8_192
GRAMS = 3
CENTROIDS = 4
#: training documents of a language that its clusters are fitted on, at most
SAMPLE = 1_000
#: share of a centroid's training vectors whose distance counts as far
REJECT = 0.005
FOLDS, HELD_OUT = 4, 2
NONE = "und"
SLICE = 1 << 18
_BLOCK = 256

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter (once a process)."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def counts(text: str | None, buckets: int = BUCKETS) -> np.ndarray | None:
    """The counts of a text's hashed n-grams; None if it has no letter."""
    out, carried, seen = np.zeros(buckets), np.zeros(1, np.uint64), False
    for at in range(0, len(text or ""), SLICE):
        c = np.frombuffer(text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _is_letter()[c]
        c = np.where(letter, c, 0).astype(np.uint64)
        seen = seen or bool(letter.any())
        c = np.concatenate((carried, c))
        c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]  # one space for a run
        h = np.zeros(len(c), np.uint64)
        old = len(carried)  # grams that end in the part carried over are counted already
        for n in range(1, GRAMS + 1):
            h = h[: len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1 :] + np.uint64(n)
            new = h[max(0, old - n + 1) :]
            out += np.bincount((mix64(new) % np.uint64(buckets)).astype(np.int64), minlength=buckets)
            if len(c) <= n:
                break
        carried = c[1 - GRAMS :]
    return out if seen else None


def held_out(doc_id: Column) -> Column:
    rest = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(rest == HELD_OUT, F.lit(False))


def _vectors(found: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    x = np.array(found).reshape(len(found), len(idf))
    x = np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def training_rows(docs: DataFrame) -> DataFrame:
    use = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    return docs.filter(use).select("doc_id", "lang", "text")


def document_frequencies(rows: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, int, dict[str, int]]:
    """Documents that hold each feature, all documents, and those of each
    language; one partial count a task, summed by Spark."""

    def run(batches):
        df, n = np.zeros(buckets, np.int64), {}
        for b in batches:
            for t, lang in zip(column(b, "text").to_pylist(), column(b, "lang").to_pylist()):
                found = counts(t, buckets)
                if found is not None:
                    df += found > 0
                    n[lang] = n.get(lang, 0) + 1
        at = np.flatnonzero(df)
        keys = [None] * len(at) + list(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([*at.tolist(), *[None] * len(n)], pa.int32()), pa.array([*df[at].tolist(), *n.values()], pa.int64())],
            ["lang", "feature", "n"],
        )

    found = map_batches(rows.select("text", "lang"), run, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    df, languages = np.zeros(buckets, np.int64), {}
    for r in found.collect():  # a row a feature and a row a language
        if r["feature"] is None:
            languages[r["lang"]] = r["n"]
        else:
            df[r["feature"]] = r["n"]
    return df, sum(languages.values()), languages


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids, and each row's own one.  Starts at the
    first row and then at the row least like any start so far."""
    start = [0]
    for _ in range(min(k, len(x)) - 1):
        start.append(int(np.argmin((x @ x[start].T).max(axis=1))))
    c = x[start]
    of = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        of = (x @ c.T).argmax(axis=1)
        sums = np.array([x[of == j].sum(axis=0) for j in range(len(c))])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.maximum(norm, 1e-12), c)
    return c, (x @ c.T).argmax(axis=1)


class Model:
    """idf, centroids, and for each centroid its language and the least cosine
    that is not rejected."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, languages: list[str], least: np.ndarray):
        self.idf, self.centroids, self.languages, self.least = idf, centroids, languages, least

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, whether rejected) of each text."""
        out: list[tuple[str, float, bool]] = []
        for at in range(0, len(texts), _BLOCK):
            found = [counts(t, len(self.idf)) for t in texts[at : at + _BLOCK]]
            have = [f for f in found if f is not None]
            if not have or not len(self.languages):
                out += [(NONE, 0.0, True)] * len(found)
                continue
            cosine = _vectors(have, self.idf) @ self.centroids.T
            best = iter(zip(cosine.argmax(axis=1), cosine.max(axis=1)))  # the first of equals: languages ascend
            for f in found:
                if f is None:
                    out.append((NONE, 0.0, True))
                else:
                    j, s = next(best)
                    out.append((self.languages[j], float(min(1.0, max(0.0, s))), bool(s < self.least[j])))
        return out


def fit(docs: DataFrame, buckets: int = BUCKETS, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Model:
    rows = training_rows(docs)
    df, total, languages = document_frequencies(rows, buckets)
    idf = np.log((1 + total) / (1 + df)) + 1
    if not languages:
        return Model(idf, np.zeros((0, buckets)), [], np.zeros(0))
    # about 3 * sample rows of a language by hash, then the first of them
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, 3 * sample / n)) for k, n in languages.items()], "lang string, share double")
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11).cast("double") / float(2**53)
    drawn = rows.join(F.broadcast(shares), "lang").withColumn("chance", chance).filter("chance < share")  # a row a language
    first = Window.partitionBy("lang").orderBy("chance", "doc_id")
    drawn = drawn.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= sample)

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("place")
        found = [x for x in (counts(t, buckets) for t in pdf["text"]) if x is not None]
        if not found:
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        x = _vectors(found, idf)
        c, of = cluster(x, centroids)
        own = (x * c[of]).sum(axis=1)
        used = [j for j in range(len(c)) if (of == j).any()]
        return pd.DataFrame({
            "lang": [pdf["lang"].iloc[0]] * len(used), "centroid": [c[j].astype(np.float64).tobytes() for j in used],
            "least": [float(np.quantile(own[of == j], REJECT)) for j in used],
        })

    found = map_groups(drawn.select("lang", "text", "place"), run, "lang string, centroid binary, least double").collect()  # centroids a language
    found = sorted(found, key=lambda r: (r["lang"], bytes(r["centroid"])))
    vectors = np.array([np.frombuffer(r["centroid"]) for r in found]).reshape(len(found), buckets)
    return Model(idf, vectors, [r["lang"] for r in found], np.array([r["least"] for r in found]))


def map_groups(rows: DataFrame, fn, schema: str) -> DataFrame:
    from tessera.session import ship_package

    ship_package(rows.sparkSession)
    return rows.groupBy("lang").applyInPandas(fn, schema)


_FIELDS = [
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (the cosine) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch):
        found = shared.value.predict(column(b, "text").to_pylist())
        return [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]

    return map_columns(docs, _FIELDS, run)


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected."""
    model = fit(docs)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )
