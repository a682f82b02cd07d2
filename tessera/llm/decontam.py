"""Benchmark decontamination by a broadcast hash set of test n-grams.

Both sides are normalised alike (A-Z lower-cased, words are runs of digits,
ASCII letters and non-ASCII characters).  Every run of ``ngram`` consecutive
words of a benchmark item is a window; an item with fewer words, but not
none, is one window.  The windows become a hash set that is broadcast; a
document task maps its words to the benchmark's vocabulary, hashes each run
of known words, looks the hash up and then verifies the words themselves, so
a hash collision is never a hit.

Size of what is broadcast: a long item is cut into overlapping pieces of at
most ``PIECE`` windows, and the pieces are dealt by hash into as many sets as
give each half of ``MAX_WINDOWS``.  Each set is collected, broadcast and
applied in a pass of its own before the next one is collected, and the passes'
hits are united per document.

Defined results: a null or empty text has no words, no hit and no item;
a null benchmark text has no window; the windows of an item with a null
item_id are hit like any other, but it is no item of the result; repeated
items each count under their own id; repeated documents are each scanned, and
very long ones whole; an empty benchmark hits nothing; extra columns ride
along in ``remove``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import column, map_batches, map_columns, staged, utf8

NGRAM = 10
#: windows in one broadcast set: 8 bytes of hash, 4 bytes a word and the
#: vocabulary, well under 150 MB
MAX_WINDOWS = 1_000_000
#: windows of one item that go into a set together
PIECE = 50_000

_SEP = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes | None) -> list[bytes]:
    return text.lower().translate(_SEP).split() if text else []


class WindowSet:
    """The windows of some benchmark items, ready to scan documents with."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], ngram: int = NGRAM):
        vocab: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = [vocab.setdefault(w, len(vocab) + 1) for w in words(text)]
            size = min(ngram, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                found[size][tuple(ids[i : i + size])].add(item)
        self.vocab = vocab
        self.by_size = []
        for size, windows in sorted(found.items()):
            grams = np.array(list(windows), dtype=np.int32).reshape(len(windows), size)
            hashes = self._hash(grams.T)
            order = np.argsort(hashes, kind="stable")
            owners = [sorted(i for i in x if i is not None) for x in windows.values()]
            self.by_size.append((size, hashes[order], grams[order], [owners[i] for i in order]))

    @staticmethod
    def _hash(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            h = h * _BASE + c.astype(np.uint64)
        return h

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit windows as (start, size), items hit."""
        ws = words(text)
        spans: list[tuple[int, int]] = []
        hit: set[str] = set()
        if not ws or not self.vocab:
            return len(ws), spans, hit
        get = self.vocab.get
        ids = np.array([get(w, 0) for w in ws], dtype=np.int32)
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for size, hashes, grams, owners in self.by_size:
            if len(ids) < size:
                continue
            start = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(start):
                continue
            h = self._hash([ids[start + j] for j in range(size)])
            lo = np.searchsorted(hashes, h, "left")
            hi = np.searchsorted(hashes, h, "right")
            for k in np.flatnonzero(hi > lo):
                at = int(start[k])
                for slot in range(lo[k], hi[k]):  # more than one only where hashes collide
                    if np.array_equal(grams[slot], ids[at : at + size]):
                        spans.append((at, size))
                        hit.update(owners[slot])
        return len(ws), spans, hit


def _mark(n: int, spans) -> np.ndarray:
    marks = np.zeros(n + 1, dtype=np.int32)
    for at, size in spans:
        marks[at] += 1
        marks[at + size] -= 1
    return np.cumsum(marks[:n]) > 0


def _pieces(benchmark: DataFrame, ngram: int) -> DataFrame:
    """item and text, items of many words cut into pieces whose windows are
    together those of the item."""

    def run(batches):
        for b in batches:
            items, texts = [], []
            for item, text in zip(column(b, "item").to_pylist(), column(b, "text").to_pylist()):
                w = words(text)
                for at in range(0, max(1, len(w) - ngram + 1), PIECE):
                    items.append(item), texts.append(b" ".join(w[at : at + PIECE + ngram - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.binary())], ["item", "text"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    return map_batches(rows, run, "item string, text binary")


def window_sets(benchmark: DataFrame, ngram: int = NGRAM, max_windows: int = MAX_WINDOWS) -> tuple[int, Iterator[WindowSet]]:
    """The number of sets that the benchmark's windows are dealt into, and the
    sets, each collected when it is asked for."""
    pieces = _pieces(benchmark, ngram)
    total = pieces.agg(F.sum(F.length("text"))).first()[0] or 0  # over twice the number of windows
    passes = max(1, -(-total // max_windows))

    def sets():
        for k in range(passes):
            part = pieces if passes == 1 else pieces.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
            yield WindowSet([(r["item"], r["text"]) for r in part.collect()], ngram)

    return passes, sets()


_HITS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def _scan(docs: DataFrame, windows: WindowSet, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def run(b: pa.RecordBatch):
        w = shared.value
        found = [w.scan(t) for t in utf8(b, text_col)]
        return [
            pa.array([n for n, _, _ in found], pa.int64()),
            pa.array([[list(s) for s in spans] for _, spans, _ in found], pa.list_(pa.list_(pa.int32()))),
            pa.array([sorted(items) for _, _, items in found], pa.list_(pa.string())),
        ]

    return map_columns(docs, _HITS, run)


def find_hits(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document row: doc_id, n_words, hit_spans (start word and
    number of words of every window found) and hit_items."""
    passes, sets = window_sets(benchmark, ngram, max_windows)
    rows = docs.select("doc_id", "text")
    if passes == 1:
        return _scan(rows, next(sets), "text").drop("text")
    # one pass per set; a document row is known by its id and text
    key = ["doc_id", "__h1", "__h2", "n_words"]
    parts = [
        staged(
            _scan(rows.withColumns({"__h1": F.xxhash64("text"), "__h2": F.xxhash64(F.lit(7), "text")}), w, "text")
            .groupBy(*key, "hit_spans", "hit_items").agg(F.count(F.lit(1)).alias("__copies")),
            f"decontam-{k}",
        )
        for k, w in enumerate(sets)
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return (
        union.groupBy(*key)
        .agg(
            F.flatten(F.collect_list("hit_spans")).alias("hit_spans"),
            F.array_distinct(F.flatten(F.collect_list("hit_items"))).alias("hit_items"),
            F.max("__copies").alias("__copies"),
        )
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int"))))
        .select("doc_id", "n_words", "hit_spans", "hit_items")
    )


def report(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per document: n_words, n_hit (words inside any window's occurrence),
    n_items, items_sha256 and contaminated."""
    hits = find_hits(docs, benchmark, ngram, max_windows)

    def run(b: pa.RecordBatch):
        n = column(b, "n_words").to_pylist()
        spans, items = column(b, "hit_spans").to_pylist(), column(b, "hit_items").to_pylist()
        n_hit = [int(_mark(k, s).sum()) if s else 0 for k, s in zip(n, spans)]
        return [
            pa.array(n_hit, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
            pa.array([x > 0 for x in n_hit], pa.bool_()),
        ]

    fields = [
        T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
    ]
    return map_columns(hits, fields, run, drop=("hit_spans", "hit_items"))


def remove(
    docs: DataFrame, benchmark: DataFrame, how: str = "documents", ngram: int = NGRAM, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """``docs`` without its contaminated documents (``how="documents"``) or
    with the hit words cut out of their texts (``how="spans"``); columns and
    all other rows stay as they are."""
    if how not in ("documents", "spans"):
        raise ValueError(f"how must be 'documents' or 'spans', not {how!r}")
    out = docs
    passes, sets = window_sets(benchmark, ngram, max_windows)
    for n, w in enumerate(sets):
        if n:
            out = staged(out, "decontaminated")  # the pass before is done with its set
        shared = docs.sparkSession.sparkContext.broadcast(w)
        if how == "documents":

            def clean(batches, shared=shared):
                for b in batches:
                    yield b.filter(pa.array([not shared.value.scan(t)[1] for t in utf8(b, "text")], pa.bool_()))

            out = map_batches(out, clean, docs.schema)
        else:
            at = docs.schema["text"]

            def cut(b: pa.RecordBatch, shared=shared):
                return [pa.array([_cut(t, shared.value) for t in utf8(b, "text")], pa.binary()).cast(pa.string())]

            out = map_columns(out, [at], cut).select(*docs.columns)
    return out


def _cut(text: bytes | None, w: WindowSet) -> bytes | None:
    """The text without its hit words and the separators between them."""
    n, spans, _ = w.scan(text)
    if not spans:
        return text
    hit, keep = _mark(n, spans), []
    flat = text.lower().translate(_SEP)
    start = at = 0
    for k in range(n):
        while flat[at] == 0x20:
            at += 1
        end = flat.find(b" ", at)
        end = len(flat) if end < 0 else end
        if hit[k]:
            if not (k and hit[k - 1]):
                keep.append(text[start:at])
            start = end
        at = end
    return b"".join([*keep, text[start:]])
