"""Line deduplication with a sharded minimal perfect hash.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased.  A key of at least ``min_chars`` characters found in two or more
documents stays only in the smallest doc_id that holds it.

1. Each line becomes 128 bits of hash, written once; one aggregation (partial
   sums before the shuffle, so a line in every document costs one row a task)
   gives each distinct hash its number of lines, smallest and largest document.
   Hashes of one document only need no entry: no document loses them.
2. The hashes are dealt to shards by value, as many as give each shard about
   ``SHARD_LINES`` lines.  In each shard a minimal perfect hash (levels of bit
   arrays; a key rests in the first level where no other key falls on its bit,
   its slot is the rank of that bit) indexes three arrays without gaps:
   fingerprints, counts and keeping documents.
3. Documents send their lines' hashes, never the lines, to the shards.  A task
   reads a shard's arrays and then streams its probes past them: slot, compare
   the fingerprint, compare the keeper.  No group is held in memory.
4. A document's dropped line numbers go back to it.

Hot lines: a hash with more than 1/``HOT_SHARE`` of all lines is one of at
most ``HOT_SHARE`` such hashes; these few (a proven bound) make a small
broadcast table that answers their lines in place, so no shard gets a hot
line's probes.

Defined results: a null or empty text is one empty line; lines shorter than
``min_chars`` are never dropped; equal doc_ids are one document when counting
and every row of a text gets the same lines dropped; rows with a null doc_id
are returned unchanged; a very long text is split whole, one text at a time;
an empty table gives an empty one; extra columns ride along, but for those
named ``n_lines`` or ``n_dropped``, which are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SPACE, column, map_batches, map_columns, mix64, staged, utf8

MIN_CHARS = 10
SHARD_LINES = 16_384
HOT_SHARE = 10_000


# -- the index of one shard ----------------------------------------------------


def _position(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    return (mix64(mix64(h1.view(np.uint64) ^ salt) + h2.view(np.uint64)) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray, room: float = 2.0) -> tuple[list[int], np.ndarray]:
    """Level sizes and the bit array of a minimal perfect hash over distinct
    128-bit keys."""
    sizes, bits = [], []
    left = np.arange(len(h1))
    while len(left):
        size = max(8, int(room * len(left)))
        at = _position(h1[left], h2[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


class ShardIndex:
    """Probes a shard: the slot of a key, or -1 for no slot."""

    def __init__(self, sizes, bits, fingerprints, counts, keepers):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits) - 1
        self.fingerprints, self.counts, self.keepers = fingerprints, counts, keepers

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), -1, dtype=np.int64)
        open_, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = base + _position(h1[open_], h2[open_], level, size)
            set_ = self.bits[at]
            out[open_[set_]] = self.rank[at[set_]]
            open_, base = open_[~set_], base + size
        return out

    def keeper(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is a member found in several documents, and its
        keeping document."""
        slot = self.slots(h1, h2)
        safe = np.maximum(slot, 0)
        if not len(self.fingerprints):
            return np.zeros(len(h1), bool), np.zeros(len(h1), np.int64)
        member = (slot >= 0) & (self.fingerprints[safe] == h2) & (self.counts[safe] > 1)
        return member, self.keepers[safe]

    @classmethod
    def build(cls, h1, h2, counts, keepers) -> ShardIndex:
        sizes, bits = build_hash(h1, h2)
        out = cls(sizes, bits, np.zeros(len(h1), np.int64), np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.int64))
        slot = out.slots(h1, h2)
        out.fingerprints[slot] = h2
        out.counts[slot] = np.minimum(counts, 2**32 - 1)
        out.keepers[slot] = keepers
        return out


def _pack(x: ShardIndex) -> bytes:
    """The index as one value: five lengths, then its arrays."""
    arrays = [np.array(x.sizes, np.int64), np.packbits(x.bits), x.fingerprints, x.counts, x.keepers]
    parts = [a.tobytes() for a in arrays]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def _unpack(packed: bytes) -> ShardIndex:
    lengths = np.frombuffer(packed, np.int64, 5)
    edges = 40 + np.concatenate(([0], np.cumsum(lengths)))
    sizes, bits, *arrays = (packed[a:b] for a, b in zip(edges, edges[1:]))
    n = np.frombuffer(sizes, np.int64)
    flat = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(n.sum())).astype(bool)
    fingerprints, counts, keepers = (np.frombuffer(a, t) for a, t in zip(arrays, (np.int64, np.uint32, np.int64)))
    return ShardIndex(n.tolist(), flat, fingerprints, counts, keepers)


# -- the Spark jobs ------------------------------------------------------------


_STRIP = SPACE.encode()
_CONTINUED = bytes(range(0x80, 0xC0))


def line_keys(text: bytes | None, min_chars: int) -> tuple[list[int], list[bytes]]:
    """Numbers and keys of the lines that count."""
    numbers, keys = [], []
    for k, line in enumerate((text or b"").split(b"\n")):
        key = line.strip(_STRIP).lower()  # of bytes: A-Z alone
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.translate(None, _CONTINUED)) >= min_chars):
            numbers.append(k), keys.append(key)
    return numbers, keys


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text hash, line number and key hash of every line that counts."""

    def run(batches):
        for b in batches:
            owners, numbers, digests = [], [], []
            for row, text in enumerate(utf8(b, "text")):
                at, keys = line_keys(text, min_chars)
                owners.append(np.full(len(at), row)), numbers.extend(at)
                digests.extend(hashlib.blake2b(k, digest_size=16).digest() for k in keys)
            of = pa.array(np.concatenate(owners) if owners else np.zeros(0, np.int64))
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id").take(of), column(b, "th").take(of), pa.array(numbers, pa.int32()),
                 pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1]))],
                ["doc_id", "th", "line_no", "h1", "h2"],
            )

    rows = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text"
    )
    return map_batches(rows, run, "doc_id long, th long, line_no int, h1 long, h2 long")


def _build_shards(members: DataFrame) -> DataFrame:
    def build(batches):
        shard, held = None, []

        def done():
            if shard is None:
                return
            x = [np.concatenate([h[k] for h in held]) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([_pack(ShardIndex.build(*x))], pa.binary())], ["shard", "index"]
            )

        for b in batches:
            of = column(b, "shard").to_numpy()
            cut = np.flatnonzero(np.diff(of)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(of)]):
                if hi == lo:
                    continue
                if of[lo] != shard:
                    yield from done()
                    shard, held = int(of[lo]), []
                held.append([column(b, c).to_numpy(zero_copy_only=False)[lo:hi] for c in ("h1", "h2", "n", "keeper")])
        yield from done()

    rows = members.repartition("shard").sortWithinPartitions("shard")
    return map_batches(rows, build, "shard long, index binary")


def _probe(lines: DataFrame, shards: DataFrame) -> DataFrame:
    """doc_id, th, line_no of the lines that their document loses."""
    probes = lines.select("shard", "doc_id", "th", "line_no", "h1", "h2", F.lit(None).cast("binary").alias("index"))
    none = F.lit(None).cast("long")
    # a line number below all others puts a shard's arrays before its probes
    heads = shards.select("shard", none.alias("doc_id"), none.alias("th"), F.lit(-1).alias("line_no"), none.alias("h1"), none.alias("h2"), "index")
    rows = heads.unionByName(probes).repartition("shard").sortWithinPartitions("shard", "line_no")

    def probe(batches):
        shard, index = None, None
        for b in batches:
            of = column(b, "shard").to_numpy()
            cut = np.flatnonzero(np.diff(of)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(of)]):
                if hi == lo:
                    continue
                part = b.slice(lo, hi - lo)
                if of[lo] != shard:
                    shard, index = of[lo], None
                if column(part, "line_no")[0].as_py() < 0:
                    index = _unpack(column(part, "index")[0].as_py())
                    part = part.slice(1)
                if index is None or not part.num_rows:
                    continue  # a shard without repeated lines
                h1, h2, doc = (column(part, c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc_id"))
                member, keeper = index.keeper(h1, h2)
                gone = pa.array(np.flatnonzero(member & (keeper != doc)))
                yield pa.RecordBatch.from_arrays(
                    [column(part, c).take(gone) for c in ("doc_id", "th", "line_no")], ["doc_id", "th", "line_no"]
                )

    return map_batches(rows, probe, "doc_id long, th long, line_no int")


def find_dropped(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, th (hash of the text) and line_no of every line to drop."""
    lines = staged(_lines(docs, min_chars), "lines")
    found = staged(
        lines.groupBy("h1", "h2").agg(
            F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keeper"), F.max("doc_id").alias("__last")
        ).select("h1", "h2", "n", "keeper", (F.col("keeper") < F.col("__last")).alias("repeated")),
        "line-hashes",
    )
    total = found.agg(F.sum("n")).first()[0] or 0
    n_shards = max(1, -(-total // SHARD_LINES))
    shard = F.pmod("h1", F.lit(n_shards)).alias("shard")
    repeated = found.filter("repeated").drop("repeated")
    # at most HOT_SHARE hashes can pass this filter
    hot = repeated.filter(F.col("n") * HOT_SHARE > total).select("h1", "h2", F.col("keeper").alias("hot_keeper"))
    members = repeated.filter(F.col("n") * HOT_SHARE <= total).select(shard, "h1", "h2", "n", "keeper")
    shards = staged(_build_shards(members), "line-shards")
    marked = lines.join(F.broadcast(hot), ["h1", "h2"], "left")
    cold = marked.filter("hot_keeper is null").select(shard, "doc_id", "th", "line_no", "h1", "h2")
    in_place = marked.filter("hot_keeper <> doc_id").select("doc_id", "th", "line_no")
    return _probe(cold, shards).unionByName(in_place)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and n_lines (before)
    and n_dropped.  A null text stays null."""
    dropped = (
        find_dropped(docs, min_chars)
        .groupBy(F.col("doc_id").alias("__doc"), F.col("th").alias("__th"))
        .agg(F.collect_list("line_no").alias("__gone"))  # no more than the text's own lines
    )
    of = F.xxhash64(F.coalesce("text", F.lit("")))
    joined = docs.withColumn("__of", of).join(
        dropped, (F.col("doc_id").cast("long") == F.col("__doc")) & (F.col("__of") == F.col("__th")), "left"
    )

    def run(b: pa.RecordBatch):
        texts, gone = column(b, "text").to_pylist(), column(b, "__gone")
        out, n_lines, n_gone = [], [], []
        for t, g in zip(texts, gone):
            g = set(g.as_py() or ())
            if g:
                lines = t.split("\n")
                n_lines.append(len(lines))
                t = "\n".join(x for k, x in enumerate(lines) if k not in g)
            else:
                n_lines.append((t or "").count("\n") + 1)
            out.append(t)
            n_gone.append(len(g))
        return [pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())]

    fields = [docs.schema["text"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return map_columns(joined, fields, run, drop=("__doc", "__th", "__of", "__gone")).select(
        *names, "n_lines", "n_dropped"
    )


def report(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    kept = dedup_lines(docs.select("doc_id", "text"), min_chars)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
