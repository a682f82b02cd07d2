"""N-gram Jaccard join over a token-group matrix.

A document is the set of its distinct word 5-grams, as 64-bit hashes; two
documents link when 100 * |intersection| >= 75 * |union|.  The result is the
components of the links; no link between different texts is lost.

1. Equal sets are one class (128-bit digest), whatever their number.
2. A set of n tokens can only link with one that shares a token of its
   prefix: its first n - ceil(0.75 n) + 1 tokens in one order for all.  The
   order goes from rare to frequent (counted over all documents, in powers of
   two), then by hash; any order is exact, this one keeps a token's bucket
   small.
3. Classes that share a prefix token are grouped by similarity, whether they
   link or not: each goes with the bucket leader of about its size that it
   meets most often, and
   the followers of a leader are dealt, by size, into groups of about
   ``GROUP_SIZE``.
4. The token-group matrix: a row is a prefix token of a group, with the sizes
   of the classes that hold it.  Two groups meet in the rows of a token; the
   number of tokens in which they meet bounds the overlap of any two of their
   classes, so with groups of g a passage held by m similar classes makes
   (m / g)^2 rows, not m^2.
5. Groups are opened inside, then against the group that they share most with,
   then against the other groups left, each pair of groups once; before each
   step go the pairs of groups that are in one component already.  An opened group is stored as its union
   of tokens; a class of another group must find ceil(0.75 n) of its tokens in
   the union before it is compared with the members.  A step's links join what
   was apart, no more.  A pair of groups is first asked with short sets of two
   bytes a token: these meet in as many tokens as the sets or more, so only
   pairs that cannot link are left out, and whole sets are sent for the others
   alone.

Defined results: lower-casing is A-Z only, words are runs without
``[\\x20\\x09-\\x0D]``; a text with fewer words than a shingle is one shingle;
a null, empty or blank text has no shingle, links with nothing and is its own
component; repeated rows of a doc_id are one document each, and copies of each
other; a null doc_id never names a component of others; a very long text is
one set, held by one task at a time; an empty table gives an empty one; only
doc_id and text are read, and ``keep_one`` keeps every column as it is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import column, map_batches, mix64, staged, utf8
from tessera.llm.graph import components
from tessera.llm.words import word_hashes

SHINGLE = 5
PERCENT = 75
GROUP_SIZE = 64
#: tokens counted together when looking for frequent ones
COUNT_WINDOW = 1 << 21
#: a token counted so often in all (windows where it is found once apart) is
#: put late in the order
FREQUENT = 8
#: frequent tokens broadcast at most (8 bytes each)
MAX_FREQUENT = 1 << 20
#: a bucket of rare tokens with more classes makes its token frequent
LARGE_BUCKET = 256
#: sets follow a leader of a size within this factor
LEADER_BAND = 1.15
#: groups that one task compares with a group
PAIRS_A_TASK = 16
#: groups of large stars hold sizes within this factor
SIZE_BAND = 1.06
#: bits for each wanted set in the bitmap that tasks get, and all its bits at
#: most (8 MB)
BITMAP, MAX_BITMAP = 16, 1 << 26


_PLACES = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h += words[j : j + len(h)] * _PLACES[j]
    return mix64(h)


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word 5-grams."""
    words = word_hashes(texts)
    sizes = np.array([len(w) for w in words], np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    whole = np.concatenate(words) if words else np.zeros(0, np.uint64)
    grams = _grams(whole, SHINGLE) if len(whole) >= SHINGLE else np.zeros(0, np.uint64)
    out = []
    for k, n in enumerate(sizes):
        if n >= SHINGLE:
            h = np.sort(grams[at[k] : at[k] + n - SHINGLE + 1])
            h = h[np.concatenate(([True], h[1:] != h[:-1]))]
        elif n:
            h = _grams(words[k], int(n))
        else:
            h = np.zeros(0, np.uint64)
        out.append(h)
    return out


def _sets_of(texts: list[bytes | None], slice_: int = 256):
    """The shingle sets of a batch's texts, a slice at a time."""
    for k in range(0, len(texts), slice_):
        yield from shingle_sets(texts[k : k + slice_])


def shingles(text: bytes | None) -> np.ndarray:
    return shingle_sets([text])[0]


def prefix_length(n: int) -> int:
    return n + (-PERCENT * n // 100) + 1  # n - ceil(0.75 n) + 1


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    n, m = len(a), len(b)
    if min(n, m) * 100 < PERCENT * max(n, m):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (n + m - both)


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64), pa.int64())


# -- 1: sets and frequent tokens -----------------------------------------------


def _sketch(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, d1, d2, null) of the documents and (null, null, token,
    null, count) of the tokens found often among the sets of one window."""
    names = ["doc_id", "n", "d1", "d2", "often"]

    def run(batches):
        held, size, seen = [], 0, set()

        def often():
            t, c = np.unique(np.concatenate(held), return_counts=True)
            t, c = t[c > 1], c[c > 1]
            none = pa.nulls(len(t), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, _long(t), none, pa.array(c, pa.int64())], names)

        for b in batches:
            n, d1, d2 = [], [], []
            for tokens in _sets_of(utf8(b, "text")):
                x, y = _digest(tokens)
                n.append(len(tokens)), d1.append(x), d2.append(y)
                if len(tokens) and x not in seen:
                    seen.add(x)
                    held.append(tokens)
                    size += len(tokens)
                if size >= COUNT_WINDOW:
                    yield often()
                    held, size = [], 0
                    seen.clear()
            ids = column(b, "doc_id").cast(pa.int64())
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(d1), pa.array(d2), none], names)
        if held:
            yield often()

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n long, d1 long, d2 long, often long")


# -- 2: buckets of prefix tokens -----------------------------------------------


def prefix(tokens: np.ndarray, frequent: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The first tokens of a set, from rare to frequent."""
    p = prefix_length(len(tokens))
    if not len(frequent):
        return tokens[:p]
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    level = np.where(frequent[at] == tokens, levels[at], 0)
    return tokens[np.argsort(level, kind="stable")[:p]]


def _prefixes(docs: DataFrame, frequent: np.ndarray, levels: np.ndarray, bins: int) -> DataFrame:
    """(bin, tokens, sids, sizes): the prefix tokens of a batch's distinct
    sets that fall into a bin, packed; ``levels`` are those of the frequent
    tokens, ascending by token."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, levels))

    def run(batches):
        known, seen = shared.value, set()
        for b in batches:
            held, sids, sizes = [], [], []
            for tokens in _sets_of(utf8(b, "text")):
                if not len(tokens):
                    continue
                sid = _digest(tokens)[0]
                if sid in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(sid)
                first = prefix(tokens, *known)
                held.append(first)
                sids.append(np.full(len(first), sid, np.int64))
                sizes.append(np.full(len(first), len(tokens), np.int32))
            if not held:
                continue
            t, s, z = np.concatenate(held), np.concatenate(sids), np.concatenate(sizes)
            of = (mix64(t) % np.uint64(bins)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            t, s, z, of = t[order], s[order], z[order], of[order]
            cut = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(of[cut[:-1]], pa.int64()),
                    pa.array([t[lo:hi].tobytes() for lo, hi in zip(cut, cut[1:])], pa.binary()),
                    pa.array([s[lo:hi].tobytes() for lo, hi in zip(cut, cut[1:])], pa.binary()),
                    pa.array([z[lo:hi].tobytes() for lo, hi in zip(cut, cut[1:])], pa.binary()),
                ],
                ["bin", "tokens", "sids", "sizes"],
            )

    return map_batches(docs.select("text"), run, "bin long, tokens binary, sids binary, sizes binary")


def _buckets(packed: DataFrame) -> DataFrame:
    """(token, sid, n, leader, leader_n, size) of the tokens that two or more
    sets share; the leader is the smallest sid of the bucket's sets of about
    the same size."""
    names = ["token", "sid", "n", "leader", "leader_n", "size"]

    def run(batches):
        now, held = None, []

        def done():
            if not held:
                return
            t, s, n = (np.concatenate([np.frombuffer(h[k], kind) for h in held]) for k, kind in enumerate((np.int64, np.int64, np.int32)))
            band = np.floor(np.log(n) / np.log(LEADER_BAND)).astype(np.int64)
            order = np.lexsort((s, band, t))
            t, s, n, band = t[order], s[order], n[order], band[order]
            new = np.concatenate(([True], (t[1:] != t[:-1]) | (s[1:] != s[:-1])))
            t, s, n, band = t[new], s[new], n[new].astype(np.int64), band[new]
            start = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            size = np.diff(np.concatenate((start, [len(t)])))
            each = np.repeat(size, size)
            led = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (band[1:] != band[:-1]))))
            first = np.repeat(led, np.diff(np.concatenate((led, [len(t)]))))
            keep = each > 1
            yield pa.RecordBatch.from_arrays([pa.array(x[keep], pa.int64()) for x in (t, s, n, s[first], n[first], each)], names)

        for b in batches:
            rows = zip(*(column(b, c).to_pylist() for c in ("bin", "tokens", "sids", "sizes")))
            for k, *arrays in rows:
                if k != now:
                    yield from done()
                    now, held = k, []
                held.append(arrays)
        yield from done()

    rows = packed.repartition("bin").sortWithinPartitions("bin")
    return map_batches(rows, run, "token long, sid long, n long, leader long, leader_n long, size long")


# -- 3 and 4: comparisons ------------------------------------------------------


def _can_link(n: Column, m: Column) -> Column:
    return (n * 100 >= m * PERCENT) & (m * 100 >= n * PERCENT)


def _common_needed(n: Column, m: Column) -> Column:
    """The prefix tokens that sets of n and m tokens that link surely share:
    their intersection, less what can lie behind the prefixes."""
    both = F.ceil((n + m) * PERCENT / (100 + PERCENT))
    behind = F.ceil(F.greatest(n, m) * PERCENT / 100) - 1
    return F.greatest(both - behind, F.lit(1))


def _needed_of_groups(lo: Column, hi: Column) -> Column:
    """No more than ``_common_needed`` of any sizes from lo to hi: for sizes
    m <= n it is over 3 (n + m) / 7 - 3 n / 4 = (12 m - 9 n) / 28."""
    return F.greatest(F.floor((lo * 12 - hi * 9) / 28) + 1, F.lit(1))


def short(tokens: np.ndarray) -> np.ndarray:
    """The first two bytes of each token of a set, repeats kept: a token that
    two sets share is in both of their short sets."""
    return (tokens >> np.uint64(48)).astype(np.uint16)


def _sets(docs: DataFrame, wanted: DataFrame, shape=lambda tokens: tokens) -> DataFrame:
    """(sid, tokens) of the wanted sets, with the other columns of ``wanted``,
    which has a row for each sid; ``shape`` makes the tokens sent.  Tasks send the sets that hit a bitmap of
    the wanted (of ``BITMAP`` bits a set, ``MAX_BITMAP`` at most), and a join
    drops the few others."""
    wanted = staged(wanted, "wanted")
    bits = min(MAX_BITMAP, 1 << max(10, int(wanted.count() * BITMAP).bit_length()))
    slots = wanted.select(F.pmod("sid", F.lit(bits)).alias("slot")).groupBy(F.floor(F.col("slot") / 8).alias("byte")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(slot % 8 as int))")).alias("mask")
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    packed = slots.toPandas()  # MAX_BITMAP / 8 rows at most
    bitmap[packed["byte"].to_numpy(np.int64)] = packed["mask"].to_numpy(np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            sids, tokens = [], []
            for t in _sets_of(utf8(b, "text")):
                sid = _digest(t)[0]
                slot = sid % bits
                if len(t) and sid not in seen and shared.value[slot >> 3] >> (slot & 7) & 1:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(sid)
                    sids.append(sid), tokens.append(shape(t).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(tokens, pa.binary())], ["sid", "tokens"])

    rows = map_batches(docs.select("text"), run, "sid long, tokens binary")
    return rows.join(wanted, "sid").dropDuplicates(["sid"])


class Group:
    """A group's sets as their union of tokens, ready to be queried.  Of short
    sets, ``links`` has every member that may link, and others."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(t) for t in sets])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.union, self.of = np.unique(np.concatenate(sets), return_inverse=True)

    def links(self, q: np.ndarray) -> np.ndarray:
        """The members that link with a set, if the union lets it be opened."""
        at = np.minimum(np.searchsorted(self.union, q), len(self.union) - 1)
        hit = at[self.union[at] == q]
        if 100 * len(hit) < PERCENT * len(q):
            return np.zeros(0, np.int64)  # the bound: the group stays closed
        found = np.zeros(len(self.union), bool)
        found[hit] = True
        both = np.add.reduceat(found[self.of], self.starts, dtype=np.int64)
        return np.flatnonzero(100 * both >= PERCENT * (self.sizes + len(q) - both))


class Forest:
    """Says of each link whether it joins two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def _inside(sets: DataFrame) -> DataFrame:
    """(a, b): links between members of a group, a spanning forest of them;
    ``sets`` (gid, sid, tokens) holds whole groups."""
    rows = sets.select("gid", "sid", "tokens").repartition("gid").sortWithinPartitions("gid", "sid")

    def run(batches):
        now, names, held = None, [], []

        def done():
            out = []
            if len(held) > 1:
                group, forest = Group(held), Forest()
                for name, q in zip(names, held):
                    out += [(name, names[j]) for j in group.links(q) if names[j] > name and forest.join(name, names[j])]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            for g, sid, tokens in zip(*(column(b, c).to_pylist() for c in ("gid", "sid", "tokens"))):
                if g != now:
                    yield done()
                    now, names, held = g, [], []
                names.append(sid), held.append(np.frombuffer(tokens, np.uint64))
        yield done()

    return map_batches(rows, run, "a long, b long")


def _sent(pairs: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(gid, part, kind, of, sid, label, tokens): the classes to compare for
    pairs of groups (gid, other) with ``groups`` (sid, gid, label), a task's
    rows together: the group ``gid`` (kind 0), then the classes of ``other``
    (kind 1; ``of`` is the group of a class), the queries on it.  A group with
    many partners is dealt to several tasks.  Where each class goes is found
    without its tokens, which are joined to that last."""
    parts = pairs.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_TASK).alias("parts"))
    part = F.pmod(F.xxhash64("other"), F.col("parts")).alias("part")
    heads = parts.select(
        "gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.col("gid").alias("of")
    )
    asked = pairs.join(parts, "gid").select("gid", part, F.lit(1).alias("kind"), F.col("other").alias("of"))
    members = groups.select(F.col("gid").alias("of"), "sid", "label")
    sent = heads.unionByName(asked).join(members, "of").join(sets, "sid").select("gid", "part", "kind", "of", "sid", "label", "tokens")
    return sent.repartition("gid", "part").sortWithinPartitions("gid", "part", "kind", "of", "sid")


def _possible(pairs: DataFrame, groups: DataFrame, shorts: DataFrame) -> DataFrame:
    """(gid, other): the pairs of groups that hold two classes whose short
    sets meet in as many tokens as a link needs."""
    rows = _sent(pairs, groups, shorts)

    def run(batches):
        now, held, group, done = None, [], None, None
        for b in batches:
            out = []
            for g, p, kind, of, tokens in zip(*(column(b, c).to_pylist() for c in ("gid", "part", "kind", "of", "tokens"))):
                if (g, p) != now:
                    now, held, group, done = (g, p), [], None, None
                q = np.frombuffer(tokens, np.uint16)
                if kind == 0:
                    held.append(q)
                    continue
                if group is None:
                    group = Group(held)
                if of != done and len(group.links(q)):
                    done = of
                    out.append((g, of))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["gid", "other"])

    return map_batches(rows, run, "gid long, other long")


def _across(pairs: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between the classes of pairs of groups (gid, other) with
    ``groups`` (sid, gid, label): those that join components, in the eyes of a
    task.  The union of the group ``gid`` is built once a task."""
    rows = _sent(pairs, groups, sets)

    def run(batches):
        now, names, labels, held, group, forest = None, [], [], [], None, None
        for b in batches:
            out = []
            for g, p, kind, sid, label, tokens in zip(*(column(b, c).to_pylist() for c in ("gid", "part", "kind", "sid", "label", "tokens"))):
                if (g, p) != now:
                    now, names, labels, held, group, forest = (g, p), [], [], [], None, Forest()
                q = np.frombuffer(tokens, np.uint64)
                if kind == 0:
                    names.append(sid), labels.append(label), held.append(q)
                    continue
                if group is None:
                    group = Group(held)
                if all(forest.root(x) == forest.root(label) for x in set(labels)):
                    continue
                out += [(sid, names[j]) for j in group.links(q) if forest.join(label, labels[j])]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return map_batches(rows, run, "a long, b long")


def _groups(buckets: DataFrame) -> DataFrame:
    """(sid, n, gid, members) of every class with a bucket.  A class follows
    the leader of a size that can link that it shares most prefix tokens with,
    else itself; the followers of a leader are a group, or where they are many
    several, of like sizes, dealt by hash."""
    sizes = buckets.groupBy("sid").agg(F.first("n").alias("n"))
    met = buckets.filter("sid <> leader").groupBy("sid", "leader").agg(
        F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("leader_n").alias("m")
    ).filter(_can_link(F.col("n"), F.col("m")))
    best = met.groupBy("sid").agg(F.max(F.struct("c", "leader")).alias("x")).select("sid", F.col("x.leader").alias("leader"))
    of = sizes.join(best, "sid", "left").select("sid", "n", F.coalesce("leader", "sid").alias("leader"))
    of = staged(of, "leaders")
    stars = of.groupBy("leader").agg(F.count(F.lit(1)).alias("star"))
    band = F.when(F.col("star") > GROUP_SIZE, F.floor(F.log(F.col("n").cast("double")) / float(np.log(SIZE_BAND)))).otherwise(-1)
    banded = of.join(stars, "leader").select("sid", "n", "leader", band.alias("band"))
    counts = banded.groupBy("leader", "band").agg(F.count(F.lit(1)).alias("like"))
    part = F.pmod(F.xxhash64("sid"), F.ceil(F.col("like") / GROUP_SIZE))
    dealt = banded.join(counts, ["leader", "band"]).select("sid", "n", F.xxhash64("leader", "band", part).alias("gid"))
    dealt = staged(dealt, "dealt")
    return dealt.join(dealt.groupBy("gid").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight")), "gid")


def _matrix(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """The token-group matrix: a row for each prefix token of a group, with
    the number and sizes of the classes that hold it."""
    placed = buckets.select("token", "sid").join(groups.select("sid", "n", "gid", "weight"), "sid")
    return placed.groupBy("token", "gid").agg(
        F.count(F.lit(1)).alias("held"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.first("weight").alias("weight")
    )


def _own_pairs(matrix: DataFrame) -> DataFrame:
    """(gid): groups that may hold a link inside: the prefix tokens that two
    or more of their classes hold reach what a link needs."""
    shared = matrix.filter("held > 1").groupBy("gid").agg(F.count(F.lit(1)).alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return shared.filter(F.col("c") >= _needed_of_groups(F.col("lo"), F.col("hi"))).select("gid")


def _group_pairs(matrix: DataFrame) -> DataFrame:
    """(gid, other, c): pairs of groups that may hold a link, found in the
    token-group matrix, with the number of prefix tokens in which they meet.
    ``gid`` is the one with more tokens."""
    mixed = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("token")
    matrix = staged(matrix.join(mixed, "token", "left_semi"), "mixed")
    other = matrix.select("token", *(F.col(c).alias(f"o_{c}") for c in ("gid", "lo", "hi", "weight")))
    first = (F.col("weight") > F.col("o_weight")) | (F.col("weight") == F.col("o_weight")) & (F.col("gid") > F.col("o_gid"))
    near = (F.col("hi") * 100 >= F.col("o_lo") * PERCENT) & (F.col("o_hi") * 100 >= F.col("lo") * PERCENT)
    met = matrix.join(other, "token").filter(first & near)
    shared = met.groupBy("gid", F.col("o_gid").alias("other")).agg(
        F.count(F.lit(1)).alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("o_lo").alias("o_lo"), F.max("o_hi").alias("o_hi")
    )
    return shared.filter(F.col("c") >= _needed_of_groups(F.least("lo", "o_lo"), F.greatest("hi", "o_hi"))).select("gid", "other", "c")


def _labelled(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` with the label of each class's component so far."""
    return groups.join(components(links).withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs of groups that are not wholly in one component."""
    span = groups.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    joined = pairs.join(span, "gid").join(span.select(F.col("gid").alias("other"), F.col("lo").alias("o_lo"), F.col("hi").alias("o_hi")), "other")
    return joined.filter("not (lo = hi and o_lo = o_hi and lo = o_lo)").select("gid", "other")


def _ends(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """(sid): the classes of the groups in pairs."""
    ends = pairs.select("gid").unionByName(pairs.select(F.col("other").alias("gid")))
    return groups.join(ends, "gid", "left_semi").select("sid")


def _links(buckets: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all links."""
    groups = staged(_groups(buckets), "groups")
    matrix = staged(_matrix(buckets, groups), "matrix")
    own, pairs = staged(_own_pairs(matrix), "own"), staged(_group_pairs(matrix), "group-pairs")
    sets = staged(_sets(docs, groups.join(own, "gid", "left_semi").select("sid", "gid")), "sets")
    links = staged(_inside(sets), "links")
    either = pairs.select(F.col("gid").alias("g"), "gid", "other", "c").unionByName(pairs.select(F.col("other").alias("g"), "gid", "other", "c"))
    best = either.groupBy("g").agg(F.max(F.struct("c", "gid", "other")).alias("x")).select("x.*").distinct()
    best = staged(best.select("gid", "other"), "best")
    rest = pairs.select("gid", "other").join(best, ["gid", "other"], "left_anti")  # best ones are compared whole, no need to do it again
    for step in (best, rest):
        if not step.limit(1).count():
            break
        labelled = staged(_labelled(groups, links).select("sid", "gid", "label"), "labelled")
        left = staged(_apart(step, labelled), "left")
        if not left.limit(1).count():
            continue
        shorts = staged(_sets(docs, _ends(left, labelled), short), "short-sets")
        left = staged(_possible(left, labelled, shorts), "possible")
        if left.limit(1).count():
            sets = staged(_sets(docs, _ends(left, labelled)), "sets")
            links = staged(links.unionByName(_across(left, labelled, sets)), "links")
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document row."""
    docs = docs.select("doc_id", "text")
    sketch = staged(_sketch(docs), "shingle-sets")
    members = sketch.filter("n is not null").select("doc_id", "n", "d1", "d2")
    classes = staged(
        members.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "classes"
    )
    length = F.col("n") + 1 - F.ceil(F.col("n") * PERCENT / 100)
    total = classes.agg(F.sum(length)).first()[0] or 0
    bins = max(1, int(total**0.5 / 8))
    counted = sketch.filter("often is not null").groupBy("d1").agg(F.sum("often").alias("c")).filter(F.col("c") >= FREQUENT)
    top = counted.orderBy(F.desc("c"), "d1").limit(MAX_FREQUENT).toPandas()
    known = dict(zip(top["d1"].to_numpy(np.int64).view(np.uint64).tolist(), top["c"].tolist()))
    while True:
        frequent = np.array(sorted(known), np.uint64)
        levels = np.array([int(known[t]).bit_length() for t in frequent.tolist()], np.uint8)
        buckets = staged(_buckets(_prefixes(docs, frequent, levels, bins)), "buckets")
        large = buckets.filter(F.col("size") > LARGE_BUCKET).groupBy("token").agg(F.first("size").alias("c"))
        room = MAX_FREQUENT - len(known)
        found = large.orderBy(F.desc("c"), "token").limit(max(0, room) + len(known)).toPandas()
        new = [(t, c) for t, c in zip(found["token"].to_numpy(np.int64).view(np.uint64).tolist(), found["c"].tolist()) if t not in known]
        if not new[: max(0, room)]:
            break
        known.update(new[: max(0, room)])  # a better order, and once more
    labels = components(_links(buckets, docs))
    named = classes.join(labels, classes["d1"] == labels["node"], "left").select(
        "d1", "d2", "rep", F.coalesce("label", "d1").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = named.join(smallest, "label").select("d1", "d2", "component_id")
    return members.join(of, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (of rows
    that repeat it, one); rows with a null doc_id stay."""
    kept = near_duplicates(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    one = docs.filter("doc_id is not null").join(kept, F.col("doc_id") == F.col("__kept"), "left_semi")
    one = one.withColumn("__row", F.row_number().over(first)).filter("__row = 1").drop("__row")
    return one.unionByName(docs.filter("doc_id is null"))
