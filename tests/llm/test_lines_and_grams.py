"""Line dedup, n-gram Jaccard join and decontamination against brute force."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import decontam, graph, line_dedup, ngram_join
from tessera.llm.words import word_hashes

A = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# -- line dedup ----------------------------------------------------------------


def key(line):
    return line.translate(A).strip(" \t\n\x0b\x0c\r")


def brute_lines(rows):
    held = defaultdict(set)
    for d, t in rows:
        if d is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 10:
                    held[key(x)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(held.get(key(x), ())) < 2 or min(held[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def brute_kept(rows):
    """The texts of rows (doc_id, text) without their repeated lines."""
    held = defaultdict(set)
    for d, t in rows:
        if d is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 10:
                    held[key(x)].add(d)
    return [
        t if t is None or d is None else "\n".join(x for x in t.split("\n") if len(held.get(key(x), ())) < 2 or min(held[key(x)]) == d)
        for d, t in rows
    ]


def test_lines_of_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(tuple(r) for r in line_dedup.report(odd).collect()) == brute_lines(rows)
    kept = line_dedup.dedup_lines(odd)
    assert kept.columns == ["doc_id", "text", "source", "n_words", "n_lines", "n_dropped"] and kept.count() == odd.count()
    assert line_dedup.report(none).count() == 0


def test_clashing_columns_of_lines(spark):
    line = "a line of two documents"
    df = spark.createDataFrame([(1, line, "x", 7), (2, "own\n" + line, "y", 8)], "doc_id long, text string, th string, n_lines long")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "th", "n_lines", "n_dropped"]
    assert sorted(map(tuple, out.collect())) == [(1, line, "x", 1, 0), (2, "own", "y", 2, 1)]


def test_hot_lines_take_the_broadcast_and_cold_ones_the_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 16)
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 6)
    rnd = random.Random(5)
    rows = [(d, "\n".join(["the line of all documents"] + [f"shared line number {rnd.randrange(40)}" for _ in range(4)])) for d in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in line_dedup.report(df).collect()) == brute_lines(rows)


def test_minimal_perfect_hash_is_a_bijection_and_rejects_strangers():
    rnd = np.random.default_rng(1)
    h1, h2 = rnd.integers(-(2**62), 2**62, (2, 5000))
    h1[:50] = h1[0]  # equal halves
    index = line_dedup.ShardIndex.build(h1, h2, np.full(5000, 2), np.arange(5000))
    assert sorted(index.slots(h1, h2)) == list(range(5000))
    member, keeper = line_dedup._unpack(line_dedup._pack(index)).keeper(h1, h2)
    assert member.all() and (keeper == np.arange(5000)).all()
    assert not index.keeper(*rnd.integers(-(2**62), 2**62, (2, 5000)))[0].any()


# -- n-gram Jaccard join -------------------------------------------------------


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    ids = sorted({d for d, _ in rows if d is not None})
    sets = {d: grams(t) for d, t in rows if d is not None}
    up = {d: d for d in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def near_copies(seed, groups=12, noise=30):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(6, 150))]
        for _ in range(rnd.randint(1, 14)):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                text[rnd.randrange(len(text))] = rnd.choice(vocab)
            rows.append(" ".join(text))
    for _ in range(noise):
        own = [rnd.choice(vocab) for _ in range(rnd.randint(0, 80))]
        rows.append(" ".join(own + passage if rnd.random() < 0.5 else own))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def crowd(seed, size=60):
    """Near copies of one text, most pairs close to the threshold: few link."""
    rnd = random.Random(seed)
    base = ["w%d" % k for k in range(120)]
    rows = []
    for k in range(size):
        text = list(base)
        for at in rnd.sample(range(120), rnd.choice([3, 4, 5])):
            text[at] = f"own{k}.{at}"
        rows.append(" ".join(text))
    return list(enumerate(rows))


@pytest.mark.parametrize("rows", [near_copies(1), near_copies(2), crowd(4)])
def test_components_equal_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(ngram_join, "GROUP_SIZE", 4)
    monkeypatch.setattr(ngram_join, "LARGE_BUCKET", 8)
    monkeypatch.setattr(ngram_join, "PAIRS_A_TASK", 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_the_bound_of_groups_is_no_more_than_any_sizes_need(spark):
    def needed(n, m):
        return max(-(-(n + m) * 75 // 175) - -(-max(n, m) * 75 // 100) + 1, 1)

    df = spark.createDataFrame([(lo, hi) for lo in range(1, 150) for hi in range(lo, 150)], "lo long, hi long")
    bound = {(r.lo, r.hi): r.x for r in df.select("lo", "hi", ngram_join._needed_of_groups(df["lo"], df["hi"]).alias("x")).collect()}
    assert 10 <= bound[100, 100] <= needed(100, 100) and bound[100, 104] >= 9
    for n in range(1, 150):
        for m in range(n, min(149, n * 100 // 75) + 1):
            for lo in range(max(1, n - 3), n + 1):
                assert bound[lo, m] <= needed(n, m)


def test_group_queries_find_the_links_and_forests_join_once():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    group = ngram_join.Group(sets[:20])
    for q in sets:
        assert group.links(q).tolist() == [j for j in range(20) if ngram_join.linked(q, sets[j])]
    forest = ngram_join.Forest()
    assert [forest.join(*e) for e in ((1, 2), (3, 4), (2, 1), (4, 1), (3, 2))] == [True, True, False, True, False]


def test_short_sets_keep_every_link():
    rnd = np.random.default_rng(5)
    for n in (1, 5, 60, 400):
        base = rnd.integers(0, 1 << 63, n * 2).astype(np.uint64)
        sets = [np.unique(np.concatenate((base[: n - k], base[n : n + k]))) for k in range(0, n, max(1, n // 20))]
        group = ngram_join.Group([ngram_join.short(t) for t in sets])
        for q in sets:
            may = group.links(ngram_join.short(q)).tolist()
            assert {j for j, t in enumerate(sets) if ngram_join.linked(q, t)} <= set(may)
            assert n < 60 or len(may) < len(sets)


def test_a_pair_of_groups_is_sent_whole_once_and_only_if_it_may_link(spark, monkeypatch):
    pairs, across = [], ngram_join._across

    def seen(left, *more):
        pairs.extend((r.gid, r.other) for r in left.collect())
        return across(left, *more)

    monkeypatch.setattr(ngram_join, "_across", seen)
    monkeypatch.setattr(ngram_join, "GROUP_SIZE", 4)
    for rows in (near_copies(1), crowd(4)):
        pairs.clear()
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
        assert got == brute_components(rows)
        assert len(pairs) == len(set(pairs))
    pairs.clear()
    shared = " ".join(f"s{k}" for k in range(60))  # one passage, no links
    far = spark.createDataFrame([(k, shared + "".join(f" own{k}.{j}" for j in range(40))) for k in range(30)], "doc_id long, text string")
    assert ngram_join.near_duplicates(far).filter("component_id <> doc_id").count() == 0
    assert not pairs


def test_components_of_odd_rows(odd, none):
    rows = ngram_join.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by[4] == 4 and by[1] == 1 and by[2] == 2 and by[8] == 8
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, None, 7, 8, 9])  # 5 is near 4
    assert ngram_join.near_duplicates(none).count() == 0


def test_word_hashes_follow_the_words():
    rnd = random.Random(2)
    texts = [None, b"", b" a  b ", "Ä ä É\x0b tab\tnew\nline".encode(), *("".join(rnd.choice("ab \n\x0cC") for _ in range(n)).encode() for n in range(60))]
    seen = {}
    for text, hashes in zip(texts, word_hashes(texts)):
        words = (text or b"").lower().split()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    big = b"word " * 300_000 + b"x" * 2_000_000
    one, two = word_hashes([big])[0], word_hashes([b"word", b"x" * 2_000_000])
    assert len(one) == 300_001 and one[5] == two[0][0] and one[-1] == two[1][0]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


# -- decontamination -----------------------------------------------------------


def dwords(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A))


def brute_hits(docs, items):
    wins = [(str(i), tuple(w[k : k + min(10, len(w))])) for i, t in items for w in [dwords(t)] if w for k in range(max(1, len(w) - 9))]
    out = []
    for d, t in docs:
        w, hit, found = dwords(t), set(), set()
        for item, win in wins:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= {item} - {"None"}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("max_windows, piece", [(1_000_000, 50_000), (60, 2)])
def test_hits_equal_brute_force(spark, monkeypatch, max_windows, piece):
    monkeypatch.setattr(decontam, "PIECE", piece)
    rnd = random.Random(3)
    vocab = "alpha Beta γάμμα d3 e f".split()
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 14)))) for i in range(12)] + [(99, None), (7, "alpha beta"), (None, "of no id f e")]
    docs = [(d, "-".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60))) + (items[d % 12][1] or "")) for d in range(40)]
    docs += [(1, None), (2, ""), (3, "alpha, BETA!"), (3, "alpha, BETA!"), (41, "one of no id f e."), (None, "alpha beta")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert Counter(tuple(r) for r in decontam.report(df, bench, max_windows=max_windows).collect()) == brute_hits(docs, items)


def test_removal(spark, odd, none):
    bench = spark.createDataFrame([(1, "that several documents")], "item_id long, text string")
    kept = decontam.remove(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, 7, 8, 9}
    cut = {r.doc_id: r.text for r in decontam.remove(odd, bench, how="spans").collect()}
    assert cut[4] == "a line  share, word for word" and cut[1] is None and cut[9] == "日本語 текст ñandú\u0000 end"
    assert decontam.report(none, bench).count() == 0
    assert decontam.report(odd, bench.limit(0)).filter("contaminated").count() == 0


def test_staged_tables_leave_no_shuffle_files(spark):
    import glob
    import os
    import tempfile
    import time

    from tessera.llm.common import FILE_CLEANUP, staged

    base = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())

    def files():
        return set(glob.glob(f"{base}/**/blockmgr-*/*/shuffle_*.data", recursive=True))

    was, before = spark.conf.get(FILE_CLEANUP, None), files()
    counts = spark.range(20000, numPartitions=4).groupBy("id").count()
    assert staged(counts, "counts").count() == 20000
    for _ in range(50):
        left = files() - before
        if sum(os.path.getsize(f) for f in left if os.path.exists(f)) < 20000:
            break
        time.sleep(0.1)
    else:
        raise AssertionError(left)
    assert spark.conf.get(FILE_CLEANUP, None) == was
