"""Language identification, the filter interaction audit and the
fill-in-the-middle transformation against plain versions of each."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import fill_middle, filter_audit, language

SF = "/root/testdata/sf0.01"


# -- fill-in-the-middle --------------------------------------------------------


def brute_middle(doc_id, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or h3 % 100 >= 90 or any(s in text for s in ("<P>", "<S>", "<M>")):
        return len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD_TEXTS = [
    None, "", " ", "a", "ab cd", "<P>", "x<S>y", "<M", "<<<>>>", "<P<S<M", "P>S>M>", "日本語 текст ñandú\u0000 end\U0001f600z",
    "lorem ipsum " * 100_000, "é" * 5, "\n\r\n", "Zz9", "<S" * 30, ">" * 9,
]


def test_middle_equals_the_plain_version(spark, texts):
    rows = [(d, t, "x") for d, t in texts.items()]
    rows += [(10_000 + 50 * j + k, t, None) for k, t in enumerate(ODD_TEXTS) for j in range(9)] + [(None, "of no one", "y"), (None, None, "y")]
    rows += [(10_004, "ab cd", "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string")  # form clashes: replaced
    out = fill_middle.transform(docs)
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect())
    assert got == Counter((d, *brute_middle(d, t)) for d, t, _ in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = fill_middle.restore(out.select("doc_id", "text", "output", "form"))
    assert back.filter(F.coalesce("text", F.lit("")) != F.col("restored")).count() == 0
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    report = Counter((r.doc_id, r.n, r.form, r.output_sha256, r.restored_sha256) for r in fill_middle.report(docs).collect())
    want = Counter()
    for d, t, _ in rows:
        n, form, _, _, o = brute_middle(d, t)
        want[(d, n, form, sha(o), sha(t or ""))] += 1
    assert report == want
    assert fill_middle.report(docs.limit(0)).count() == 0


def test_pieces_are_cut_and_permuted_without_copies():
    text = b"one two three"
    whole = fill_middle.PieceTable([text, fill_middle.SENTINELS], [(0, 0, len(text))])
    parts = whole.cut(0, 3, 7)
    assert [bytes(v) for v in parts.views()] == [b"one", b" two", b" three"]
    assert parts.arranged([2, 0, 1]).write() == b" threeone two" and parts.write() == text
    assert all(v.obj is text for v in parts.views())


def test_units_across_slices(monkeypatch):
    monkeypatch.setattr(fill_middle, "SLICE", 7)
    text = "abcdefgh ijklmnopqrstuv, é日本 wxyz".encode()
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text.decode())
    assert fill_middle.count_units(text) == len(units)
    starts = [len("".join(units[:k]).encode()) for k in range(len(units) + 1)]
    for a in range(len(units) + 1):
        for b in range(a, len(units) + 1):
            assert fill_middle.places_of(text, [a, b]) == [starts[a], starts[b]]


# -- filter audit --------------------------------------------------------------


def brute_audit(docs, labels):
    good, toxic = ({d for d, *f in labels if f[k] == 1 and d is not None} for k in (0, 1))
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    fails = []
    for d, t, lang in docs:
        t = t or ""
        w = [x for x in re.split("[ \t-\r]+", t) if x]
        fails.append((lang or "", d, {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and first[t] < d,
        }))
    out, total = {}, Counter()
    for part in {p for p, _, _ in fails}:
        rows = [(d, f) for p, d, f in fails if p == part]
        for order in permutations("ABCDE"):
            left = rows
            for k, letter in enumerate(order):
                gone = [(d, f) for d, f in left if f[letter]]
                left = [(d, f) for d, f in left if not f[letter]]
                failing = [f for _, f in rows if f[letter]]
                total[part, letter] += len(gone)
                out[part, "".join(order), k + 1] = (
                    len(left), len(gone), len(failing) - len(gone), sum(sum(f.values()) == 1 for f in failing),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                )
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_walking_every_order(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["a", "b", "Cc", "d#", "long", "WORDS", "x"], rng.integers(0, 400))) for _ in range(60)]
    texts += [" ".join(f"w{k}" for k in range(300)), "y" * 100_000, None, "", " \n"]
    docs = [(int(rng.integers(0, 300)), texts[rng.integers(0, len(texts))], [None, "", "en", "fr"][rng.integers(0, 4)]) for _ in range(400)]
    docs += [(None, texts[0], "en"), (None, None, None), (7, "same row", "de"), (7, "same row", "de"), (8, "same row", "de"), (3, "only", "sv")]
    labels = [(int(d), int(rng.integers(0, 2)), int(rng.integers(0, 2))) for d in range(0, 300, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (8, None, None), (9, None, 1)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, lang string, mask int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(df, lab).collect()}
    assert got == brute_audit(docs, labels)
    assert filter_audit.audit(df.limit(0), lab).count() == 0
    assert filter_audit.audit(df, lab.limit(0)).count() == len(got)


def test_gray_walk_keeps_every_state():
    rng = np.random.default_rng(2)
    mask, n = rng.integers(0, 64, 40), rng.integers(1, 9, (40, 2))
    states = filter_audit.gray_walk(mask, n, 6)
    for subset in range(64):
        assert states[subset].tolist() == n[mask & subset == 0].sum(axis=0).tolist()


# -- language ------------------------------------------------------------------


def brute_counts(text):
    """Hashes of the 1- to 3-grams of the whole text, one by one."""
    s = " " + re.sub(r"[^\W\d_]|.", lambda m: m[0] if m[0].isalpha() else " ", text.lower(), flags=re.S)
    s = re.sub(" +", " ", s)
    out, mask = np.zeros(language.BUCKETS), 2**64 - 1
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            if i + n == 1:
                continue  # the space put before the text
            h = 0
            for j in range(n):
                h = (h * 0x100000001B3 + (0 if s[i + j] == " " else ord(s[i + j])) + j + 1) & mask
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = ((h ^ h >> shift) * factor) & mask
            out[(h ^ h >> 31) % language.BUCKETS] += 1
    return out


@pytest.mark.parametrize("text", ["a", "The cat, the mat", "  x--y ", "Ünïcode 日本語\n42 слова", "e" * 30])
def test_counts(text, monkeypatch):
    want = brute_counts(text)
    assert np.array_equal(language.counts(text), want)
    for size in (1, 2, 3, 5):
        monkeypatch.setattr(language, "SLICE", size)
        assert np.array_equal(language.counts(text), want)


def test_prediction_is_the_nearest_centroid(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = language.fit(docs)
    df, total, languages = language.document_frequencies(language.training_rows(docs))
    rows = docs.collect()
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    found = [brute_counts(r.text) for r in train]
    assert np.array_equal(df, np.sum([f > 0 for f in found], axis=0)) and total == len(train)
    assert languages == Counter(r.lang for r in train)
    for r, (lang, score, _) in zip(rows[:40], model.predict([r.text for r in rows[:40]])):
        x = brute_counts(r.text)
        x = np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0) * (np.log((1 + total) / (1 + df)) + 1)
        cosines = [float(x @ c / np.linalg.norm(x) / np.linalg.norm(c)) for c in model.centroids]
        assert score == pytest.approx(max(cosines)) and lang == model.languages[int(np.argmax(cosines))]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.report(docs).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) >= 0.99
    # the languages of held-out rows are not looked at
    blind = docs.withColumn("lang", F.when(~language.held_out(F.col("doc_id")), F.col("lang"))).withColumn("source", F.lit(None))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, language.report(blind).collect()))


def test_odd_language_rows(spark):
    rows = [(d, f"the word number {d} of the thing" if d % 2 else f"le mot de la chose {d} et des", "en" if d % 2 else "fr") for d in range(60)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "42 -- !", "en"), (103, "the thing " * 200_000, None), (None, "le mot", "xx"), (1, "the same id", "en")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    got = {(r.doc_id, r.lang_pred): r for r in language.report(docs).collect()}
    assert all(got[d, "und"].score == 0 for d in (100, 101, 102)) and (103, "en") in got and (None, "fr") in got
    assert language.report(docs.limit(0)).count() == 0
    unlabelled = language.report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"} and len(unlabelled) == len(rows)
    model = language.fit(docs)
    far = language.identify(spark.createDataFrame([(1, "жук шёл", 2)], "doc_id long, text string, rejected int"), model).first()
    assert far.rejected is True and far.lang_pred in ("en", "fr")
    tied = language.Model(np.ones(language.BUCKETS), np.ones((2, language.BUCKETS)) / language.BUCKETS**0.5, ["aa", "bb"], np.zeros(2))
    assert tied.predict(["x"])[0][0] == "aa"
