"""Toxicity by a weighted finite-state pattern grammar.

Two transducers are composed over a text's tokens.  The lexical one reads a
word letter by letter along a trie (whole words first, else the longest stem)
and writes its class and weight: insult, threat, target, negation, reported
speech.  The clause one reads the classes of one clause and writes its match:

* an insult or threat scores; one aimed at a target scores under its own
  weight;
* after a negation it is a negated match, inside a quotation or after a verb
  of saying a reported one, each under its own weight;
* the end of a sentence, a semicolon or a line break ends the clause.

A document's score is a logistic function of its matches by pattern.  Seed words are fixed below; further insult words and stems,
and all weights, are learned from labelled training rows (at most ``SAMPLE``
of each label, the lowest by hash of doc_id; near copies count once).
Inputs of a score are the words of the text alone.

Defined results: null and empty texts score like a text without a match; rows
with conflicting labels count as toxic; null labels, and labels without a
document, teach nothing; without training rows the seed words and prior
weights alone score; rows that repeat a doc_id are each scored by their own
text; a very long text is scored whole, in the task of its row; an empty table
gives an empty one; columns of the documents named ``score`` or ``predicted``
are replaced by the result's, and ``reject`` keeps every column as it is.

Bounds: ``SAMPLE`` labelled rows of each label, and of the terms learned from
them the ``MAX_TERMS`` with the most evidence (the terms come from the bounded
sample, so neither grows with the data).
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import column, map_batches, map_columns, staged

#: labelled rows of each label that are learned from, at most
SAMPLE = 6_000
#: learned words and stems kept, at most
MAX_TERMS = 5_000
STEMS = (4, 5, 6, 7)
FOLDS = 5
#: evidence (log-likelihood ratio) and odds a learned term needs
MIN_G2, MIN_ODDS = 24.0, 8.0

SEED_INSULTS = "idiot moron stupid scum worthless pathetic disgusting loser trash vermin imbecile dumbass bastard arschloch dummkopf abschaum connard salaud ordure estúpido basura escoria gilipollas".split()
THREATS = "kill murder hurt destroy strangle stab shoot burn töten umbringen erschießen tuer égorger massacrer matar asesinar degollar".split()
TARGETS = "you your yours u ya he she they them those people dich dir euch ihr tu toi vous te ti usted ustedes vosotros".split()
NEGATIONS = "not no never without isn aren wasn nicht kein keine niemals pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says called calls wrote writes claimed reported quoted sagte schrieb nannte dit écrit déclaré dijo llamó escribió".split()

_TOKENS = re.compile(r"[^\W\d_]+|[.!?;\n\"“”«»]")
INSULT, THREAT, TARGET, NEGATION, REPORT, END, QUOTE = range(1, 8)
PATTERNS = ["insult", "insult_aimed", "threat", "threat_aimed", "negated", "reported"]
#: prior weights of the patterns and of the constant
PRIOR = np.array([3.0, 3.5, 1.0, 2.5, 0.5, 0.5, -4.0])
_AFTER = 3  # words that a negation or a verb of saying reaches


class Lexicon(dict):
    """The lexical transducer: word -> (class, weight) or None, remembered."""

    def __init__(self, insults: dict[str, float]):
        super().__init__()
        self.insults = insults
        self.stems: list[dict] = [{}]
        self.ends: list[float | None] = [None]
        for term, weight in insults.items():
            if not term.startswith("^"):
                continue
            node = 0
            for c in term[1:]:
                if c not in self.stems[node]:
                    self.stems[node][c] = len(self.stems)
                    self.stems.append({})
                    self.ends.append(None)
                node = self.stems[node][c]
            self.ends[node] = weight
        fixed = [(TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT)]
        self.fixed = {w: (kind, 1.0) for ws, kind in fixed for w in ws}
        self.fixed |= dict.fromkeys(".!?;\n", (END, 0.0)) | dict.fromkeys('"“”«»', (QUOTE, 0.0))

    def __missing__(self, word: str):
        if len(self) > 300_000:
            self.clear()
        out = self.fixed.get(word)
        if out is None:
            weight = self.insults.get(word)
            if weight is None:
                node = 0
                for c in word:
                    node = self.stems[node].get(c)
                    if node is None:
                        break
                    if self.ends[node] is not None:
                        weight = self.ends[node]
            if weight is not None:
                out = (INSULT, weight)
        self[word] = out
        return out

    def __reduce__(self):
        return Lexicon, (self.insults,)


def matches(text: str | None, lexicon: Lexicon) -> list[float]:
    """The summed weights of a text's matches, by pattern."""
    out = [0.0] * len(PATTERNS)
    if not text:
        return out
    classes = [lexicon[w] for w in _TOKENS.findall(text.lower())]
    hot = [k for k, c in enumerate(classes) if c is not None and c[0] <= THREAT]
    done = -1
    for k in hot:
        if k <= done:
            continue
        start = k
        while start > 0 and not ((c := classes[start - 1]) is not None and c[0] == END):
            start -= 1
        end = k
        while end < len(classes) and not ((c := classes[end]) is not None and c[0] == END):
            end += 1
        done = end
        clause(classes[start:end], out)
    return out


def clause(classes: list, out: list[float]) -> None:
    """The clause transducer: its state is how far a negation and a verb of
    saying still reach, whether a quotation is open and a target was named."""
    negated = reported = 0
    quoted = False
    aimed = any(c is not None and c[0] == TARGET for c in classes)
    for c in classes:
        kind, weight = c or (0, 0.0)
        if kind == NEGATION:
            negated = _AFTER + 1
        elif kind == REPORT:
            reported = _AFTER + 1
        elif kind == QUOTE:
            quoted = not quoted
        elif kind in (INSULT, THREAT):
            if negated:
                out[4] += weight
            elif reported or quoted:
                out[5] += weight
            else:
                out[(0 if kind == INSULT else 2) + aimed] += weight
        negated, reported = max(0, negated - 1), max(0, reported - 1)


def _features(found: list[float]) -> list[float]:
    return [math.log1p(x) for x in found] + [1.0]


def _score(found: list[float], weights: np.ndarray) -> float:
    z = float(np.dot(_features(found), weights))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


# -- learning ------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _near_key(text: str) -> list[int]:
    words = text.lower().split()
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh3_64_intdigest(g) for g in grams] or [0]
    return [min((h * m) % 2**61 for h in hashes) for m in (1, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def _training(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    known = (
        labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("__doc")).agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64("__doc"), "__doc"]
    parts = [known.filter(F.col("toxic") == t).orderBy(*order).limit(sample) for t in (0, 1)]
    few = F.broadcast(staged(parts[0].unionByName(parts[1]), "labels"))  # 2 * sample rows at most
    texts = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("__doc")).select("text", "toxic")

    def run(batches):
        for b in batches:
            texts = [t or "" for t in column(b, "text").to_pylist()]
            keys = [_near_key(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), column(b, "toxic").cast(pa.int32())]
                + [pa.array([k[j] for k in keys], pa.int64()) for j in range(4)],
                ["text", "toxic", "k0", "k1", "k2", "k3"],
            )

    out = map_batches(texts, run, "text string, toxic int, k0 long, k1 long, k2 long, k3 long")
    for j in range(4):  # near copies count once for each label
        out = out.groupBy("toxic", f"k{j}").agg(F.min(F.struct("text", *(f"k{i}" for i in range(4)))).alias("x")).select(
            "toxic", "x.text", *(f"x.k{i}" for i in range(4))
        )
    return staged(out.select("text", "toxic"), "toxicity-train")


def _terms(train: DataFrame) -> dict[str, float]:
    """Words and stems that mark toxic texts, with their log odds."""
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return {}

    def run(batches):
        for b in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(column(b, "text").to_pylist(), column(b, "toxic").to_pylist()):
                words = set(_TOKENS.findall(text.lower()))
                terms = {w for w in words if len(w) > 2}
                terms.update("^" + w[:k] for w in words for k in STEMS if len(w) > k)
                seen[toxic].update(terms)
            both = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(both, pa.string()), *(pa.array([seen[t][w] for w in both], pa.int64()) for t in (1, 0))],
                ["term", "tox", "non"],
            )

    counts = map_batches(train, run, "term string, tox long, non long").groupBy("term").agg(
        F.sum("tox").alias("a"), F.sum("non").alias("b")
    )
    n1, n0 = float(totals[1]), float(totals[0])
    odds = ((F.col("a") + 0.5) / (n1 + 1)) / ((F.col("b") + 0.5) / (n0 + 1))
    each = F.col("a") + F.col("b")
    g2 = 2 * (
        F.col("a") * F.log(F.greatest(F.col("a"), F.lit(1e-9)) * (n1 + n0) / (each * n1))
        + F.col("b") * F.log(F.greatest(F.col("b"), F.lit(1e-9)) * (n1 + n0) / (each * n0))
    )
    best = counts.filter("a >= 3").select("term", "a", odds.alias("odds"), g2.alias("g2")).filter(
        (F.col("odds") >= MIN_ODDS) & (F.col("g2") >= MIN_G2)
    ).orderBy(F.desc("g2"), "term").limit(MAX_TERMS)
    found = {r["term"]: r for r in best.collect()}
    out = {}
    for term, r in found.items():
        if term.startswith("^"):
            longer = [x for x in found if x.startswith(term) and len(x) == len(term) + 1 or x.startswith(term[1:])]
            if any(found[x]["a"] >= 0.95 * r["a"] for x in longer):
                continue  # one longer stem or a whole word says the same
        out[term] = math.log(r["odds"])
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Lexicon, np.ndarray]:
    train = _training(docs, labels, sample)
    lexicon = Lexicon({**dict.fromkeys(SEED_INSULTS, 4.0), **_terms(train)})
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for b in batches:
            x = [matches(t, shared.value) for t in column(b, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), column(b, "toxic")], ["x", "toxic"])

    rows = map_batches(train, run, "x array<double>, toxic int").collect()  # 2 * sample short rows
    weights = PRIOR.copy()
    if rows:
        x = np.array([_features(r["x"]) for r in rows])
        y = np.array([float(r["toxic"]) for r in rows])
        penalty = np.diag([1.0] * len(PATTERNS) + [0.1])
        for _ in range(30):  # Newton steps towards the prior's neighbourhood
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            gradient = x.T @ (p - y) + penalty @ (weights - PRIOR)
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
            weights = weights - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
    return lexicon, weights


# -- scoring -------------------------------------------------------------------


def score(docs: DataFrame, model: tuple[Lexicon, np.ndarray]) -> DataFrame:
    """``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch):
        lexicon, weights = shared.value
        s = [_score(matches(t, lexicon), weights) for t in column(b, "text").to_pylist()]
        return [pa.array(s, pa.float64()), pa.array([int(v >= 0.5) for v in s], pa.int32())]

    return map_columns(docs, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], run)


def report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    model = fit(docs, labels, sample)
    rows = docs.select("doc_id", "text")
    return score(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def reject(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def run(batches):
        lexicon, weights = shared.value
        for b in batches:
            yield b.filter(pa.array([_score(matches(t, lexicon), weights) < 0.5 for t in column(b, "text").to_pylist()], pa.bool_()))

    return map_batches(docs, run, docs.schema)
