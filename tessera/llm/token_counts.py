"""Token counts by a finite-state compilation of a BPE tokenizer.

The vocabulary of a sentencepiece BPE model (identity normaliser, dummy
prefix, byte fallback) is compiled, state by state as texts need it, into a
deterministic transducer over characters:

* In a BPE encoding every two neighbouring tokens encode to themselves when
  joined, and a sequence with that property is the encoding.  So the last
  token of a prefix is the one piece that ends there and is compatible with
  the last token of the prefix before it.
* A state holds the positions from which a piece may still be in the making:
  for each the trie node reached since, the last token before it and the
  token count there, relative to the count now.  That is finite, and a
  character leads to one next state.
* Each transition is annotated with the change of the prefix's token count;
  the sum along a path is the number of tokens.

No piece holds a space mark after another character, so the transducer is in
its start state at each mark that follows one.  A chunk of text is thereby a
map that is known up to its first and last fragment: (head, count between,
tail).  These maps form a monoid; the chunks of one text compose by a
balanced (parallel prefix) tree, and repeated words reuse their path's sum.

Defined results: null and empty texts have 0 tokens; every row gets a row, rows
that repeat a doc_id each their own; a very long text is counted whole, chunk
by chunk; an empty table gives an empty one; extra columns ride along, but for
those that have the names of the added ones, which are replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import column, map_columns

MARK = "▁"
CHUNK = 1 << 16
#: entries kept of transitions and of word counts before they start anew
MAX_MEMO = 1_000_000
MAX_WORDS = 500_000
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Transducer:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.chars = {c for p in scores for c in p}
        self.single = {c for c in self.chars if c in scores}
        self.trie: list[dict[str, int]] = [{}]
        self.piece: list[str | None] = [None]
        for p in scores:
            if len(p) > 1 and self.merge(p) != [p]:
                continue  # no sequence of merges makes it
            node = 0
            for c in p:
                nxt = self.trie[node].get(c)
                if nxt is None:
                    nxt = self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.piece.append(None)
                node = nxt
            self.piece[node] = p
        self.pairs: dict[tuple[str, str], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.words = _Words(self)
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.n_moves = 0
        self.start = self._state(((0, None, 0),))

    def merge(self, s: str) -> list[str]:
        """The encoding by its definition: the best-scored neighbouring pair
        merges first, the leftmost of equals."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _joins(self, a: str | None, b: str) -> bool:
        if a is None:
            return True
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > MAX_MEMO:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return known

    def _state(self, key: tuple) -> int:
        at = self.ids.get(key)
        if at is None:
            at = self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return at

    def _move(self, state: int, c: str) -> tuple[int, int]:
        self.n_moves += 1
        if c not in self.single:  # bytes, and nothing joins across them
            move = self._state(((0, None, 0),)), len(c.encode())
        else:
            reached, last, delta = [], None, 0
            for node, before, count in self.states[state]:
                nxt = self.trie[node].get(c)
                if nxt is None:
                    continue
                p = self.piece[nxt]
                if last is None and p is not None and self._joins(before, p):
                    last, delta = p, count + 1
                if self.trie[nxt]:
                    reached.append((nxt, before, count))
            open_ = tuple((n, b, k - delta) for n, b, k in reached) + ((0, last, 0),)
            move = self._state(open_), delta
        self.moves[state][c] = move
        return move

    def run(self, segment: str) -> int:
        """Tokens of a segment that begins in the start state."""
        if self.n_moves > MAX_MEMO:
            self._reset()
        state, n, moves = self.start, 0, self.moves
        for c in segment:
            m = moves[state].get(c) or self._move(state, c)
            state = m[0]
            n += m[1]
        return n

    def count(self, marked: str) -> int:
        """Tokens of a text whose spaces are marks, the first included."""
        if not marked:
            return 0
        words = marked.split(MARK)
        if "" in words[1:] or words[0]:  # runs of marks, or a fragment
            return sum(map(self.run, _SEGMENT.findall(marked)))
        return sum(map(self.words.__getitem__, words[1:]))

    def chunk(self, marked: str) -> tuple[str, int, str | None]:
        """The map of a chunk: its fragment up to the first restart, the count
        between, the fragment from the last restart (None: no restart)."""
        parts = _SEGMENT.findall(marked)
        if len(parts) < 2:
            return marked, 0, None
        return parts[0], sum(map(self.run, parts[1:-1])), parts[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[2] is None:
            return (a[0] + b[0], b[1], b[2])
        if b[2] is None:
            return (a[0], a[1], a[2] + b[0])
        return (a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2])

    def tokens(self, text: str | None) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if len(marked) <= CHUNK:
            return self.count(marked)
        maps = [self.chunk(marked[i : i + CHUNK]) for i in range(0, len(marked), CHUNK)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, n, tail = maps[0]
        return self.count(head) + n + (self.count(tail) if tail is not None else 0)


def load_scores(model: bytes) -> dict[str, float]:
    """The normal pieces of a sentencepiece model with their merge scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = range(sp.get_piece_size())
    return {
        sp.id_to_piece(i): sp.get_score(i)
        for i in ids
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    }


class _Words(dict):
    """Token counts of words that follow one mark."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        n = self.transducer.run(MARK + word)
        if len(word) <= 64:
            if len(self) > MAX_WORDS:
                self.clear()
            self[word] = n
        return n


_COMPILED: dict[str, Transducer] = {}


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit to the rows of ``docs``.  The
    model file is read by the driver and sent with the tasks (0.5 MB)."""
    import hashlib

    with open(model_path, "rb") as f:
        model = f.read()
    key = hashlib.sha256(model).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(load_scores(model))

    def run(b: pa.RecordBatch):
        t = _COMPILED.get(key)
        if t is None:  # once in a worker process
            t = _COMPILED[key] = Transducer(shared.value)
        texts = column(b, "text").to_pylist()
        n = [t.tokens(x) for x in texts]
        return [
            pa.array([len(x.encode()) if x else 0 for x in texts], pa.int64()),
            pa.array(n, pa.int64()),
            pa.array([x > limit for x in n], pa.bool_()),
        ]

    fields = [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
    return map_columns(docs, fields, run)
