"""Fill-in-the-middle transformation with a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers
that never change: the text's bytes and the sentinels.  Cutting splits the
text's descriptor in three, an arrangement permutes the parts and puts
sentinel descriptors between them, and only writing an output copies bytes.
The way back reads the sentinels of an output, takes descriptors over it and
applies the inverse permutation.  Hashes are fed descriptor by descriptor.

A text's units are its tokens ``[A-Za-z]+|[^A-Za-z]`` over code points.  The
cuts, the form and its order come from the sha256 of "1:" and the doc_id, so a
document gets the same form wherever and whenever it is processed.

Defined results: a null text is an empty one, with form plain and an empty
output; a null doc_id hashes as no digits ("1:"); equal doc_ids draw the same
numbers, applied to each row's own text; texts that hold a sentinel stay
plain; a very long text is counted and cut in slices, beside its own bytes; an
empty table gives an empty one; extra columns ride along, and columns whose
names clash with the added ones are replaced by them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import column, map_columns, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: the parts of a form in the order in which it writes them
ARRANGEMENTS = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
#: documents of 100 that stay plain, and of the others those written spm
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SEED = "1"
SLICE = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True


class PieceTable:
    """Descriptors (buffer, start, length) over immutable buffers."""

    def __init__(self, buffers: list[bytes], pieces: list[tuple[int, int, int]]):
        self.buffers = [memoryview(b) for b in buffers]
        self.pieces = pieces

    def cut(self, k: int, *places: int) -> PieceTable:
        """Piece ``k`` split at ascending places of it."""
        buffer, start, length = self.pieces[k]
        edges = [0, *places, length]
        parts = [(buffer, start + a, b - a) for a, b in zip(edges, edges[1:])]
        return PieceTable(self.buffers, self.pieces[:k] + parts + self.pieces[k + 1 :])

    def arranged(self, order) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def views(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start : start + length]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for v in self.views():
            h.update(v)
        return h.hexdigest()

    def write(self) -> bytes:
        return b"".join(self.views())


def _unit_starts(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """For each slice of the text: where it starts and which of its bytes
    start a unit."""
    raw, letter = np.frombuffer(text, np.uint8), False
    for at in range(0, len(raw), SLICE):
        part = raw[at : at + SLICE]
        now = _LETTER[part]
        after = np.concatenate(([letter], now[:-1]))  # whether a letter comes before
        yield at, ((part & 0xC0) != 0x80) & ~(now & after)
        letter = bool(now[-1])


def count_units(text: bytes) -> int:
    return sum(int(np.count_nonzero(s)) for _, s in _unit_starts(text))


def places_of(text: bytes, units: list[int]) -> list[int]:
    """The byte at which each unit (ascending numbers) starts; the end for a
    number past the last."""
    out, done = [], 0
    for at, starts in _unit_starts(text):
        n = int(np.count_nonzero(starts))
        here = [u for u in units[len(out) :] if u < done + n]
        if here:
            found = np.flatnonzero(starts)
            out += [at + int(found[u - done]) for u in here]
        if len(out) == len(units):
            return out
        done += n
    return out + [len(text)] * (len(units) - len(out))


def _chars(view: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(view, np.uint8) & 0xC0) != 0x80))


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[k : k + 8], 16) for k in range(0, 32, 8)]


def arrange(text: bytes, doc_id: int | None, seed: str = SEED) -> tuple[PieceTable, str, int, int | None, int | None]:
    """The output as a piece table, its form, the number of units and the
    characters of prefix and middle (None if plain)."""
    whole = PieceTable([text, SENTINELS], [(0, 0, len(text))])
    n = count_units(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= 100 - PLAIN_PERCENT or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return whole, PLAIN, n, None, None
    form = SPM if h4 % 100 < SPM_PERCENT else PSM
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = whole.cut(0, *places_of(text, [first, second]))
    prefix, middle, _ = parts.views()
    # each part after its sentinel, in the order of the form
    pieces = [p for k, s in zip(ARRANGEMENTS[form], sentinel_order(form)) for p in ((1, SENTINELS.index(s), len(s)), parts.pieces[k])]
    return PieceTable(parts.buffers, pieces), form, n, _chars(prefix), _chars(middle)


def sentinel_order(form: str) -> tuple[bytes, ...]:
    return tuple((PREFIX, MIDDLE, SUFFIX)[k] for k in ARRANGEMENTS[form])


def rebuild(output: bytes, form: str) -> PieceTable:
    """The text of an output, as descriptors over the output.  Text and
    sentinels cannot make a sentinel together, so the first one found of each
    kind is the written one."""
    if form == PLAIN:
        return PieceTable([output], [(0, 0, len(output))])
    pieces, at = [], 0
    for s in sentinel_order(form):
        found = output.index(s, at)
        if pieces:
            pieces[-1] = (0, pieces[-1][1], found - pieces[-1][1])
        at = found + len(s)
        pieces.append((0, at, len(output) - at))
    order = ARRANGEMENTS[form]
    return PieceTable([output], pieces).arranged([order.index(k) for k in range(3)])  # the inverse permutation


_LONG, _TEXT = T.LongType(), T.StringType()


def transform(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars and output."""

    def run(b: pa.RecordBatch):
        rows = [arrange(t or b"", d, seed) for t, d in zip(utf8(b, "text"), column(b, "doc_id").to_pylist())]
        return [
            pa.array([r[2] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.string()),
            pa.array([r[3] for r in rows], pa.int64()),
            pa.array([r[4] for r in rows], pa.int64()),
            pa.array([r[0].write() for r in rows], pa.binary()).cast(pa.string()),
        ]

    fields = [T.StructField("n", _LONG), T.StructField("form", _TEXT), T.StructField("prefix_chars", _LONG),
              T.StructField("middle_chars", _LONG), T.StructField("output", _TEXT)]
    return map_columns(docs, fields, run)


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (output, form) with the texts they were made of, as
    ``restored``."""

    def run(b: pa.RecordBatch):
        rows = zip(utf8(b, "output"), column(b, "form").to_pylist())
        return [pa.array([rebuild(o, f).write() for o, f in rows], pa.binary()).cast(pa.string())]

    return map_columns(outputs, [T.StructField("restored", _TEXT)], run)


def report(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars,
    output_sha256, restored_sha256."""

    def run(b: pa.RecordBatch):
        out = []
        for t, d in zip(utf8(b, "text"), column(b, "doc_id").to_pylist()):
            table, form, n, prefix, middle = arrange(t or b"", d, seed)
            out.append((n, form, prefix, middle, table.sha256(), rebuild(table.write(), form).sha256()))
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return [pa.array([r[k] for r in out], t) for k, t in enumerate(types)]

    fields = [T.StructField("n", _LONG), T.StructField("form", _TEXT), T.StructField("prefix_chars", _LONG),
              T.StructField("middle_chars", _LONG), T.StructField("output_sha256", _TEXT),
              T.StructField("restored_sha256", _TEXT)]
    return map_columns(docs.select("doc_id", "text"), fields, run, drop=("text",))
