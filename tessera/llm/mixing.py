"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of ``block_size``.  A source with
weight w (its share of the weights of the sources not yet used up) releases
its j-th block at time floor((j-1)/w) and must place it by ceil(j/w); each
time slot goes to the released block with the earliest deadline.  With
weights that sum to 1 every block meets its window, so after any number of
slots each source is less than one block away from its target.

Weights are whole numbers of ``units`` in all, so the schedule repeats after
one period.  A phase is the time over which the same sources last: the
period's schedule is worked out once for each phase (its size depends on
``units`` and the number of named sources, not on the data) and the blocks
find their slot by arithmetic.  When a source runs out, a new phase begins
with the weights of those that remain.

Numbering a source's documents takes no sort of a whole source: rows are
dealt to ``BINS`` bins by a hash, numbered inside (source, bin), and the
bins' counts shift the numbers, so a source with most of the rows is spread
over many tasks.

Defined results: every row is placed, none twice; sources without a target
weight, null sources among them, form one stream with weight
``other_weight``; equal rows get their own places, and rows with equal or null
doc_ids follow each other in no set order; texts are carried, never read; an
empty table gives an empty one; extra columns ride along, but for those that
have the names of the added ones, which are replaced.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: the columns that tell a row's place
PLACE = ["mix_stream", "mix_phase", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position"]
BLOCK_SIZE = 64
UNITS = 1_000
BINS = 1_024
#: streams that can be told apart: bounds the schedule on the driver
MAX_STREAMS = 4_096
OTHER = "other"


def whole_weights(weights: dict[str, float], units: int = UNITS) -> dict[str, int]:
    """The weights as whole units (at least 1 each), by largest remainder."""
    total = sum(weights.values())
    if not weights or total <= 0 or min(weights.values()) <= 0:
        raise ValueError("target weights must be above 0")
    units = max(units, len(weights))
    exact = {s: Fraction(w).limit_denominator(10**9) * units / Fraction(total).limit_denominator(10**9) for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s)):
        if sum(out.values()) >= units:
            break
        out[s] += 1
    return out


def period(units: dict[str, int]) -> list[str]:
    """The streams of one period's slots, earliest deadline first."""
    total = sum(units.values())
    waiting = [(0, s, 1) for s in sorted(units)]  # release, stream, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots = []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * total // units[s]), s, j))
        _, s, j = heapq.heappop(ready)
        slots.append(s)
        if j < units[s]:
            heapq.heappush(waiting, (j * total // units[s], s, j + 1))
    return slots


def phases(units: dict[str, int], blocks: dict[str, int]) -> list[dict]:
    """The phases of the mix: the first slot, the period's slots, how long it
    lasts and the first block of each stream in it."""
    left = {s: b for s, b in blocks.items() if b > 0}
    done = dict.fromkeys(left, 0)
    start, out = 0, []
    while left:
        slots = period({s: units[s] for s in left})
        where: dict[str, list[int]] = {s: [] for s in left}
        for t, s in enumerate(slots):
            where[s].append(t)
        # the slot in which a stream places its last block
        last = {s: (b - 1) // units[s] * len(slots) + where[s][(b - 1) % units[s]] for s, b in left.items()}
        length = min(last.values()) + 1
        out.append({"start": start, "period": len(slots), "length": length, "first": dict(done), "where": where})
        full, rest = divmod(length, len(slots))
        for s in list(left):
            placed = full * units[s] + sum(1 for t in where[s] if t < rest)
            done[s] += placed
            left[s] -= placed
            if not left[s]:
                del left[s]
        start += length
    return out


def mix(
    docs: DataFrame,
    weights: dict[str, float],
    block_size: int = BLOCK_SIZE,
    other_weight: float = 1.0,
    units: int = UNITS,
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` with their place in the mix: mix_stream, mix_block (from 0,
    within the stream), mix_phase, mix_release and mix_deadline (slots from
    the phase's start), mix_slot and mix_position (both from 0; reading the
    rows by position gives the mix)."""
    if len(weights) > MAX_STREAMS:
        raise ValueError(f"at most {MAX_STREAMS} named sources")
    spark = docs.sparkSession
    named = whole_weights({**{f"={s}": w for s, w in weights.items()}, OTHER: other_weight}, units)
    labels = spark.createDataFrame([(s, f"={s}") for s in weights], "__source string, __name string")
    columns = [c for c in docs.columns if c not in PLACE]
    tied = F.xxhash64(F.lit(3), F.col(key))
    rows = (
        docs.select(*columns)
        .join(F.broadcast(labels), F.col("source").eqNullSafe(F.col("__source")), "left")  # the named sources
        .withColumns({"mix_stream": F.coalesce("__name", F.lit(OTHER)), "__bin": F.pmod(F.xxhash64(key), F.lit(BINS)).cast("int")})
        .drop("__source", "__name")
    )
    # a row for each stream and bin: no more than (MAX_STREAMS + 1) * BINS
    counts = rows.groupBy("mix_stream", "__bin").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("mix_stream").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    sizes = {r["mix_stream"]: r["n"] for r in counts.groupBy("mix_stream").agg(F.sum("__n").alias("n")).collect()}
    plan = phases(named, {s: -(-n // block_size) for s, n in sizes.items()})

    within = F.row_number().over(Window.partitionBy("mix_stream", "__bin").orderBy(tied, key)) - 1
    numbered = (
        rows.withColumn("__in", within)
        .join(counts.drop("__n"), ["mix_stream", "__bin"])
        .withColumn("__no", F.col("__in") + F.col("__before"))
        .withColumn("mix_block", F.floor(F.col("__no") / block_size))
    )
    table = []  # stream, phase, blocks [first, end), slots and the rows placed before
    for p, (ph, nxt) in enumerate(zip(plan, [*plan[1:], None])):
        for s, where in ph["where"].items():
            end = nxt["first"].get(s) if nxt else None
            end = -(-sizes[s] // block_size) if end is None else end
            table.append((s, p, ph["first"][s], end, named[s], ph["period"], ph["start"], where))
    schema = "mix_stream string, mix_phase int, __first long, __end long, __units long, __period long, __start long, __where array<int>"
    schedule = spark.createDataFrame(table, schema)
    at = F.col("mix_block") - F.col("__first")
    turn = F.floor(at / F.col("__units"))
    slot = F.col("__start") + turn * F.col("__period") + F.element_at("__where", (at % F.col("__units") + 1).cast("int"))
    # only a stream's last block can be short, and it is the last of its
    # stream: slots after it lose its missing rows
    short = [(s, -n % block_size) for s, n in sizes.items() if n % block_size]
    last_slots = []
    for s, gap in short:
        b = -(-sizes[s] // block_size) - 1
        ph = next(ph for ph in reversed(plan) if s in ph["where"])
        k = b - ph["first"][s]
        last_slots.append((ph["start"] + k // named[s] * ph["period"] + ph["where"][s][k % named[s]], gap))
    last_slots.sort()
    lost = F.lit(0).cast("long")
    if last_slots:
        gaps = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(g).alias("g")) for t, g in last_slots))
        lost = F.aggregate(gaps, lost, lambda acc, x: acc + F.when(x["t"] < F.col("mix_slot"), x["g"]).otherwise(0))
    out = (
        numbered.join(F.broadcast(schedule), "mix_stream")  # one row for each stream and phase
        .filter((F.col("mix_block") >= F.col("__first")) & (F.col("mix_block") < F.col("__end")))
        .withColumn("mix_slot", slot.cast("long"))
        .withColumn("mix_release", F.floor(at * F.col("__period") / F.col("__units")))
        .withColumn("mix_deadline", F.ceil((at + 1) * F.col("__period") / F.col("__units")))
        .withColumn("mix_position", F.col("mix_slot") * block_size + F.col("__no") % block_size - lost)
        .withColumn("mix_stream", F.regexp_replace("mix_stream", "^=", ""))
    )
    return out.select(*columns, *PLACE)
