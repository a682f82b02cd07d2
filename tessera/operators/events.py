"""Drive sync state as a fold of events.

Everything that happens to a drive's checkpoint is one event: a page, an
error, a claim by a worker, a reset.  An event is a map of the state: it sets
some fields and keeps the others.  Such maps compose associatively, field by
field the later one wins, so the state of a drive is one aggregate
(``max(struct(order, value))`` for each field) whatever the order in which its
events arrive, however they are grouped and however often they are read.  The
aggregate itself is kept (``sync_maps``): folding more events into it
(``merge_maps``) is the same aggregate over both.

Order of a drive's events: ``(seq, rank, no)``.  A page has its ``page_seq``;
an error or a claim has the ``page_seq`` of the last page before it and the
collector's running number; a reset comes after everything at its fence.

=============  ========  =========  ==========  ==========  =============  ========
event          status    next_link  delta_link  last_error  last_completed  attempts
=============  ========  =========  ==========  ==========  =============  ========
page, next     moving    set        .           .           .              .
page, delta    done      null       set         null        set            .
page, neither  pending   .          .           message     .              .
error 410      pending   null       null        message     .              .
error 4xx      failed    .          .           message     .              .
error other    pending   .          .           message     .              .
claim          moving    .          .           .           .              set
checkpoint     pending   null       null        null        .              .
site           pending   null       null        null        null           0
=============  ========  =========  ==========  ==========  =============  ========

(4xx: the codes that are not retried; ``.`` keeps.)  Every event sets
``updated_at``; ``last_started_at`` is set by a claim and cleared by a site
reset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import truncate_message
from tessera.functions.classify import EXPIRED_TOKEN_CODE, SYNC_MESSAGE_MAX
from tessera.operators.sync import DONE, EXPIRED_MESSAGE, FAILED, IN_PROGRESS, NO_LINK_MESSAGE, PENDING, SYNC_COLUMNS, drive_error_retryable

PAGE, ERROR, CLAIM, RESET_CHECKPOINT, RESET_SITE = "page", "error", "claim", "reset_checkpoint", "reset_site"

S, L, I = T.StringType(), T.LongType(), T.IntegerType()
EVENT = T.StructType(
    [
        T.StructField("drive_id", S), T.StructField("site_id", S), T.StructField("library_name", S),
        T.StructField("seq", L), T.StructField("no", L), T.StructField("kind", S), T.StructField("status_code", I),
        T.StructField("message", S), T.StructField("next_link", S), T.StructField("delta_link", S), T.StructField("attempt", I),
        T.StructField("at", S),
    ]
)
EVENT_COLUMNS = [f.name for f in EVENT.fields]

#: the type of each folded field
FIELDS = {
    "site_id": S, "library_name": S, "status": S, "attempts": I, "next_link": S, "delta_link": S, "last_error": S,
    "updated_at": S, "last_started_at": S, "last_completed_at": S,
}


def conform(events: DataFrame) -> DataFrame:
    """``events`` with exactly the columns of ``EVENT`` (absent ones null)."""
    return events.select(*[(F.col(f.name) if f.name in events.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields])


def page_events(page_log: DataFrame) -> DataFrame:
    """Events of a page log (``sources.change_pages.page_log``)."""
    return conform(
        page_log.withColumnsRenamed({"page_seq": "seq", "collected_at": "at"}).withColumns({"kind": F.lit(PAGE), "no": F.lit(0)})
    )


def error_events(errors: DataFrame) -> DataFrame:
    """Events of drive errors: ``errors`` rows plus ``after_seq``, the last
    page before the error; the error's id is its running number."""
    return conform(
        errors.filter(F.col("drive_id").isNotNull())
        .withColumnsRenamed({"after_seq": "seq", "created_at": "at"})
        .withColumns({"kind": F.lit(ERROR), "no": F.col("id")})
    )


def event_order() -> Column:
    rank = F.when(F.col("kind") == PAGE, 0).when(F.col("kind").isin(RESET_CHECKPOINT, RESET_SITE), 2).otherwise(1)
    return F.struct(F.col("seq").alias("seq"), rank.alias("rank"), F.coalesce("no", F.lit(0)).cast("long").alias("no"))


def _settings() -> dict[str, tuple[Column, Column]]:
    """For each field when an event sets it, and to what."""
    kind = F.col("kind")
    page = kind == PAGE
    delta = page & F.col("delta_link").isNotNull()
    moving = page & F.col("delta_link").isNull() & F.col("next_link").isNotNull()
    broken = page & F.col("delta_link").isNull() & F.col("next_link").isNull()
    error, claim = kind == ERROR, kind == CLAIM
    expired = error & F.coalesce(F.col("status_code") == EXPIRED_TOKEN_CODE, F.lit(False))
    final = error & ~expired & ~drive_error_retryable("status_code")
    site = kind == RESET_SITE
    reset = site | (kind == RESET_CHECKPOINT)
    cleared = expired | reset
    message = F.when(broken, F.lit(NO_LINK_MESSAGE)).when(expired, F.lit(EXPIRED_MESSAGE)).when(
        error, truncate_message(F.col("message"), SYNC_MESSAGE_MAX)
    )
    status = F.when(delta, F.lit(DONE)).when(moving | claim, F.lit(IN_PROGRESS)).when(final, F.lit(FAILED)).otherwise(F.lit(PENDING))
    always, at = F.lit(True), F.col("at")
    return {
        "site_id": (F.col("site_id").isNotNull(), F.col("site_id")),
        "library_name": (F.col("library_name").isNotNull(), F.col("library_name")),
        "status": (always, status),
        "attempts": (claim | site, F.when(site, F.lit(0)).otherwise(F.col("attempt"))),
        "next_link": (moving | delta | cleared, F.when(moving, F.col("next_link"))),
        "delta_link": (delta | cleared, F.when(delta, F.col("delta_link"))),
        "last_error": (error | broken | delta | reset, message),
        "updated_at": (always, at),
        "last_started_at": (claim | site, F.when(claim, at)),
        "last_completed_at": (delta | site, F.when(delta, at)),
    }


def sync_maps(events: DataFrame) -> DataFrame:
    """The composed map of each drive's events: ``drive_id``, for each field
    the order and value of the last event that sets it, and the first event's
    time as ``created``."""
    order = event_order()
    fields = [
        F.max(F.when(when, F.struct(order.alias("ord"), value.cast(FIELDS[name]).alias("value")))).alias(name)
        for name, (when, value) in _settings().items()
    ]
    first = F.min(F.struct(order.alias("ord"), F.col("at").alias("value"))).alias("created")
    return events.filter("drive_id is not null and seq is not null").groupBy("drive_id").agg(*fields, first)


def merge_maps(*maps: DataFrame) -> DataFrame:
    """The composition of maps over the same drives."""
    union = maps[0]
    for m in maps[1:]:
        union = union.unionByName(m)
    return union.groupBy("drive_id").agg(*(F.max(c).alias(c) for c in FIELDS), F.min("created").alias("created"))


def sync_state(maps: DataFrame) -> DataFrame:
    """The public sync-state table of composed maps."""
    out = {name: F.col(f"{name}.value") for name in FIELDS}
    out["attempts"] = F.coalesce(out["attempts"], F.lit(0))
    out |= {"drive_id": F.col("drive_id"), "mode": F.lit(None).cast("string"), "created_at": F.col("created.value")}
    return maps.select(*[out[c].alias(c) for c in SYNC_COLUMNS])


def relists(events: DataFrame) -> DataFrame:
    """``drive_id, relist_from, relist_to, relist_at`` of each drive's last
    complete relist: after an expired token or a checkpoint reset a drive is
    listed from the start, and the first delta link after it, with no other
    such event between, says that the list is complete.  Only these few events
    of a drive (some for each run, not for each page) are looked at."""
    from pyspark.sql.window import Window

    lost = (F.col("kind") == RESET_CHECKPOINT) | ((F.col("kind") == ERROR) & (F.col("status_code") == EXPIRED_TOKEN_CODE))
    complete = (F.col("kind") == PAGE) & F.col("delta_link").isNotNull()
    marks = (
        events.filter("drive_id is not null and seq is not null").filter(lost | complete)
        .select("drive_id", "seq", event_order().alias("ord"), lost.alias("lost"), "at").dropDuplicates(["drive_id", "ord"])
    )
    after = Window.partitionBy("drive_id").orderBy("ord")
    pairs = marks.select(
        "drive_id", "seq", "lost", F.lead("lost").over(after).alias("then_lost"), F.lead("seq").over(after).alias("to_seq"),
        F.lead("at").over(after).alias("to_at"),
    )
    return (
        pairs.filter("lost and not then_lost").groupBy("drive_id")
        .agg(F.max(F.struct("seq", "to_seq", "to_at")).alias("r"))
        .select("drive_id", F.col("r.seq").alias("relist_from"), F.col("r.to_seq").alias("relist_to"), F.col("r.to_at").alias("relist_at"))
    )
