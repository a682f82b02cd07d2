"""The store of a change feed: logs, snapshots, resets.

A store is a folder with three append-only logs and snapshots of their folds::

    pages/query=<q>/epoch=<e>/       landed pages, as they are
    events/query=<q>/epoch=<e>/      errors and claims (``operators.events.EVENT``)
    controls/query=<q>/epoch=<e>/    resets
    snapshots/gen=<n>-<id>/          items, sync, runs, seen, marks, folders, then _PUBLISHED

A batch is one folder, written by Spark's own Parquet writer; the same (query,
epoch) again replaces it, and only folders whose write succeeded count.

*Tables are folds of the logs.*  Items and sync state are maxima over the
drives' own order of pages and events, so pages may land in any order, in any
batches and more than once, and no crash can leave one table without the
other.

*A snapshot is a fold that was written.*  It names the log folders that it
folded; reading a table reads the last published snapshot and the folders it
does not name.  ``marks`` holds the highest page of each drive: a page above
it is new; of the others an anti join with ``seen`` keeps those that landed
late and drops those that were read again.

*Resets are records.*  A reset writes, for each of its drives, a fence: the
highest page or event known by then.  What is at or below a fence no fold
takes, whatever lands later and wherever it is read again.  Late pages of a
drive that had no page before the reset are not fenced.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import events as ev
from tessera.operators import item_state as its
from tessera.operators.sync import _site_filter
from tessera.sinks.parquet import table_exists
from tessera.sources.change_pages import LANDED_PAGE, page_changes, page_log

PAGES, EVENTS, CONTROLS = "pages", "events", "controls"
CONTROL = T.StructType(ev.EVENT.fields + [T.StructField("clears", T.BooleanType())])
_SCHEMAS = {PAGES: LANDED_PAGE, EVENTS: ev.EVENT, CONTROLS: CONTROL}
_DONE = "_PUBLISHED"


class FeedStore:
    """One store at one moment: the folders of the logs are listed when they
    are first asked for, so all tables of an object agree."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- logs ------------------------------------------------------------------

    def append(self, log: str, rows: DataFrame, query: str, epoch: int) -> None:
        """Append a batch to a log; the same (query, epoch) replaces it."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{log}/query={query}/epoch={epoch}")

    def append_events(self, events: DataFrame, query: str, epoch: int) -> None:
        """Append errors and claims (``operators.events``)."""
        self.append(EVENTS, ev.conform(events), query, epoch)

    def _glob(self, pattern: str) -> list[str]:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(where)
        return sorted(str(f.getPath().toString()).rpartition("/")[0] for f in found or [])

    @cached_property
    def folders(self) -> dict[tuple[str, str], str]:
        """(log, batch) and path of every batch whose write succeeded."""
        out = {}
        for log in _SCHEMAS:
            for at in self._glob(f"{log}/query=*/epoch=*/_SUCCESS"):
                query, epoch = at.split("/")[-2:]
                out[log, f"{query}/{epoch}"] = at
        return out

    def _read(self, log: str, batches: list[str]) -> DataFrame:
        paths = [self.folders[log, b] for b in batches]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMAS[log])
        return self.spark.read.schema(_SCHEMAS[log]).parquet(*paths)

    def all_pages(self) -> DataFrame:
        """Every page of the log (pages read again are there again)."""
        return self._read(PAGES, [b for log, b in self.folders if log == PAGES])

    # -- snapshots -------------------------------------------------------------

    @cached_property
    def snapshot(self) -> str | None:
        """The last published snapshot's folder."""
        found = self._glob(f"snapshots/gen=*/{_DONE}")
        return found[-1] if found else None

    def _part(self, name: str) -> DataFrame | None:
        return None if self.snapshot is None else self.spark.read.parquet(f"{self.snapshot}/{name}")

    @cached_property
    def _folded(self) -> set[tuple[str, str]]:
        part = self._part("folders")
        return set() if part is None else {(r["log"], r["batch"]) for r in part.collect()}  # a name a batch

    def tail(self, log: str) -> DataFrame:
        """The rows of the batches that the snapshot does not hold."""
        return self._read(log, [b for kind, b in self.folders if kind == log and (kind, b) not in self._folded])

    def new_pages(self) -> DataFrame:
        """The tail's pages that the snapshot has not folded."""
        pages = self.tail(PAGES)
        if self.snapshot is None:
            return pages
        marks = self._part("marks").select("drive_id", F.col("page_mark").alias("_mark"))
        known = pages.join(marks, "drive_id", "left")
        fresh = F.col("_mark").isNull() | (F.col("page_seq") > F.col("_mark"))
        late = known.filter(~fresh).join(self._part("seen"), ["drive_id", "page_seq"], "left_anti")
        return known.filter(fresh).unionByName(late).drop("_mark")

    def fences(self) -> DataFrame:
        """The highest fence of each drive."""
        controls = self._read(CONTROLS, [b for log, b in self.folders if log == CONTROLS])
        return controls.filter("clears").groupBy("drive_id").agg(F.max("seq").alias("fence"))

    def _controls(self) -> DataFrame:
        return ev.conform(self._read(CONTROLS, [b for log, b in self.folders if log == CONTROLS]))

    def _tail_events(self) -> DataFrame:
        return ev.page_events(page_log(self.tail(PAGES))).unionByName(self.tail(EVENTS)).unionByName(self._controls())

    def write_snapshot(self) -> str:
        """Fold the logs into a new snapshot; it counts from the moment that
        its marker is written.  Two at once are two snapshots, each right."""
        last = 0 if self.snapshot is None else int(self.snapshot.rpartition("gen=")[2].split("-")[0])
        path = f"{self.path}/snapshots/gen={last + 1:010d}-{uuid.uuid4().hex[:8]}"
        self.item_states().write.parquet(f"{path}/items")
        self.sync_maps().write.parquet(f"{path}/sync")
        self._runs().write.parquet(f"{path}/runs")
        seen = self.tail(PAGES).select("drive_id", "page_seq").distinct()
        if self.snapshot is not None:
            before = self._part("seen")
            seen = before.unionByName(seen.join(before, ["drive_id", "page_seq"], "left_anti"))
        seen.write.parquet(f"{path}/seen")
        self.marks().write.parquet(f"{path}/marks")
        names = [(log, batch) for log, batch in self.folders if log != CONTROLS]
        self.spark.createDataFrame(names, "log string, batch string").coalesce(1).write.parquet(f"{path}/folders")
        jvm = self.spark._jvm
        marker = jvm.org.apache.hadoop.fs.Path(f"{path}/{_DONE}")
        marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(marker).close()
        return path

    def _runs(self) -> DataFrame:
        """The events that start or complete a listing, once each."""
        rows = self._tail_events().filter(
            (F.col("kind") != ev.PAGE) & (F.col("kind") != ev.CLAIM) | (F.col("kind") == ev.PAGE) & F.col("delta_link").isNotNull()
        ).select(*ev.EVENT_COLUMNS)
        before = self._part("runs")
        return (rows if before is None else before.unionByName(rows)).dropDuplicates(["drive_id", "seq", "no", "kind"])

    def marks(self) -> DataFrame:
        """drive_id, site_id, page_mark, mark: the highest page, and the
        highest place, known of each drive."""
        rows = self.tail(PAGES).select("drive_id", "site_id", F.col("page_seq").alias("page_mark"), F.col("page_seq").alias("mark"))
        rows = rows.unionByName(self.tail(EVENTS).select("drive_id", "site_id", F.lit(None).cast("long").alias("page_mark"), F.col("seq").alias("mark")))
        before = self._part("marks")
        rows = rows if before is None else before.unionByName(rows)
        return rows.filter("drive_id is not null").groupBy("drive_id").agg(
            F.max_by("site_id", F.when(F.col("site_id").isNotNull(), F.col("mark"))).alias("site_id"),
            F.max("page_mark").alias("page_mark"), F.max("mark").alias("mark"),
        )

    # -- tables ----------------------------------------------------------------

    def item_states(self) -> DataFrame:
        pages = self.new_pages()
        # a page with neither link is an error: what it brought does not count
        whole = pages.filter("page.`@odata.nextLink` is not null or page.`@odata.deltaLink` is not null")
        fences = self.fences()
        states = its.states_of(its.fence_changes(page_changes(whole), fences))
        before = self._part("items")
        return states if before is None else its.merge_states(its.fence(before, fences), states)

    def items(self, reconciled: bool = False) -> DataFrame:
        """The items table.  With ``reconciled`` the items that a drive's last
        complete relist did not bring are deleted; a page of the relist that
        lands late brings its items back."""
        states = self.item_states()
        if reconciled:
            states = its.reconcile(states, ev.relists(self._runs()))
        return its.items_of(states)

    def sync_maps(self) -> DataFrame:
        maps = ev.sync_maps(self._tail_events())
        before = self._part("sync")
        return maps if before is None else ev.merge_maps(before, maps)

    def sync_state(self) -> DataFrame:
        """The drive sync state: pages, errors, claims and resets in one fold."""
        return ev.sync_state(self.sync_maps())

    def errors(self) -> DataFrame:
        """The drive errors above the fences (a site reset drops the others)."""
        rows = self._read(EVENTS, [b for log, b in self.folders if log == EVENTS]).filter(F.col("kind") == ev.ERROR)
        site = self._controls().filter(F.col("kind") == ev.RESET_SITE).groupBy("drive_id").agg(F.max("seq").alias("_fence"))
        return rows.dropDuplicates(["drive_id", "seq", "no"]).join(site, "drive_id", "left").filter("_fence is null or seq > _fence").drop("_fence")

    # -- resets ----------------------------------------------------------------

    def _reset(self, kind: str, drives: DataFrame, at: str, clears: bool) -> None:
        rows = drives.select("drive_id", "site_id", F.col("mark").alias("seq"), F.lit(kind).alias("kind"), F.lit(at).alias("at"))
        rows = ev.conform(rows).withColumn("clears", F.lit(clears))
        self.append(CONTROLS, rows, f"reset-{uuid.uuid4().hex}", 0)
        self.__dict__.pop("folders", None)  # listed anew

    def reset_site(self, site_id: str, at: str) -> dict[str, int]:
        """Forget all that the drives of a site brought so far: items, errors
        and checkpoints.  Returns the numbers of rows concerned."""
        site_id = (site_id or "").strip()
        if not site_id:
            raise ValueError("site_id must not be blank")
        drives = self.marks().filter(F.col("site_id") == site_id)
        counts = {
            name: table.join(drives.select("drive_id"), "drive_id", "left_semi").count()
            for name, table in (("items", self.items()), ("drive_sync_state", self.sync_state()), ("errors", self.errors()))
        }
        self._reset(ev.RESET_SITE, drives, at, clears=True)
        return counts

    def reset_checkpoints(self, at: str, site_ids=None, clear_items: bool = False) -> None:
        """Forget links and errors, so that drives are listed from the start;
        with ``clear_items`` their items too.  ``site_ids``: None for every
        site, else the listed ones."""
        self._reset(ev.RESET_CHECKPOINT, _site_filter(self.marks(), site_ids), at, clears=clear_items)


def exists(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, f"{path.rstrip('/')}/{PAGES}")
