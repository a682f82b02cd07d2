"""Registered queries of the change-feed store: pages and events of the test
tables land in a fresh store in several batches, out of order and partly more
than once, between snapshots and resets; the tables read from it must be those
of applying everything in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import work_path
from tessera.sources import testdata as td
from tessera.sources.change_pages import page_changes, page_log
from tessera.streaming.feed_store import PAGES, FeedStore

# The sites that the reset queries reset, and when.
RESET_SITE_ID, RESET_CHECKPOINT_ID, RESET_AT = "7", "3", "2024-12-31T00:00:00Z"
ITEM_FIELDS = [
    "drive_id", "id", "site_id", "library_name", "parent_id", "parent_path", "full_path", "name", "item_type", "extension", "mime_type",
    "size_bytes", "formatted_size", "modified_at", "web_url", "status", "collected_at",
]


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    """A fresh store, and the pages and other events that will land in it."""
    t = td.Tables(spark, sf_dir)
    return work_path(spark, "feed"), _staged(td.landed_pages(t), "landed"), td.drive_events(t)


def ingest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change records of all landed pages."""
    changes = page_changes(td.landed_pages(td.Tables(spark, sf_dir)))
    return changes.select(*[c for c in ITEM_FIELDS if c != "status"], "page_seq", "row_idx", "is_tombstone")


def ingest_page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and times of all landed pages."""
    return page_log(td.landed_pages(td.Tables(spark, sf_dir)))


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items from a snapshot and its tail: pages land in no order, and some
    land twice."""
    path, pages, _ = _landed(spark, sf_dir)
    part = F.col("page_seq") % 3
    FeedStore(spark, path).append(PAGES, pages.filter(part == 2), "q", 0)
    FeedStore(spark, path).write_snapshot()
    FeedStore(spark, path).append(PAGES, pages.filter(part == 0), "q", 1)
    FeedStore(spark, path).write_snapshot()
    FeedStore(spark, path).append(PAGES, pages.filter(part != 0), "again", 0)
    return FeedStore(spark, path).items().select(*ITEM_FIELDS)


def _middle(pages: DataFrame) -> int:
    return (pages.agg(F.max("page_seq")).first()[0] or 0) // 2


def log_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items after a site was reset in the middle of the log: pages from
    before the reset land late and once more, and change nothing there."""
    path, pages, _ = _landed(spark, sf_dir)
    old, late = F.col("page_seq") <= _middle(pages), F.col("page_seq") % 5 == 2
    FeedStore(spark, path).append(PAGES, pages.filter(old & ~late), "q", 0)
    FeedStore(spark, path).write_snapshot()
    FeedStore(spark, path).reset_site(RESET_SITE_ID, RESET_AT)
    FeedStore(spark, path).append(PAGES, pages.filter(old & late), "late", 0)
    FeedStore(spark, path).append(PAGES, pages.filter(old), "again", 0)
    FeedStore(spark, path).append(PAGES, pages.filter(~old), "q", 1)
    return FeedStore(spark, path).items().select(*ITEM_FIELDS)


def sync_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sync state of pages, errors, claims and two resets in one fold."""
    path, pages, events = _landed(spark, sf_dir)
    middle = _middle(pages)
    FeedStore(spark, path).append(PAGES, pages.filter(F.col("page_seq") <= middle), "q", 0)
    FeedStore(spark, path).append_events(events.filter((F.col("seq") <= middle) & (F.col("no") % 2 == 0)), "q", 0)
    FeedStore(spark, path).reset_site(RESET_SITE_ID, RESET_AT)
    FeedStore(spark, path).reset_checkpoints(RESET_AT, [RESET_CHECKPOINT_ID])
    FeedStore(spark, path).write_snapshot()
    FeedStore(spark, path).append_events(events.filter((F.col("seq") > middle) | (F.col("no") % 2 == 1)), "q", 1)
    FeedStore(spark, path).append(PAGES, pages, "again", 0)
    return FeedStore(spark, path).sync_state()


def reconciled_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items after the complete relists that followed expired tokens."""
    path, pages, events = _landed(spark, sf_dir)
    middle = _middle(pages)
    FeedStore(spark, path).append(PAGES, pages.filter(F.col("page_seq") > middle), "q", 0)
    FeedStore(spark, path).append_events(events, "q", 0)
    FeedStore(spark, path).write_snapshot()
    FeedStore(spark, path).append(PAGES, pages.filter(F.col("page_seq") <= middle), "q", 1)
    return FeedStore(spark, path).items(reconciled=True).select("drive_id", "id", "name", "status", "collected_at")


QUERIES = {
    "ingest_pages": ingest_pages,
    "ingest_page_log": ingest_page_log,
    "feed_items": feed_items,
    "log_after_reset": log_after_reset,
    "sync_events": sync_events,
    "reconciled_items": reconciled_items,
}
