"""Change feed with Structured Streaming.

Landed change pages (JSON lines, see ``tessera.sources.change_pages``) are
read as a file stream and appended, as they are, to the page log of a store
(``tessera.streaming.feed_store``): one folder for each (query, epoch).  A
replayed epoch overwrites its own folder and no other, and a new checkpoint
is a new query, so neither can skip or mix pages.

Items and drive sync state are folds over that store; snapshots keep reading
them from folding the whole log again.  Within a drive ``page_seq`` must grow
from page to page over all runs; it is the order.

Item paths are rooted at the library for all pages alike, so they do not
depend on which pages shared a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.change_pages import read_pages, read_pages_stream
from tessera.streaming.feed_store import PAGES, FeedStore


def append_pages(pages: DataFrame, store_path: str, query: str, epoch: int) -> None:
    """Append a batch of landed pages to the log; the same (query, epoch)
    again replaces what it wrote."""
    FeedStore(pages.sparkSession, store_path).append(PAGES, pages, query, epoch)


def start(
    spark: SparkSession,
    landing_path: str,
    store_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the change-feed stream; returns the ``StreamingQuery``.  The
    checkpoint belongs to one store: it lies in the store unless given."""

    def on_batch(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        append_pages(batch, store_path, query, int(epoch))

    writer = (
        read_pages_stream(spark, landing_path, max_files_per_trigger)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint_location or f"{store_path.rstrip('/')}/_checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_batch(spark: SparkSession, landing_path: str, store_path: str) -> None:
    """Append all landed pages at once, without a stream."""
    append_pages(read_pages(spark, landing_path), store_path, "batch", 0)


def stored_pages(spark: SparkSession, store_path: str) -> DataFrame:
    """Every page of the log (re-read pages are there again)."""
    return FeedStore(spark, store_path).all_pages()


def current_items(spark: SparkSession, store_path: str, reconciled: bool = False) -> DataFrame:
    """The items table: the last snapshot and the pages after it."""
    return FeedStore(spark, store_path).items(reconciled)


def current_sync_state(spark: SparkSession, store_path: str) -> DataFrame:
    """The drive sync state: pages, errors, claims and resets in one fold."""
    return FeedStore(spark, store_path).sync_state()


def current_errors(spark: SparkSession, store_path: str) -> DataFrame:
    """The drive errors that no site reset has dropped."""
    return FeedStore(spark, store_path).errors()


def snapshot(spark: SparkSession, store_path: str) -> str:
    """Fold the store's logs into a new snapshot; later reads start from it."""
    return FeedStore(spark, store_path).write_snapshot()


def reset_site(spark: SparkSession, store_path: str, site_id: str, at: str) -> dict[str, int]:
    """Forget what the drives of a site brought so far, for good."""
    return FeedStore(spark, store_path).reset_site(site_id, at)


def processed_drives(drives: DataFrame, sync_state: DataFrame) -> DataFrame:
    """``drives`` with processed_at set where the sync state is done."""
    done = sync_state.filter("status = 'done'").select(F.col("drive_id").alias("id"), F.col("last_completed_at").alias("_at"))
    columns = [F.coalesce("_at", "processed_at").alias(c) if c == "processed_at" else F.col(c) for c in drives.columns]
    return drives.join(done, "id", "left").select(*columns)


def compact(spark: SparkSession, store_path: str, target: str) -> None:
    """Write the folded tables to ``target`` (a folder of the caller's)."""
    current_items(spark, store_path).write.parquet(f"{target.rstrip('/')}/items")
    current_sync_state(spark, store_path).write.parquet(f"{target.rstrip('/')}/drive_sync_state")
