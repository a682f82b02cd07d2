"""Folder rollup kept up to date from a batch of changes.

``hierarchy.folder_totals`` adds up every file.  Here the totals before the
batch are taken as they are and only differences move:

* a file that came, went, grew or moved changes the sums of its old and of its
  new parent folder, its ``direct`` sums;
* a folder that moved, came, went or lost its parent changes its pointer.  All
  such folders are cut off first: each takes its old total away from the
  folders above it, up to the next cut, which leaves every folder with the
  total of its own piece of the tree.  Then the pieces are put where they are
  now: each gives its piece's total to all folders above it.

Both are the same operation, ``push_up``: values put on some folders are added
to all folders above them by pointer doubling, in log2(depth) rounds over the
folders of the drives concerned.  No file that the batch does not touch is
read: the direct sums of every folder are part of the state (also of deleted
folders, which may come back).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.hierarchy import KEY, _staged

SUMS = ("n", "b")


def direct_sums(items: DataFrame) -> DataFrame:
    """drive_id, folder_id, n, b of the live files right in each folder,
    whether the folder itself is live, deleted or unknown."""
    files = items.filter((F.col("item_type") == "file") & (F.col("status") != "deleted"))
    return files.groupBy("drive_id", F.col("parent_id").alias("folder_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("size_bytes", F.lit(0))).cast("long").alias("b")
    )


def merge_direct(direct: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """Direct sums after a batch; ``old`` and ``new`` are the touched items
    before and after it."""
    return direct.unionByName(_changes(old, new)).groupBy(*KEY).agg(*(F.sum(c).cast("long").alias(c) for c in SUMS))


def _changes(old: DataFrame, new: DataFrame) -> DataFrame:
    minus = direct_sums(old).select(*KEY, *((-F.col(c)).alias(c) for c in SUMS))
    both = minus.unionByName(direct_sums(new)).groupBy(*KEY).agg(*(F.sum(c).cast("long").alias(c) for c in SUMS))
    return both.filter("n <> 0 or b <> 0")


def live_folders(items: DataFrame) -> DataFrame:
    """drive_id, folder_id, up of the live folders; ``up`` is the parent as
    stored, live or not."""
    live = items.filter((F.col("item_type") == "folder") & (F.col("status") != "deleted"))
    return live.select("drive_id", F.col("id").alias("folder_id"), F.col("parent_id").alias("up"))


def linked(folders: DataFrame) -> DataFrame:
    """The pointers of ``folders`` (drive_id, folder_id, up) that name one of
    them; others become null."""
    there = folders.select("drive_id", F.col("folder_id").alias("up"), F.lit(True).alias("_there"))
    return folders.join(there, ["drive_id", "up"], "left").select(*KEY, F.when(F.col("_there"), F.col("up")).alias("up"))


def push_up(folders: DataFrame, values: DataFrame) -> DataFrame:
    """drive_id, folder_id, n, b: for each folder the sum of the values put on
    it and on all folders below it."""
    put = values.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in SUMS))
    nodes = folders.join(put, KEY, "left").select(*KEY, "up", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in SUMS))
    nodes = _staged(nodes, "push-up")
    for _ in range(nodes.count().bit_length() + 1):
        moving = nodes.filter("up is not null")
        if not moving.limit(1).count():
            return nodes.select(*KEY, *SUMS)
        gain = moving.filter("n <> 0 or b <> 0").groupBy("drive_id", F.col("up").alias("folder_id")).agg(*(F.sum(c).alias(f"d{c}") for c in SUMS))
        far = nodes.select("drive_id", F.col("folder_id").alias("up"), F.col("up").alias("far"))
        nodes = _staged(
            nodes.join(gain, KEY, "left").join(far, ["drive_id", "up"], "left").select(
                *KEY, F.col("far").alias("up"), *((F.col(c) + F.coalesce(f"d{c}", F.lit(0))).cast("long").alias(c) for c in SUMS)
            ),
            "push-up",
        )
    stuck = nodes.filter("up is not null").orderBy(*KEY).first()
    if stuck is not None:
        raise ValueError(f"folder {stuck['folder_id']!r} of drive {stuck['drive_id']!r} lies below a cycle of parents")
    return nodes.select(*KEY, *SUMS)


def _minus(c: str) -> Column:
    return (-F.col(c)).alias(c)


def update_totals(totals: DataFrame, direct: DataFrame, folders: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """The folder totals (drive_id, id, file_count, folder_total_size_bytes)
    after a batch.

    ``totals``, ``direct`` and ``folders`` (``live_folders``) are the state
    before it; ``old`` and ``new`` are the items that it touches, as they were
    (absent for new ones) and as they are."""
    touched = new.select("drive_id").unionByName(old.select("drive_id")).distinct()
    touched = _staged(touched, "touched-drives")
    stored = folders.join(touched, "drive_id", "left_semi")
    keys = new.select("drive_id", F.col("id").alias("folder_id")).unionByName(old.select("drive_id", F.col("id").alias("folder_id"))).distinct()
    after = stored.join(keys, KEY, "left_anti").unionByName(live_folders(new))
    after, before = _staged(linked(after), "tree-after"), _staged(linked(stored), "tree-before")
    was = before.select(*KEY, F.col("up").alias("up0"), F.lit(True).alias("was"))
    tree = after.withColumn("is", F.lit(True)).join(was, KEY, "full")
    cut = F.coalesce("is", F.lit(False)) != F.coalesce("was", F.lit(False))
    tree = _staged(tree.withColumn("cut", cut | ~F.col("up").eqNullSafe(F.col("up0"))), "tree")
    total = totals.select("drive_id", F.col("id").alias("folder_id"), F.col("file_count").alias("n"), F.col("folder_total_size_bytes").alias("b"))
    old_total = total.join(touched, "drive_id", "left_semi")
    gone = tree.filter("cut and up0 is not null").select(*KEY, "up0").join(old_total, KEY).select("drive_id", F.col("up0").alias("folder_id"), _minus("n"), _minus("b"))
    pieces = push_up(tree.filter("was").select(*KEY, F.when(~F.col("cut"), F.col("up0")).alias("up")), gone)
    own = pieces.select(*KEY, F.col("n").alias("dn"), F.col("b").alias("db"))
    fresh = direct.select(*KEY, F.col("n").alias("fn"), F.col("b").alias("fb"))
    base = (
        tree.filter("is").select(*KEY, "up", "was", "cut").join(old_total, KEY, "left").join(own, KEY, "left").join(fresh, KEY, "left")
        .select(*KEY, "up", "cut", *(
            F.when(F.col("was"), F.coalesce(c, F.lit(0)) + F.coalesce(f"d{c}", F.lit(0))).otherwise(F.coalesce(f"f{c}", F.lit(0))).cast("long").alias(c)
            for c in SUMS
        ))
    )
    base = _staged(base, "pieces")
    back = base.filter("cut and up is not null").select("drive_id", F.col("up").alias("folder_id"), *SUMS)
    gained = push_up(base.select(*KEY, "up"), _changes(old, new).unionByName(back))
    now = base.join(gained.select(*KEY, F.col("n").alias("dn"), F.col("b").alias("db")), KEY).select(
        "drive_id", F.col("folder_id").alias("id"), (F.col("n") + F.col("dn")).alias("file_count"), (F.col("b") + F.col("db")).alias("folder_total_size_bytes")
    )
    return totals.join(touched, "drive_id", "left_anti").select(*now.columns).unionByName(now)
