"""Paths rebuilt from parent pointers after folders were renamed or moved.

A change page brings the renamed or moved folder, not what lies below it, so
the stored paths of its subtree go stale.  An item is stale where its stored
``parent_path`` is not the ``full_path`` of its parent folder.  Only the
subtrees of stale folders are rebuilt:

1. stale folders are found by one join with their parents, in drives that have
   any stale item;
2. pointers double: after k rounds a folder knows whether any of its nearest
   2^k ancestors, or itself, is stale; those are the folders to rebuild;
3. pointers double again over these folders alone, and a round appends the
   names gathered so far to those of the folder they point at, until each path
   starts at a folder whose path is right;
4. items whose parent was rebuilt, and stale items, get their paths.

Live folders are parents; items below a deleted or unknown folder keep their
paths, and so does a root.  A cycle of parents is an error that names a folder
of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import full_path
from tessera.operators.hierarchy import _staged

KEY = ["drive_id", "folder_id"]


def _moving(nodes: DataFrame) -> bool:
    return nodes.filter("up is not null").limit(1).count() > 0


def _cycle(nodes: DataFrame) -> ValueError:
    stuck = nodes.filter("up is not null").orderBy(*KEY).first()
    return ValueError(f"folder {stuck['folder_id']!r} of drive {stuck['drive_id']!r} lies below a cycle of parents")


def _double(nodes: DataFrame, carried: str, joined: Column) -> DataFrame:
    """Pointers squared until they end; ``joined`` combines a node's value with
    that of the node its pointer names (``far``)."""
    limit = nodes.count().bit_length() + 1
    for _ in range(limit):
        if not _moving(nodes):
            return nodes
        far = nodes.select("drive_id", F.col("folder_id").alias("up"), F.col("up").alias("far_up"), F.col(carried).alias("far"))
        nodes = _staged(
            nodes.join(far, ["drive_id", "up"], "left").select(*KEY, F.col("far_up").alias("up"), joined.alias(carried)), "paths"
        )
    if _moving(nodes):
        raise _cycle(nodes)
    return nodes


def rebuild_paths(items: DataFrame) -> DataFrame:
    """``items`` with ``parent_path`` and ``full_path`` of the subtrees of
    renamed and moved folders set anew."""
    live = items.filter((F.col("item_type") == "folder") & (F.col("status") != "deleted"))
    folders = live.select("drive_id", F.col("id").alias("folder_id"), F.col("parent_id").alias("up"), "name", "parent_path", "full_path")
    parents = folders.select("drive_id", F.col("folder_id").alias("parent_id"), F.col("full_path").alias("_path"))
    # whether a path follows from its own row's parent path needs no join, so
    # the files of a folder meet it as one row, not one by one
    own = F.col("full_path").eqNullSafe(full_path(F.col("parent_path"), F.col("name"))).alias("_own")
    placed = items.select("drive_id", "parent_id", "parent_path", own).distinct().join(parents, ["drive_id", "parent_id"])
    stale = F.col("_path").isNotNull() & ~(F.col("parent_path").eqNullSafe(F.col("_path")) & F.col("_own"))
    drives = _staged(placed.filter(stale).select("drive_id").distinct(), "stale-drives")
    folders = folders.join(drives, "drive_id", "left_semi")
    up = folders.select("drive_id", F.col("folder_id").alias("up"), F.col("full_path").alias("_path"))
    folders = _staged(
        folders.join(up, ["drive_id", "up"], "left").select(
            *KEY, F.when(F.col("_path").isNotNull(), F.col("up")).alias("up"), "name", "full_path", _is_stale().alias("stale")
        ),
        "stale-folders",
    )
    marked = _double(folders.select(*KEY, "up", "stale"), "stale", F.col("stale") | F.coalesce("far", F.lit(False)))
    below = marked.filter("stale").select(*KEY)
    todo = folders.join(below, KEY, "left_semi")
    # a path starts at a parent that is not rebuilt: its stored path is right
    right = folders.join(below, KEY, "left_anti").select("drive_id", F.col("folder_id").alias("up"), F.col("full_path").alias("_path"))
    start = F.when(F.col("_path").isNotNull(), full_path(F.col("_path"), F.col("name"))).otherwise(F.col("name"))
    nodes = todo.join(right, ["drive_id", "up"], "left").select(*KEY, F.when(F.col("_path").isNull(), F.col("up")).alias("up"), start.alias("path"))
    nodes = _double(_staged(nodes, "paths"), "path", F.when(F.col("far").isNotNull(), full_path(F.col("far"), F.col("path"))).otherwise(F.col("path")))
    new = nodes.select("drive_id", F.col("folder_id").alias("parent_id"), F.col("path").alias("_new"))
    # below a folder that was not rebuilt, a stale item still follows it
    old = parents.join(drives, "drive_id", "left_semi")
    known = old.join(new, ["drive_id", "parent_id"], "left").select("drive_id", "parent_id", F.coalesce("_new", "_path").alias("_path"))
    path = F.col("_path")
    out = items.join(known, ["drive_id", "parent_id"], "left")
    return out.select(
        *[
            F.coalesce(path, F.col(c)).alias(c) if c == "parent_path"
            else F.when(path.isNotNull(), full_path(path, F.col("name"))).otherwise(F.col(c)).alias(c) if c == "full_path"
            else F.col(c)
            for c in items.columns
        ]
    )


def _is_stale() -> Column:
    """Whether an item's stored path is not that of its parent (``_path``)."""
    return F.col("_path").isNotNull() & ~(
        F.col("parent_path").eqNullSafe(F.col("_path")) & F.col("full_path").eqNullSafe(full_path(F.col("_path"), F.col("name")))
    )
