"""Inventory export: live items joined to their site and drive, 22 columns,
ordered by site URL, library and path, written as Parquet parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import held, lookup_join
from tessera.operators.hierarchy import recalculate_folders
from tessera.schemas import INVENTORY_COLUMNS
from tessera.sinks.parquet import CHUNK_SIZE, ROWS_PER_FILE, write_inventory

EXPORT_ORDER = ["site_url", "biblioteca", "caminho_item"]
#: what tells rows of one path apart, so that the export order is total
EXPORT_TIES = ["id_drive", "id_item"]


def inventory(items: DataFrame, sites: DataFrame, drives: DataFrame) -> DataFrame:
    """items ⋈ sites ⋈ drives (inner), live items only, renamed columns."""
    i = items.filter(F.col("status") != "deleted").alias("i")
    s = sites.select("id", "host_name", "name", "web_url").alias("s")
    d = drives.select("id", "name").alias("d")
    j = lookup_join(i, s, F.col("i.site_id") == F.col("s.id"), "inner")
    j = lookup_join(j, d, F.col("i.drive_id") == F.col("d.id"), "inner")
    return j.select(*[F.col(src).alias(name) for name, src in INVENTORY_COLUMNS])


def export_inventory(
    items: DataFrame,
    sites: DataFrame,
    drives: DataFrame,
    output_dir: str,
    rows_per_file: int = ROWS_PER_FILE,
    chunk_size: int = CHUNK_SIZE,
    recalculate: bool = False,
) -> dict:
    """Write ``<output_dir>/inventory_parquet`` and return the export totals.

    The rows are dealt to the writing tasks by ranges of the export key; with a
    hot site the range boundaries fall inside it on library and path, so no task
    receives a whole site.
    """
    if recalculate:
        items = recalculate_folders(items)
    rows = inventory(items, held(sites), held(drives))
    order = [F.col(c) for c in EXPORT_ORDER + EXPORT_TIES]
    return write_inventory(rows, f"{output_dir.rstrip('/')}/inventory_parquet", rows_per_file, chunk_size, order)
