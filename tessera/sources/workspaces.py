"""Workspaces of several tenants, found on the file system.

A workspace holds ``exports/inventory_parquet*`` (one folder for each export
run), ``exports/site_priority.csv`` and ``data/gold/``.  The newest *complete*
run counts: a folder whose write succeeded, by the time of that success.
Folder names are listed on the driver through Hadoop's FileSystem (a handful a
tenant); the data are read by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The names of a workspace's parts and of the first workspace.
RUN_PREFIX, GOLD, PRIORITY = "inventory_parquet", "data/gold", "exports/site_priority.csv"
GOLD_MARK = "data/gold/storage_kpis.parquet"
CURRENT_TENANT = "Cliente atual"


@dataclass(frozen=True)
class Workspace:
    name: str
    root: str
    inventory: str | None  # the newest complete run
    gold: str
    site_priority: str


def _listed(spark: SparkSession, pattern: str) -> list:
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or [])


def newest_run(spark: SparkSession, root: str) -> str | None:
    """The folder of a workspace's newest complete export run; of runs that
    ended at the same time the last by name."""
    done = [(f.getModificationTime(), f.getPath().getParent().toString()) for f in _listed(spark, f"{root}/exports/{RUN_PREFIX}*/_SUCCESS")]
    return max(done)[1] if done else None


def workspace(spark: SparkSession, name: str, root: str) -> Workspace:
    root = root.rstrip("/")
    return Workspace(name, root, newest_run(spark, root), f"{root}/{GOLD}", f"{root}/{PRIORITY}")


def discover(spark: SparkSession, root: str, clients: str | None = None) -> list[Workspace]:
    """The current workspace at ``root``, then those of the folders of
    ``clients`` that hold an inventory, gold tables or a ranked list, by name."""
    out = [workspace(spark, CURRENT_TENANT, root)]
    for f in sorted(_listed(spark, f"{clients.rstrip('/')}/*") if clients else [], key=lambda f: f.getPath().getName()):
        if not f.isDirectory():
            continue
        found = workspace(spark, f.getPath().getName(), f.getPath().toString())
        if found.inventory or any(_listed(spark, f"{found.root}/{part}") for part in (GOLD_MARK, PRIORITY)):
            out.append(found)
    return out


def read_inventories(spark: SparkSession, workspaces: list[Workspace]) -> DataFrame:
    """The inventories of all workspaces that have one, with ``tenant``, in
    one scan for each set of columns."""
    by_columns: dict[tuple, list[Workspace]] = {}
    for w in workspaces:
        if w.inventory:
            columns = tuple((f.name, f.dataType.simpleString()) for f in spark.read.parquet(w.inventory).schema.fields)
            by_columns.setdefault(columns, []).append(w)
    out = None
    for same in by_columns.values():
        rows = spark.read.parquet(*(w.inventory for w in same))
        at = F.col("_metadata.file_path")
        tenant = F.lit(None).cast("string")
        for w in same:
            tenant = F.when(F.contains(at, F.lit(_path_text(w.inventory) + "/")), F.lit(w.name)).otherwise(tenant)
        rows = rows.select("*", tenant.alias("tenant"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return spark.createDataFrame([], T.StructType([T.StructField("tenant", T.StringType())])) if out is None else out


def _path_text(path: str) -> str:
    """A path as file metadata spell it (escaped, without scheme)."""
    from urllib.parse import quote

    return quote(path.partition(":")[2] if ":" in path.split("/")[0] else path, safe="/:=~!$&'()*+,;@").replace("//", "/")
