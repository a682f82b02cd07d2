"""Session construction and the shared checkpoint/work folder.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir``
(a shared file system path).  We read it from the session; only when it is
unset (local tests) do we pick a private temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # a generated method above HotSpot's 8000-byte JIT limit would run
    # interpreted; let Spark split/fall back instead (wide projections)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # broadcast thresholds: estimated (static) and measured (AQE) sizes
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def build_session(
    app: str = "tessera",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the setting results depend on (UTC session time zone) and the one
    without which wide projections run interpreted."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(key, DEFAULT_CONF[key])
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors (once per application), so
    that functions run in tasks can import it wherever the workers start."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-src-"), "tessera_src.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tessera", os.path.relpath(path, here)))
    sc.addPyFile(archive)
    sc._tessera_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.  Only a local session, as in tests, gets
    one of its own; a cluster must name a shared one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate
    tables written to cut lineage."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-work/{name}-{uuid.uuid4().hex}"


#: session setting: a query's shuffle files go as soon as it ends
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: nothing reads
    them once its table is whole, and those of the steps of a job would pile
    up on the executors' disks."""
    was = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILE_CLEANUP) if was is None else spark.conf.set(FILE_CLEANUP, was)


def work_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: what
    several passes read is made once.  A table that only the job itself reads
    is packed with zstd."""
    spark = df.sparkSession
    path = work_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
