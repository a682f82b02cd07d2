"""Tables in published versions.

A table is a folder of data generations and manifests::

    data/gen=<id>/bucket=<k>/part-…      written by Spark, never changed
    manifests/v=<n>                      for each bucket the generation that holds it

Readers take the newest manifest.  A write puts its data beside the others and
then publishes a manifest by a rename that fails when another writer published
that version first, so a failed write leaves the table as it was, a reader
never meets half a table, and two writers cannot lose each other's rows: the
later one gets a ``ConflictError`` (``merge`` starts anew from what the other
published).

A row lies in the bucket of its key's hash.  A merge reads and writes only the
buckets that its rows fall into; the files of all others keep their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import upsert_by_key


class ConflictError(RuntimeError):
    """Another writer published the version first."""


class PublishedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    # -- files -----------------------------------------------------------------

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, pattern: str) -> list[str]:
        where, fs = self._fs(f"{self.path}/{pattern}")
        return sorted(f.getPath().getName() for f in fs.globStatus(where) or [])

    def versions(self) -> list[int]:
        return [int(n.partition("=")[2]) for n in self._names("manifests/v=*")]

    def version(self) -> int:
        """The newest published version; 0 before the first."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """The generation of each bucket that has rows."""
        version = self.version() if version is None else version
        if not version:
            return {}
        lines = self.spark.read.text(f"{self.path}/manifests/v={version:010d}").collect()  # one a bucket
        return {int(k): gen for k, _, gen in (r["value"].partition(" ") for r in lines)}

    def _publish(self, version: int, parts: dict[int, str]) -> int:
        jvm = self.spark._jvm
        text = "".join(f"{k} {gen}\n" for k, gen in sorted(parts.items()))
        draft, fs = self._fs(f"{self.path}/manifests/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        target, _ = self._fs(f"{self.path}/manifests/v={version:010d}")
        options = self.spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        except Exception as e:
            if "AlreadyExists" in str(e):
                raise ConflictError(f"version {version} of {self.path} is published already") from e
            raise
        return version

    def _write(self, rows: DataFrame) -> dict[int, str]:
        gen = uuid.uuid4().hex
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        bucket = self.bucket().alias("bucket")
        typed.select("*", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/gen={gen}")
        return {int(n.partition("=")[2]): gen for n in self._names(f"data/gen={gen}/bucket=*")}

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # -- reads and writes --------------------------------------------------------

    def _read(self, parts: dict[int, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/data/gen={gen}/bucket={k}" for k, gen in sorted(parts.items())))

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version (the newest one unless given)."""
        return self._read(self.manifest(version))

    def overwrite(self, rows: DataFrame, version: int | None = None) -> int:
        """Replace the table as it was at ``version`` (the newest one unless
        given); returns the version published."""
        version = self.version() if version is None else version
        return self._publish(version + 1, self._write(rows))

    def merge(self, rows: DataFrame, keep_old: list[str] | None = None, attempts: int = 5) -> int:
        """Insert or replace by key (one row a key); columns in ``keep_old``
        keep their values where the key was there.  ``rows`` should not be dear
        to compute twice."""
        hit = {r["bucket"] for r in rows.select(self.bucket().alias("bucket")).distinct().collect()}  # self.buckets at most
        for left in range(attempts - 1, -1, -1):
            version = self.version()
            parts = self.manifest(version)
            if not hit:
                return version
            merged = upsert_by_key(self._read({k: gen for k, gen in parts.items() if k in hit}), rows, self.keys, keep_old)
            new = {k: gen for k, gen in parts.items() if k not in hit} | self._write(merged)
            try:
                return self._publish(version + 1, new)
            except ConflictError:
                if not left:
                    raise
        raise AssertionError("unreachable")
