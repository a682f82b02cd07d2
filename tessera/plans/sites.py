"""Site-level helpers: requested-id resolution, usable URLs, id lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import py_strip


def resolution_keys(site_list: DataFrame) -> DataFrame:
    """Every key a requested id may match, lower-cased: the whole id, each
    ','-part, and the alternate site / collection / web ids.  A key several
    sites claim keeps the last site by id (the last write of the map)."""
    lid = F.lower(F.col("id"))
    keys = F.array_union(
        F.array(lid, F.lower(F.col("alt_site_id")), F.lower(F.col("alt_collection_id")), F.lower(F.col("alt_web_id"))),
        F.split(lid, ","),
    )
    x = site_list.select("id", F.explode(keys).alias("k")).filter(F.col("k").isNotNull() & (F.col("k") != ""))
    return x.groupBy("k").agg(F.max("id").alias("resolved_site_id"))


def resolve_site_ids(requested: DataFrame, site_list: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested ids (column ``site_id``) → ``(resolved, errors)``.

    An id equal to a known site id resolves directly; otherwise it is looked
    up among the keys above.  Unresolved ids become error rows (404, not
    retryable), as the discovery step records them.
    """
    if "alt_web_id" not in site_list.columns:
        site_list = site_list.withColumn("alt_web_id", F.lit(None).cast("string"))
    req = requested.select(py_strip(F.col("site_id")).alias("site_id")).filter(F.col("site_id") != "")
    direct = req.join(site_list.select(F.col("id").alias("site_id")), "site_id", "left_semi").withColumn(
        "resolved_site_id", F.col("site_id")
    )
    rest = req.join(site_list.select(F.col("id").alias("site_id")), "site_id", "left_anti")
    mapped = rest.join(resolution_keys(site_list), F.lower(rest["site_id"]) == F.col("k"), "left").drop("k")
    resolved = direct.unionByName(mapped.filter(F.col("resolved_site_id").isNotNull()))
    errors = mapped.filter(F.col("resolved_site_id").isNull()).select(
        F.lit("site").alias("entity_type"),
        F.col("site_id").alias("entity_id"),
        F.col("site_id"),
        F.lit("resolve_site_id").alias("operation"),
        F.lit(404).alias("status_code"),
        F.concat(F.lit("Site ID nao encontrado no Graph: "), F.col("site_id")).alias("message"),
        F.lit(False).alias("retryable"),
    )
    return resolved, errors


def sites_with_url(sites: DataFrame) -> DataFrame:
    """Sites that can be queried for storage metrics, ordered by name."""
    return sites.filter(F.col("web_url").isNotNull() & (F.col("web_url") != "")).select("id", "web_url", "name").orderBy("name", "id")


def combine_id_lists(*lists: DataFrame) -> DataFrame:
    """Ids from several sources (literal list, file, discovery) in order:
    each source's positions follow the previous ones; each id once, at its
    first position."""
    out = None
    for i, ids in enumerate(lists):
        known = ids.schema["pos"].dataType if "pos" in ids.columns else None
        if isinstance(known, T.StructType):  # a place in files
            file, block, row = (F.col(f"pos.{c}") for c in ("file", "block", "row"))
        else:
            file, block, row = F.lit(""), F.lit(0), F.col("pos") if known else F.monotonically_increasing_id()
        pos = F.struct(F.lit(i).alias("list"), file.alias("file"), block.cast("long").alias("block"), row.cast("long").alias("row"))
        part = ids.select("id", pos.alias("pos"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("id").agg(F.min("pos").alias("pos")).orderBy("pos")


def register_inventory_view(inventory: DataFrame, name: str = "inventory") -> DataFrame:
    """Expose the inventory to SQL and return its schema description."""
    inventory.createOrReplaceTempView(name)
    return inventory.sparkSession.sql(f"DESCRIBE {name}")
