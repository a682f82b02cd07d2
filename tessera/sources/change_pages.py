"""Landed change pages → change records, and site/drive JSON → catalogue rows.

Landing format (one JSON object per line, written by the collector)::

    {"drive_id": ..., "site_id": ..., "library_name": ..., "page_seq": n,
     "collected_at": "...Z",
     "page": {"value": [ {item}, ... ], "@odata.nextLink": ..., "@odata.deltaLink": ...}}

Items are kept as their JSON text (``raw_json``) and parsed with a fixed
schema.  Presence-only facets (``folder``, ``package``, ``root``,
``deleted``) are read as STRING, so an empty object ``{}`` still arrives as
non-null text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import extension_from_name, format_size, full_path, parent_path_from_reference

S = T.StringType()

PAGE_ITEM = T.StructType(
    [
        T.StructField("id", S), T.StructField("name", S), T.StructField("size", T.LongType()),
        T.StructField("folder", S), T.StructField("package", S), T.StructField("root", S),
        T.StructField("deleted", S),
        T.StructField("file", T.StructType([T.StructField("mimeType", S)])),
        T.StructField("parentReference", T.StructType([T.StructField("id", S), T.StructField("path", S)])),
        T.StructField("createdDateTime", S), T.StructField("lastModifiedDateTime", S),
        T.StructField("lastAccessedDateTime", S), T.StructField("webUrl", S),
    ]
)

LANDED_PAGE = T.StructType(
    [
        T.StructField("drive_id", S), T.StructField("site_id", S), T.StructField("library_name", S),
        T.StructField("page_seq", T.LongType()), T.StructField("collected_at", S),
        T.StructField(
            "page",
            T.StructType(
                [
                    T.StructField("value", T.ArrayType(S)),
                    T.StructField("@odata.nextLink", S),
                    T.StructField("@odata.deltaLink", S),
                ]
            ),
        ),
    ]
)

SITE_JSON = T.StructType(
    [
        T.StructField("id", S), T.StructField("displayName", S), T.StructField("name", S),
        T.StructField("webUrl", S),
        T.StructField("siteCollection", T.StructType([T.StructField("hostname", S)])),
        T.StructField(
            "sharepointIds",
            T.StructType([T.StructField("siteId", S), T.StructField("siteCollectionId", S), T.StructField("webId", S)]),
        ),
    ]
)

DRIVE_JSON = T.StructType(
    [T.StructField("id", S), T.StructField("name", S), T.StructField("driveType", S), T.StructField("webUrl", S)]
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED_PAGE).json(path)


def read_pages_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LANDED_PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def page_log(pages: DataFrame) -> DataFrame:
    """One row per landed page: links and time, for the sync state."""
    return pages.select(
        "drive_id", "site_id", "library_name", "page_seq", "collected_at",
        F.col("page.`@odata.nextLink`").alias("next_link"),
        F.col("page.`@odata.deltaLink`").alias("delta_link"),
    )


def drive_root_paths(items: DataFrame | None) -> DataFrame | None:
    """Latest live root folder path per drive (``max_by`` on collected_at)."""
    if items is None:
        return None
    roots = items.filter(
        F.col("parent_id").isNull() & (F.col("item_type") == "folder") & (F.col("status") != "deleted")
    )
    return roots.groupBy("drive_id").agg(F.max_by("full_path", "collected_at").alias("_root_path"))


def page_changes(pages: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Change records (item columns + page_seq, row_idx, is_tombstone) from
    landed pages.  Rows without an id are skipped."""
    exploded = pages.select(
        "drive_id", "site_id", "library_name", "page_seq", "collected_at",
        F.posexplode(F.col("page.value")).alias("row_idx", "raw_json"),
    )
    roots = drive_root_paths(items)
    if roots is not None:
        exploded = exploded.join(roots, "drive_id", "left")
    else:
        exploded = exploded.withColumn("_root_path", F.lit(None).cast("string"))
    it = F.from_json(F.col("raw_json"), PAGE_ITEM)
    x = exploded.withColumn("_it", it).filter(F.col("_it.id").isNotNull())
    library = F.coalesce(F.col("library_name"), F.col("drive_id"))
    root_path = F.coalesce(F.nullif(F.col("_root_path"), F.lit("")), library)
    is_root = F.col("_it.root").isNotNull()
    item_type = F.when(F.col("_it.folder").isNotNull() | F.col("_it.package").isNotNull(), F.lit("folder")).otherwise(F.lit("file"))
    name = F.coalesce(F.nullif(F.col("_it.name"), F.lit("")), F.col("_it.id"))
    parent_path = F.when(is_root, F.lit("")).otherwise(parent_path_from_reference(root_path, F.col("_it.parentReference.path")))
    size = F.coalesce(F.col("_it.size"), F.lit(0)).cast("long")
    return x.select(
        F.col("_it.id").alias("id"),
        "drive_id", "site_id",
        library.alias("library_name"),
        F.when(is_root, F.lit(None).cast("string")).otherwise(F.col("_it.parentReference.id")).alias("parent_id"),
        parent_path.alias("parent_path"),
        full_path(parent_path, name).alias("full_path"),
        name.alias("name"),
        item_type.alias("item_type"),
        extension_from_name(name, item_type).alias("extension"),
        F.col("_it.file.mimeType").alias("mime_type"),
        size.alias("size_bytes"),
        format_size(size).alias("formatted_size"),
        F.col("_it.createdDateTime").alias("created_at"),
        F.col("_it.lastModifiedDateTime").alias("modified_at"),
        F.col("_it.lastAccessedDateTime").alias("last_accessed_at"),
        F.col("_it.webUrl").alias("web_url"),
        "raw_json",
        "collected_at",
        "page_seq",
        F.col("row_idx").cast("long").alias("row_idx"),
        F.col("_it.deleted").isNotNull().alias("is_tombstone"),
    )


def site_records(site_json: DataFrame, col: str = "json") -> DataFrame:
    """Site JSON text → sites rows: name = displayName, else name, else id;
    host from siteCollection.hostname (either spelling)."""
    s = F.from_json(F.col(col), SITE_JSON)
    host = F.coalesce(
        F.get_json_object(F.col(col), "$.siteCollection.hostname"),
        F.get_json_object(F.col(col), "$.siteCollection.hostName"),
        F.lit(""),
    )
    x = site_json.select(s.alias("s"), F.col(col).alias("raw_json"), host.alias("host_name"))
    return x.select(
        F.col("s.id").alias("id"),
        F.coalesce(F.nullif(F.col("s.displayName"), F.lit("")), F.nullif(F.col("s.name"), F.lit("")), F.col("s.id")).alias("name"),
        F.coalesce(F.col("s.webUrl"), F.lit("")).alias("web_url"),
        "host_name", "raw_json",
    )


def drive_records(drive_json: DataFrame, site_id_col: str = "site_id", col: str = "json") -> DataFrame:
    d = F.from_json(F.col(col), DRIVE_JSON)
    x = drive_json.select(d.alias("d"), F.col(site_id_col).alias("site_id"), F.col(col).alias("raw_json"))
    return x.select(
        F.col("d.id").alias("id"), "site_id",
        F.coalesce(F.nullif(F.col("d.name"), F.lit("")), F.col("d.id")).alias("name"),
        F.col("d.driveType").alias("drive_type"), F.col("d.webUrl").alias("web_url"), "raw_json",
    )


def user_drive_sites(users: DataFrame) -> DataFrame:
    """Personal drives: site id ``user:<id>``, name displayName → UPN → id."""
    return users.select(
        F.concat(F.lit("user:"), F.col("id")).alias("id"),
        F.coalesce(F.nullif(F.col("displayName"), F.lit("")), F.nullif(F.col("userPrincipalName"), F.lit("")), F.col("id")).alias("name"),
        F.coalesce(F.col("userPrincipalName"), F.lit("")).alias("web_url"),
        F.lit("OneDrive for Business").alias("host_name"),
    )
