"""End-to-end jobs, one per command of the original tool.

Each job reads its inputs with Spark, runs the plans above and writes with
the sinks; what it returns is a small summary built from one-row
aggregates or ``observe`` metrics (never the data itself).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import audit as au
from tessera.plans import catalog as cg
from tessera.plans import lakehouse as lh
from tessera.plans import priority as pr
from tessera.plans import reports as rp
from tessera.plans.inventory import export_inventory
from tessera.operators.dedup import latest_per_key
from tessera.operators.joins import upsert_by_key
from tessera.schemas import DRIVES, PRIORITY_COLUMNS, SITE_STORAGE_METRICS, SITES, Catalog
from tessera.sinks.parquet import table_exists
from tessera.sinks.published import PublishedTable
from tessera.sinks import reports as sk
from tessera.sources.change_pages import drive_records, site_records
from tessera.sources.files import read_site_priority, read_storage_metric_results


def export(
    spark: SparkSession,
    sites: DataFrame,
    drives: DataFrame,
    items: DataFrame,
    output_dir: str,
    data_dir: str,
    as_of,
    rows_per_file: int = 1_000_000,
    recalculate_folders: bool = False,
) -> dict:
    """Inventory Parquet export followed by the full lakehouse build."""
    result = export_inventory(items, sites, drives, output_dir, rows_per_file, recalculate=recalculate_folders)
    result["lakehouse"] = lh.build_lakehouse(spark, Catalog(sites, drives, items), data_dir, as_of, "all")
    return result


def client_report(spark: SparkSession, inventory_path: str, output_dir: str, as_of, old_file_days: int = 365, compression: str = "none") -> dict:
    inv = spark.read.parquet(inventory_path)
    return sk.write_client_report(rp.client_report(inv, as_of, old_file_days), output_dir, compression)


def prioritize_sites(
    spark: SparkSession,
    report_csv: str,
    output_dir: str,
    site_list: DataFrame | None = None,
    period: str = "D7",
    **thresholds,
) -> dict:
    """Rank the usage report, write every output and return the summary."""
    report = pr.read_usage_report(spark, report_csv)
    sk.copy_raw_text(spark, report_csv, f"{output_dir.rstrip('/')}/site_usage_detail_raw")
    priority = pr.prioritize(report, site_list, **thresholds).persist()
    try:
        paths = sk.write_priority(priority, output_dir, PRIORITY_COLUMNS)
        sk.write_json_rows(pr.tier_summary(priority), f"{output_dir.rstrip('/')}/site_priority_tiers.json")
        summary = sk.summary_dict(pr.priority_summary(priority))
        summary.update(
            period=period,
            raw_report_rows=report.count(),
            raw_report_headers=[c for c in report.columns if c != pr.ORDER_COL],
            output_dir=output_dir,
            outputs=paths,
        )
        return summary
    finally:
        priority.unpersist()


def audit(
    spark: SparkSession,
    sites: DataFrame,
    drives: DataFrame,
    items: DataFrame,
    site_priority_csv: str,
    output_dir: str,
    warn_ratio: float = 0.8,
) -> dict:
    expected = au.expected_sites(read_site_priority(spark, site_priority_csv))
    rows = au.audit_sites(expected, au.collected_per_site(sites, drives, items), warn_ratio)
    path = f"{output_dir.rstrip('/')}/site_collection_audit.csv"
    rows = rows.persist()
    try:
        sk.write_csv(rows, path, sep=",", bom=True)
        summary = sk.summary_dict(au.audit_rollup(rows))
    finally:
        rows.unpersist()
    summary["audit_file"] = path
    return summary


def storage_metrics(spark: SparkSession, results_json: str, store_path: str, collected_at: str) -> dict:
    """Ingest collector results into ``site_storage_metrics`` and count ok /
    failed.  The store is a folder of generations, each a whole table: a new
    one holds the old rows with this collection's upserted by site id (the
    last write of a site wins), and readers take the newest complete one."""
    new = au.metric_rows(read_storage_metric_results(spark, results_json), collected_at)
    base = store_path.rstrip("/")
    old, generation = read_storage_metrics(spark, base)
    last = latest_per_key(new.withColumn("_row", F.monotonically_increasing_id()), "site_id", [F.col("_row")]).drop("_row")
    upsert_by_key(old, last, "site_id").write.mode("overwrite").parquet(f"{base}/generation={generation + 1}")
    return sk.summary_dict(au.ingest_counts(new))


def read_storage_metrics(spark: SparkSession, store_path: str) -> tuple[DataFrame | None, int]:
    """The newest generation of the metric store and its number (None and -1
    before the first)."""
    base, n = store_path.rstrip("/"), -1
    while table_exists(spark, f"{base}/generation={n + 1}/_SUCCESS"):
        n += 1
    return (None, -1) if n < 0 else (spark.read.schema(SITE_STORAGE_METRICS).parquet(f"{base}/generation={n}"), n)


def summary(sites: DataFrame, drives: DataFrame, items: DataFrame, errors: DataFrame) -> dict:
    return sk.summary_dict(cg.summary(sites, drives, items, errors))


def sites_table(spark: SparkSession, path: str, buckets: int = 16) -> PublishedTable:
    return PublishedTable(spark, path, SITES, ["id"], buckets)


def drives_table(spark: SparkSession, path: str, buckets: int = 64) -> PublishedTable:
    return PublishedTable(spark, path, DRIVES, ["id"], buckets)


def _upsert(table: PublishedTable, records: DataFrame, at: str) -> int:
    """Insert or replace records with an id, of several with one id the last;
    when a record was first found and last processed stays."""
    rows = records.filter("id is not null").withColumn("_row", F.monotonically_increasing_id())
    last = latest_per_key(rows, "id", [F.col("_row")]).drop("_row")
    return table.merge(last.withColumns({"discovered_at": F.lit(at), "processed_at": F.lit(None).cast("string")}), ["discovered_at", "processed_at"])


def upsert_sites(spark: SparkSession, site_json: DataFrame, path: str, at: str) -> int:
    """Merge listed sites (``json``) into the published sites table."""
    return _upsert(sites_table(spark, path), site_records(site_json), at)


def upsert_drives(spark: SparkSession, drive_json: DataFrame, path: str, at: str) -> int:
    """Merge listed drives (``site_id``, ``json``) into the published drives
    table; ``operators.sync.prepare`` gives new ones their pending state."""
    return _upsert(drives_table(spark, path), drive_records(drive_json), at)
