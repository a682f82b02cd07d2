"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

The catalogue tables are derived from the test tables (see
``tessera.sources.testdata``); every query then runs the engine's own
operators over them, whole tables, no sampling.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.classify import run_outcome
from tessera.plans import feed_suite, io_suite
from tessera.plans import lakehouse as lh
from tessera.sources import testdata as td
from tessera.operators.hierarchy import folder_totals, recalculate_folders
from tessera.plans import inventory as inv_plan
from tessera.plans import reports as rp
from tessera.plans import priority as pr
from tessera.schemas import PRIORITY_COLUMNS
from tessera.session import work_path
from tessera.operators.changes import apply_changes
from tessera.operators.sync import apply_failures, prepare, sync_from_pages, sync_state_columns
from tessera.plans import catalog as cg
from tessera.plans import audit as au
from tessera.plans import urls as ur
from tessera.plans import sites as st

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {**feed_suite.QUERIES, **io_suite.QUERIES}

def catalog(spark: SparkSession, sf_dir: str):
    return td.catalog(spark, sf_dir)


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn

    return deco


# --------------------------------------------------------------------------- lakehouse

def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def build():
        cat = catalog(spark, sf_dir)
        bronze = lh.build_bronze(cat.sites, cat.drives, cat.items, flatten=False)
        return lh.build_silver(bronze, td.AS_OF)

    return build()


@register("storage_kpis")
def q_storage_kpis(spark, sf_dir):
    return lh.storage_kpis(lh.site_storage(silver(spark, sf_dir)["files"]))


@register("top_sites")
def q_top_sites(spark, sf_dir):
    return lh.top_sites(lh.storage_kpis(lh.site_storage(silver(spark, sf_dir)["files"])))


@register("storage_savings")
def q_storage_savings(spark, sf_dir):
    return lh.storage_savings(lh.storage_kpis(lh.site_storage(silver(spark, sf_dir)["files"])))


@register("inactive_sites")
def q_inactive_sites(spark, sf_dir):
    return lh.inactive_sites(lh.site_storage(silver(spark, sf_dir)["files"]))


@register("top_extensions")
def q_top_extensions(spark, sf_dir):
    return lh.top_extensions(silver(spark, sf_dir)["files"])


@register("archive_candidates")
def q_archive_candidates(spark, sf_dir):
    return lh.archive_candidates(silver(spark, sf_dir)["files"])


# --------------------------------------------------------------------------- hierarchy & inventory



def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table on shared storage: what several passes read is made
    once, as the catalogue's own tables are in production."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def inventory_df(spark: SparkSession, sf_dir: str, rollup: bool = False) -> DataFrame:
    cat = catalog(spark, sf_dir)
    if rollup:  # the rollup, the pass-through and the sort's sample all read the items
        items = _written(cat.items, "items")
        return inv_plan.inventory(recalculate_folders(items), cat.sites, cat.drives)
    return inv_plan.inventory(cat.items, cat.sites, cat.drives)


@register("folder_rollup")
def q_folder_rollup(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    totals = folder_totals(cat.items)
    paths = cat.items.filter("item_type = 'folder'").select("drive_id", "id", "full_path")
    from tessera.functions import format_size

    return totals.join(paths, ["drive_id", "id"]).select(
        "drive_id", "id", "full_path", "file_count", "folder_total_size_bytes",
        format_size("folder_total_size_bytes").alias("folder_total_size_formatted"),
    )


@register("inventory")
def q_inventory(spark, sf_dir):
    return inventory_df(spark, sf_dir, rollup=True).orderBy(
        *[F.col(c).asc_nulls_first() for c in inv_plan.EXPORT_ORDER]
    )


# --------------------------------------------------------------------------- client report

@register("client_site_summary")
def q_client_sites(spark, sf_dir):
    return rp.client_site_summary(inventory_df(spark, sf_dir))


@register("client_extension_summary")
def q_client_ext(spark, sf_dir):
    return rp.client_extension_summary(inventory_df(spark, sf_dir))


@register("client_largest_files")
def q_client_largest(spark, sf_dir):
    return rp.client_largest_files(inventory_df(spark, sf_dir))


@register("client_old_files")
def q_client_old(spark, sf_dir):
    return rp.client_old_files(inventory_df(spark, sf_dir), td.AS_OF)


@register("client_file_list")
def q_client_files(spark, sf_dir):
    # the sort's sample reads its input once more: the joined rows are made once
    return rp.client_file_list(_written(inventory_df(spark, sf_dir), "inventory"))


# --------------------------------------------------------------------------- profile

@register("profile_sites")
def q_profile_sites(spark, sf_dir):
    return rp.profile_sites(inventory_df(spark, sf_dir))


@register("profile_totals")
def q_profile_totals(spark, sf_dir):
    return rp.profile_totals(inventory_df(spark, sf_dir))


@register("profile_type_status")
def q_profile_type_status(spark, sf_dir):
    return rp.profile_type_status(inventory_df(spark, sf_dir))


@register("profile_latest_files")
def q_profile_latest(spark, sf_dir):
    return rp.profile_latest_files(inventory_df(spark, sf_dir))


@register("profile_sample")
def q_profile_sample(spark, sf_dir):
    return rp.profile_sample(inventory_df(spark, sf_dir))


@register("profile_extensions")
def q_profile_ext(spark, sf_dir):
    return rp.profile_extensions(inventory_df(spark, sf_dir))


@register("profile_libraries")
def q_profile_libs(spark, sf_dir):
    return rp.profile_libraries(inventory_df(spark, sf_dir))


@register("profile_folders")
def q_profile_folders(spark, sf_dir):
    # only the rollup reads the files, and five of their columns: nothing is written first
    cat = catalog(spark, sf_dir)
    return rp.profile_folders(inv_plan.inventory(recalculate_folders(cat.items), cat.sites, cat.drives))


@register("profile_missing")
def q_profile_missing(spark, sf_dir):
    return rp.profile_missing(inventory_df(spark, sf_dir))


# --------------------------------------------------------------------------- dashboard

# The site selection used by the filtered dashboard query.
DASH_SELECTED_SITES = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003"]


@register("dash_site_names")
def q_dash_names(spark, sf_dir):
    return rp.dash_site_names(inventory_df(spark, sf_dir))


@register("dash_overview")
def q_dash_overview(spark, sf_dir):
    return rp.dash_overview(inventory_df(spark, sf_dir))


@register("dash_overview_selected")
def q_dash_overview_sel(spark, sf_dir):
    return rp.dash_overview(inventory_df(spark, sf_dir), DASH_SELECTED_SITES)


@register("dash_top_sites")
def q_dash_top_sites(spark, sf_dir):
    return rp.dash_top_sites(inventory_df(spark, sf_dir))


@register("dash_top_extensions")
def q_dash_top_ext(spark, sf_dir):
    return rp.dash_top_extensions(inventory_df(spark, sf_dir))


@register("dash_extension_table")
def q_dash_ext_table(spark, sf_dir):
    return rp.dash_extension_table(rp.dash_top_extensions(inventory_df(spark, sf_dir)))


@register("dash_unused_by_site")
def q_dash_unused(spark, sf_dir):
    return rp.dash_unused_by_site(inventory_df(spark, sf_dir), td.AS_OF)


@register("dash_unused_sample")
def q_dash_unused_sample(spark, sf_dir):
    return rp.dash_unused_sample(inventory_df(spark, sf_dir), td.AS_OF)


@register("dash_unused_kpis")
def q_dash_unused_kpis(spark, sf_dir):
    return rp.dash_unused_kpis(inventory_df(spark, sf_dir), td.AS_OF)


@register("dash_site_chart")
def q_dash_chart(spark, sf_dir):
    return rp.site_chart(rp.dash_top_sites(inventory_df(spark, sf_dir)))


@register("gold_totals")
def q_gold_totals(spark, sf_dir):
    return rp.gold_totals(lh.storage_kpis(lh.site_storage(silver(spark, sf_dir)["files"])))


# --------------------------------------------------------------------------- site priority



def priority_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the distributed rank checkpoints its sorted input: never shared
    t = td.Tables(spark, sf_dir)
    report = td.usage_report(t)
    sites = td.site_list(t)
    return pr.prioritize(report, sites)


def dashboard_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.Tables(spark, sf_dir)
    return pr.load_priority(priority_df(spark, sf_dir), td.site_list(t))


@register("site_priority")
def q_site_priority(spark, sf_dir):
    return priority_df(spark, sf_dir).select(*PRIORITY_COLUMNS, "tier").orderBy("rank")


@register("priority_tiers")
def q_priority_tiers(spark, sf_dir):
    return pr.tier_summary(priority_df(spark, sf_dir))


@register("priority_summary")
def q_priority_summary(spark, sf_dir):
    return pr.priority_summary(priority_df(spark, sf_dir))


@register("storage_limits")
def q_storage_limits(spark, sf_dir):
    return pr.storage_limits(dashboard_priority(spark, sf_dir))


@register("quota_kpis")
def q_quota_kpis(spark, sf_dir):
    return pr.quota_kpis(dashboard_priority(spark, sf_dir))


@register("inactive_priority_sites")
def q_inactive_priority(spark, sf_dir):
    return pr.inactive_sites(dashboard_priority(spark, sf_dir), td.AS_OF)


# --------------------------------------------------------------------------- change feed, sync state, catalogue stats


APPLIED_COLUMNS = ["drive_id", "id", "site_id", "name", "size_bytes", "formatted_size", "modified_at", "status", "collected_at", "raw_json"]


@register("apply_changes")
def q_apply_changes(spark, sf_dir):
    t = td.Tables(spark, sf_dir)
    return apply_changes(None, td.change_records(t)).select(*APPLIED_COLUMNS)


@register("apply_changes_incremental")
def q_apply_changes_incremental(spark, sf_dir):
    """The pages up to the middle one as stored state, the later ones as a
    batch merged into it: the same table as from all pages at once."""
    changes = td.change_records(td.Tables(spark, sf_dir))
    middle = (changes.agg(F.max("page_seq")).first()[0] or 0) // 2
    state = apply_changes(None, changes.filter(F.col("page_seq") <= middle), keep_ghosts=True)
    merged = apply_changes(state, changes.filter(F.col("page_seq") > middle), keep_ghosts=True)
    return merged.filter("not _ghost").select(*APPLIED_COLUMNS)


@register("pending_count")
def q_pending_count(spark, sf_dir):
    return cg.pending_count(sync_from_pages(td.page_log(td.Tables(spark, sf_dir))))


@register("run_outcome")
def q_run_outcome(spark, sf_dir):
    t = td.Tables(spark, sf_dir)
    cat = catalog(spark, sf_dir)
    sync = sync_from_pages(td.page_log(t))
    stats = cg.catalog_stats(cat.sites, cat.drives, cat.items, td.errors(t), sync)
    none = F.lit(0).cast("long")
    states = sync.agg(F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "in_progress").alias("moving"))
    both = stats.select("open_errors", none.alias("failed"), none.alias("moving")).unionByName(states.withColumn("open_errors", none))
    total = both.agg(*(F.sum(c).alias(c) for c in ("open_errors", "failed", "moving")))
    return total.select(run_outcome("open_errors", "failed", "moving").alias("outcome"))


@register("sync_state")
def q_sync_state(spark, sf_dir):
    return sync_state_columns(sync_from_pages(td.page_log(td.Tables(spark, sf_dir))))


@register("sync_status_counts")
def q_sync_counts(spark, sf_dir):
    return cg.sync_counts(sync_from_pages(td.page_log(td.Tables(spark, sf_dir))))


@register("catalog_stats")
def q_catalog_stats(spark, sf_dir):
    t = td.Tables(spark, sf_dir)
    cat = catalog(spark, sf_dir)
    return cg.catalog_stats(cat.sites, cat.drives, cat.items, td.errors(t), sync_from_pages(td.page_log(t)))


@register("export_summary")
def q_export_summary(spark, sf_dir):
    t = td.Tables(spark, sf_dir)
    cat = catalog(spark, sf_dir)
    return cg.summary(cat.sites, cat.drives, cat.items, td.errors(t))


# --------------------------------------------------------------------------- audit, storage metrics, URLs, layers



def audit_df(spark, sf_dir):
    t = td.Tables(spark, sf_dir)
    cat = catalog(spark, sf_dir)
    collected = au.collected_per_site(cat.sites, cat.drives, cat.items)
    return au.audit_sites(au.expected_sites(td.expected_usage(t)), collected)


@register("collected_per_site")
def q_collected(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    return au.collected_per_site(cat.sites, cat.drives, cat.items)


@register("site_audit")
def q_site_audit(spark, sf_dir):
    return audit_df(spark, sf_dir)


@register("audit_rollup")
def q_audit_rollup(spark, sf_dir):
    return au.audit_rollup(audit_df(spark, sf_dir))


def metrics_df(spark, sf_dir):
    return au.metric_rows(td.storage_metric_results(td.Tables(spark, sf_dir)), td.COLLECTED_AT)


@register("storage_metrics_report")
def q_metrics_report(spark, sf_dir):
    return au.metrics_report(metrics_df(spark, sf_dir), catalog(spark, sf_dir).sites)


@register("storage_ingest_counts")
def q_ingest_counts(spark, sf_dir):
    return au.ingest_counts(metrics_df(spark, sf_dir))


@register("version_kpis")
def q_version_kpis(spark, sf_dir):
    return au.version_kpis(au.ok_metrics(metrics_df(spark, sf_dir), catalog(spark, sf_dir).sites))


@register("version_table")
def q_version_table(spark, sf_dir):
    return au.version_table(au.ok_metrics(metrics_df(spark, sf_dir), catalog(spark, sf_dir).sites))


@register("page_urls")
def q_page_urls(spark, sf_dir):
    pages = td.Tables(spark, sf_dir).pages.select("page_id", "url")
    return ur.url_profile(pages)


@register("page_hosts")
def q_page_hosts(spark, sf_dir):
    pages = td.Tables(spark, sf_dir).pages.select("page_id", "url")
    return ur.host_summary(ur.url_profile(pages))


@register("bronze_sites")
def q_bronze_sites(spark, sf_dir):
    from tessera.operators.flatten import flatten_json_column

    return flatten_json_column(lh.bronze_sites(td.sites(td.Tables(spark, sf_dir))), "raw_json", "raw_")


@register("silver_sites")
def q_silver_sites(spark, sf_dir):
    return silver(spark, sf_dir)["sites"]


@register("silver_drives")
def q_silver_drives(spark, sf_dir):
    return silver(spark, sf_dir)["drives"]


@register("silver_files")
def q_silver_files(spark, sf_dir):
    return silver(spark, sf_dir)["files"]


# --------------------------------------------------------------------------- site id resolution



def _requested_ids(spark, sf_dir):
    """Requested ids: each usage-report site id, in upper case for every
    fourth customer and as the composite id for every fifth."""
    c = td.Tables(spark, sf_dir).customer
    k = F.col("c_custkey").cast("string")
    rid = (
        F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit(td.HOST + ",sc"), k, F.lit(","), k))
        .when(F.col("c_custkey") % 4 == 0, F.upper(F.concat(F.lit("SID-"), k)))
        .otherwise(k)
    )
    return c.select(rid.alias("site_id"))


@register("site_id_resolution")
def q_site_id_resolution(spark, sf_dir):
    resolved, _ = st.resolve_site_ids(_requested_ids(spark, sf_dir), td.site_list(td.Tables(spark, sf_dir)))
    return resolved


@register("site_id_errors")
def q_site_id_errors(spark, sf_dir):
    _, errors = st.resolve_site_ids(_requested_ids(spark, sf_dir), td.site_list(td.Tables(spark, sf_dir)))
    return errors


@register("version_chart")
def q_version_chart(spark, sf_dir):
    return au.version_chart(au.ok_metrics(metrics_df(spark, sf_dir), catalog(spark, sf_dir).sites))


# --------------------------------------------------------------------------- sync-state transitions


# Fixed value: the time stamp the transition queries record.
TRANSITION_AT = "2025-01-01T00:00:00Z"


@register("sync_prepared")
def q_sync_prepared(spark, sf_dir):
    t = td.Tables(spark, sf_dir)
    state = sync_from_pages(td.page_log(t))
    return sync_state_columns(prepare(state, td.sync_drives(t), TRANSITION_AT, reset_completed=True))


@register("sync_after_failures")
def q_sync_after_failures(spark, sf_dir):
    t = td.Tables(spark, sf_dir)
    return sync_state_columns(apply_failures(sync_from_pages(td.page_log(t)), td.next_run_errors(t)))


# Fixed value: the site the reset query clears.
RESET_SITE_ID = "7"


@register("reset_site_counts")
def q_reset_site_counts(spark, sf_dir):
    from tessera.operators.sync import reset_site

    t = td.Tables(spark, sf_dir)
    cat = catalog(spark, sf_dir)
    tables = {
        "sites": cat.sites, "drives": cat.drives, "items": cat.items,
        "drive_sync_state": sync_state_columns(sync_from_pages(td.page_log(t))), "errors": td.errors(t),
    }
    _, counts = reset_site(tables, RESET_SITE_ID, TRANSITION_AT)
    return counts


@register("drive_roots")
def q_drive_roots(spark, sf_dir):
    from tessera.sources.change_pages import drive_root_paths

    return drive_root_paths(catalog(spark, sf_dir).items).withColumnRenamed("_root_path", "root_path")


@register("bronze_files")
def q_bronze_files(spark, sf_dir):
    return lh.bronze_files(catalog(spark, sf_dir).items)


@register("bronze_drives")
def q_bronze_drives(spark, sf_dir):
    return lh.bronze_drives(catalog(spark, sf_dir).drives)
