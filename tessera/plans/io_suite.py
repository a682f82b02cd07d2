"""Registered queries of sources, sinks and merges: what the test tables give
is written as the jobs write it, read back as the readers read it, and
returned; and the tree operators over the catalogue after a batch of moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.urls import path_depth
from tessera.functions import format_size
from tessera.operators import held
from tessera.operators import item_state as its
from tessera.operators import rollup_deltas as rd
from tessera.operators.hierarchy import folder_totals
from tessera.operators.paths import rebuild_paths
from tessera.plans import audit as au
from tessera.plans import catalog as cg
from tessera.plans import inventory as inv_plan
from tessera.plans import lakehouse as lh
from tessera.plans import pipelines, reports
from tessera.plans import priority as pr
from tessera.plans import sites as st
from tessera.schemas import PRIORITY_COLUMNS
from tessera.session import work_path, work_table
from tessera.sinks import reports as sk
from tessera.sinks.parquet import read_layer, write_layer
from tessera.sources import files as sf
from tessera.sources import testdata as td
from tessera.sources.change_pages import drive_records, site_records, user_drive_sites

# Rows of an exported part in the export query, and the time
# stamps of the merge queries.
EXPORT_ROWS, FIRST_AT, LATER_AT = 10_000, "2001-01-01T00:00:00Z", "2002-01-01T00:00:00Z"


# What the tree queries read of an item, and what of it the paths
# need; the other columns are not staged.
TREE_COLUMNS = ["drive_id", "id", "library_name", "parent_id", "parent_path", "full_path", "name", "item_type", "size_bytes", "status"]
PATH_COLUMNS = ["drive_id", "id", "parent_id", "parent_path", "full_path", "name", "item_type", "status"]


#: buckets in which the rows of two tables are summed up before they are compared
HASH_BUCKETS = 1 << 16


def _staged(df: DataFrame, name: str) -> DataFrame:
    return work_table(df, name)


# -- exports -------------------------------------------------------------------


def export_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported parts, in file order: rows, bytes, first and last path."""
    cat, out = td.catalog(spark, sf_dir), work_path(spark, "export")
    inv_plan.export_inventory(cat.items, cat.sites, cat.drives, out, EXPORT_ROWS)
    rows = spark.read.parquet(f"{out}/inventory_parquet")
    sizes = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("tamanho_bytes").alias("bytes"),
        F.min(F.struct("site_url", "biblioteca", "caminho_item")).alias("lo"), F.max(F.struct("site_url", "biblioteca", "caminho_item")).alias("hi"),
    )
    from pyspark.sql.window import Window

    place = F.row_number().over(Window.orderBy("file"))  # a row a part
    return sizes.select(
        (place - 1).cast("long").alias("part_no"), "n_rows", "bytes", F.col("lo.caminho_item").alias("first_path"), F.col("hi.caminho_item").alias("last_path")
    )


def _differing(given: DataFrame, back: DataFrame) -> DataFrame:
    """One row: the rows of ``back``, and how many of ``given`` it lacks
    (``exceptAll``).  Both are read once and summed up in buckets, by two hashes
    of the whole row; where the sums of a bucket differ, its rows are read
    again and compared as they are, so equal tables shuffle no row."""
    both = given.withColumns({"_g": F.lit(1), "_b": F.lit(0)}).unionByName(back.withColumns({"_g": F.lit(0), "_b": F.lit(1)}))
    nulls = [F.col(f.name).isNull() for f in both.schema if f.nullable]  # a null leaves a hash as it is
    both = both.withColumns({f"_h{k}": F.xxhash64(F.lit(k), *given.columns, *nulls) for k in range(2)})
    both = both.withColumn("_bucket", F.pmod("_h0", F.lit(HASH_BUCKETS)))
    more = F.col("_g") - F.col("_b")
    # halves of the hashes: their sums stay inside a long
    halves = [half for h in ("_h0", "_h1") for half in (F.shiftright(h, 32), F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)))]
    signs = {"_more": F.sum(more), **{f"_s{k}": F.sum(more * half) for k, half in enumerate(halves)}}
    sums = _staged(both.groupBy("_bucket").agg(F.sum("_b").alias("_b"), *[c.alias(k) for k, c in signs.items()]), "row-sums")
    unequal = sums.filter(" or ".join(f"{k} <> 0" for k in signs)).select("_bucket")
    counts = both.join(F.broadcast(unequal), "_bucket", "left_semi").groupBy(*given.columns).agg(F.sum("_g").alias("_g"), F.sum("_b").alias("_b"))
    lacking = F.greatest(F.col("_g") - F.col("_b"), F.lit(0))
    return sums.agg(F.coalesce(F.sum("_b"), F.lit(0)).alias("n_rows")).crossJoin(counts.agg(F.coalesce(F.sum(lacking), F.lit(0)).alias("differing")))


def client_report_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each CSV table of the client report its rows, and how many rows
    differ from what was written."""
    cat, out = td.catalog(spark, sf_dir), work_path(spark, "client-report")
    inv = _staged(inv_plan.inventory(cat.items, held(cat.sites), held(cat.drives)), "inventory")
    tables = reports.client_report(inv, td.AS_OF)
    given = {"05_inventario_arquivos_cliente": reports.client_file_rows(inv)}  # no order is compared
    result = None
    for stem, path in sk.write_client_report(tables, out, "gzip").items():
        back = spark.read.option("header", True).option("sep", ";").option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
        # empty text and null are one in CSV
        text = lambda df: df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"c{k}") for k, c in enumerate(df.columns)])
        # the other tables are small beside the inventory; written first, their sorts run once more and not three times
        rows = text(given[stem]) if stem in given else _staged(text(tables[stem]), "report-table")
        one = _differing(rows, text(back)).select(F.lit(stem).alias("name"), "n_rows", "differing")
        result = one if result is None else result.unionByName(one)
    return result


def layer_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver drives, written as a layer and read again."""
    cat = td.catalog(spark, sf_dir)
    silver = lh.build_silver(lh.build_bronze(cat.sites, cat.drives, cat.items, flatten=False), td.AS_OF)["drives"]
    path = work_path(spark, "layer")
    write_layer(silver, path, "drives")
    return read_layer(spark, path).unionByName(read_layer(spark, f"{path}-none", silver.schema))


# -- usage report, ranked list, id lists, metrics ------------------------------


def _report_file(spark: SparkSession, sf_dir: str) -> str:
    """The usage report as CSV files with a byte-order mark, in report order."""
    path = work_path(spark, "usage-report")
    report = td.usage_report(td.Tables(spark, sf_dir))
    sk.write_csv(report.orderBy("_report_row").drop("_report_row"), path, sep=",", bom=True)
    return path


def report_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked list from a usage report that was read from files."""
    ranked = pr.prioritize(pr.read_usage_report(spark, _report_file(spark, sf_dir)), td.site_list(td.Tables(spark, sf_dir)))
    return ranked.select(*PRIORITY_COLUMNS, "tier")


def priority_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks and ids as each output of the ranked list gives them back."""
    t, out = td.Tables(spark, sf_dir), work_path(spark, "priority")
    ranked = _staged(pr.prioritize(td.usage_report(t), td.site_list(t)), "ranked")
    paths = sk.write_priority(ranked, out, PRIORITY_COLUMNS)
    none = F.lit(None).cast("string")
    csv = sf.read_site_priority(spark, paths["site_priority_csv"]).select(F.lit("csv").alias("source"), "rank", "site_id", none.alias("tier"))
    rows = spark.read.schema("rank long, site_id string").json(paths["json"]).select(F.lit("json").alias("source"), "rank", "site_id", none.alias("tier"))
    tiers = spark.read.schema("rank long, site_id string, tier string").json(paths["json_by_tier"]).select(F.lit("json_by_tier").alias("source"), "rank", "site_id", "tier")
    ids = sf.read_id_list(spark, paths["ids"]).select(F.lit("ids").alias("source"), F.lit(None).cast("long").alias("rank"), F.col("id").alias("site_id"), none.alias("tier"))
    by_tier = spark.read.schema("value string, tier string").text(paths["ids_by_tier"]).select(F.lit("ids_by_tier").alias("source"), F.lit(None).cast("long").alias("rank"), F.col("value").alias("site_id"), "tier")
    out = csv.unionByName(rows).unionByName(tiers).unionByName(ids).unionByName(by_tier)
    return out.withColumn("site_id", F.coalesce("site_id", F.lit("")))


def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of two list files and a frame, each once, in order: blank and
    comment lines dropped, the mark of the first line too."""
    c = td.Tables(spark, sf_dir).customer.select("c_custkey")
    k = F.col("c_custkey")
    one, two = work_path(spark, "ids"), work_path(spark, "ids")
    line = F.when(k == 1, F.concat(F.lit(sf.BOM), F.lit("id-1 "))).when(k % 5 == 0, F.lit("  ")).when(k % 7 == 0, F.lit("# no id")).otherwise(
        F.concat(F.lit("\tid-"), (k % 1000).cast("string"))
    )
    c.orderBy("c_custkey").select(line.alias("value")).write.text(one)
    c.filter(k % 3 == 0).orderBy(F.desc("c_custkey")).select(F.concat(F.lit("id-"), k.cast("string")).alias("value")).write.text(two)
    given = c.filter(k <= 3).select(F.concat(F.lit("id-"), (k * 2).cast("string")).alias("id"), k.alias("pos"))
    lists = st.combine_id_lists(given, sf.read_id_list(spark, one), sf.distinct_ids(sf.read_id_list(spark, two)))
    return lists.select("id", F.col("pos.list").alias("list"))


def metrics_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows from collector files, each a JSON array or one object."""
    path = work_path(spark, "metrics")
    results = td.storage_metric_results(td.Tables(spark, sf_dir))
    one = results.withColumn("g", F.pmod(F.xxhash64("site_id"), F.lit(50)))
    many = one.filter("g >= 5").groupBy("g").agg(F.collect_list(F.struct(*results.columns)).alias("r")).select(F.to_json("r").alias("value"))
    single = one.filter("g < 5").select(F.to_json(F.struct(*results.columns)).alias("value"))
    # a file is a document: one row a file
    many.unionByName(single).write.option("maxRecordsPerFile", 1).text(path)
    return au.metric_rows(sf.read_storage_metric_results(spark, path), td.COLLECTED_AT)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs appended to the run log, one for each outcome of the rule."""
    path = work_path(spark, "runs")
    errors = td.errors(td.Tables(spark, sf_dir)).count()
    for k, stats in enumerate(({"open_errors": errors}, {"open_errors": 0, "delta": {"failed": 1}}, {"open_errors": 0})):
        cg.append_run(cg.run_record(spark, k, "crawl", FIRST_AT, LATER_AT, stats), path)
    return spark.read.parquet(path).select("id", "command", "started_at", "finished_at", "status")


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rows as the catalogue keeps them (messages cut to their limit)."""
    raw = td.errors(td.Tables(spark, sf_dir)).drop("resolved")
    return cg.error_records(raw.withColumn("message", F.repeat(F.concat("message", F.lit(" ")), (F.col("id") % 900).cast("int"))))


def sites_with_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.Tables(spark, sf_dir)
    url = F.when(F.col("id").cast("long") % 6 == 0, F.lit("")).when(F.col("id").cast("long") % 6 != 1, F.col("web_url"))
    return st.sites_with_url(td.sites(t).withColumn("web_url", url))


def folder_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = td.catalog(spark, sf_dir).items
    return items.groupBy(path_depth("full_path").cast("long").alias("depth"), "item_type").agg(F.count(F.lit(1)).alias("items"))


# -- records and merges --------------------------------------------------------


def ingest_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_records(td.sites(td.Tables(spark, sf_dir)), "raw_json").drop("raw_json")


def _drive_json(t: td.Tables) -> DataFrame:
    d = td.drives(t)
    name = F.when(F.col("site_id").cast("long") % 3 == 0, F.lit("")).otherwise(F.col("name"))
    return d.select("site_id", F.to_json(F.struct("id", name.alias("name"), F.col("drive_type").alias("driveType"), F.col("web_url").alias("webUrl"))).alias("json"))


def ingest_drives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drive_records(_drive_json(td.Tables(spark, sf_dir))).drop("raw_json")


def ingest_user_drives(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = td.Tables(spark, sf_dir).customer
    k = F.col("c_custkey")
    return user_drive_sites(c.select(
        k.cast("string").alias("id"), F.when(k % 4 != 0, F.col("c_name")).alias("displayName"),
        F.when(k % 8 != 0, F.concat(F.lit("u"), k.cast("string"), F.lit("@h.example"))).alias("userPrincipalName"),
    ))


def sites_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites listed twice: the second list renames some, adds others, and the
    first time of discovery stays."""
    t, path = td.Tables(spark, sf_dir), work_path(spark, "sites")
    listed = td.sites(t).select("id", F.col("raw_json").alias("json"))
    k = F.col("id").cast("long")
    pipelines.upsert_sites(spark, listed.filter(k % 5 != 0), path, FIRST_AT)
    renamed = F.replace(F.col("json"), F.lit('"displayName":"'), F.lit('"displayName":"New '))
    pipelines.upsert_sites(spark, listed.filter(k % 5 < 2).withColumn("json", renamed), path, LATER_AT)
    return pipelines.sites_table(spark, path).read().drop("raw_json")


def drives_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drives listed twice, the second time under another site."""
    t, path = td.Tables(spark, sf_dir), work_path(spark, "drives")
    listed = _drive_json(t)
    k = F.col("site_id").cast("long")
    pipelines.upsert_drives(spark, listed.filter(k % 4 != 0), path, FIRST_AT)
    pipelines.upsert_drives(spark, listed.filter(k % 4 < 2).withColumn("site_id", F.concat(F.lit("moved-"), "site_id")), path, LATER_AT)
    return pipelines.drives_table(spark, path).read().drop("raw_json")


# -- trees after moves ---------------------------------------------------------


def _moved(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The items that a batch touches, before and after: every fifth nation's
    folder is renamed, every tenth supplier's folder moves to the root, every
    sixth file grows or is deleted, a folder comes back."""
    number = F.regexp_extract("id", r"^[NS](\d+)$", 1).try_cast("long")
    renamed = (F.col("item_type") == "folder") & F.col("id").startswith("N") & (number % 5 == 1)
    moved = (F.col("item_type") == "folder") & F.col("id").startswith("S") & (number % 10 == 0)
    back = (F.col("item_type") == "folder") & F.col("id").startswith("N") & (F.col("status") == "deleted") & (number % 2 == 0)
    h = F.split_part("id", F.lit("-"), F.lit(1)).try_cast("long") % 12
    file = (F.col("item_type") == "file") & h.isin(0, 6)
    # no flag may be null: the digits of a file's id are none
    flags = [F.coalesce(c, F.lit(False)) for c in (renamed, moved, back, file)]
    old = items.withColumns(dict(zip(("_renamed", "_moved", "_back", "_file"), flags))).filter("_renamed or _moved or _back or _file")
    name = F.when(F.col("_renamed"), F.concat(F.lit("X"), "name")).otherwise(F.col("name"))
    new = old.withColumns({
        "name": name,
        "parent_id": F.when(F.col("_moved"), F.lit("T")).otherwise(F.col("parent_id")),
        "parent_path": F.when(F.col("_moved"), F.col("library_name")).otherwise(F.col("parent_path")),
        "status": F.when(F.col("_back"), F.lit("ok")).when(F.col("_file") & (h == 0), F.lit("deleted")).otherwise(F.col("status")),
        "size_bytes": F.when(F.col("_file"), F.col("size_bytes") + 1000).otherwise(F.col("size_bytes")),
    })
    new = new.withColumn("full_path", F.when(F.col("item_type") == "folder", F.concat_ws("/", "parent_path", "name")).otherwise(F.col("full_path")))
    return old.select(*items.columns), new.select(*items.columns)


def rebuilt_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of all items after folders were renamed and moved."""
    items = _staged(td.catalog(spark, sf_dir).items.select(*TREE_COLUMNS), "items")
    _, new = _moved(items)
    new = _staged(new, "touched")
    after = items.join(new.select("drive_id", "id"), ["drive_id", "id"], "left_anti").select(*items.columns).unionByName(new)
    after = _staged(after.select(*PATH_COLUMNS), "after")  # read several times: the anti join runs once
    return rebuild_paths(after).select("drive_id", "id", "item_type", "parent_path", "full_path")


def rollup_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder totals brought up to date from the touched items alone."""
    items = _staged(td.catalog(spark, sf_dir).items.select(*TREE_COLUMNS), "items")
    old, new = (_staged(x, "touched") for x in _moved(items))
    totals, direct, folders = folder_totals(items), rd.direct_sums(items), rd.live_folders(items)
    return rd.update_totals(totals, direct, folders, old, new)


def rollup_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes to items whose state carries rollup columns: an upsert brings
    the new size and leaves the rollup columns as they were."""
    changes = td.change_records(td.Tables(spark, sf_dir))
    middle = (changes.agg(F.max("page_seq")).first()[0] or 0) // 2
    states = its.states_of(changes.filter(F.col("page_seq") <= middle))
    rolled = its.items_of(states).withColumns({
        "file_count": F.col("id").cast("long"), "folder_total_size_bytes": F.col("id").cast("long") * 3,
        "folder_total_size_formatted": format_size(F.col("id").cast("long") * 3),
    })
    merged = its.merge_states(its.with_rollup(states, rolled), its.states_of(changes.filter(F.col("page_seq") > middle)))
    return its.items_of(merged).select("drive_id", "id", "size_bytes", "status", "file_count", "folder_total_size_bytes", "folder_total_size_formatted")


QUERIES = {
    f.__name__: f
    for f in (
        export_parts, client_report_read_back, layer_read_back, report_from_file, priority_read_back, id_lists, metrics_read_back, run_log,
        error_log, sites_with_url, folder_depths, ingest_sites, ingest_drives, ingest_user_drives, sites_merged, drives_merged,
        rebuilt_paths, rollup_updated, rollup_carried,
    )
}
