"""Catalogue tables derived from the driver's test tables.

The engine's inputs are a document estate catalogue (sites, drives, items,
errors, change pages, usage reports, storage metrics).  The test data is a
TPC-H-like star schema, so these functions derive catalogue-shaped
DataFrames from it with plain Spark expressions.  The mapping rules are
fixed: the DuckDB oracle queries restate them in SQL.

Every derived table is a projection/join of the given tables, so its size
grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import format_size, full_path, iso_utc
from tessera.schemas import Catalog

# The evaluation date standing in for "today" (later than
# every ship date in the test data) and the catalogue's fixed timestamps.
AS_OF = "2001-12-01"
DISCOVERED_AT = "2001-01-01T00:00:00Z"
PROCESSED_AT = "2001-01-02T00:00:00Z"
COLLECTED_AT = "2001-12-01T00:00:00Z"
HOST = "h.example"
SITE_URL_PREFIX = "https://h.example/sites/"

# File extension by brand number modulo 8 ('' = no extension).
BRAND_EXTENSIONS = ["docx", "PDF", "png", "mp4", "zip", "exe", "xyz", ""]
#: the same in lower case: looked up, as ``lower`` a row took a quarter of the
#: time in which the items are made
LOWER_EXTENSIONS = [e.lower() for e in BRAND_EXTENSIONS]
# Libraries (drives) per site, one per return flag.
LIBRARY_FLAGS = ["A", "N", "R"]
# Error status codes picked by event id modulo 7.
ERROR_CODES = [401, 403, 404, 410, 423, 429, 503]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


#: session setting: deal the line items, one row group in a small test table, to
#: so many tasks by key.  Set by a caller (bench.py) that wants all cores; no
#: size is tested, and results do not depend on it.
SPREAD = "tessera.spread"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its plan (file listing, schema) is made once a session."""
    path, spread = f"{sf_dir.rstrip('/')}/{name}.parquet", spark.conf.get(SPREAD, None)
    known = spark.__dict__.setdefault("_tessera_tables", {})
    if (path, spread) not in known:
        df = spark.read.parquet(path)
        if spread and name == "lineitem":
            df = df.repartition(int(spread), "l_orderkey", "l_linenumber")
        known[path, spread] = df
    return known[path, spread]


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def _site_url(suppkey: Column) -> Column:
    return F.concat(
        F.lit(SITE_URL_PREFIX), suppkey.cast("string"),
        F.when(suppkey % 2 == 0, F.lit("/")).otherwise(F.lit("")),
    )


def sites(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    url = _site_url(k)
    name = F.when(k % 17 == 0, F.lit(None).cast("string")).when(k % 23 == 0, F.lit("")).otherwise(F.col("s_name"))
    raw = F.to_json(
        F.struct(
            k.cast("string").alias("id"),
            F.col("s_name").alias("displayName"),
            url.alias("webUrl"),
            F.struct(F.lit(HOST).alias("hostname")).alias("siteCollection"),
        )
    )
    return s.select(
        k.cast("string").alias("id"),
        name.alias("name"),
        url.alias("web_url"),
        F.lit(HOST).alias("host_name"),
        raw.alias("raw_json"),
        F.lit(DISCOVERED_AT).alias("discovered_at"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.lit(PROCESSED_AT)).alias("processed_at"),
    )


def drives(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey").withColumn(
        "flag", F.explode(F.array(*[F.lit(f) for f in LIBRARY_FLAGS]))
    )
    k, flag = F.col("s_suppkey"), F.col("flag")
    return s.select(
        F.concat(k.cast("string"), F.lit("-"), flag).alias("id"),
        k.cast("string").alias("site_id"),
        flag.alias("name"),
        F.when(flag == "R", F.lit("Business")).otherwise(F.lit("documentLibrary")).alias("drive_type"),
        F.concat(_site_url(k), F.lit("/"), flag).alias("web_url"),
        F.lit(None).cast("string").alias("raw_json"),
        F.lit(DISCOVERED_AT).alias("discovered_at"),
        F.when(flag == "N", F.lit(None).cast("string")).otherwise(F.lit(PROCESSED_AT)).alias("processed_at"),
    )


def _supplier_geo(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", "s_nationkey").join(
        t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey"
    )


def _folder_path(flag: Column, region: Column, nation: Column, supp: Column) -> Column:
    return F.concat_ws(
        "/", flag, F.concat(F.lit("R"), region.cast("string")),
        F.concat(F.lit("N"), nation.cast("string")), F.concat(F.lit("S"), supp.cast("string")),
    )


def file_items(t: Tables) -> DataFrame:
    """One file item per line item.  Built in two projections so derived
    columns reference computed ones instead of repeating their expressions."""
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_tax", "l_returnflag", "l_shipdate",
    )
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    # the joins that may shuffle the line items come first, the part's texts
    # after the orders; supplier and nation are joined one by one, as a join of
    # the two is estimated at the product of their sizes and then shuffled to
    j = li.join(orders, "l_orderkey").join(part, "l_partkey").join(supplier, "l_suppkey").join(nation, "s_nationkey")

    brand_no = F.substring_index(F.col("p_brand"), "#", -1).cast("int")
    ext, low = (F.element_at(F.array(*[F.lit(e) for e in each]), (brand_no % 8) + 1) for each in (BRAND_EXTENSIONS, LOWER_EXTENSIONS))
    modified = (
        F.when((F.col("l_linenumber") == 7) & (F.col("l_partkey") % 5 == 0), F.lit(None))
        .when(F.col("l_suppkey") % 5 == 0, F.col("l_shipdate") - F.expr("INTERVAL 1 YEAR"))
        .otherwise(F.col("l_shipdate"))
    )
    base = j.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"),
        F.col("l_suppkey").cast("string").alias("supp"),
        F.col("l_returnflag").alias("flag"),
        ext.alias("ext"),
        low.alias("low"),
        "p_name", "l_linenumber", "l_tax", "l_shipdate", "o_orderdate",
        _folder_path(F.col("l_returnflag"), F.col("n_regionkey"), F.col("s_nationkey"), F.col("l_suppkey")).alias("parent_path"),
        F.when(F.col("l_quantity") == 1, F.lit(0).cast("long"))
        .otherwise(F.floor(F.col("l_extendedprice")) * F.lit(1048576)).cast("long").alias("size_bytes"),
        modified.alias("modified"),
    )
    ext_c, low = F.col("ext"), F.col("low")
    name = F.when(ext_c == "", F.col("p_name")).otherwise(F.concat(F.col("p_name"), F.lit("."), ext_c))
    mime = (
        F.when(ext_c == "", F.lit(None).cast("string"))
        .when(low == "png", F.lit("image/png"))
        .when(low == "mp4", F.lit("video/mp4"))
        .otherwise(F.concat(F.lit("application/"), low))
    )
    accessed = (
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("l_linenumber") == 1, F.lit(""))
        .otherwise(iso_utc(F.col("l_shipdate")))
    )
    null = F.lit(None).cast("string")
    named = base.select("*", name.alias("name"))
    return named.select(
        "id",
        F.concat(F.col("supp"), F.lit("-"), F.col("flag")).alias("drive_id"),
        F.col("supp").alias("site_id"),
        F.col("flag").alias("library_name"),
        F.concat(F.lit("S"), F.col("supp")).alias("parent_id"),
        "parent_path",
        full_path(F.col("parent_path"), F.col("name")).alias("full_path"),
        "name",
        F.lit("file").alias("item_type"),
        F.when(low == "", null).otherwise(low).alias("extension"),
        mime.alias("mime_type"),
        "size_bytes",
        format_size(F.col("size_bytes")).alias("formatted_size"),
        iso_utc(F.col("o_orderdate")).alias("created_at"),
        iso_utc(F.col("modified")).alias("modified_at"),
        accessed.alias("last_accessed_at"),
        F.lit(0).cast("long").alias("file_count"),
        F.lit(0).cast("long").alias("folder_total_size_bytes"),
        null.alias("folder_total_size_formatted"),
        F.concat(F.lit("https://h.example/items/"), F.col("id")).alias("web_url"),
        null.alias("raw_json"),
        F.when(F.col("l_tax") == 0, F.lit("deleted")).otherwise(F.lit("ok")).alias("status"),
        F.lit(COLLECTED_AT).alias("collected_at"),
    )


def folder_items(t: Tables) -> DataFrame:
    """Per drive a folder chain root → R<region> → N<nation> → S<supplier>;
    nation folders with ``n_nationkey % 7 = 3`` are deleted."""
    d = _supplier_geo(t).withColumn("flag", F.explode(F.array(*[F.lit(f) for f in LIBRARY_FLAGS])))
    flag, supp = F.col("flag"), F.col("s_suppkey").cast("string")
    r = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))
    n = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    s = F.concat(F.lit("S"), supp)
    null = F.lit(None).cast("string")
    levels = F.array(
        F.struct(F.lit("T").alias("id"), null.alias("parent_id"), F.lit("").alias("parent_path"), flag.alias("name"), F.lit(False).alias("gone")),
        F.struct(r.alias("id"), F.lit("T").alias("parent_id"), flag.alias("parent_path"), r.alias("name"), F.lit(False).alias("gone")),
        F.struct(n.alias("id"), r.alias("parent_id"), F.concat_ws("/", flag, r).alias("parent_path"), n.alias("name"), (F.col("s_nationkey") % 7 == 3).alias("gone")),
        F.struct(s.alias("id"), n.alias("parent_id"), F.concat_ws("/", flag, r, n).alias("parent_path"), s.alias("name"), F.lit(False).alias("gone")),
    )
    x = d.select(flag.alias("flag"), supp.alias("site_id"), F.explode(levels).alias("f"))
    drive_id = F.concat(F.col("site_id"), F.lit("-"), F.col("flag"))
    return x.select(
        F.col("f.id").alias("id"),
        drive_id.alias("drive_id"),
        F.col("site_id"),
        F.col("flag").alias("library_name"),
        F.col("f.parent_id").alias("parent_id"),
        F.col("f.parent_path").alias("parent_path"),
        full_path(F.col("f.parent_path"), F.col("f.name")).alias("full_path"),
        F.col("f.name").alias("name"),
        F.lit("folder").alias("item_type"),
        null.alias("extension"),
        null.alias("mime_type"),
        F.lit(0).cast("long").alias("size_bytes"),
        F.lit("0 B").alias("formatted_size"),
        null.alias("created_at"),
        null.alias("modified_at"),
        null.alias("last_accessed_at"),
        F.lit(0).cast("long").alias("file_count"),
        F.lit(0).cast("long").alias("folder_total_size_bytes"),
        null.alias("folder_total_size_formatted"),
        null.alias("web_url"),
        null.alias("raw_json"),
        F.when(F.col("f.gone"), F.lit("deleted")).otherwise(F.lit("ok")).alias("status"),
        F.lit(COLLECTED_AT).alias("collected_at"),
    )


def items(t: Tables) -> DataFrame:
    return file_items(t).unionByName(folder_items(t))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    t = Tables(spark, sf_dir)
    return Catalog(sites=sites(t), drives=drives(t), items=items(t))


# --------------------------------------------------------------------------- usage report & site list

TIB = 1024**4
# Storage allocated per market segment (bytes, as report text).
SEGMENT_ALLOCATION = {"BUILDING": 0, "MACHINERY": 25 * TIB}
DEFAULT_ALLOCATION = TIB


def usage_report(t: Tables) -> DataFrame:
    """A usage report with the report's own header names; one row per
    customer, in customer-key order (``_report_row``)."""
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("last_order"),
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
    )
    c = t.customer.join(o, "c_custkey", "left")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    alloc = F.lit(DEFAULT_ALLOCATION).cast("long")
    for name, value in SEGMENT_ALLOCATION.items():
        alloc = F.when(seg == name, F.lit(value).cast("long")).otherwise(alloc)
    return c.select(
        F.lit(AS_OF).alias("Report Refresh Date"),
        k.cast("string").alias("Site Id"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(SITE_URL_PREFIX + "c"), k.cast("string"))).alias("Site URL"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.col("c_name")).alias("Owner Display Name"),
        F.lower(F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.lit("@" + HOST))).alias("Owner Principal Name"),
        F.when(k % 13 == 0, F.lit("True")).otherwise(F.lit("False")).alias("Is Deleted"),
        F.when(k % 19 == 0, F.lit("")).otherwise(F.date_format("last_order", "yyyy-MM-dd")).alias("Last Activity Date"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("string").alias("File Count"),
        F.coalesce(F.col("n_open"), F.lit(0)).cast("string").alias("Active File Count"),
        (F.greatest(F.floor(F.col("c_acctbal")), F.lit(0)) * F.lit(268435456)).cast("string").alias("Storage Used (Byte)"),
        alloc.cast("string").alias("Storage Allocated (Byte)"),
        seg.alias("Root Web Template"),
        F.lit("180").alias("Report Period"),
        k.alias("_report_row"),
    )


def site_list(t: Tables) -> DataFrame:
    """The tenant's site list: composite ids ``host,sc<k>,<k>``, alternate ids
    and a catalogue URL.  Every third customer is listed under keys ``x<k>``
    that no report or request names."""
    key = F.col("c_custkey")
    k = F.concat(F.when(key % 3 == 0, F.lit("x")).otherwise(F.lit("")), key.cast("string"))
    return t.customer.select(
        F.concat(F.lit(HOST + ",sc"), k, F.lit(","), k).alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit(SITE_URL_PREFIX + "cat-"), k).alias("web_url"),
        F.concat(F.lit("sid-"), k).alias("alt_site_id"),
        F.concat(F.lit("col-"), F.col("c_nationkey").cast("string")).alias("alt_collection_id"),
    )


# --------------------------------------------------------------------------- change feed & errors

def change_records(t: Tables) -> DataFrame:
    """Change records from events: drive = user, item = props.k, 100 events
    per page, error events are tombstones."""
    e = t.events
    k = F.get_json_object(F.col("props"), "$.k")
    size = F.floor(F.col("value") * 100).cast("long")
    return e.select(
        k.alias("id"),
        F.col("user_id").cast("string").alias("drive_id"),
        (F.col("user_id") % 20).cast("string").alias("site_id"),
        F.concat(F.lit("item-"), k).alias("name"),
        F.lit("file").alias("item_type"),
        size.alias("size_bytes"),
        iso_utc(F.col("ts")).alias("modified_at"),
        iso_utc(F.col("ts")).alias("collected_at"),
        F.floor(F.col("event_id") / 100).cast("long").alias("page_seq"),
        F.col("event_id").cast("long").alias("row_idx"),
        (F.col("event_type") == "error").alias("is_tombstone"),
    ).withColumn("formatted_size", format_size("size_bytes"))


def page_log(t: Tables) -> DataFrame:
    """One row per (drive, page): the drive's last page carries the delta
    link unless ``user_id % 10 = 0`` (an interrupted sync)."""
    pages = t.events.groupBy(
        F.col("user_id").alias("u"), F.floor(F.col("event_id") / 100).cast("long").alias("page_seq")
    ).agg(F.max("ts").alias("ts"))
    last = pages.groupBy("u").agg(F.max("page_seq").alias("last_page"))
    j = pages.join(last, "u")
    drive = F.col("u").cast("string")
    is_last = F.col("page_seq") == F.col("last_page")
    finished = is_last & (F.col("u") % 10 != 0)
    return j.select(
        drive.alias("drive_id"),
        (F.col("u") % 20).cast("string").alias("site_id"),
        F.concat(F.lit("lib-"), drive).alias("library_name"),
        "page_seq",
        iso_utc(F.col("ts")).alias("collected_at"),
        F.when(finished, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("next:"), drive, F.lit(":"), (F.col("page_seq") + 1).cast("string"))
        ).alias("next_link"),
        F.when(finished, F.concat(F.lit("delta:"), drive, F.lit(":"), F.col("page_seq").cast("string"))).alias("delta_link"),
    )


def landed_pages(t: Tables) -> DataFrame:
    """The change pages as a collector lands them: the events of a drive with
    the same hundreds of event ids are one page of items, as JSON text in
    event order; the page's links are those of ``page_log``."""
    e, n = t.events, F.col("event_id")
    k = F.get_json_object(F.col("props"), "$.k")
    ext = F.element_at(F.array(*[F.lit(x) for x in (".PDF", ".docx", "", ".tar.gz")]), (n % 4 + 1).cast("int"))
    path = (
        F.when(n % 4 == 1, F.lit("/drives/d"))
        .when(n % 4 == 2, F.lit("/drive/root:"))
        .when(n % 4 == 3, F.concat(F.lit("/drive/root:/dir-"), k, F.lit("/sub/")))
    )
    some = lambda c, *fields: F.when(c, F.struct(*fields))
    item = F.struct(
        k.alias("id"),
        F.when(n % 11 != 0, F.concat(F.lit("item-"), k, ext)).alias("name"),
        F.when(n % 13 != 0, F.floor(F.col("value") * 100).cast("long")).alias("size"),
        some(n % 10 == 0, F.lit(1).alias("childCount")).alias("folder"),
        some(n % 10 == 1, F.lit("oneNote").alias("type")).alias("package"),
        some(n % 50 == 7, F.lit(True).alias("isRoot")).alias("root"),
        some(F.col("event_type") == "error", F.lit("deleted").alias("state")).alias("deleted"),
        some(n % 3 != 0, F.lit("application/x").alias("mimeType")).alias("file"),
        F.struct((n % 17).cast("string").alias("id"), path.alias("path")).alias("parentReference"),
        iso_utc(F.col("ts")).alias("lastModifiedDateTime"),
        F.concat(F.lit("https://h.example/"), n.cast("string")).alias("webUrl"),
    )
    values = e.groupBy(F.col("user_id").cast("string").alias("drive_id"), F.floor(n / 100).cast("long").alias("page_seq")).agg(
        F.sort_array(F.collect_list(F.struct(n.alias("n"), F.to_json(item).alias("json")))).alias("rows")  # 100 at most
    )
    return page_log(t).join(values, ["drive_id", "page_seq"]).select(
        "drive_id", "site_id", "library_name", "page_seq", "collected_at",
        F.struct(F.col("rows.json").alias("value"), F.col("next_link").alias("@odata.nextLink"), F.col("delta_link").alias("@odata.deltaLink")).alias("page"),
    )


def drive_events(t: Tables) -> DataFrame:
    """Errors and claims of the drives, placed after the page of the same
    hundreds of event ids: every error event is a failed request, and every
    31st other event a worker's claim."""
    from tessera.operators.events import CLAIM, conform, error_events

    after = F.floor(F.col("id") / 100).cast("long")
    failed = error_events(errors(t).withColumn("after_seq", after))
    e = t.events.filter("event_type <> 'error' and event_id % 31 = 0")
    claims = e.select(
        F.col("user_id").cast("string").alias("drive_id"), (F.col("user_id") % 20).cast("string").alias("site_id"),
        F.floor(F.col("event_id") / 100).cast("long").alias("seq"), F.col("event_id").alias("no"), F.lit(CLAIM).alias("kind"),
        (F.col("event_id") % 7 + 1).cast("int").alias("attempt"), iso_utc(F.col("ts")).alias("at"),
    )
    return failed.unionByName(conform(claims))


def errors(t: Tables) -> DataFrame:
    """Error rows from error events: status code by event id modulo 7,
    site = user_id % 20; drive sync errors."""
    from tessera.operators.sync import drive_error_retryable

    e = t.events.filter(F.col("event_type") == "error")
    code = F.element_at(F.array(*[F.lit(c) for c in ERROR_CODES]), (F.col("event_id") % 7 + 1).cast("int"))
    return e.select(
        F.col("event_id").alias("id"),
        F.lit("drive").alias("entity_type"),
        F.col("user_id").cast("string").alias("entity_id"),
        F.col("user_id").cast("string").alias("drive_id"),
        (F.col("user_id") % 20).cast("string").alias("site_id"),
        F.lit("drive_delta").alias("operation"),
        code.cast("int").alias("status_code"),
        F.concat(F.lit("error "), F.col("event_id").cast("string")).alias("message"),
        drive_error_retryable(code).alias("retryable"),
        F.lit(False).alias("resolved"),
        iso_utc(F.col("ts")).alias("created_at"),
        iso_utc(F.col("ts")).alias("updated_at"),
    )


# --------------------------------------------------------------------------- audit & storage metrics

def expected_usage(t: Tables) -> DataFrame:
    """Expected sites as a ranked usage list would give them: the collected
    site URL, upper-cased with a trailing '/' for ``s_suppkey % 3 = 1``,
    unknown for ``s_suppkey % 10 = 0``; bytes from the account balance."""
    k = F.col("s_suppkey")
    url = _site_url(k)
    shown = (
        F.when(k % 10 == 0, F.concat(F.lit(SITE_URL_PREFIX + "missing-"), k.cast("string")))
        .when(k % 3 == 1, F.concat(F.upper(url), F.lit("/")))
        .otherwise(url)
    )
    used = (F.greatest(F.floor(F.col("s_acctbal")), F.lit(0)) * F.lit(4294967296)).cast("string")
    return t.supplier.select(
        k.cast("string").alias("site_id"), shown.alias("site_url"), F.col("s_name").alias("owner"),
        used.alias("storage_used_bytes"),
    )


def storage_metric_results(t: Tables) -> DataFrame:
    """Collector results per supplier site: used MB from the file bytes,
    version bytes of the 'R' library, one version per line item; every
    ninth site failed (no numbers)."""
    li = t.lineitem.select("l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice")
    size = F.when(F.col("l_quantity") == 1, F.lit(0).cast("long")).otherwise(F.floor(F.col("l_extendedprice")) * F.lit(1048576))
    per = li.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.sum(size).alias("used"),
        F.count(F.lit(1)).alias("versions"),
        F.sum(F.when(F.col("l_returnflag") == "R", size).otherwise(F.lit(0))).alias("version_bytes"),
    )
    s = t.supplier.select("s_suppkey").join(per, "s_suppkey", "left")
    k = F.col("s_suppkey")
    failed = k % 9 == 0
    null = F.lit(None).cast("string")
    return s.select(
        k.cast("string").alias("site_id"),
        _site_url(k).alias("site_url"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
        F.when(failed, F.lit(None).cast("double")).otherwise(F.col("used") / F.lit(1048576.0)).alias("storage_used_mb"),
        F.when(failed, null).otherwise(F.col("versions").cast("string")).alias("version_count"),
        F.when(failed, null).otherwise(F.col("version_bytes").cast("string")).alias("version_size_bytes"),
        F.when(failed, F.lit("Access denied")).otherwise(null).alias("message"),
    )


def sync_drives(t: Tables) -> DataFrame:
    """Drives known to the catalogue for the sync tests: every event user,
    plus a never-synced twin (``1000000 + user_id``) for every seventh user."""
    users = t.events.select(F.col("user_id")).distinct()
    twins = users.filter(F.col("user_id") % 7 == 0).select((F.col("user_id") + 1000000).alias("user_id"))
    d = users.unionByName(twins)
    return d.select(
        F.col("user_id").cast("string").alias("id"),
        (F.col("user_id") % 20).cast("string").alias("site_id"),
        F.concat(F.lit("lib-"), F.col("user_id").cast("string")).alias("name"),
    )


def next_run_errors(t: Tables) -> DataFrame:
    """The error rows as a later sync run would record them (one year after
    the events), so they are newer than every landed page."""
    e = errors(t)
    later = iso_utc(F.col("ts") + F.expr("INTERVAL 1 YEAR"))
    ts = t.events.filter(F.col("event_type") == "error").select(F.col("event_id").alias("id"), "ts")
    return e.join(ts, "id").withColumn("created_at", later).withColumn("updated_at", later).drop("ts")
