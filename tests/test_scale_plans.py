"""Plans and settings that keep the larger queries inside their limits."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.plans import priority as pr

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_projections_are_not_run_interpreted(spark):
    """A session that was built elsewhere gets the limit above which HotSpot
    leaves a generated method interpreted."""
    key, was = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set(key, "65535")
    try:
        entry.queries()["bronze_drives"](spark, SF)
        assert spark.conf.get(key) == "8000"
    finally:
        spark.conf.set(key, was)


def test_site_keys_are_sorted_in_dealt_pieces(spark):
    """The keys of a site list that is read as one split are not sorted whole
    in one task: an exchange of the sites lies below the partial aggregate."""
    sites = spark.range(0, 300, 1, 1).select(
        F.concat(F.lit("h,"), F.col("id").cast("string"), F.lit(",x")).alias("id"), F.lit("n").alias("name"), F.lit("u").alias("web_url"),
        F.lit("a").alias("alt_site_id"), F.lit("c").alias("alt_collection_id"),
    )
    for lookup in (pr.site_variant_lookup(sites), pr.site_url_lookup(sites)):
        text = plan_text(lookup)
        assert text.count("Exchange") == 2 and text.rindex("Exchange") > text.rindex("Generate"), text
    assert pr.site_variant_lookup(sites).count() == 300 * 2 + 2 and pr.site_url_lookup(sites).count() == 300 + 3


def test_files_of_a_folder_meet_it_once(spark, monkeypatch):
    """The search for stale drives joins a row a folder, not a row a file."""
    from tessera.operators import paths

    folder = [("d", "T", None, "", "L", "L", "folder", "ok"), ("d", "A", "T", "L", "A", "L/A", "folder", "ok")]
    files = [("d", f"f{k}", "A", "L/A", f"n{k}", f"L/A/n{k}", "file", "ok") for k in range(50)]
    bad = [("e", "T", None, "", "L", "L", "folder", "ok"), ("e", "f", "T", "L", "n", "L/old", "file", "ok"), ("e", "g", "T", None, "m", None, "file", "ok")]
    items = spark.createDataFrame(
        folder + files + bad, "drive_id string, id string, parent_id string, parent_path string, name string, full_path string, item_type string, status string"
    )
    seen, staged = {}, paths._staged
    monkeypatch.setattr(paths, "_staged", lambda df, name: seen.setdefault(name, df) and staged(df, name))
    got = {(r.drive_id, r.id): (r.parent_path, r.full_path) for r in paths.rebuild_paths(items).collect()}
    assert got["e", "f"] == ("L", "L/n") and got["e", "g"] == ("L", "L/m") and got["d", "f7"] == ("L/A", "L/A/n7")
    text = seen["stale-drives"]._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join Inner")
    assert "Aggregate [drive_id" in text[join:], text
    assert [r.drive_id for r in seen["stale-drives"].collect()] == ["e"]


def test_file_list_sorts_written_rows(spark):
    """The sort's sample reads the joined rows again; they are not joined again."""
    assert "Join" not in plan_text(entry.queries()["client_file_list"](spark, SF))


def test_rollup_stages_only_what_it_reads(spark, monkeypatch):
    from tessera.plans import io_suite

    seen, staged = {}, io_suite._staged
    monkeypatch.setattr(io_suite, "_staged", lambda df, name: seen.setdefault(name, df) and staged(df, name))
    io_suite.rollup_updated(spark, SF)
    assert {"formatted_size", "created_at", "web_url"}.isdisjoint(seen["items"].columns)


def test_differing_rows_are_those_of_except_all(spark):
    from tessera.plans import io_suite

    given = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "x"), ("b", ""), ("c", "y")], "c0 string, c1 string")
    back = spark.createDataFrame([("a", "x"), ("b", ""), ("d", "z"), ("d", "z")], "c0 string, c1 string")
    got = io_suite._differing(given, back).first()
    assert (got.n_rows, got.differing) == (4, given.exceptAll(back).count()) == (4, 3)
    none = given.limit(0)
    assert io_suite._differing(none, none).first().asDict() == {"n_rows": 0, "differing": 0}
    text = plan_text(io_suite._differing(given, back))
    assert "Generate" not in text


def test_extensions_are_looked_up_in_lower_case(spark):
    """No ``lower`` a row when the items are made; the same text as ``lower``."""
    from types import SimpleNamespace

    from tessera.sources import testdata as td

    brands = [(k, f"p{k}", f"Brand#{k}") for k in range(8)] + [(8, "p8", None)]
    t = SimpleNamespace(
        part=spark.createDataFrame(brands, "p_partkey long, p_name string, p_brand string"),
        orders=spark.sql("select 1L o_orderkey, timestamp'1995-01-01' o_orderdate"),
        supplier=spark.sql("select 1L s_suppkey, 0 s_nationkey"),
        nation=spark.sql("select 0 n_nationkey, 0 n_regionkey"),
        lineitem=spark.range(9).selectExpr(
            "1L l_orderkey", "id l_partkey", "1L l_suppkey", "2 l_linenumber", "3D l_quantity", "7D l_extendedprice", "0.1D l_tax", "'A' l_returnflag", "timestamp'1996-01-01' l_shipdate"
        ),
    )
    items = td.file_items(t)
    assert "lower(" not in items._jdf.queryExecution().optimizedPlan().toString()
    got = {r.name: (r.extension, r.mime_type) for r in items.collect()}
    assert got["p1.PDF"] == ("pdf", "application/pdf") and got["p0.docx"] == ("docx", "application/docx") and got["p2.png"] == ("png", "image/png")
    assert got["p3.mp4"] == ("mp4", "video/mp4") and got["p7"] == (None, None) and len(got) == 9, sorted(got.items(), key=str)


def test_small_export_parts_share_tasks(spark, monkeypatch):
    """Tasks follow the rows, not the parts, and hold whole parts in order."""
    from tessera.sinks import parquet as sink

    df = spark.range(1003).select((F.col("id") * 7919 % 1003).alias("k")).repartition(5)
    assert sink.in_ordered_parts(df, [F.col("k")], 10).rdd.getNumPartitions() == 1
    monkeypatch.setattr(sink, "ROWS_A_TASK", 250)
    dealt = sink.in_ordered_parts(df, [F.col("k")], 100).rdd.map(lambda r: r.k).glom().collect()
    assert dealt == [list(range(at, min(at + 200, 1003))) for at in range(0, 1003, 200)]
    monkeypatch.setattr(sink, "PARTS_A_TASK", 3)
    dealt = sink.in_ordered_parts(df, [F.col("k")], 10).rdd.map(lambda r: r.k).glom().collect()
    assert dealt == [list(range(at, min(at + 30, 1003))) for at in range(0, 1003, 30)]


def test_profile_of_folders_writes_no_items(spark, monkeypatch):
    from tessera.plans import suite

    monkeypatch.setattr(suite, "_written", lambda df, name: (_ for _ in ()).throw(AssertionError(name)))
    df = entry.queries()["profile_folders"](spark, SF)
    assert "lineitem" not in df._jdf.queryExecution().optimizedPlan().toString() and df.count() > 0


def test_equal_tables_are_compared_without_their_rows(spark, monkeypatch):
    """Rows are summed up in buckets; only those of unequal buckets are compared
    whole, and nulls, empty text and their places are told apart."""
    from tessera.plans import io_suite

    seen, staged = {}, io_suite._staged
    monkeypatch.setattr(io_suite, "_staged", lambda df, name: seen.setdefault(name, staged(df, name)))
    given = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "y"), ("", "y"), ("y", None)], "c0 string, c1 string")
    assert io_suite._differing(given, given.repartition(3)).first().asDict() == {"n_rows": 5, "differing": 0}
    signs = [c for c in seen["row-sums"].columns if c not in ("_bucket", "_b")]
    assert len(signs) == 5 and seen["row-sums"].filter(" or ".join(f"{c} <> 0" for c in signs)).count() == 0
    seen.clear()
    back = spark.createDataFrame([("a", "x"), ("y", None), ("y", None), (None, "y"), ("", "z")], "c0 string, c1 string")
    got = io_suite._differing(given, back).first()
    assert (got.n_rows, got.differing) == (5, given.exceptAll(back).count()) == (5, 2)


def test_report_files_are_packed_and_leave_no_shuffle_files(spark, tmp_path):
    import glob
    import os
    import tempfile
    import time

    from tessera.sinks.reports import write_client_report

    base = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())
    files = lambda: set(glob.glob(f"{base}/**/blockmgr-*/*/shuffle_*.data", recursive=True))
    df = spark.range(2000).select(F.concat(F.lit("n;\"x\n"), F.col("id").cast("string")).alias("a"), "id").orderBy(F.desc("id"))
    before = files()
    path = write_client_report({"t": df}, str(tmp_path), "gzip")["t"]
    for _ in range(50):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")
    back = spark.read.option("header", True).option("sep", ";").option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    assert back.exceptAll(df.select("a", F.col("id").cast("string"))).count() == 0 and back.count() == 2000
    assert glob.glob(write_client_report({"p": df}, str(tmp_path))["p"] + "/*.csv")


def test_line_items_are_not_shuffled_to_supplier_and_nation(spark):
    """A join of two small tables is estimated at the product of their sizes;
    one by one they are small."""
    from tessera.sources import testdata as td

    key, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "4000")
    try:
        text = plan_text(td.file_items(td.Tables(spark, SF)))
    finally:
        spark.conf.set(key, was)
    assert "BroadcastHashJoin [l_suppkey" in text and "BroadcastHashJoin [s_nationkey" in text, text
    assert "SortMergeJoin [l_orderkey" in text and "SortMergeJoin [l_suppkey" not in text, text


def test_lookups_are_held_up_to_a_number_of_rows(spark, monkeypatch):
    from tessera.operators import held, joins

    one = spark.range(10)
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(held(one))
    monkeypatch.setattr(joins, "HELD_ROWS", 9)
    assert not hinted(held(one))


def test_export_parts_shuffle_rows_once(spark, monkeypatch):
    """The parts are cut at exact places, though a key repeats and is null,
    without a checkpoint and with one shuffle of the rows."""
    from pyspark.sql import DataFrame

    from tessera.operators import ranking
    from tessera.sinks import parquet as sink

    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a: (_ for _ in ()).throw(AssertionError("checkpoint")))
    monkeypatch.setattr(sink, "ROWS_A_TASK", 70)
    k = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(500).select(k.alias("k"), "id").repartition(4)
    for sampled in (4, 0.01):  # stretches of a few rows, and one of all
        monkeypatch.setattr(ranking, "SAMPLE_A_CUT", sampled)
        dealt = sink.in_ordered_parts(df, [F.col("k")], 70)
        assert plan_text(dealt).count("Exchange") == 1, plan_text(dealt)
        parts = dealt.rdd.glom().collect()
        assert [len(p) for p in parts] == [70] * 7 + [10]
        got = [r.k for p in parts for r in p]
        assert got == sorted(got, key=lambda x: (x is not None, x or "")) and sorted(r.id for p in parts for r in p) == list(range(500))


def test_cut_keys_are_those_of_a_sort(spark):
    from tessera.operators.ranking import cut_keys

    keys = spark.range(1000).select(F.struct((F.col("id") * 7919 % 1000).alias("a"), F.lit(1).alias("b")).alias("key"))
    for every in (1000, 999, 300, 250, 7):
        bounds, n = cut_keys(keys, 1000, every)
        assert [r.a for r in bounds.first()["keys"]] == list(range(every, 1000, every)) and n == len(range(every, 1000, every))
