"""Readers, sinks and the end-to-end jobs on the smallest test data."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tessera.plans import catalog as cg
from tessera.plans import pipelines as pl
from tessera.plans import sites as st
from tessera.plans.suite import catalog
from tessera.sources import files as fs
from tessera.sources import testdata as td
from tessera.sources.change_pages import drive_records, site_records, user_drive_sites

SF = "/root/testdata/sf0.001"


def tmpdir():
    return tempfile.mkdtemp(prefix="tessera-io-")


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_id_list_and_combination(spark):
    p = write(os.path.join(tmpdir(), "ids.txt"), "﻿ a \n\n# note\nb\na\n  c  \n")
    ids = fs.read_id_list(spark, p)
    assert [r.id for r in ids.orderBy("pos").collect()] == ["a", "b", "a", "c"]
    assert [r.id for r in fs.distinct_ids(ids).orderBy("pos").collect()] == ["a", "b", "c"]
    other = spark.createDataFrame([("c",), ("z",)], "id string")
    assert [r.id for r in st.combine_id_lists(ids, other).collect()] == ["a", "b", "c", "z"]


def test_storage_metric_results_list_or_object(spark):
    d = tmpdir()
    a = write(os.path.join(d, "list.json"), '﻿[{"site_id":"1","storage_used_mb":1.5,"version_count":"3","status":"ok"},{"site_id":"2","status":"failed","message":"x"}]')
    b = write(os.path.join(d, "one.json"), '{"site_id":"3","storage_used_mb":"2","version_size_bytes":10,"status":"ok"}')
    la = fs.read_storage_metric_results(spark, a)
    lb = fs.read_storage_metric_results(spark, b)
    assert sorted(r.site_id for r in la.collect()) == ["1", "2"] and lb.first().site_id == "3"
    out = pl.storage_metrics(spark, a, os.path.join(d, "metrics"), "2001-12-01T00:00:00Z")
    assert out == {"ok": 1, "failed": 1, "total": 2}
    pl.storage_metrics(spark, b, os.path.join(d, "metrics"), "2001-12-02T00:00:00Z")
    got = {r.site_id: r for r in spark.read.parquet(os.path.join(d, "metrics")).collect()}
    assert set(got) == {"1", "2", "3"} and got["1"].storage_used_bytes == 1572864 and got["3"].version_size_bytes == 10


def test_site_and_drive_records(spark):
    sites = spark.createDataFrame(
        [('{"id":"s1","displayName":"","name":"N","webUrl":"u","siteCollection":{"hostName":"H"}}',), ('{"id":"s2"}',)], "json string"
    )
    got = {r.id: r for r in site_records(sites).collect()}
    assert (got["s1"].name, got["s1"].host_name) == ("N", "H") and (got["s2"].name, got["s2"].web_url) == ("s2", "")
    drives = spark.createDataFrame([("s1", '{"id":"d1","driveType":"documentLibrary"}')], "site_id string, json string")
    assert drive_records(drives).first().name == "d1"
    users = spark.createDataFrame([("u1", None, "a@x")], "id string, displayName string, userPrincipalName string")
    r = user_drive_sites(users).first()
    assert (r.id, r.name, r.host_name) == ("user:u1", "a@x", "OneDrive for Business")


def test_export_lakehouse_report_and_audit(spark):
    d = tmpdir()
    cat = catalog(spark, SF)
    res = pl.export(spark, cat.sites, cat.drives, cat.items, os.path.join(d, "exports"), os.path.join(d, "data"), td.AS_OF,
                    rows_per_file=10, recalculate_folders=True)
    inv_path = res["dataset_dir"]
    inv = spark.read.parquet(inv_path)
    assert res["inventory_rows"] == inv.count() and res["part_files"] >= 1
    assert res["rows_per_file"] == 10_000  # raised to the fetch batch
    total = inv.filter("tipo_item = 'file'").agg(F.sum("tamanho_bytes")).first()[0]
    assert res["file_total_bytes"] == total
    assert set(res["lakehouse"]) == {"bronze", "silver", "gold"}
    assert res["lakehouse"]["gold"]["storage_kpis"]["rows"] > 0
    assert "raw_displayName" in spark.read.parquet(os.path.join(d, "data", "bronze", "sites.parquet")).columns
    out = pl.client_report(spark, inv_path, os.path.join(d, "client"), td.AS_OF)
    sites_csv = spark.read.option("header", True).option("sep", ";").csv(out["01_resumo_por_site"])
    assert "Armazenamento GB" in sites_csv.columns and sites_csv.count() > 0
    prio = os.path.join(d, "prio.csv")
    td.expected_usage(td.Tables(spark, SF)).coalesce(1).write.option("header", True).csv(prio)
    summary = pl.audit(spark, cat.sites, cat.drives, cat.items, prio, os.path.join(d, "audit"))
    assert summary["expected_sites"] == summary["missing_sites"] + summary["under_collected_sites"] + summary["ok_sites"]


def test_prioritize_job_outputs(spark):
    d = tmpdir()
    t = td.Tables(spark, SF)
    report_path = os.path.join(d, "report_csv")
    td.usage_report(t).drop("_report_row").coalesce(1).write.option("header", True).csv(report_path)
    out = pl.prioritize_sites(spark, report_path, os.path.join(d, "out"), td.site_list(t))
    assert out["sites"] == out["sites_with_url"] + out["sites_without_url"]
    assert out["raw_report_rows"] >= out["sites"] and "Site Id" in out["raw_report_headers"]
    back = fs.read_site_priority(spark, out["outputs"]["site_priority_csv"])
    assert back.count() == out["sites"] and "storage_used_gb" in back.columns
    tiers = spark.read.json(out["outputs"]["json_by_tier"])
    assert tiers.count() == out["sites"]


def test_workspaces_and_latest_run(spark):
    d = tmpdir()
    for tenant in ("t1", "t2"):
        spark.createDataFrame([(tenant, 1)], "site_name string, n int").write.parquet(os.path.join(d, tenant))
    ws = fs.read_workspaces(spark, {"t1": os.path.join(d, "t1"), "t2": os.path.join(d, "t2")})
    assert sorted(r.tenant for r in ws.collect()) == ["t1", "t2"]
    runs = spark.createDataFrame([("t1", "2001", "a"), ("t1", "2002", "b")], "tenant string, run_ts string, path string")
    assert fs.latest_runs(runs).first().path == "b"


def test_run_log_and_views(spark):
    d = tmpdir()
    run = cg.run_record(spark, 1, "export", "s", "f", {"open_errors": 0, "delta": {"failed": 1}})
    assert run.first().status == "completed_with_errors"
    cg.append_run(run, os.path.join(d, "runs"))
    assert json.loads(spark.read.parquet(os.path.join(d, "runs")).first().stats_json)["delta"]["failed"] == 1
    inv = spark.createDataFrame([("a",)], "site_name string")
    assert st.register_inventory_view(inv).count() == 1
    sites = spark.createDataFrame([("1", "u", "b"), ("2", "", "a"), ("3", None, "c")], "id string, web_url string, name string")
    assert [r.id for r in st.sites_with_url(sites).collect()] == ["1"]


def test_upsert_keeps_discovered_at(spark):
    from tessera.operators.joins import upsert_by_key

    old = spark.createDataFrame([("1", "a", "t0"), ("2", "b", "t0")], "id string, name string, discovered_at string")
    new = spark.createDataFrame([("1", "A", "t1"), ("3", "c", "t1")], "id string, name string, discovered_at string")
    got = {r.id: (r.name, r.discovered_at) for r in upsert_by_key(old, new, "id", ["discovered_at"]).collect()}
    assert got == {"1": ("A", "t0"), "2": ("b", "t0"), "3": ("c", "t1")}


def test_bom_csv_round_trip(spark):
    import glob

    from tessera.sinks.reports import write_csv

    d = tmpdir()
    df = spark.createDataFrame([(1, "a")], "rank long, site_id string")
    write_csv(df.coalesce(1), os.path.join(d, "out"), sep=",", bom=True)
    part = glob.glob(os.path.join(d, "out", "part-*"))[0]
    with open(part, "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    back = fs.read_site_priority(spark, os.path.join(d, "out"))
    assert back.columns[:2] == ["rank", "site_id"] and back.first().rank == 1


def test_stats_variants(spark):
    from tessera.operators.sync import sync_from_pages

    t = td.Tables(spark, SF)
    cat = catalog(spark, SF)
    errs = td.errors(t)
    sync = sync_from_pages(td.page_log(t))
    full = cg.catalog_stats(cat.sites, cat.drives, cat.items, errs, sync).first()
    cheap = cg.catalog_stats(cat.sites, cat.drives, cat.items, errs, sync, include_inventory_totals=False).first()
    assert (cheap.files, cheap.folders, cheap.total_bytes, cheap.total_formatted) == (0, 0, 0, "0 B")
    assert (cheap.sites, cheap.open_errors, cheap.blocked_sites) == (full.sites, full.open_errors, full.blocked_sites)
    summary = pl.summary(cat.sites, cat.drives, cat.items, errs)
    blocked = errs.filter("status_code = 423").count()
    assert summary["open_errors"] == full.open_errors + blocked  # the export summary counts 423 as open
    assert summary["files"] == full.files and summary["total_formatted"] == full.total_formatted


def test_lakehouse_layers_alone(spark):
    import pytest

    from tessera.plans import lakehouse as lh
    from tessera.sinks.parquet import read_layer

    d = tmpdir()
    cat = catalog(spark, SF)
    with pytest.raises(ValueError):
        lh.build_lakehouse(spark, cat, d, td.AS_OF, "platinum")
    assert read_layer(spark, os.path.join(d, "silver", "files.parquet")).count() == 0  # missing → empty
    lh.build_lakehouse(spark, cat, d, td.AS_OF, "bronze")
    lh.build_lakehouse(spark, cat, d, td.AS_OF, "silver")
    gold = lh.build_lakehouse(spark, cat, d, td.AS_OF, "gold")["gold"]
    assert set(gold) == set(lh.GOLD_TABLES)
    kpis = spark.read.parquet(gold["storage_kpis"]["file"])
    assert kpis.count() == gold["storage_kpis"]["rows"] > 0


def test_quoted_csv_round_trip(spark, tmp_path):
    from tessera.sinks.reports import write_csv
    from tessera.sources.files import read_quoted_csv

    rows = [('Ann "A", Ltd', "two\nlines", "  blanks  "), ("back\\slash", None, 'say ""'), ("ç;é", "a,b", "x")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for sep in (",",):
        write_csv(df, str(tmp_path / "out.csv"), sep=sep, bom=True)
        got = read_quoted_csv(spark, str(tmp_path / "out.csv"))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_usage_report_with_quotes_and_line_breaks(spark, tmp_path):
    from tessera.plans import priority as pr

    path = tmp_path / "report.csv"
    path.write_text('\ufeffSite Id,Site URL,Owner Display Name,Storage Used (Byte)\n1,u1,"Ann ""A"", Ltd",70\n2,u2,"two\nlines",90\n', encoding="utf-8")
    rows = pr.parse_usage_report(pr.read_usage_report(spark, str(path))).collect()
    assert [(r.site_id, r.owner, r.storage_used_bytes) for r in rows] == [("1", 'Ann "A", Ltd', 70), ("2", "two\nlines", 90)]


def test_metric_upsert_keeps_one_row_a_site(spark, tmp_path):
    import json

    from tessera.plans import pipelines as pl

    def results(name, *rows):
        (tmp_path / name).write_text(json.dumps([{"site_id": s, "site_url": "u", "status": "ok", "storage_used_mb": mb} for s, mb in rows]))
        return str(tmp_path / name)

    store = str(tmp_path / "store")
    pl.storage_metrics(spark, results("a.json", ("1", "1"), ("1", "2"), ("2", "5")), store, "t1")
    pl.storage_metrics(spark, results("b.json", ("2", "7")), store, "t2")
    table, generation = pl.read_storage_metrics(spark, store)
    assert generation == 1
    assert sorted((r.site_id, r.storage_used_bytes >> 20, r.collected_at) for r in table.collect()) == [("1", 2, "t1"), ("2", 7, "t2")]


def test_missing_layers_build_typed_empty_tables(spark, tmp_path):
    from tessera.plans import lakehouse as lh

    base = str(tmp_path / "lake")
    out = lh.build_lakehouse(spark, None, base, "2001-12-01", "silver")
    assert {n: x["rows"] for n, x in out["silver"].items()} == dict.fromkeys(lh.SILVER_TABLES, 0)
    out = lh.build_lakehouse(spark, None, str(tmp_path / "lake2"), "2001-12-01", "gold")
    assert {n: x["rows"] for n, x in out["gold"].items()} == dict.fromkeys(lh.GOLD_TABLES, 0)
    assert spark.read.parquet(out["gold"]["storage_kpis"]["file"]).columns
