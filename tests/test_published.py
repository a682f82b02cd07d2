"""Published tables and workspaces."""

import os
import tempfile

import pytest

from tessera.sinks.published import ConflictError, PublishedTable
from tessera.sources import workspaces as ws

SCHEMA = "id string, name string, discovered_at string"


def table(spark, path, rows=(), buckets=8):
    t = PublishedTable(spark, path, spark.createDataFrame([], SCHEMA).schema, ["id"], buckets)
    if rows:
        t.overwrite(spark.createDataFrame(list(rows), SCHEMA))
    return t


def content(t, version=None):
    return sorted(map(tuple, t.read(version).collect()))


ROWS = [(f"k{k}", f"n{k}", "d0") for k in range(60)]


def test_merge_writes_touched_buckets_only(spark):
    path = tempfile.mkdtemp(prefix="tessera-table-")
    t = table(spark, path)
    assert t.version() == 0 and content(t) == []
    t = table(spark, path, ROWS)
    before = t.manifest()
    files = set(t.read().inputFiles())
    t.merge(spark.createDataFrame([("k3", "new", "d1"), ("k99", "n99", "d1")], SCHEMA), keep_old=["discovered_at"])
    want = sorted([r for r in ROWS if r[0] != "k3"] + [("k3", "new", "d0"), ("k99", "n99", "d1")])
    assert content(t) == want and content(t, 1) == sorted(ROWS) and t.version() == 2
    same = {k for k, gen in t.manifest().items() if before.get(k) == gen}
    assert len(t.manifest()) - len(same) <= 2 and len(same) >= 5
    assert len(files & set(t.read().inputFiles())) == len(same)
    assert t.merge(spark.createDataFrame([], SCHEMA)) == 2  # nothing to do, nothing published


def test_a_failed_write_leaves_the_table(spark):
    path = tempfile.mkdtemp(prefix="tessera-table-")
    t = table(spark, path, ROWS)
    bad = spark.createDataFrame([("k1", "1", "x")], SCHEMA).selectExpr("id", "raise_error('no') as name", "discovered_at")
    for write in (t.overwrite, t.merge):
        with pytest.raises(Exception):  # noqa: B017
            write(bad)
        assert content(t) == sorted(ROWS) and t.version() == 1


def test_two_writers_lose_nothing(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="tessera-table-")
    one, two = table(spark, path, ROWS), table(spark, path)
    write = one._write
    done = []

    def meanwhile(rows):
        out = write(rows)
        if not done:
            done.append(two.merge(spark.createDataFrame([("k1", "two", "d2")], SCHEMA)))
        return out

    monkeypatch.setattr(one, "_write", meanwhile)
    assert one.merge(spark.createDataFrame([("k1", "one", "d1"), ("k2", "one", "d1")], SCHEMA)) == 3 and done == [2]
    assert content(one) == sorted([r for r in ROWS if r[0] not in ("k1", "k2")] + [("k1", "one", "d1"), ("k2", "one", "d1")])
    done.clear()
    with pytest.raises(ConflictError):
        one.overwrite(spark.createDataFrame(ROWS[:1], SCHEMA))
    assert len(content(one)) == 60


def test_jobs_keep_what_was_found_first(spark):
    import json

    from tessera.plans import pipelines

    base = tempfile.mkdtemp(prefix="tessera-jobs-")
    site = lambda i, name: (json.dumps({"id": i, "displayName": name, "webUrl": f"u/{i}", "siteCollection": {"hostname": "h"}}),)
    sites = lambda rows: spark.createDataFrame(rows, "json string")
    pipelines.upsert_sites(spark, sites([site("a", "A"), site("b", "B"), ("{}",)]), f"{base}/sites", "t1")
    pipelines.upsert_sites(spark, sites([site("b", "first"), site("b", "B2"), site("c", "C")]), f"{base}/sites", "t2")
    got = {r.id: (r.name, r.discovered_at, r.processed_at) for r in pipelines.sites_table(spark, f"{base}/sites").read().collect()}
    assert got == {"a": ("A", "t1", None), "b": ("B2", "t1", None), "c": ("C", "t2", None)}
    drives = spark.createDataFrame([("s", json.dumps({"id": "d", "name": "", "driveType": "x"})), ("s", None)], "site_id string, json string")
    pipelines.upsert_drives(spark, drives, f"{base}/drives", "t1")
    pipelines.upsert_drives(spark, drives.replace("s", "s2"), f"{base}/drives", "t2")
    assert [tuple(r)[:4] for r in pipelines.drives_table(spark, f"{base}/drives").read().collect()] == [("d", "s2", "d", "x")]
    assert pipelines.drives_table(spark, f"{base}/drives").read().first().discovered_at == "t1"


def test_newest_complete_run_of_each_tenant(spark):
    base = tempfile.mkdtemp(prefix="tessera-ws-")

    def run(root, name, rows, at, done=True):
        path = os.path.join(base, root, "exports", name)
        spark.createDataFrame(rows, "id long" if root != "clients/b c" else "id long, more string").write.parquet(path)
        mark = os.path.join(path, "_SUCCESS")
        os.utime(mark, (at, at)) if done else os.remove(mark)
        return path

    run("now", "inventory_parquet", [(1,)], 100)
    run("clients/a", "inventory_parquet", [(2,)], 300)
    run("clients/a", "inventory_parquet_2", [(3,), (4,)], 200)
    run("clients/a", "inventory_parquet_3", [(5,)], 400, done=False)  # half written
    run("clients/b c", "inventory_parquet_x", [(6, "m")], 100)
    os.makedirs(os.path.join(base, "clients/empty/exports"))
    os.makedirs(os.path.join(base, "clients/gold/data/gold/storage_kpis.parquet"))
    os.makedirs(os.path.join(base, "clients/runs-only"))
    found = ws.discover(spark, f"{base}/now", f"{base}/clients")
    assert [w.name for w in found] == [ws.CURRENT_TENANT, "a", "b c", "gold"] and found[3].inventory is None
    assert found[1].inventory.endswith("clients/a/exports/inventory_parquet")
    rows = ws.read_inventories(spark, found).select("tenant", "id", "more").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(ws.CURRENT_TENANT, 1, None), ("a", 2, None), ("b c", 6, "m")], key=str)
    assert ws.read_inventories(spark, []).columns == ["tenant"]
    assert [w.name for w in ws.discover(spark, f"{base}/nothing")] == [ws.CURRENT_TENANT]


def test_stored_schema_only_widens(spark):
    from tessera.operators import flatten_schema as fs

    batches = [['{"a": 1, "b": {"c": "x"}, "E": true}', "no json"], ['{"a": 1.5, "b": 3, "e": 2}'], ['{"a": "t", "d": [1], "b": {"c": 2}}', None]]
    frames = [spark.createDataFrame([(x,) for x in b], "raw_json string") for b in batches]
    found = []
    for order in ((0, 1, 2), (2, 1, 0)):
        stored = fs.StoredSchema(spark, tempfile.mkdtemp(prefix="tessera-schema-"))
        seen = set()
        for k in order:
            leaves = stored.widen(frames[k], "raw_json")
            assert seen <= set(leaves)
            seen = set(leaves)
        found.append(stored.leaves())
        assert stored.widen(frames[0], "raw_json") == found[-1] and stored.table.version() <= 3
    assert found[0] == found[1] == {("a",): "string", ("b",): "json", ("b", "c"): "string", ("d",): "json", ("E",): "boolean", ("e",): "bigint"}
    out = fs.flatten_with(frames[1], found[0])
    assert out.columns == ["raw_json", "raw_E", "raw_a", "raw_b", "raw_b_c", "raw_d", [c for c in out.columns if c.startswith("raw_e__")][0]]
    assert tuple(out.first())[1:] == (None, "1.5", "3", None, None, 2)
    assert fs.wider("boolean", "bigint") == "string" and fs.wider("bigint", "double") == "double" and fs.wider("date", "json") == "json"


def test_exact_parts_in_order(spark):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from tessera.sinks.parquet import in_ordered_parts

    path = os.path.join(tempfile.mkdtemp(prefix="tessera-parts-"), "out")
    df = spark.range(1003).select((F.col("id") * 7919 % 1003).alias("k"), F.lit("hot").alias("site")).repartition(5)
    parts = in_ordered_parts(df, [F.col("site"), F.col("k")], 100)
    parts.write.option("maxRecordsPerFile", 100).parquet(path)
    files = [pq.read_table(f)["k"].to_pylist() for f in sorted(glob.glob(f"{path}/part-*"))]
    files = [f for f in files if f]
    assert [len(f) for f in files] == [100] * 10 + [3] and [k for f in files for k in f] == list(range(1003))
    assert in_ordered_parts(df.limit(0), [F.col("k")], 100).count() == 0
