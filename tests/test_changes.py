"""Change-feed merge against a page-by-page simulation of the upsert /
tombstone rules."""

import random

from pyspark.sql import functions as F

from tessera.operators.changes import apply_changes
from tessera.operators.sync import apply_failures, prepare, reset, sync_from_pages
from tessera.schemas import ITEMS

CHANGE_SCHEMA = "drive_id string, id string, name string, size_bytes long, status string, collected_at string, page_seq long, row_idx long, is_tombstone boolean"


def random_pages(seed, n_pages=12, keys=15):
    rnd = random.Random(seed)
    out = []
    for p in range(n_pages):
        for i in range(rnd.randint(0, 12)):
            k = f"k{rnd.randrange(keys)}"
            tomb = rnd.random() < 0.3
            out.append(("d1", k, None if tomb else f"n{p}-{i}", None if tomb else rnd.randrange(100), None, f"t{p:03d}", p, i, tomb))
    return out


def simulate(changes, state=None):
    items = dict(state or {})
    pages = sorted({c[6] for c in changes})
    for p in pages:
        rows = [c for c in changes if c[6] == p]
        for c in sorted(rows, key=lambda c: c[7]):
            if not c[8]:
                items[(c[0], c[1])] = {"name": c[2], "size": c[3], "status": "ok", "at": c[5]}
        for c in sorted(rows, key=lambda c: c[7]):
            if c[8] and (c[0], c[1]) in items:
                items[(c[0], c[1])].update(status="deleted", at=c[5])
    return items


def as_dict(df):
    return {(r.drive_id, r.id): {"name": r.name, "size": r.size_bytes, "status": r.status, "at": r.collected_at} for r in df.collect()}


def test_apply_matches_simulation(spark):
    for seed in range(4):
        ch = random_pages(seed)
        df = spark.createDataFrame(ch, CHANGE_SCHEMA)
        assert as_dict(apply_changes(None, df)) == simulate(ch)


def test_incremental_equals_one_shot_and_replay_is_idempotent(spark):
    ch = random_pages(11, n_pages=16)
    first = [c for c in ch if c[6] < 8]
    second = [c for c in ch if c[6] >= 8]
    s1 = apply_changes(None, spark.createDataFrame(first, CHANGE_SCHEMA)).checkpoint()
    s2 = apply_changes(s1, spark.createDataFrame(second, CHANGE_SCHEMA))
    assert as_dict(s2) == simulate(ch)
    again = apply_changes(s2.checkpoint(), spark.createDataFrame(second, CHANGE_SCHEMA))
    assert as_dict(again) == as_dict(s2)


def test_page_order_rules(spark):
    ch = [
        ("d", "a", None, None, None, "t1", 1, 0, True),   # tombstone first in the page...
        ("d", "a", "A", 5, None, "t1", 1, 1, False),     # ...upsert later: still deleted
        ("d", "b", None, None, None, "t1", 1, 0, True),   # unknown id: no-op
        ("d", "c", "C", 1, None, "t1", 1, 2, False),
        ("d", "c", None, None, None, "t2", 2, 0, True),
        ("d", "c", "C2", 2, None, "t3", 3, 0, False),    # revived on a later page
    ]
    got = as_dict(apply_changes(None, spark.createDataFrame(ch, CHANGE_SCHEMA)))
    assert got == {
        ("d", "a"): {"name": "A", "size": 5, "status": "deleted", "at": "t1"},
        ("d", "c"): {"name": "C2", "size": 2, "status": "ok", "at": "t3"},
    }


def test_upsert_keeps_rollup_columns(spark):
    state = spark.createDataFrame(
        [{**{f.name: None for f in ITEMS.fields}, "id": "f", "drive_id": "d", "site_id": "s", "item_type": "folder",
          "status": "ok", "collected_at": "t0", "file_count": 7, "folder_total_size_bytes": 70,
          "folder_total_size_formatted": "70 B"}],
        ITEMS,
    )
    ch = spark.createDataFrame([("d", "f", "F", 0, None, "t1", 1, 0, False)], CHANGE_SCHEMA)
    r = apply_changes(state, ch.withColumn("item_type", F.lit("folder")).withColumn("site_id", F.lit("s"))).first()
    assert (r.name, r.file_count, r.folder_total_size_bytes, r.collected_at) == ("F", 7, 70, "t1")


def test_sync_state_transitions(spark):
    log = spark.createDataFrame(
        [("d1", "s", "L", 1, "t1", "n2", None), ("d1", "s", "L", 2, "t2", None, "delta1"),
         ("d2", "s", "L", 1, "t1", "n2", None), ("d3", "s", "L", 1, "t1", None, None)],
        "drive_id string, site_id string, library_name string, page_seq long, collected_at string, next_link string, delta_link string",
    )
    st = {r.drive_id: r for r in sync_from_pages(log).collect()}
    assert (st["d1"].status, st["d1"].delta_link, st["d1"].next_link, st["d1"].last_completed_at) == ("done", "delta1", None, "t2")
    assert (st["d2"].status, st["d2"].next_link) == ("in_progress", "n2")
    assert st["d3"].status == "pending" and st["d3"].last_error
    state = sync_from_pages(log)
    drives = spark.createDataFrame([("d1", "s", "L"), ("d4", "s", "M")], "id string, site_id string, name string")
    prep = {r.drive_id: r for r in prepare(state, drives, "t9", reset_completed=True).collect()}
    assert prep["d2"].status == "pending" and prep["d2"].last_error == "Retomado apos interrupcao"
    assert prep["d1"].status == "pending" and prep["d4"].status == "pending"
    rs = {r.drive_id: r for r in reset(state, "t9", site_ids=[]).collect()}
    assert rs["d1"].status == "done"  # empty site set touches nothing
    errors = spark.createDataFrame(
        [(1, "d1", 410, "expired", "t5"), (2, "d2", 403, "forbidden", "t5"), (3, "d3", 503, "busy", "t0")],
        "id long, drive_id string, status_code int, message string, created_at string",
    )
    f = {r.drive_id: r for r in apply_failures(state, errors).collect()}
    assert (f["d1"].status, f["d1"].delta_link, f["d1"].last_error) == ("pending", None, "expired")
    assert f["d2"].status == "failed"
    assert f["d3"].status == "pending" and f["d3"].last_error != "busy"  # older than the last step


def test_site_filter_modes_and_clear_items(spark):
    from tessera.operators.sync import clear_items
    from tessera.plans.catalog import pending_count
    from tessera.plans.reports import filter_sites

    state = spark.createDataFrame(
        [("d1", "s1", "pending"), ("d2", "s2", "pending"), ("d3", "s1", "done")], "drive_id string, site_id string, status string"
    )
    assert pending_count(state).first().pending == 2
    assert pending_count(state, []).first().pending == 0  # empty set → nothing
    assert pending_count(state, ["s1"]).first().pending == 1
    inv = spark.createDataFrame([("a",), ("b",)], "site_name string")
    assert filter_sites(inv, []).count() == 2  # dashboard: empty selection = all sites
    assert filter_sites(inv, None).count() == 2 and filter_sites(inv, ["a"]).count() == 1
    assert filter_sites(inv, [], empty_means_all=False).count() == 0
    assert filter_sites(inv, spark.createDataFrame([("b",)], "n string")).count() == 1
    items = spark.createDataFrame([("i1", "s1"), ("i2", "s2")], "id string, site_id string")
    assert clear_items(items, None).count() == 0
    assert [r.id for r in clear_items(items, ["s1"]).collect()] == ["i2"]
    assert clear_items(items, []).count() == 2
