"""Folder rollup against a direct simulation of the per-folder update rule:
live folders deepest first; a folder's totals are the sum over its live
children (a file counts 1 and its size, a folder its own totals)."""

import random

from tessera.operators.hierarchy import folder_totals, recalculate_folders
from tessera.schemas import ITEMS


def make_tree(seed):
    rnd = random.Random(seed)
    rows = []
    for d in range(3):
        drive = f"d{d}"
        folders = ["root"]
        rows.append(dict(id="root", drive_id=drive, parent_id=None, item_type="folder", size_bytes=0, status="ok"))
        for i in range(rnd.randint(5, 25)):
            fid = f"f{i}"
            parent = rnd.choice(folders)
            status = "deleted" if rnd.random() < 0.15 else "ok"
            rows.append(dict(id=fid, drive_id=drive, parent_id=parent, item_type="folder", size_bytes=0, status=status))
            folders.append(fid)
        for j in range(rnd.randint(10, 60)):
            parent = rnd.choice(folders + ["missing"])
            status = "deleted" if rnd.random() < 0.1 else "ok"
            size = rnd.choice([None, 0, rnd.randrange(1, 10**12)])
            rows.append(dict(id=f"x{j}", drive_id=drive, parent_id=parent, item_type="file", size_bytes=size, status=status))
    return rows


def simulate(rows):
    by_key = {(r["drive_id"], r["id"]): dict(r, file_count=0, total=0) for r in rows}
    children = {}
    for r in rows:
        children.setdefault((r["drive_id"], r["parent_id"]), []).append(r)

    def depth(r):
        d, cur = 0, r
        while cur["parent_id"] is not None and (cur["drive_id"], cur["parent_id"]) in by_key:
            cur = by_key[(cur["drive_id"], cur["parent_id"])]
            d += 1
        return d

    live_folders = [r for r in rows if r["item_type"] == "folder" and r["status"] != "deleted"]
    out = {}
    for f in sorted(live_folders, key=depth, reverse=True):
        n = b = 0
        for c in children.get((f["drive_id"], f["id"]), []):
            if c["status"] == "deleted":
                continue
            if c["item_type"] == "file":
                n += 1
                b += c["size_bytes"] or 0
            else:
                n += by_key[(c["drive_id"], c["id"])]["file_count"]
                b += by_key[(c["drive_id"], c["id"])]["total"]
        by_key[(f["drive_id"], f["id"])].update(file_count=n, total=b)
        out[(f["drive_id"], f["id"])] = (n, b)
    return out


def frame(spark, rows):
    full = [{f.name: r.get(f.name) for f in ITEMS.fields} for r in rows]
    for r in full:
        r["site_id"] = "s"
        r["collected_at"] = "t"
    return spark.createDataFrame(full, ITEMS)


def test_rollup_matches_simulation(spark):
    for seed in (1, 2, 3):
        rows = make_tree(seed)
        got = {(r.drive_id, r.id): (r.file_count, r.folder_total_size_bytes) for r in folder_totals(frame(spark, rows)).collect()}
        assert got == simulate(rows)


def test_recalculate_keeps_files_and_deleted_folders(spark):
    rows = make_tree(4)
    df = recalculate_folders(frame(spark, rows))
    assert df.count() == len(rows)
    expected = simulate(rows)
    for r in df.collect():
        key = (r.drive_id, r.id)
        if key in expected:
            assert (r.file_count, r.folder_total_size_bytes) == expected[key]
            assert r.folder_total_size_formatted is not None
        else:
            assert (r.file_count, r.folder_total_size_bytes) == (None, None)


def test_hot_folder_rollup(spark):
    """One folder holds most files (a hot key) — totals stay exact."""
    rows = [dict(id="root", drive_id="d", parent_id=None, item_type="folder", size_bytes=0, status="ok"),
            dict(id="hot", drive_id="d", parent_id="root", item_type="folder", size_bytes=0, status="ok"),
            dict(id="cold", drive_id="d", parent_id="root", item_type="folder", size_bytes=0, status="ok")]
    rows += [dict(id=f"h{i}", drive_id="d", parent_id="hot", item_type="file", size_bytes=i, status="ok") for i in range(3000)]
    rows += [dict(id=f"c{i}", drive_id="d", parent_id="cold", item_type="file", size_bytes=1, status="ok") for i in range(10)]
    got = {r.id: (r.file_count, r.folder_total_size_bytes) for r in folder_totals(frame(spark, rows)).collect()}
    assert got == {"root": (3010, sum(range(3000)) + 10), "hot": (3000, sum(range(3000))), "cold": (10, 10)}


def _folder(i, parent):
    return ("d", str(i), None if parent is None else str(parent), "folder", "ok", 0)


ITEM = "drive_id string, id string, parent_id string, item_type string, status string, size_bytes long"


def test_deep_chain_is_exact(spark):
    rows = [_folder(i, i - 1 if i else None) for i in range(70)] + [("d", "f", "69", "file", "ok", 5)]
    got = {int(r.id): (r.file_count, r.folder_total_size_bytes) for r in folder_totals(spark.createDataFrame(rows, ITEM)).collect()}
    assert got == dict.fromkeys(range(70), (1, 5))


def test_a_cycle_of_parents_is_reported(spark):
    import pytest

    rows = [_folder(1, 2), _folder(2, 3), _folder(3, 1), _folder(4, 1), _folder(5, None), ("d", "f", "1", "file", "ok", 5)]
    with pytest.raises(ValueError, match="cycle"):
        folder_totals(spark.createDataFrame(rows, ITEM))


def test_site_sets_may_be_frames(spark):
    from tessera.operators.sync import prepare, reset
    from tessera.schemas import DRIVE_SYNC_STATE

    state = spark.createDataFrame([], DRIVE_SYNC_STATE)
    drives = spark.createDataFrame([("a", "s1", "n"), ("b", "s2", "n")], "id string, site_id string, name string")
    wanted = spark.createDataFrame([("s1",)], "site string")
    ready = prepare(state, drives, "t", site_ids=wanted)
    assert [r.drive_id for r in ready.collect()] == ["a"]
    assert [r.updated_at for r in reset(ready, "u", site_ids=wanted).collect()] == ["u"]
    assert [r.updated_at for r in reset(ready, "u", site_ids=[]).collect()] == ["t"]
