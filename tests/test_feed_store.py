"""The change-feed store against a plain, event by event simulation: random
orders of arrival, repeated batches, snapshots, resets, errors and relists."""

import json
import os
import random
import tempfile

import pytest

from tessera.operators import events as ev
from tessera.operators.sync import EXPIRED_MESSAGE, NO_LINK_MESSAGE, SYNC_COLUMNS
from tessera.streaming import change_feed as cf
from tessera.streaming.feed_store import EVENTS, PAGES, FeedStore
from tessera.sources.change_pages import LANDED_PAGE

ITEM = ["drive_id", "id", "site_id", "name", "size_bytes", "status", "collected_at"]
EVENT_SCHEMA = ev.EVENT


def history(rnd, drives=4, steps=14):
    """What happens to each drive, in order: pages, errors, claims."""
    out = []
    for d in range(drives):
        seq, no = 0, 0
        for _ in range(steps):
            kind = rnd.choice(["page"] * 6 + ["error", "error", "claim"])
            base = {"drive_id": f"d{d}", "site_id": f"s{d % 2}", "library_name": f"lib{d}"}
            if kind == "page":
                seq += rnd.choice([1, 1, 2])
                items = []
                for _ in range(rnd.randint(0, 4)):
                    i = f"i{rnd.randint(0, 5)}"
                    items.append({"id": i, "deleted": {}} if rnd.random() < 0.3 else {"id": i, "name": f"{i}-{seq}", "size": rnd.randint(0, 9)})
                link = rnd.choice(["next", "next", "delta", None])
                out.append({**base, "kind": kind, "seq": seq, "items": items, "link": link, "at": f"t{seq:03d}.0"})
            else:
                no += 1
                out.append({
                    **base, "kind": kind, "seq": seq, "no": no, "at": f"t{seq:03d}.{no:03d}", "attempt": no,
                    "status_code": rnd.choice([410, 403, 503, None]), "message": f"m{no}" * rnd.choice([1, 1500]),
                })
    return out


def simulate(events, fences=None, relisted=False):
    """Items and sync state by applying every event in its drive's order;
    ``fences``: drive -> (kind, seq, at, clears)."""
    fences = fences or {}
    items, state = {}, {}
    for d in sorted({e["drive_id"] for e in events}):
        mine = [(e["seq"], 0 if e["kind"] == "page" else 1, e.get("no", 0), e) for e in events if e["drive_id"] == d]
        for kind, seq, at, clears in fences.get(d, []):
            mine.append((seq, 2, 0, {"kind": kind, "at": at, "clears": clears}))
        s = dict.fromkeys(SYNC_COLUMNS) | {"drive_id": d, "attempts": 0}
        for _, _, _, e in sorted(mine, key=lambda x: x[:3]):
            s["created_at"] = s["created_at"] or e["at"]
            s["updated_at"] = e["at"]
            if e["kind"] in ("page", "error", "claim"):
                s |= {"site_id": e["site_id"], "library_name": e["library_name"]}
            if e["kind"] == "page" and e["link"] is None:
                s |= {"status": "pending", "last_error": NO_LINK_MESSAGE}
            elif e["kind"] == "page":
                seen = {}
                for k, x in enumerate(e["items"]):  # upserts of a page come before its tombstones
                    if "deleted" not in x:
                        seen[x["id"]] = (e["site_id"], x["name"], x["size"], "ok", e["at"], e["seq"])
                for key, row in seen.items():
                    items[d, key] = row
                for x in e["items"]:
                    if "deleted" in x and (d, x["id"]) in items:
                        items[d, x["id"]] = (*items[d, x["id"]][:3], "deleted", e["at"], items[d, x["id"]][5])
                if e["link"] == "delta":
                    s |= {"status": "done", "next_link": None, "delta_link": f"dl{e['seq']}", "last_error": None, "last_completed_at": e["at"]}
                else:
                    s |= {"status": "in_progress", "next_link": f"nl{e['seq']}"}
            elif e["kind"] == "claim":
                s |= {"status": "in_progress", "attempts": e["attempt"], "last_started_at": e["at"]}
            elif e["kind"] == "error" and e["status_code"] == 410:
                s |= {"status": "pending", "next_link": None, "delta_link": None, "last_error": EXPIRED_MESSAGE}
            elif e["kind"] == "error":
                s |= {"status": "failed" if e["status_code"] == 403 else "pending", "last_error": e["message"][:2000]}
            else:
                s |= {"status": "pending", "next_link": None, "delta_link": None, "last_error": None}
                if e["kind"] == "reset_site":
                    s |= {"attempts": 0, "last_started_at": None, "last_completed_at": None}
                if e["clears"]:
                    items = {k: v for k, v in items.items() if k[0] != d}
        state[d] = s
        if relisted:
            lost = None
            last = None
            for seq, _, _, e in sorted(mine, key=lambda x: x[:3]):
                if e["kind"] == "reset_checkpoint" or e["kind"] == "error" and e["status_code"] == 410:
                    lost = seq
                elif e["kind"] == "page" and e["link"] == "delta" and lost is not None:
                    last, lost = (lost, e["at"]), None
            if last:
                for k, v in items.items():
                    if k[0] == d and v[5] <= last[0] and v[3] == "ok":
                        items[k] = (*v[:3], "deleted", last[1], v[5])
    return sorted((*k, *v[:5]) for k, v in items.items()), sorted((tuple(s[c] for c in SYNC_COLUMNS) for s in state.values()), key=str)


def landed(spark, events):
    rows = [
        (e["drive_id"], e["site_id"], e["library_name"], e["seq"], e["at"],
         ([json.dumps(x) for x in e["items"]], f"nl{e['seq']}" if e["link"] == "next" else None, f"dl{e['seq']}" if e["link"] == "delta" else None))
        for e in events if e["kind"] == "page"
    ]
    return spark.createDataFrame(rows, LANDED_PAGE)


def others(spark, events):
    names = [f.name for f in EVENT_SCHEMA.fields]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in events if e["kind"] != "page"], EVENT_SCHEMA)


def put(spark, path, events, query, epoch):
    store = FeedStore(spark, path)
    if any(e["kind"] == "page" for e in events):
        store.append(PAGES, landed(spark, events), query, epoch)
    if any(e["kind"] != "page" for e in events):
        store.append_events(others(spark, events), query, epoch)


def tables(spark, path, reconciled=False):
    items = cf.current_items(spark, path, reconciled).select(*ITEM)
    return sorted(map(tuple, items.collect())), sorted(map(tuple, cf.current_sync_state(spark, path).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_arrival_with_snapshots(spark, seed):
    rnd = random.Random(seed)
    events = history(rnd)
    want = simulate(events)
    path = tempfile.mkdtemp(prefix="tessera-feed-")
    arriving = events + rnd.sample(events, 6)  # some are read twice
    rnd.shuffle(arriving)
    cut = sorted(rnd.sample(range(1, len(arriving)), 3))
    for k, (a, b) in enumerate(zip([0, *cut], [*cut, len(arriving)])):
        put(spark, path, arriving[a:b], "q", k)
        if k < 2:
            cf.snapshot(spark, path)
        if k == 1:
            assert tables(spark, path) == simulate(_distinct(arriving[:b]))
    assert tables(spark, path) == want
    put(spark, path, events, "another", 0)  # a new checkpoint reads everything again
    assert tables(spark, path) == want
    assert FeedStore(spark, path).new_pages().filter("drive_id = 'd0'").count() == len(
        {(e["seq"]) for e in events if e["kind"] == "page" and e["drive_id"] == "d0"} - {e["seq"] for e in arriving[: cut[1]] if e["kind"] == "page" and e["drive_id"] == "d0"}
    ) + _again(arriving[cut[1] :], arriving[: cut[1]], events)
    assert tables(spark, path, reconciled=True)[0] == simulate(events, relisted=True)[0]


def _distinct(events):
    out = {}
    for e in events:
        out[e["drive_id"], e["seq"], e["kind"], e.get("no")] = e
    return list(out.values())


def _again(tail, before, events):
    """Pages of d0 in the tail's first batch that its second batch holds too."""
    pages = lambda x: [e["seq"] for e in x if e["kind"] == "page" and e["drive_id"] == "d0"]
    return len([s for s in pages(tail) if s not in pages(before)])


def test_only_tail_folders_are_read(spark):
    path = tempfile.mkdtemp(prefix="tessera-feed-")
    events = history(random.Random(9))
    half = len(events) // 2
    put(spark, path, events[:half], "q", 0)
    cf.snapshot(spark, path)
    put(spark, path, events[half:], "q", 1)
    items = cf.current_items(spark, path)
    read = {f.partition(path)[2] for f in items.inputFiles()}
    assert read and not any("/epoch=0/" in f and "/pages/" in f for f in read)
    assert any("/pages/query=q/epoch=1/" in f for f in read) and any("/snapshots/" in f for f in read)


@pytest.mark.parametrize("clears", [None, True, False])
def test_resets_stick(spark, clears):
    """A reset survives late pages, a repeated batch, a new checkpoint and a
    snapshot; pages after it count."""
    rnd = random.Random(5)
    path = tempfile.mkdtemp(prefix="tessera-feed-")
    events = history(rnd)
    middle = [e for e in events if e["seq"] <= 8]
    late = [e for e in middle if rnd.random() < 0.2 and e["seq"] < 8]
    put(spark, path, [e for e in middle if e not in late], "q", 0)
    cf.snapshot(spark, path)
    marks = {r.drive_id: r.mark for r in FeedStore(spark, path).marks().collect()}
    if clears is None:
        counts = cf.reset_site(spark, path, " s1 ", "reset-at")
        before = simulate([e for e in middle if e not in late])[0]
        assert counts["items"] == sum(r[2] == "s1" for r in before) and counts["drive_sync_state"] == 2
        fences = {d: [("reset_site", m, "reset-at", True)] for d, m in marks.items() if d in ("d1", "d3")}
    else:
        FeedStore(spark, path).reset_checkpoints("reset-at", None if clears else ["s0"], clear_items=clears)
        fences = {d: [("reset_checkpoint", m, "reset-at", clears)] for d, m in marks.items() if clears or d in ("d0", "d2")}
    gone = [e for e in late if not (e["drive_id"] in fences and e["seq"] > fences[e["drive_id"]][0][1])]
    put(spark, path, late, "late", 0)
    put(spark, path, [e for e in middle if e not in late], "q", 0)  # the batch again
    put(spark, path, middle, "new-checkpoint", 0)
    assert tables(spark, path) == simulate(middle, fences) and gone
    cf.snapshot(spark, path)
    assert tables(spark, path) == simulate(middle, fences)
    put(spark, path, [e for e in events if e["seq"] > 8], "q", 1)
    assert tables(spark, path) == simulate(events, fences)
    kept = {(r.drive_id, r.seq, r.no) for r in cf.current_errors(spark, path).collect()}
    floor = {d: f[0][1] for d, f in fences.items() if f[0][0] == "reset_site"}
    assert kept == {(e["drive_id"], e["seq"], e["no"]) for e in events if e["kind"] == "error" and e["seq"] > floor.get(e["drive_id"], -1)}


def test_reset_of_a_blank_site(spark):
    with pytest.raises(ValueError):
        FeedStore(spark, tempfile.mkdtemp(prefix="tessera-feed-")).reset_site("  ", "t")


def test_an_unfinished_batch_or_snapshot_does_not_count(spark):
    path = tempfile.mkdtemp(prefix="tessera-feed-")
    events = history(random.Random(3))
    put(spark, path, events, "q", 0)
    put(spark, path, events, "q", 1)
    os.remove(os.path.join(path, "pages", "query=q", "epoch=1", "_SUCCESS"))
    want = tables(spark, path)
    snap = cf.snapshot(spark, path)
    os.remove(os.path.join(snap, "_PUBLISHED"))
    assert FeedStore(spark, path).snapshot is None and tables(spark, path) == want == simulate(events)


def test_relist_marks_what_it_did_not_bring(spark):
    page = lambda seq, items, link: {"drive_id": "d", "site_id": "s", "library_name": "l", "kind": "page", "seq": seq, "items": [{"id": i, "name": i, "size": 1} for i in items], "link": link, "at": f"t{seq}"}
    lost = {"drive_id": "d", "site_id": "s", "library_name": "l", "kind": "error", "seq": 2, "no": 1, "status_code": 410, "message": "gone", "at": "t2.1"}
    path = tempfile.mkdtemp(prefix="tessera-feed-")
    put(spark, path, [page(1, "ab", "next"), page(2, "c", "delta"), lost, page(3, "a", "next")], "q", 0)
    status = lambda: {r.id: (r.status, r.collected_at) for r in cf.current_items(spark, path, reconciled=True).collect()}
    assert status() == {"a": ("ok", "t3"), "b": ("ok", "t1"), "c": ("ok", "t2")}  # the relist is not complete
    cf.snapshot(spark, path)
    put(spark, path, [page(5, "d", "delta")], "q", 1)
    assert status() == {"a": ("ok", "t3"), "b": ("deleted", "t5"), "c": ("deleted", "t5"), "d": ("ok", "t5")}
    put(spark, path, [page(4, "c", "next")], "q", 2)  # a page of the relist that lands late
    assert status() == {"a": ("ok", "t3"), "b": ("deleted", "t5"), "c": ("ok", "t4"), "d": ("ok", "t5")}
    put(spark, path, [{**lost, "seq": 5, "no": 2}, page(6, "x", "next")], "q", 3)  # lost again: the earlier relist still holds
    assert status()["b"] == ("deleted", "t5") and status()["a"] == ("ok", "t3")


def test_empty_store(spark):
    path = tempfile.mkdtemp(prefix="tessera-feed-")
    assert tables(spark, path) == ([], []) and EVENTS not in os.listdir(path)


def test_rollup_columns_ride_with_the_state(spark):
    from tessera.operators import item_state as its
    from tessera.sources.change_pages import page_changes

    first = history(random.Random(4))
    states = its.states_of(page_changes(landed(spark, first)))
    items = its.items_of(states)
    rolled = items.limit(3).withColumn("file_count", items["size_bytes"] + 7).withColumn("folder_total_size_formatted", items["name"])
    with_totals = its.with_rollup(states, rolled)
    more = [{**e, "seq": e["seq"] + 100} for e in first]
    merged = its.items_of(its.merge_states(with_totals, its.states_of(page_changes(landed(spark, more)))))
    got = {(r.drive_id, r.id): (r.file_count, r.folder_total_size_formatted) for r in merged.collect()}
    want = {(r.drive_id, r.id): (r.file_count, r.folder_total_size_formatted) for r in rolled.collect()}
    assert got == {k: want.get(k, (0, None)) for k in got} and set(want) <= set(got)
