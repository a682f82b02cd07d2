"""Change pages through Structured Streaming equal the batch application;
re-running the stream applies nothing twice."""

import json
import os
import tempfile

from tessera.streaming import change_feed as cf


def landed(tmp, pages):
    os.makedirs(tmp, exist_ok=True)
    for i, p in enumerate(pages):
        with open(os.path.join(tmp, f"page-{i:04d}.json"), "w") as f:
            f.write(json.dumps(p) + "\n")


def page(drive, seq, items, nxt=None, delta=None):
    return {
        "drive_id": drive, "site_id": "s", "library_name": "Docs", "page_seq": seq,
        "collected_at": f"2001-01-01T00:00:{seq:02d}Z",
        "page": {"value": [json.dumps(x) if not isinstance(x, str) else x for x in items], "@odata.nextLink": nxt, "@odata.deltaLink": delta},
    }


PAGES = [
    page("d1", 1, [
        {"id": "root", "name": "root", "root": {}, "folder": {}},
        {"id": "f1", "name": "Folder", "folder": {"childCount": 1}, "parentReference": {"id": "root", "path": "/drive/root:"}},
        {"id": "a", "name": "report.PDF", "size": 10, "file": {"mimeType": "application/pdf"}, "parentReference": {"id": "f1", "path": "/drive/root:/Folder"}},
        {"name": "no id is skipped"},
    ], nxt="n2"),
    page("d1", 2, [
        {"id": "b", "name": ".bashrc", "size": 5, "parentReference": {"id": "f1", "path": "/drive/root:/Folder"}},
        {"id": "a", "deleted": {}},
    ], delta="dl"),
    page("d2", 1, [{"id": "x", "name": "x.tar.gz", "size": 3, "package": {}}], nxt="n2"),
]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def both(spark, store):
    return rows_of(cf.current_items(spark, store)), rows_of(cf.current_sync_state(spark, store))


def run(spark, landing, store, checkpoint=None, files=None):
    cf.start(spark, landing, store, checkpoint, max_files_per_trigger=files).awaitTermination(300)


MORE = PAGES + [
    page("d2", 2, [{"id": "y", "name": "y.docx", "size": 9}, {"id": "x", "deleted": {}}], delta="dl2"),
    page("d3", 1, [{"id": "z", "name": "z", "size": 1}], delta="dl3"),
    page("d1", 3, [{"id": "a", "name": "report.PDF", "size": 11, "parentReference": {"id": "f1", "path": "/drive/root:/Folder"}}], delta="dl4"),
]


def test_one_page_per_batch_equals_one_batch_on_all_columns(spark):
    base = tempfile.mkdtemp(prefix="tessera-feed-")
    landing, batch, stream = (os.path.join(base, x) for x in ("landing", "batch", "stream"))
    landed(landing, MORE)
    cf.run_batch(spark, landing, batch)
    run(spark, landing, stream, files=1)
    want = both(spark, batch)
    assert both(spark, stream) == want
    got = {r.id: r for r in cf.current_items(spark, stream).collect()}
    assert set(got) == {"root", "f1", "a", "b", "x", "y", "z"}
    assert got["a"].status == "ok" and got["x"].status == "deleted" and got["b"].extension is None
    assert got["f1"].full_path == "Docs/Folder" and got["a"].full_path == "Docs/Folder/report.PDF"
    run(spark, landing, stream)  # nothing new
    assert both(spark, stream) == want
    cf.compact(spark, stream, os.path.join(base, "compact"))
    assert rows_of(spark.read.parquet(os.path.join(base, "compact", "items"))) == want[0]


def test_fresh_checkpoint_on_an_old_store_loses_nothing(spark):
    base = tempfile.mkdtemp(prefix="tessera-feed-")
    landing, store = os.path.join(base, "landing"), os.path.join(base, "store")
    landed(landing, MORE[:1])
    run(spark, landing, store, os.path.join(base, "c1"))
    landed(landing, MORE)
    run(spark, landing, store, os.path.join(base, "c2"))
    cf.run_batch(spark, landing, os.path.join(base, "batch"))
    assert both(spark, store) == both(spark, os.path.join(base, "batch"))


def test_crash_before_and_after_the_write_and_two_stores(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="tessera-feed-")
    landing, one, two = (os.path.join(base, x) for x in ("landing", "one", "two"))
    landed(landing, MORE)
    write = cf.append_pages
    for step in ("before", "after"):

        def fail(pages, store, query, epoch, step=step):
            if step == "after":
                write(pages, store, query, epoch)
            raise RuntimeError("crash")

        monkeypatch.setattr(cf, "append_pages", fail)
        try:
            run(spark, landing, one)
        except Exception:  # noqa: BLE001 - the crash
            pass
        monkeypatch.setattr(cf, "append_pages", write)
    run(spark, landing, one)
    run(spark, landing, two)
    assert both(spark, one) == both(spark, two) and both(spark, one)[0]


def test_done_drives_are_processed(spark):
    drives = spark.createDataFrame([("d1", None), ("d2", None)], "id string, processed_at string")
    sync = spark.createDataFrame([("d1", "done", "t1"), ("d2", "pending", None)], "drive_id string, status string, last_completed_at string")
    assert rows_of(cf.processed_drives(drives, sync)) == [("d1", "t1"), ("d2", None)]


def test_pages_landing_in_reverse_order(spark):
    """Newest page first (file times reversed): the stored state must still
    equal in-order application."""
    base = tempfile.mkdtemp(prefix="tessera-feed-")
    landing = os.path.join(base, "landing")
    seq = [
        page("d9", 1, [{"id": "p", "name": "v1.txt", "size": 1}], nxt="n2"),
        page("d9", 2, [{"id": "p", "deleted": {}}], nxt="n3"),
        page("d9", 3, [{"id": "p", "name": "v3.txt", "size": 3}, {"id": "q", "name": "q.txt", "size": 4}], nxt="n4"),
        page("d9", 4, [{"id": "q", "deleted": {}}], delta="dl"),
    ]
    landed(landing, seq)
    now = 2_000_000_000
    for i in range(len(seq)):
        t = now - i * 100  # page 0 newest on disk → processed last
        os.utime(os.path.join(landing, f"page-{i:04d}.json"), (t, t))
    q = cf.start(spark, landing, os.path.join(base, "stream"), os.path.join(base, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(300)
    got = {r.id: r for r in cf.current_items(spark, os.path.join(base, "stream")).collect()}
    assert (got["p"].name, got["p"].size_bytes, got["p"].status) == ("v3.txt", 3, "ok")
    assert got["q"].status == "deleted"
    sync = cf.current_sync_state(spark, os.path.join(base, "stream")).first()
    assert (sync.status, sync.delta_link) == ("done", "dl")
