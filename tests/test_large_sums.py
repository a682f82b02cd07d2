"""Totals over 2**63 / 100 bytes: a percentage must not overflow a long."""

from tessera.functions import version_percent
from tessera.plans import audit as au
from tessera.plans import reports as rp

#: 120 PiB, held as one size; 100 times as much fits no long
BIG = 120 * 1024**5


def test_unused_share_of_large_totals(spark):
    inv = spark.createDataFrame(
        [("s", "file", BIG, "2000-01-01T00:00:00Z"), ("s", "file", 2 * BIG, "2001-11-01T00:00:00Z")],
        "site_name string, tipo_item string, tamanho_bytes long, data_modificacao string",
    )
    got = rp.dash_unused_kpis(inv, "2001-12-01").first()
    assert (got.unused_bytes, got.unused_files, got.unused_percent) == (BIG, 1, 33.33)
    recent = spark.createDataFrame([("s", "file", 2 * 1024**6, "2001-11-01T00:00:00Z")] * 5, inv.schema)  # over 2**63 in all
    got = rp.dash_unused_kpis(inv.unionByName(recent), "2001-12-01").first()
    assert (got.unused_bytes, got.unused_files, got.unused_percent) == (BIG, 1, 1.13)
    assert rp.dash_unused_kpis(inv.limit(0), "2001-12-01").first().asDict() == {"unused_bytes": 0, "unused_files": 0, "unused_percent": 0.0}


def test_extension_shares_of_large_totals(spark):
    top = spark.createDataFrame(
        [("a", 1, BIG, 0.0), ("b", 3, 5 * 1024**6, 0.0), ("c", 2, 5 * 1024**6, 0.0)], "extension string, file_count long, storage_bytes long, storage_gb double"
    )
    got = {r.extension: r for r in rp.dash_extension_table(top).collect()}
    assert [got[x].storage_percent for x in "abc"] == [1.16, 49.42, 49.42]
    assert (got["a"].storage_gb, got["c"].avg_file_size_mb) == (BIG / 1024**3, 5 * 1024**6 / 2 / 1024**2)


def test_version_shares_of_large_totals(spark):
    ok = spark.createDataFrame(
        [("a", BIG, 1, 2 * BIG), ("b", BIG, None, 4 * BIG), ("c", None, 5, None)], "site_id string, version_size_bytes long, version_count long, storage_used_bytes long"
    )
    got = au.version_kpis(ok).first()
    assert (got.version_count, got.version_size_bytes, got.version_percent) == (6, 2 * BIG, 33.3)
    share = ok.select(version_percent("version_size_bytes", "storage_used_bytes").alias("p")).collect()
    assert [r.p for r in share] == [50.0, 25.0, None]
