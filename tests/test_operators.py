"""Joins, de-duplication and flattening helpers."""

from pyspark.sql import functions as F

from tessera.operators import keep_one, latest_per_key
from tessera.operators.flatten import flatten_json_column


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_one_is_deterministic(spark):
    a = spark.createDataFrame([("k", "b", 2), ("k", "a", 1), ("j", "z", 0)], "key string, v string, n int")
    b = a.orderBy(F.desc("v")).repartition(3)
    assert sorted(tuple(r) for r in keep_one(a, "key").collect()) == sorted(tuple(r) for r in keep_one(b, "key").collect())
    latest = {r.key: r.v for r in latest_per_key(a, "key", [F.col("n")]).collect()}
    assert latest == {"k": "b", "j": "z"}


def test_flatten_case_variants_and_dots(spark):
    df = spark.createDataFrame([('{"siteCollection":{"hostname":"h"},"a.b":1}',), ('{"siteCollection":{"hostName":"H"}}',)], "raw_json string")
    out = flatten_json_column(df, "raw_json", "raw_")
    cols = [c for c in out.columns if c.startswith("raw_")]
    assert "raw_a.b" in cols and any(c.lower() == "raw_sitecollection_hostname" for c in cols)
    assert out.count() == 2


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from tessera.sinks.parquet import write_bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        items = spark.range(0, 2000).select((F.col("id") % 50).cast("string").alias("drive_id"), F.col("id").alias("item"))
        drives = spark.range(0, 50).select(F.col("id").cast("string").alias("drive_id"), F.lit("lib").alias("name"))
        write_bucketed(items, "t_items_b", ["drive_id"], 8, str(tmp_path / "items"))
        write_bucketed(drives, "t_drives_b", ["drive_id"], 8, str(tmp_path / "drives"))
        j = spark.table("t_items_b").join(spark.table("t_drives_b"), "drive_id")
        assert j.count() == 2000
        assert "Exchange" not in plan(j)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        spark.sql("DROP TABLE IF EXISTS t_items_b")
        spark.sql("DROP TABLE IF EXISTS t_drives_b")
