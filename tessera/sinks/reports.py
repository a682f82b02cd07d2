"""Report sinks: CSV tables, id lists per tier, JSON rows and summaries.

Every sink is a distributed write (a folder of part files).  Nothing is
gathered into one task: a tier's sites are written as JSON lines under a
``tier=`` partition instead of one nested array document.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import shuffles_dropped

BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True, bom: bool = False, compression: str = "none") -> None:
    """Quoted CSV (``"`` quote and escape), header, UTF-8.  With ``bom`` the
    header line starts with a byte-order mark (UTF-8-with-BOM readers such
    as spreadsheet tools expect it); it is carried by the first column name,
    so every part file's header has it.  ``compression`` packs each part file
    (``gzip`` and others that Spark reads by the file's name)."""
    if bom and header and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .option("compression", compression)
        .csv(path)
    )


def write_client_report(tables: dict[str, DataFrame], output_dir: str, compression: str = "none") -> dict[str, str]:
    out = {}
    for stem, df in tables.items():
        path = f"{output_dir.rstrip('/')}/{stem}.csv"
        with shuffles_dropped(df.sparkSession):
            write_csv(df, path, sep=";", compression=compression)
        out[stem] = path
    return out


def write_priority(priority: DataFrame, output_dir: str, columns: list[str]) -> dict[str, str]:
    """Ranked CSV, id lists (all, and per tier), JSON lines of all rows and
    of each tier (partitioned by tier)."""
    base = output_dir.rstrip("/")
    ranked = priority.orderBy("rank")
    paths = {
        "site_priority_csv": f"{base}/site_priority.csv",
        "ids": f"{base}/site_ids_priority_order",
        "ids_by_tier": f"{base}/site_ids_by_tier",
        "json": f"{base}/site_priority.json",
        "json_by_tier": f"{base}/site_priority_groups",
    }
    write_csv(ranked.select(*columns), paths["site_priority_csv"], sep=",", bom=True)
    ids = ranked.filter(F.col("site_id") != "")
    ids.select("site_id").write.mode("overwrite").text(paths["ids"])
    ids.select("tier", "site_id").write.mode("overwrite").partitionBy("tier").text(paths["ids_by_tier"])
    ranked.select(*columns).write.mode("overwrite").json(paths["json"])
    ranked.select("tier", *columns).write.mode("overwrite").partitionBy("tier").json(paths["json_by_tier"])
    return paths


def write_json_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def summary_dict(one_row: DataFrame) -> dict:
    """A one-row result as a plain dict (the only rows that reach the
    driver are such fixed-size summaries)."""
    row = one_row.first()
    return {} if row is None else json.loads(json.dumps(row.asDict(recursive=True), default=str))


def copy_raw_text(spark, source_path: str, target_path: str) -> None:
    """Keep a raw report verbatim (line by line, distributed)."""
    spark.read.text(source_path).write.mode("overwrite").text(target_path)
