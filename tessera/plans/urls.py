"""URL profile: normalised URL, host, last path segment, display label and
the file extension of the path — the URL helpers applied to a URL column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import (
    display_site_name,
    extension_from_name,
    last_path_segment,
    normalize_url,
    shorten_label,
    url_netloc,
)


def url_profile(df: DataFrame, url_col: str = "url", name_col: str | None = None) -> DataFrame:
    name = F.col(name_col) if name_col else F.lit(None).cast("string")
    seg = last_path_segment(url_col)
    display = display_site_name(name, F.col(url_col))
    return df.select(
        "*",
        normalize_url(url_col).alias("normalized_url"),
        url_netloc(url_col).alias("host"),
        seg.alias("path_segment"),
        extension_from_name(seg).alias("path_extension"),
        display.alias("display_name"),
        shorten_label(display).alias("label"),
    )


def host_summary(profile: DataFrame) -> DataFrame:
    return profile.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.countDistinct("normalized_url").alias("distinct_urls"),
        F.count_if(F.col("path_extension").isNotNull()).alias("pages_with_extension"),
    )
