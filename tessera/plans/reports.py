"""Analytical reports over the inventory dataset (22 columns).

Three families, all plain aggregations/sorts over the Parquet inventory so
filters and column pruning reach the scan:

* client report — five CSV tables (site summary, extension summary, largest
  files, oldest files, full file list);
* profile — the exploratory quality/volume queries;
* dashboard — overview KPIs, top sites/extensions, unused files, chart ranks.

Top-k outputs sort on a total order (a unique key breaks ties), so the
k rows are well defined.  Every "today" is an explicit ``as_of`` date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import (
    bytes_to,
    display_site_name,
    format_size,
    label_or_default,
    parse_timestamp,
    percent_of,
    round_ratio,
    rounded_units,
    shorten_label,
    wide_sum,
)
from tessera.functions.sizes import BYTES_IN_GB, BYTES_IN_MB

# Report limits.
CLIENT_TOP_FILES = 1000
OLD_FILE_DAYS = 365
PROFILE_LATEST = 30
PROFILE_SAMPLE = 1000
PROFILE_TOP = 50
DASH_TOP_SITES = 25
DASH_TOP_EXTENSIONS = 20
DASH_UNUSED_SAMPLE = 100
DASH_CHART_TOP = 10

def _is_file() -> Column:
    return F.col("tipo_item") == "file"


def _is_folder() -> Column:
    return F.col("tipo_item") == "folder"


def _file_bytes() -> Column:
    return F.when(_is_file(), F.col("tamanho_bytes")).otherwise(F.lit(0))


def filter_sites(df: DataFrame, sites: Sequence[str] | DataFrame | None, column: str = "site_name", empty_means_all: bool = True) -> DataFrame:
    """Site-set filter: ``None`` → all rows; an empty set → all rows (dashboard)
    or no rows (catalogue, ``empty_means_all=False``); a list → ``isin``; a
    DataFrame of names → semi join (for sets too large to inline)."""
    if sites is None:
        return df
    if isinstance(sites, DataFrame):
        keys = sites.select(F.col(sites.columns[0]).alias(column)).distinct()
        return df.join(keys, column, "left_semi")
    sites = list(sites)
    if not sites:
        return df if empty_means_all else df.limit(0)
    return df.filter(F.col(column).isin(sites))


def _ext_label(col: str = "extensao") -> Column:
    return label_or_default(F.col(col))


def _older_than(col: str, cutoff: Column) -> Column:
    return parse_timestamp(col) < cutoff.cast("timestamp")


def _sum_long(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


# --------------------------------------------------------------------------- client report

def by_library(inv: DataFrame) -> DataFrame:
    """The inventory summed per site, library and drive: one pass with partial
    sums.  Distinct counts are then taken on these few rows, so no inventory
    row is copied once for each distinct column."""
    return inv.groupBy("site_name", "site_url", "biblioteca", "id_drive").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(_is_file()).alias("_files"),
        F.count_if(_is_folder()).alias("_folders"),
        F.sum(_file_bytes()).alias("_bytes"),
        F.min("data_modificacao").alias("_first"),
        F.max("data_modificacao").alias("_last"),
    )


def client_site_summary(inv: DataFrame) -> DataFrame:
    return (
        by_library(inv).groupBy("site_name", "site_url")
        .agg(
            F.countDistinct("biblioteca").alias("Bibliotecas"),
            F.sum("_files").alias("Arquivos"),
            F.sum("_folders").alias("Pastas"),
            _sum_long(F.col("_bytes")).alias("_bytes"),
            F.max("_last").alias("Ultima modificacao identificada"),
        )
        .select(
            F.col("site_name").alias("Site"), F.col("site_url").alias("URL do site"),
            "Bibliotecas", "Arquivos", "Pastas",
            round_ratio(F.col("_bytes"), BYTES_IN_GB, 2).alias("Armazenamento GB"),
            "Ultima modificacao identificada",
        )
        .orderBy(F.desc("Armazenamento GB"), "Site", "URL do site")
    )


def client_extension_summary(inv: DataFrame) -> DataFrame:
    n_sized = F.count("tamanho_bytes")
    return (
        inv.filter(_is_file())
        .groupBy(_ext_label().alias("Extensao"))
        .agg(
            F.count(F.lit(1)).alias("Arquivos"),
            F.sum("tamanho_bytes").alias("_sum"),
            n_sized.alias("_n"),
            F.max("tamanho_bytes").alias("_max"),
        )
        .select(
            "Extensao", "Arquivos",
            F.when(F.col("_sum").isNotNull(), round_ratio(F.col("_sum"), BYTES_IN_GB, 2)).alias("Armazenamento GB"),
            F.when(F.col("_n") > 0, round_ratio(F.col("_sum"), F.col("_n") * F.lit(BYTES_IN_MB), 2)).alias("Tamanho medio MB"),
            F.when(F.col("_max").isNotNull(), round_ratio(F.col("_max"), BYTES_IN_GB, 4)).alias("Maior arquivo GB"),
        )
        .orderBy(F.desc("Armazenamento GB"), F.desc("Arquivos"), "Extensao")
    )


def _file_brief(inv: DataFrame) -> DataFrame:
    return inv.select(
        F.col("site_name").alias("Site"), F.col("site_url").alias("URL do site"),
        F.col("biblioteca").alias("Biblioteca"), F.col("nome_arquivo_ou_pasta").alias("Arquivo"),
        _ext_label().alias("Extensao"), F.col("tamanho_formatado").alias("Tamanho"),
        rounded_units("tamanho_bytes", "GB", 4).alias("Tamanho GB"),
        F.col("data_modificacao").alias("Modificado em"), F.col("caminho_item").alias("Caminho completo"),
        "tamanho_bytes", "id_item",
    )


def client_largest_files(inv: DataFrame, limit: int = CLIENT_TOP_FILES) -> DataFrame:
    """Top-k by size: TakeOrderedAndProject keeps k rows per task, then
    merges, so no task sees more than its own input plus k rows."""
    return (
        _file_brief(inv.filter(_is_file()))
        .orderBy(F.desc_nulls_last("tamanho_bytes"), "id_item")
        .limit(limit)
        .drop("tamanho_bytes", "id_item")
    )


def client_old_files(inv: DataFrame, as_of, old_file_days: int = OLD_FILE_DAYS, limit: int = CLIENT_TOP_FILES) -> DataFrame:
    cutoff = F.date_sub(F.lit(as_of).cast("date"), old_file_days)
    return (
        _file_brief(inv.filter(_is_file() & _older_than("data_modificacao", cutoff)))
        .orderBy(F.desc_nulls_last("tamanho_bytes"), "id_item")
        .limit(limit)
        .drop("tamanho_bytes", "id_item")
    )


def client_file_rows(inv: DataFrame) -> DataFrame:
    """Every file, in no order."""
    return inv.filter(_is_file()).select(
        F.col("site_name").alias("Site"), F.col("site_url").alias("URL do site"),
        F.col("biblioteca").alias("Biblioteca"), F.col("caminho_completo_da_pasta").alias("Pasta"),
        F.col("nome_arquivo_ou_pasta").alias("Arquivo"), _ext_label().alias("Extensao"),
        F.col("tipo_mime").alias("Tipo MIME"), F.col("tamanho_formatado").alias("Tamanho"),
        rounded_units("tamanho_bytes", "MB", 2).alias("Tamanho MB"),
        rounded_units("tamanho_bytes", "GB", 4).alias("Tamanho GB"),
        F.col("data_criacao").alias("Criado em"), F.col("data_modificacao").alias("Modificado em"),
        F.col("data_ultimo_uso_acesso").alias("Ultimo acesso/uso"),
        F.col("caminho_item").alias("Caminho completo"), F.col("status_leitura").alias("Status da leitura"),
    )


def client_file_list(inv: DataFrame) -> DataFrame:
    """Every file, sorted by site, library, path (nulls last)."""
    return client_file_rows(inv).orderBy(
        F.asc_nulls_last("Site"), F.asc_nulls_last("Biblioteca"), F.asc_nulls_last("Caminho completo")
    )


def client_report(inv: DataFrame, as_of, old_file_days: int = OLD_FILE_DAYS) -> dict[str, DataFrame]:
    """The five client CSV tables, keyed by output file stem."""
    return {
        "01_resumo_por_site": client_site_summary(inv),
        "02_resumo_por_extensao": client_extension_summary(inv),
        "03_top_1000_maiores_arquivos": client_largest_files(inv),
        "04_top_1000_arquivos_antigos": client_old_files(inv, as_of, old_file_days),
        "05_inventario_arquivos_cliente": client_file_list(inv),
    }


# --------------------------------------------------------------------------- profile

def profile_sites(inv: DataFrame) -> DataFrame:
    return (
        inv.groupBy("site_name", "site_url", "tenant_site")
        .agg(
            F.countDistinct("biblioteca").alias("bibliotecas"),
            F.count_if(_is_file()).alias("arquivos"),
            F.count_if(_is_folder()).alias("pastas"),
            _sum_long(_file_bytes()).alias("total_bytes_arquivos"),
        )
        .withColumn("total_gb_arquivos", round_ratio(F.col("total_bytes_arquivos"), BYTES_IN_GB, 2))
        .orderBy(F.desc_nulls_last("total_bytes_arquivos"), F.asc_nulls_last("site_name"), "site_url")
    )


def profile_totals(inv: DataFrame) -> DataFrame:
    return by_library(inv).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_linhas"),
        F.coalesce(F.sum("_files"), F.lit(0)).alias("arquivos"),
        F.coalesce(F.sum("_folders"), F.lit(0)).alias("pastas"),
        F.countDistinct("site_url").alias("sites"),
        F.countDistinct("id_drive").alias("drives"),
        F.countDistinct("biblioteca").alias("bibliotecas"),
        F.sum("_bytes").cast("long").alias("total_bytes_arquivos"),
        F.min("_first").alias("menor_data_modificacao"),
        F.max("_last").alias("maior_data_modificacao"),
    )


def profile_type_status(inv: DataFrame) -> DataFrame:
    return (
        inv.groupBy("tipo_item", "status_leitura")
        .agg(F.count(F.lit(1)).alias("quantidade"))
        .orderBy(F.asc_nulls_last("tipo_item"), F.asc_nulls_last("status_leitura"))
    )


PROFILE_SAMPLE_COLUMNS = [
    "site_name", "biblioteca", "caminho_item", "nome_arquivo_ou_pasta", "tipo_item", "extensao",
    "tipo_mime", "tamanho_bytes", "data_criacao", "data_modificacao", "data_ultimo_uso_acesso",
    "caminho_completo_da_pasta",
]


def profile_latest_files(inv: DataFrame, limit: int = PROFILE_LATEST, columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns) if columns else PROFILE_SAMPLE_COLUMNS
    return (
        inv.filter(_is_file())
        .orderBy(F.desc_nulls_last("data_modificacao"), "id_drive", "id_item")
        .limit(limit)
        .select(*cols)
    )


def profile_sample(inv: DataFrame, limit: int = PROFILE_SAMPLE) -> DataFrame:
    return profile_latest_files(inv, limit, inv.columns)


def profile_extensions(inv: DataFrame, limit: int = PROFILE_TOP) -> DataFrame:
    return (
        inv.filter(_is_file())
        .groupBy(_ext_label().alias("extensao"))
        .agg(F.count(F.lit(1)).alias("arquivos"), F.sum("tamanho_bytes").cast("long").alias("total_bytes"))
        .withColumn("total_gb", F.when(F.col("total_bytes").isNotNull(), round_ratio(F.col("total_bytes"), BYTES_IN_GB, 2)))
        .orderBy(F.desc("arquivos"), "extensao")
        .limit(limit)
    )


def profile_libraries(inv: DataFrame, limit: int = PROFILE_TOP) -> DataFrame:
    return (
        inv.filter(_is_file())
        .groupBy("site_name", "site_url", "biblioteca")
        .agg(F.count(F.lit(1)).alias("arquivos"), F.sum("tamanho_bytes").cast("long").alias("total_bytes"))
        .withColumn("total_gb", F.when(F.col("total_bytes").isNotNull(), round_ratio(F.col("total_bytes"), BYTES_IN_GB, 2)))
        .orderBy(F.desc_nulls_last("total_bytes"), F.asc_nulls_last("site_url"), F.asc_nulls_last("biblioteca"))
        .limit(limit)
    )


def profile_folders(inv: DataFrame, limit: int = PROFILE_TOP) -> DataFrame:
    return (
        inv.filter(_is_folder())
        .orderBy(F.desc_nulls_last("volume_total_pasta_bytes"), "id_drive", "id_item")
        .limit(limit)
        .select(
            "site_name", "site_url", "biblioteca", F.col("caminho_item").alias("pasta"),
            F.col("quantidade_arquivos_dentro_da_pasta").alias("arquivos_na_pasta"),
            "volume_total_pasta_bytes",
            F.when(
                F.col("volume_total_pasta_bytes").isNotNull(),
                round_ratio(F.col("volume_total_pasta_bytes"), BYTES_IN_GB, 2),
            ).alias("total_gb"),
            "data_modificacao",
        )
    )


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def profile_missing(inv: DataFrame) -> DataFrame:
    return inv.filter(_is_file()).agg(
        F.count(F.lit(1)).alias("arquivos"),
        F.count_if(_blank("data_ultimo_uso_acesso")).alias("sem_ultimo_acesso"),
        F.count_if(_blank("data_modificacao")).alias("sem_data_modificacao"),
        F.min("data_modificacao").alias("menor_data_modificacao"),
        F.max("data_modificacao").alias("maior_data_modificacao"),
    )


# --------------------------------------------------------------------------- dashboard

def dash_site_names(inv: DataFrame) -> DataFrame:
    return (
        inv.select("site_name")
        .filter(F.col("site_name").isNotNull() & (F.col("site_name") != ""))
        .distinct()
        .orderBy("site_name")
    )


def dash_overview(inv: DataFrame, sites=None) -> DataFrame:
    per_library = filter_sites(inv, sites).groupBy("site_url", "biblioteca").agg(
        F.count_if(_is_file()).alias("_files"), F.count_if(_is_folder()).alias("_folders"), F.sum(_file_bytes()).alias("_bytes")
    )
    return per_library.agg(
        F.countDistinct("site_url").alias("sites"),
        F.countDistinct("biblioteca").alias("libraries"),
        _sum_long(F.col("_files")).alias("files"),
        _sum_long(F.col("_folders")).alias("folders"),
        _sum_long(F.col("_bytes")).alias("total_bytes"),
    )


def dash_top_sites(inv: DataFrame, sites=None, limit: int = DASH_TOP_SITES) -> DataFrame:
    df = filter_sites(inv, sites)
    return (
        df.groupBy("site_name", "site_url")
        .agg(F.count_if(_is_file()).alias("file_count"), _sum_long(_file_bytes()).alias("storage_bytes"))
        .orderBy(F.desc("storage_bytes"), F.asc_nulls_last("site_name"), F.asc_nulls_last("site_url"))
        .limit(limit)
        .withColumn("storage_gb", bytes_to("storage_bytes", "GB"))
    )


def dash_top_extensions(inv: DataFrame, sites=None, limit: int = DASH_TOP_EXTENSIONS) -> DataFrame:
    df = filter_sites(inv.filter(_is_file()), sites)
    return (
        df.groupBy(_ext_label().alias("extension"))
        .agg(F.count(F.lit(1)).alias("file_count"), _sum_long(F.col("tamanho_bytes")).alias("storage_bytes"))
        .orderBy(F.desc("storage_bytes"), "extension")
        .limit(limit)
        .withColumn("storage_gb", bytes_to("storage_bytes", "GB"))
    )


def dash_extension_table(top_extensions: DataFrame) -> DataFrame:
    """Share of the listed (top-k) extensions' total.  The window has no
    partition key but runs over the k-row result of the limit."""
    total = F.sum(F.col("storage_bytes").cast("decimal(38,0)")).over(Window.partitionBy())
    return top_extensions.select(
        "extension",
        round_ratio(F.col("storage_bytes"), BYTES_IN_GB, 2, half_even=True).alias("storage_gb"),
        F.when(total > 0, percent_of("storage_bytes", total, 2))
        .otherwise(F.lit(0.0)).alias("storage_percent"),
        "file_count",
        F.when(F.col("file_count") > 0, round_ratio(F.col("storage_bytes"), F.col("file_count") * F.lit(BYTES_IN_MB), 2, half_even=True))
        .otherwise(F.lit(0.0)).alias("avg_file_size_mb"),
    )


def unused_cutoff(as_of) -> Column:
    """One calendar year before ``as_of``."""
    return F.add_months(F.lit(as_of).cast("date"), -12)


def _unused(inv: DataFrame, as_of, sites) -> DataFrame:
    return filter_sites(inv.filter(_is_file() & _older_than("data_modificacao", unused_cutoff(as_of))), sites)


def dash_unused_by_site(inv: DataFrame, as_of, sites=None, limit: int = DASH_TOP_SITES) -> DataFrame:
    return (
        _unused(inv, as_of, sites)
        .groupBy("site_name", "site_url")
        .agg(F.count(F.lit(1)).alias("old_file_count"), _sum_long(F.col("tamanho_bytes")).alias("storage_bytes"))
        .orderBy(F.desc("storage_bytes"), F.asc_nulls_last("site_name"), F.asc_nulls_last("site_url"))
        .limit(limit)
        .withColumn("storage_gb", bytes_to("storage_bytes", "GB"))
    )


def dash_unused_sample(inv: DataFrame, as_of, sites=None, limit: int = DASH_UNUSED_SAMPLE) -> DataFrame:
    return (
        _unused(inv, as_of, sites)
        .orderBy(F.desc_nulls_last("tamanho_bytes"), "id_item")
        .limit(limit)
        .select(
            "site_name", "biblioteca", "nome_arquivo_ou_pasta", "extensao", "tamanho_bytes",
            "data_modificacao", "caminho_item", bytes_to("tamanho_bytes", "GB").alias("storage_gb"),
        )
    )


def dash_unused_kpis(inv: DataFrame, as_of, sites=None) -> DataFrame:
    """Unused bytes/files and their share of all file bytes, over every row
    (not just the listed top sites), in one aggregation pass."""
    df = filter_sites(inv, sites)
    old = _is_file() & _older_than("data_modificacao", unused_cutoff(as_of))
    agg = df.agg(
        _sum_long(F.when(old, F.col("tamanho_bytes")).otherwise(F.lit(0))).alias("unused_bytes"),
        F.count_if(old).alias("unused_files"),
        wide_sum(_file_bytes().cast("long")).alias("total_bytes"),
    )
    return agg.select(
        "unused_bytes", "unused_files",
        F.when(F.col("total_bytes") > 0, percent_of("unused_bytes", F.col("total_bytes"), 2))
        .otherwise(F.lit(0.0)).alias("unused_percent"),
    )


def site_chart(ranked: DataFrame, value_col: str = "storage_bytes", limit: int = DASH_CHART_TOP) -> DataFrame:
    """Top sites for a bar chart: rank 1..k and a ``'01. name'`` label built
    from the display name (falls back to the URL) shortened to 32 chars."""
    top = ranked.orderBy(F.desc(value_col), F.asc_nulls_last("site_name"), F.asc_nulls_last("site_url")).limit(limit)
    w = Window.orderBy(F.desc(value_col), F.asc_nulls_last("site_name"), F.asc_nulls_last("site_url"))
    return top.select(
        "*",
        F.row_number().over(w).cast("long").alias("rank"),
        display_site_name("site_name", "site_url").alias("site_display_name"),
    ).withColumn(
        "site_label", F.format_string("%02d. %s", F.col("rank"), shorten_label("site_display_name"))
    )


def gold_totals(storage_kpis: DataFrame) -> DataFrame:
    return storage_kpis.agg(
        F.sum("storage_gb").alias("storage_gb"),
        F.countDistinct("site_name").alias("sites"),
        F.sum("total_files").alias("files"),
        F.sum("archive_candidate_gb").alias("archive_candidate_gb"),
    )
