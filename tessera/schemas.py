"""Catalogue table schemas (explicit, never inferred)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SITES = _struct(
    ("id", S, False), ("name", S, True), ("web_url", S, True), ("host_name", S, True),
    ("raw_json", S, True), ("discovered_at", S, False), ("processed_at", S, True),
)

DRIVES = _struct(
    ("id", S, False), ("site_id", S, False), ("name", S, True), ("drive_type", S, True),
    ("web_url", S, True), ("raw_json", S, True), ("discovered_at", S, False),
    ("processed_at", S, True),
)

ITEMS = _struct(
    ("id", S, False), ("drive_id", S, False), ("site_id", S, False), ("library_name", S, True),
    ("parent_id", S, True), ("parent_path", S, True), ("full_path", S, True), ("name", S, True),
    ("item_type", S, False), ("extension", S, True), ("mime_type", S, True),
    ("size_bytes", L, True), ("formatted_size", S, True), ("created_at", S, True),
    ("modified_at", S, True), ("last_accessed_at", S, True), ("file_count", L, True),
    ("folder_total_size_bytes", L, True), ("folder_total_size_formatted", S, True),
    ("web_url", S, True), ("raw_json", S, True), ("status", S, False), ("collected_at", S, False),
)
ITEM_KEY = ["drive_id", "id"]
# Columns an upsert never touches (they belong to the folder rollup).
ITEM_ROLLUP_COLUMNS = ["file_count", "folder_total_size_bytes", "folder_total_size_formatted"]

DRIVE_SYNC_STATE = _struct(
    ("drive_id", S, False), ("site_id", S, True), ("library_name", S, True), ("mode", S, True),
    ("status", S, False), ("attempts", I, True), ("next_link", S, True), ("delta_link", S, True),
    ("last_error", S, True), ("created_at", S, True), ("updated_at", S, True),
    ("last_started_at", S, True), ("last_completed_at", S, True),
)

ERRORS = _struct(
    ("id", L, True), ("entity_type", S, True), ("entity_id", S, True), ("drive_id", S, True),
    ("site_id", S, True), ("operation", S, True), ("status_code", I, True), ("message", S, True),
    ("retryable", B, True), ("resolved", B, True), ("created_at", S, True), ("updated_at", S, True),
)

SITE_STORAGE_METRICS = _struct(
    ("site_id", S, False), ("site_url", S, True), ("storage_used_bytes", L, True),
    ("version_count", L, True), ("version_size_bytes", L, True), ("status", S, True),
    ("message", S, True), ("collected_at", S, True),
)

RUNS = _struct(
    ("id", L, True), ("command", S, False), ("started_at", S, False), ("finished_at", S, True),
    ("status", S, False), ("stats_json", S, True),
)

# Storage-metric collector output (JSON objects; numbers may arrive as text).
STORAGE_METRIC_RESULT = _struct(
    ("site_id", S, True), ("site_url", S, True), ("status", S, True),
    ("storage_used_mb", S, True), ("version_count", S, True), ("version_size_bytes", S, True),
    ("message", S, True),
)

# The 22 inventory columns and the catalogue column each comes
# from, in output order.
INVENTORY_COLUMNS = [
    ("tenant_site", "s.host_name"),
    ("site_name", "s.name"),
    ("site_url", "s.web_url"),
    ("biblioteca", "d.name"),
    ("caminho_completo_da_pasta", "i.parent_path"),
    ("nome_arquivo_ou_pasta", "i.name"),
    ("tipo_item", "i.item_type"),
    ("extensao", "i.extension"),
    ("tipo_mime", "i.mime_type"),
    ("tamanho_bytes", "i.size_bytes"),
    ("tamanho_formatado", "i.formatted_size"),
    ("data_criacao", "i.created_at"),
    ("data_modificacao", "i.modified_at"),
    ("data_ultimo_uso_acesso", "i.last_accessed_at"),
    ("quantidade_arquivos_dentro_da_pasta", "i.file_count"),
    ("volume_total_pasta_bytes", "i.folder_total_size_bytes"),
    ("volume_total_pasta_formatado", "i.folder_total_size_formatted"),
    ("id_item", "i.id"),
    ("id_drive", "i.drive_id"),
    ("status_leitura", "i.status"),
    ("data_hora_coleta", "i.collected_at"),
    ("caminho_item", "i.full_path"),
]
INVENTORY_LONG_COLUMNS = ["tamanho_bytes", "quantidade_arquivos_dentro_da_pasta", "volume_total_pasta_bytes"]
INVENTORY = T.StructType(
    [
        T.StructField(name, L if name in INVENTORY_LONG_COLUMNS else S, True)
        for name, _ in INVENTORY_COLUMNS
    ]
)

# Usage-report columns of the ranked site list, in order.
PRIORITY_COLUMNS = [
    "rank", "site_id", "site_url", "owner", "last_activity_date", "file_count",
    "active_file_count", "storage_used_bytes", "storage_used_formatted",
    "storage_allocated_bytes", "storage_allocated_formatted", "root_web_template",
    "report_refresh_date", "report_period",
]


@dataclass(frozen=True)
class Catalog:
    """The catalogue tables one pipeline run works on."""

    sites: DataFrame
    drives: DataFrame
    items: DataFrame
