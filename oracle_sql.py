"""DuckDB oracle SQL for every registered query.

The catalogue tables are derived from the driver's test tables with the same
fixed rules as ``tessera.sources.testdata``, restated here in SQL, so each
query can be checked by an independent engine.  Money-like outputs are byte
totals converted once (exact doubles); every rounded value is computed in
integer arithmetic with the same rule the engine uses.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-01'"

# --------------------------------------------------------------------------- SQL builders


def q_round(num: str, den: str, scale: int, half_even: bool) -> str:
    """Integer round(num * 10^scale / den) for num >= 0 (HUGEINT)."""
    m = f"(CAST({num} AS HUGEINT) * {10**scale})"
    d = f"CAST({den} AS HUGEINT)"
    q = f"({m} // {d})"
    r = f"({m} % {d})"
    tie = f"(2 * {r} = {d}{' AND ' + q + ' % 2 = 1' if half_even else ''})"
    return f"({q} + CASE WHEN 2 * {r} > {d} OR {tie} THEN 1 ELSE 0 END)"


def round_ratio(num: str, den: str, scale: int = 2, half_even: bool = False) -> str:
    mag = f"abs(CAST({num} AS HUGEINT))"
    q = q_round(mag, den, scale, half_even)
    return f"(CASE WHEN CAST({num} AS HUGEINT) < 0 THEN -1 ELSE 1 END * CAST({q} AS DOUBLE) / {float(10**scale)})"


def fixed2(q: str) -> str:
    return f"(CAST({q} // 100 AS VARCHAR) || '.' || lpad(CAST({q} % 100 AS VARCHAR), 2, '0'))"


def fmt_size(x: str) -> str:
    units = ["KB", "MB", "GB", "TB", "PB"]
    parts = [f"WHEN {x} IS NULL OR {x} = 0 THEN '0 B'", f"WHEN {x} < 1024 THEN CAST({x} AS VARCHAR) || ' B'"]
    for k, unit in enumerate(units, start=1):
        rendered = fixed2(q_round(x, str(1024**k), 2, True)) + f" || ' {unit}'"
        if unit == "PB":
            parts.append(f"ELSE {rendered}")
        else:
            parts.append(f"WHEN {x} < {1024 ** (k + 1)} THEN {rendered}")
    return "(CASE " + " ".join(parts) + " END)"


def gb(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 1073741824.0)"


def mb(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 1048576.0)"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# --------------------------------------------------------------------------- catalogue CTEs

SITES = """
sites AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id,
         CASE WHEN s_suppkey % 17 = 0 THEN NULL WHEN s_suppkey % 23 = 0 THEN '' ELSE s_name END AS name,
         'https://h.example/sites/' || CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '' END AS web_url,
         'h.example' AS host_name,
         '2001-01-01T00:00:00Z' AS discovered_at,
         CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE '2001-01-02T00:00:00Z' END AS processed_at
  FROM supplier
)"""

DRIVES = """
drives AS (
  SELECT CAST(s_suppkey AS VARCHAR) || '-' || f.flag AS id, CAST(s_suppkey AS VARCHAR) AS site_id, f.flag AS name,
         CASE WHEN f.flag = 'R' THEN 'Business' ELSE 'documentLibrary' END AS drive_type,
         'https://h.example/sites/' || CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '' END || '/' || f.flag AS web_url,
         '2001-01-01T00:00:00Z' AS discovered_at,
         CASE WHEN f.flag = 'N' THEN NULL ELSE '2001-01-02T00:00:00Z' END AS processed_at
  FROM supplier CROSS JOIN (VALUES ('A'), ('N'), ('R')) f(flag)
)"""

_FILE_BASE = """
geo AS (
  SELECT s.s_suppkey, s.s_nationkey, n.n_regionkey FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
),
fx AS (
  SELECT l.*, p.p_name, o.o_orderdate, g.s_nationkey, g.n_regionkey,
         (['docx','PDF','png','mp4','zip','exe','xyz',''])[CAST(split_part(p.p_brand, '#', 2) AS INTEGER) % 8 + 1] AS ext,
         l.l_returnflag || '/R' || CAST(g.n_regionkey AS VARCHAR) || '/N' || CAST(g.s_nationkey AS VARCHAR) || '/S' || CAST(l.l_suppkey AS VARCHAR) AS ppath,
         CASE WHEN l.l_quantity = 1 THEN 0 ELSE CAST(floor(l.l_extendedprice) AS BIGINT) * 1048576 END AS sz,
         CASE WHEN l.l_linenumber = 7 AND l.l_partkey % 5 = 0 THEN NULL
              WHEN l.l_suppkey % 5 = 0 THEN l.l_shipdate - INTERVAL 1 YEAR ELSE l.l_shipdate END AS mts
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
       JOIN geo g ON g.s_suppkey = l.l_suppkey
),
file_items AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id,
         CAST(l_suppkey AS VARCHAR) || '-' || l_returnflag AS drive_id,
         CAST(l_suppkey AS VARCHAR) AS site_id,
         l_returnflag AS library_name,
         'S' || CAST(l_suppkey AS VARCHAR) AS parent_id,
         ppath AS parent_path,
         ppath || '/' || CASE WHEN ext = '' THEN p_name ELSE p_name || '.' || ext END AS full_path,
         CASE WHEN ext = '' THEN p_name ELSE p_name || '.' || ext END AS name,
         'file' AS item_type,
         CASE WHEN ext = '' THEN NULL ELSE lower(ext) END AS extension,
         CASE WHEN ext = '' THEN NULL WHEN lower(ext) = 'png' THEN 'image/png' WHEN lower(ext) = 'mp4' THEN 'video/mp4'
              ELSE 'application/' || lower(ext) END AS mime_type,
         sz AS size_bytes,
         FMT_SZ AS formatted_size,
         ISO_ORDER AS created_at,
         ISO_MTS AS modified_at,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber = 1 THEN '' ELSE ISO_SHIP END AS last_accessed_at,
         CAST(0 AS BIGINT) AS file_count,
         CAST(0 AS BIGINT) AS folder_total_size_bytes,
         CAST(NULL AS VARCHAR) AS folder_total_size_formatted,
         'https://h.example/items/' || concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS web_url,
         CASE WHEN l_tax = 0 THEN 'deleted' ELSE 'ok' END AS status,
         '2001-12-01T00:00:00Z' AS collected_at
  FROM fx
)""".replace("FMT_SZ", fmt_size("sz")).replace("ISO_ORDER", iso("o_orderdate")).replace(
    "ISO_MTS", iso("mts")
).replace("ISO_SHIP", iso("l_shipdate"))

_FOLDERS = """
fgeo AS (
  SELECT g.*, f.flag, CAST(g.s_suppkey AS VARCHAR) AS site_id,
         'R' || CAST(g.n_regionkey AS VARCHAR) AS r, 'N' || CAST(g.s_nationkey AS VARCHAR) AS n,
         'S' || CAST(g.s_suppkey AS VARCHAR) AS s
  FROM geo g CROSS JOIN (VALUES ('A'), ('N'), ('R')) f(flag)
),
folder_levels AS (
  SELECT site_id, flag, 'T' AS id, CAST(NULL AS VARCHAR) AS parent_id, '' AS parent_path, flag AS name, false AS gone FROM fgeo
  UNION ALL SELECT site_id, flag, r, 'T', flag, r, false FROM fgeo
  UNION ALL SELECT site_id, flag, n, r, flag || '/' || r, n, s_nationkey % 7 = 3 FROM fgeo
  UNION ALL SELECT site_id, flag, s, n, flag || '/' || r || '/' || n, s, false FROM fgeo
),
folder_items AS (
  SELECT id, site_id || '-' || flag AS drive_id, site_id, flag AS library_name, parent_id, parent_path,
         CASE WHEN parent_path = '' THEN name ELSE parent_path || '/' || name END AS full_path,
         name, 'folder' AS item_type, CAST(NULL AS VARCHAR) AS extension, CAST(NULL AS VARCHAR) AS mime_type,
         CAST(0 AS BIGINT) AS size_bytes, '0 B' AS formatted_size, CAST(NULL AS VARCHAR) AS created_at,
         CAST(NULL AS VARCHAR) AS modified_at, CAST(NULL AS VARCHAR) AS last_accessed_at,
         CAST(0 AS BIGINT) AS file_count, CAST(0 AS BIGINT) AS folder_total_size_bytes,
         CAST(NULL AS VARCHAR) AS folder_total_size_formatted, CAST(NULL AS VARCHAR) AS web_url,
         CASE WHEN gone THEN 'deleted' ELSE 'ok' END AS status, '2001-12-01T00:00:00Z' AS collected_at
  FROM folder_levels
),
items AS (SELECT * FROM file_items UNION ALL SELECT * FROM folder_items)"""

ITEMS = _FILE_BASE + "," + _FOLDERS

SILVER = """
silver_sites AS (
  SELECT id AS site_id, trim(coalesce(name, '(sem nome)')) AS site_name, trim(coalesce(web_url, '')) AS site_url
  FROM sites
),
silver_drives AS (
  SELECT id AS drive_id, trim(coalesce(name, '(sem nome)')) AS drive_name, lower(trim(coalesce(drive_type, 'unknown'))) AS drive_type
  FROM drives
),
silver_files AS (
  SELECT f.id AS file_id, f.drive_id, f.site_id, s.site_name, s.site_url, d.drive_name, d.drive_type,
         trim(coalesce(f.library_name, '(sem biblioteca)')) AS library_name, f.parent_id, f.parent_path, f.full_path,
         trim(coalesce(f.name, '(sem nome)')) AS file_name,
         ltrim(trim(lower(coalesce(f.extension, ''))), '.') AS extension,
         f.mime_type, coalesce(f.size_bytes, 0) AS size_bytes,
         TRY_CAST(f.created_at AS TIMESTAMP) AS created_at, TRY_CAST(f.modified_at AS TIMESTAMP) AS modified_at,
         TRY_CAST(f.last_accessed_at AS TIMESTAMP) AS last_accessed_at,
         CAST(date_diff('day', CAST(TRY_CAST(f.modified_at AS TIMESTAMP) AS DATE), AS_OF) AS INTEGER) AS days_since_modified,
         f.web_url, f.status, TRY_CAST(f.collected_at AS TIMESTAMP) AS collected_at
  FROM items f LEFT JOIN silver_sites s ON s.site_id = f.site_id LEFT JOIN silver_drives d ON d.drive_id = f.drive_id
  WHERE f.item_type = 'file' AND coalesce(f.status, '') <> 'deleted'
),
silver_files2 AS (
  SELECT *,
    CASE WHEN days_since_modified IS NULL THEN 'Unknown' WHEN days_since_modified <= 90 THEN 'Active'
         WHEN days_since_modified <= 180 THEN 'Low Usage' WHEN days_since_modified <= 365 THEN 'Unused'
         ELSE 'Archive Candidate' END AS usage_status,
    CASE WHEN extension IN ('doc','docm','docx','dot','dotm','dotx','odp','ods','odt','one','pdf','pot','potm','potx','pps','ppsm','ppsx','ppt','pptm','pptx','rtf','xls','xlsb','xlsm','xlsx') THEN 'Office Documents'
         WHEN extension IN ('ai','bmp','gif','heic','heif','ico','jpeg','jpg','png','psd','svg','tif','tiff','webp') THEN 'Images'
         WHEN extension IN ('avi','flv','m4v','mkv','mov','mp4','mpeg','mpg','ts','webm','wmv') THEN 'Videos'
         WHEN extension IN ('7z','bz2','gz','rar','tar','tgz','xz','zip') THEN 'Archives'
         WHEN extension IN ('app','bat','bin','cmd','com','dll','dmg','exe','msi','ps1','sh') THEN 'Executables'
         ELSE 'Other' END AS extension_category
  FROM silver_files
),
gold_in AS (
  SELECT coalesce(site_name, '(sem nome)') AS site_name,
         CASE WHEN extension = '' THEN '(sem extensao)' ELSE extension END AS extension,
         extension_category, file_id, file_name, size_bytes, days_since_modified, usage_status
  FROM silver_files2
),
site_stats AS (
  SELECT site_name, count(file_id) AS total_files, count(*) AS n_rows, CAST(sum(size_bytes) AS BIGINT) AS b,
         CAST(sum(CASE WHEN usage_status = 'Archive Candidate' THEN size_bytes ELSE 0 END) AS BIGINT) AS ab,
         min(days_since_modified) AS min_days
  FROM gold_in GROUP BY site_name
),
kpis AS (
  SELECT site_name, total_files, GB_B AS storage_gb, MB_B / n_rows AS avg_file_size_mb, GB_AB AS archive_candidate_gb,
         CASE WHEN b = 0 THEN 0.0 ELSE GB_AB / GB_B * 100.0 END AS archive_candidate_pct, min_days
  FROM site_stats
)""".replace("AS_OF", AS_OF).replace("GB_B", gb("b")).replace("MB_B", mb("b")).replace("GB_AB", gb("ab"))


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n"


LAKEHOUSE = with_(SITES, DRIVES, ITEMS, SILVER)

QUERIES: dict[str, str] = {}

QUERIES["storage_kpis"] = LAKEHOUSE + """
SELECT site_name, total_files, storage_gb, avg_file_size_mb, archive_candidate_gb, archive_candidate_pct FROM kpis"""

QUERIES["top_sites"] = LAKEHOUSE + "SELECT site_name, storage_gb, total_files AS file_count FROM kpis"

QUERIES["storage_savings"] = LAKEHOUSE + """
SELECT site_name, storage_gb AS current_storage_gb, archive_candidate_gb, archive_candidate_pct AS estimated_saving_pct FROM kpis"""

QUERIES["inactive_sites"] = LAKEHOUSE + """
SELECT site_name, min_days AS days_since_last_activity, storage_gb FROM kpis WHERE min_days > 180"""

QUERIES["top_extensions"] = LAKEHOUSE + f"""
SELECT extension, extension_category, {gb('CAST(sum(size_bytes) AS BIGINT)')} AS storage_gb, count(file_id) AS file_count
FROM gold_in GROUP BY extension, extension_category"""

QUERIES["archive_candidates"] = LAKEHOUSE + f"""
SELECT site_name, file_name, extension, {gb('size_bytes')} AS size_gb, days_since_modified
FROM gold_in WHERE usage_status = 'Archive Candidate'"""


# --------------------------------------------------------------------------- hierarchy & inventory

ROLLUP = """
live_folders AS (SELECT drive_id, id, parent_id FROM items WHERE item_type = 'folder' AND status <> 'deleted'),
walk(drive_id, folder_id, n, b) AS (
  SELECT f.drive_id, f.parent_id, CAST(1 AS BIGINT), f.size_bytes
  FROM items f JOIN live_folders p ON p.drive_id = f.drive_id AND p.id = f.parent_id
  WHERE f.item_type = 'file' AND f.status <> 'deleted'
  UNION ALL
  SELECT w.drive_id, c.parent_id, w.n, w.b
  FROM walk w JOIN live_folders c ON c.drive_id = w.drive_id AND c.id = w.folder_id
       JOIN live_folders p ON p.drive_id = c.drive_id AND p.id = c.parent_id
),
folder_tot AS (SELECT drive_id, folder_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(b) AS BIGINT) AS b FROM walk GROUP BY drive_id, folder_id),
folder_final AS (
  SELECT lf.drive_id, lf.id, coalesce(t.n, 0) AS file_count, coalesce(t.b, 0) AS folder_total_size_bytes
  FROM live_folders lf LEFT JOIN folder_tot t ON t.drive_id = lf.drive_id AND t.folder_id = lf.id
),
rolled AS (
  SELECT i.id, i.drive_id, i.site_id, i.library_name, i.parent_id, i.parent_path, i.full_path, i.name, i.item_type,
         i.extension, i.mime_type, i.size_bytes, i.formatted_size, i.created_at, i.modified_at, i.last_accessed_at,
         coalesce(ff.file_count, i.file_count) AS file_count,
         coalesce(ff.folder_total_size_bytes, i.folder_total_size_bytes) AS folder_total_size_bytes,
         CASE WHEN ff.id IS NULL THEN i.folder_total_size_formatted ELSE FMT_FF END AS folder_total_size_formatted,
         i.web_url, i.status, i.collected_at
  FROM items i LEFT JOIN folder_final ff ON ff.drive_id = i.drive_id AND ff.id = i.id AND i.item_type = 'folder'
)""".replace("FMT_FF", fmt_size("ff.folder_total_size_bytes"))


def _inv(name: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT s.host_name AS tenant_site, s.name AS site_name, s.web_url AS site_url, d.name AS biblioteca,
         i.parent_path AS caminho_completo_da_pasta, i.name AS nome_arquivo_ou_pasta, i.item_type AS tipo_item,
         i.extension AS extensao, i.mime_type AS tipo_mime, i.size_bytes AS tamanho_bytes,
         i.formatted_size AS tamanho_formatado, i.created_at AS data_criacao, i.modified_at AS data_modificacao,
         i.last_accessed_at AS data_ultimo_uso_acesso, i.file_count AS quantidade_arquivos_dentro_da_pasta,
         i.folder_total_size_bytes AS volume_total_pasta_bytes,
         i.folder_total_size_formatted AS volume_total_pasta_formatado, i.id AS id_item, i.drive_id AS id_drive,
         i.status AS status_leitura, i.collected_at AS data_hora_coleta, i.full_path AS caminho_item
  FROM {src} i JOIN sites s ON s.id = i.site_id JOIN drives d ON d.id = i.drive_id
  WHERE i.status <> 'deleted'
)"""


INV = with_(SITES, DRIVES, ITEMS, _inv("inv", "items"))
INV_ROLLED = with_(SITES, DRIVES, ITEMS, ROLLUP, _inv("inv", "rolled"))
ROLLED = with_(SITES, DRIVES, ITEMS, ROLLUP)

QUERIES["folder_rollup"] = ROLLED + f"""
SELECT ff.drive_id, ff.id, i.full_path, ff.file_count, ff.folder_total_size_bytes,
       {fmt_size('ff.folder_total_size_bytes')} AS folder_total_size_formatted
FROM folder_final ff JOIN items i ON i.drive_id = ff.drive_id AND i.id = ff.id AND i.item_type = 'folder'"""

QUERIES["inventory"] = INV_ROLLED + "SELECT * FROM inv"

FILE_BYTES = "CASE WHEN tipo_item = 'file' THEN tamanho_bytes ELSE 0 END"
EXT_LABEL = "coalesce(nullif(extensao, ''), '(sem extensao)')"

QUERIES["client_site_summary"] = INV + f"""
SELECT site_name AS "Site", site_url AS "URL do site", count(DISTINCT biblioteca) AS "Bibliotecas",
       count(*) FILTER (WHERE tipo_item = 'file') AS "Arquivos", count(*) FILTER (WHERE tipo_item = 'folder') AS "Pastas",
       {round_ratio(f'coalesce(sum({FILE_BYTES}), 0)', '1073741824', 2)} AS "Armazenamento GB",
       max(data_modificacao) AS "Ultima modificacao identificada"
FROM inv GROUP BY site_name, site_url"""

QUERIES["client_extension_summary"] = INV + f"""
SELECT {EXT_LABEL} AS "Extensao", count(*) AS "Arquivos",
       {round_ratio('sum(tamanho_bytes)', '1073741824', 2)} AS "Armazenamento GB",
       {round_ratio('sum(tamanho_bytes)', 'count(tamanho_bytes) * 1048576', 2)} AS "Tamanho medio MB",
       {round_ratio('max(tamanho_bytes)', '1073741824', 4)} AS "Maior arquivo GB"
FROM inv WHERE tipo_item = 'file' GROUP BY 1"""

BRIEF = f"""site_name AS "Site", site_url AS "URL do site", biblioteca AS "Biblioteca", nome_arquivo_ou_pasta AS "Arquivo",
       {EXT_LABEL} AS "Extensao", tamanho_formatado AS "Tamanho", {round_ratio('tamanho_bytes', '1073741824', 4)} AS "Tamanho GB",
       data_modificacao AS "Modificado em", caminho_item AS "Caminho completo\""""

QUERIES["client_largest_files"] = INV + f"""
SELECT {BRIEF} FROM inv WHERE tipo_item = 'file' ORDER BY tamanho_bytes DESC NULLS LAST, id_item LIMIT 1000"""

QUERIES["client_old_files"] = INV + f"""
SELECT {BRIEF} FROM inv
WHERE tipo_item = 'file' AND TRY_CAST(data_modificacao AS TIMESTAMP) < CAST({AS_OF} - INTERVAL 365 DAY AS TIMESTAMP)
ORDER BY tamanho_bytes DESC NULLS LAST, id_item LIMIT 1000"""

QUERIES["client_file_list"] = INV + f"""
SELECT site_name AS "Site", site_url AS "URL do site", biblioteca AS "Biblioteca", caminho_completo_da_pasta AS "Pasta",
       nome_arquivo_ou_pasta AS "Arquivo", {EXT_LABEL} AS "Extensao", tipo_mime AS "Tipo MIME",
       tamanho_formatado AS "Tamanho", {round_ratio('tamanho_bytes', '1048576', 2)} AS "Tamanho MB",
       {round_ratio('tamanho_bytes', '1073741824', 4)} AS "Tamanho GB", data_criacao AS "Criado em",
       data_modificacao AS "Modificado em", data_ultimo_uso_acesso AS "Ultimo acesso/uso",
       caminho_item AS "Caminho completo", status_leitura AS "Status da leitura"
FROM inv WHERE tipo_item = 'file'"""

QUERIES["profile_sites"] = INV + f"""
SELECT site_name, site_url, tenant_site, count(DISTINCT biblioteca) AS bibliotecas,
       count_if(tipo_item = 'file') AS arquivos, count_if(tipo_item = 'folder') AS pastas,
       CAST(coalesce(sum({FILE_BYTES}), 0) AS BIGINT) AS total_bytes_arquivos,
       {round_ratio(f'coalesce(sum({FILE_BYTES}), 0)', '1073741824', 2)} AS total_gb_arquivos
FROM inv GROUP BY site_name, site_url, tenant_site"""

QUERIES["profile_totals"] = INV + f"""
SELECT count(*) AS total_linhas, count_if(tipo_item = 'file') AS arquivos, count_if(tipo_item = 'folder') AS pastas,
       count(DISTINCT site_url) AS sites, count(DISTINCT id_drive) AS drives, count(DISTINCT biblioteca) AS bibliotecas,
       CAST(sum({FILE_BYTES}) AS BIGINT) AS total_bytes_arquivos,
       min(data_modificacao) AS menor_data_modificacao, max(data_modificacao) AS maior_data_modificacao
FROM inv"""

QUERIES["profile_type_status"] = INV + """
SELECT tipo_item, status_leitura, count(*) AS quantidade FROM inv GROUP BY tipo_item, status_leitura"""

QUERIES["profile_latest_files"] = INV + """
SELECT site_name, biblioteca, caminho_item, nome_arquivo_ou_pasta, tipo_item, extensao, tipo_mime, tamanho_bytes,
       data_criacao, data_modificacao, data_ultimo_uso_acesso, caminho_completo_da_pasta
FROM inv WHERE tipo_item = 'file' ORDER BY data_modificacao DESC NULLS LAST, id_drive, id_item LIMIT 30"""

QUERIES["profile_sample"] = INV + """
SELECT * FROM inv WHERE tipo_item = 'file' ORDER BY data_modificacao DESC NULLS LAST, id_drive, id_item LIMIT 1000"""

QUERIES["profile_extensions"] = INV + f"""
SELECT {EXT_LABEL} AS extensao, count(*) AS arquivos, CAST(sum(tamanho_bytes) AS BIGINT) AS total_bytes,
       {round_ratio('sum(tamanho_bytes)', '1073741824', 2)} AS total_gb
FROM inv WHERE tipo_item = 'file' GROUP BY 1 ORDER BY arquivos DESC, extensao LIMIT 50"""

QUERIES["profile_libraries"] = INV + f"""
SELECT site_name, site_url, biblioteca, count(*) AS arquivos, CAST(sum(tamanho_bytes) AS BIGINT) AS total_bytes,
       {round_ratio('sum(tamanho_bytes)', '1073741824', 2)} AS total_gb
FROM inv WHERE tipo_item = 'file' GROUP BY site_name, site_url, biblioteca
ORDER BY total_bytes DESC NULLS LAST, site_url NULLS LAST, biblioteca NULLS LAST LIMIT 50"""

QUERIES["profile_folders"] = INV_ROLLED + f"""
SELECT site_name, site_url, biblioteca, caminho_item AS pasta, quantidade_arquivos_dentro_da_pasta AS arquivos_na_pasta,
       volume_total_pasta_bytes, {round_ratio('volume_total_pasta_bytes', '1073741824', 2)} AS total_gb, data_modificacao
FROM inv WHERE tipo_item = 'folder' ORDER BY volume_total_pasta_bytes DESC NULLS LAST, id_drive, id_item LIMIT 50"""

QUERIES["profile_missing"] = INV + """
SELECT count(*) AS arquivos,
       count_if(data_ultimo_uso_acesso IS NULL OR data_ultimo_uso_acesso = '') AS sem_ultimo_acesso,
       count_if(data_modificacao IS NULL OR data_modificacao = '') AS sem_data_modificacao,
       min(data_modificacao) AS menor_data_modificacao, max(data_modificacao) AS maior_data_modificacao
FROM inv WHERE tipo_item = 'file'"""

QUERIES["dash_site_names"] = INV + """
SELECT DISTINCT site_name FROM inv WHERE site_name IS NOT NULL AND site_name <> ''"""

OVERVIEW = f"""
SELECT count(DISTINCT site_url) AS sites, count(DISTINCT biblioteca) AS libraries,
       count_if(tipo_item = 'file') AS files, count_if(tipo_item = 'folder') AS folders,
       CAST(coalesce(sum({FILE_BYTES}), 0) AS BIGINT) AS total_bytes
FROM inv WHERE 1=1"""
QUERIES["dash_overview"] = INV + OVERVIEW
QUERIES["dash_overview_selected"] = INV + OVERVIEW + """
  AND site_name IN ('Supplier#000000001', 'Supplier#000000002', 'Supplier#000000003')"""

TOP_SITES = f"""
top_sites AS (
  SELECT site_name, site_url, count_if(tipo_item = 'file') AS file_count,
         CAST(coalesce(sum({FILE_BYTES}), 0) AS BIGINT) AS storage_bytes
  FROM inv GROUP BY site_name, site_url
  ORDER BY storage_bytes DESC, site_name NULLS LAST, site_url NULLS LAST LIMIT 25
)"""
QUERIES["dash_top_sites"] = INV + "," + TOP_SITES + f"SELECT *, {gb('storage_bytes')} AS storage_gb FROM top_sites"

TOP_EXT = f"""
top_ext AS (
  SELECT {EXT_LABEL} AS extension, count(*) AS file_count, CAST(coalesce(sum(tamanho_bytes), 0) AS BIGINT) AS storage_bytes
  FROM inv WHERE tipo_item = 'file' GROUP BY 1 ORDER BY storage_bytes DESC, extension LIMIT 20
)"""
QUERIES["dash_top_extensions"] = INV + "," + TOP_EXT + f"SELECT *, {gb('storage_bytes')} AS storage_gb FROM top_ext"

QUERIES["dash_extension_table"] = INV + "," + TOP_EXT + f""",
tot AS (SELECT *, CAST(sum(storage_bytes) OVER () AS BIGINT) AS total FROM top_ext)
SELECT extension, {round_ratio('storage_bytes', '1073741824', 2, True)} AS storage_gb,
       CASE WHEN total > 0 THEN {round_ratio('storage_bytes * 100', 'total', 2, True)} ELSE 0.0 END AS storage_percent,
       file_count,
       CASE WHEN file_count > 0 THEN {round_ratio('storage_bytes', 'file_count * 1048576', 2, True)} ELSE 0.0 END AS avg_file_size_mb
FROM tot"""

OLD = f"tipo_item = 'file' AND TRY_CAST(data_modificacao AS TIMESTAMP) < CAST({AS_OF} - INTERVAL 1 YEAR AS TIMESTAMP)"

QUERIES["dash_unused_by_site"] = INV + f"""
SELECT *, {gb('storage_bytes')} AS storage_gb FROM (
  SELECT site_name, site_url, count(*) AS old_file_count, CAST(coalesce(sum(tamanho_bytes), 0) AS BIGINT) AS storage_bytes
  FROM inv WHERE {OLD} GROUP BY site_name, site_url
  ORDER BY storage_bytes DESC, site_name NULLS LAST, site_url NULLS LAST LIMIT 25)"""

QUERIES["dash_unused_sample"] = INV + f"""
SELECT site_name, biblioteca, nome_arquivo_ou_pasta, extensao, tamanho_bytes, data_modificacao, caminho_item,
       {gb('tamanho_bytes')} AS storage_gb
FROM inv WHERE {OLD} ORDER BY tamanho_bytes DESC NULLS LAST, id_item LIMIT 100"""

QUERIES["dash_unused_kpis"] = INV + f"""
SELECT unused_bytes, unused_files,
       CASE WHEN total_bytes > 0 THEN {round_ratio('unused_bytes * 100', 'total_bytes', 2, True)} ELSE 0.0 END AS unused_percent
FROM (SELECT CAST(coalesce(sum(CASE WHEN {OLD} THEN tamanho_bytes ELSE 0 END), 0) AS BIGINT) AS unused_bytes,
             count_if({OLD}) AS unused_files,
             CAST(coalesce(sum({FILE_BYTES}), 0) AS BIGINT) AS total_bytes FROM inv)"""


def display_name(name: str, url: str) -> str:
    nm = f"trim(coalesce({name}, ''))"
    u = f"trim(coalesce({url}, ''))"
    rest = f"regexp_replace({u}, '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    path = f"regexp_extract({rest}, '^(?://[^/?#]*)?([^?#]*)', 1)"
    seg = f"regexp_extract(rtrim({path}, '/'), '([^/]*)$', 1)"
    host = f"regexp_extract({rest}, '^//([^/?#]*)', 1)"
    return (
        f"(CASE WHEN {nm} <> '' AND NOT contains({nm}, ',') THEN {nm} "
        f"WHEN {u} <> '' THEN coalesce(nullif({seg}, ''), nullif({host}, ''), nullif({nm}, ''), '(sem nome)') "
        f"ELSE coalesce(nullif({nm}, ''), '(sem nome)') END)"
    )


def shorten(v: str, n: int = 32) -> str:
    return (
        f"(CASE WHEN {v} IS NULL OR {v} = '' THEN '(sem nome)' WHEN length(trim({v})) <= {n} THEN trim({v}) "
        f"ELSE substr(trim({v}), 1, {n - 1}) || '...' END)"
    )


QUERIES["dash_site_chart"] = INV + "," + TOP_SITES + f""",
ranked AS (
  SELECT *, {gb('storage_bytes')} AS storage_gb,
         row_number() OVER (ORDER BY storage_bytes DESC, site_name NULLS LAST, site_url NULLS LAST) AS rank,
         {display_name('site_name', 'site_url')} AS site_display_name
  FROM (SELECT * FROM top_sites ORDER BY storage_bytes DESC, site_name NULLS LAST, site_url NULLS LAST LIMIT 10)
)
SELECT *, lpad(CAST(rank AS VARCHAR), 2, '0') || '. ' || {shorten('site_display_name')} AS site_label FROM ranked"""

QUERIES["gold_totals"] = LAKEHOUSE + """
SELECT sum(storage_gb) AS storage_gb, count(DISTINCT site_name) AS sites, CAST(sum(total_files) AS BIGINT) AS files,
       sum(archive_candidate_gb) AS archive_candidate_gb FROM kpis"""


# --------------------------------------------------------------------------- site priority

TIB = 1024**4

PRIORITY = f"""
ord AS (
  SELECT o_custkey AS c_custkey, max(o_orderdate) AS last_order, count(*) AS n_orders,
         count_if(o_orderstatus = 'O') AS n_open
  FROM orders GROUP BY o_custkey
),
rep AS (
  SELECT c.c_custkey AS rr, CAST(c.c_custkey AS VARCHAR) AS site_id,
         CASE WHEN c.c_custkey % 11 = 0 THEN '' ELSE 'https://h.example/sites/c' || CAST(c.c_custkey AS VARCHAR) END AS site_url0,
         CASE WHEN c.c_custkey % 7 = 0 THEN lower(replace(c.c_name, '#', '.') || '@h.example') ELSE c.c_name END AS owner,
         CASE WHEN c.c_custkey % 19 = 0 THEN '' ELSE strftime(o.last_order, '%Y-%m-%d') END AS last_activity_date,
         coalesce(o.n_orders, 0) AS file_count, coalesce(o.n_open, 0) AS active_file_count,
         CAST(greatest(floor(c.c_acctbal), 0) AS BIGINT) * 268435456 AS storage_used_bytes,
         CAST(CASE c.c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN {25 * TIB} ELSE {TIB} END AS BIGINT) AS storage_allocated_bytes,
         c.c_mktsegment AS root_web_template, '2001-12-01' AS report_refresh_date, '180' AS report_period
  FROM customer c LEFT JOIN ord o ON o.c_custkey = c.c_custkey
  WHERE c.c_custkey % 13 <> 0
),
site_list AS (
  SELECT 'h.example,sc' || k || ',' || k AS id, c_name AS name,
         'https://h.example/sites/cat-' || k AS web_url,
         'sid-' || k AS sp1, 'col-' || CAST(c_nationkey AS VARCHAR) AS sp2
  FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '' END || CAST(c_custkey AS VARCHAR) AS k FROM customer) AS named
),
url_keys AS (
  SELECT id, web_url, 0 AS pos, lower(id) AS k FROM site_list
  UNION ALL SELECT id, web_url, 1, lower(string_split(id, ',')[-1]) FROM site_list
  UNION ALL SELECT id, web_url, 2, lower(sp1) FROM site_list
  UNION ALL SELECT id, web_url, 3, lower(sp2) FROM site_list
),
url_lookup AS (
  SELECT k, web_url FROM (
    SELECT k, web_url, row_number() OVER (PARTITION BY k ORDER BY id DESC, pos DESC) AS rn FROM url_keys WHERE k <> ''
  ) WHERE rn = 1
),
ranked AS (
  SELECT row_number() OVER (ORDER BY r.storage_used_bytes DESC, r.rr) AS rank, r.*,
         CASE WHEN r.site_url0 <> '' THEN r.site_url0 ELSE coalesce(u.web_url, '') END AS site_url
  FROM rep r LEFT JOIN url_lookup u ON u.k = lower(r.site_id)
),
priority AS (
  SELECT rank, site_id, site_url, owner, last_activity_date, file_count, active_file_count, storage_used_bytes,
         {fmt_size('storage_used_bytes')} AS storage_used_formatted, storage_allocated_bytes,
         {fmt_size('storage_allocated_bytes')} AS storage_allocated_formatted, root_web_template,
         report_refresh_date, report_period,
         CASE WHEN storage_used_bytes >= {TIB} THEN 'over_1tb'
              WHEN storage_used_bytes >= {500 * 1024**3} THEN 'over_500gb_to_1tb'
              WHEN storage_used_bytes >= {100 * 1024**3} THEN 'over_100gb_to_500gb'
              ELSE 'under_100gb' END AS tier
  FROM ranked
),
variants AS (
  SELECT v, arg_min(name, id) AS site_name, arg_min(web_url, id) AS site_url_lookup FROM (
    SELECT id, coalesce(name, '') AS name, coalesce(web_url, '') AS web_url,
           unnest(list_concat([lower(trim(id))], list_filter(list_transform(string_split(lower(trim(id)), ','), lambda x: trim(x)), lambda x: x <> ''))) AS v
    FROM site_list
  ) GROUP BY v
),
dash_priority AS (
  SELECT p.* EXCLUDE (site_url),
         CASE WHEN p.site_url IS NULL OR p.site_url IN ('', 'nan', 'None') THEN coalesce(v.site_url_lookup, '') ELSE p.site_url END AS site_url,
         coalesce(v.site_name, '') AS site_name
  FROM priority p LEFT JOIN variants v ON v.v = lower(trim(p.site_id))
)"""

PRI = with_(PRIORITY)

QUERIES["site_priority"] = PRI + "SELECT * FROM priority"

QUERIES["priority_tiers"] = PRI + """
SELECT t.name, t.label, coalesce(a.site_count, 0) AS site_count, CAST(coalesce(a.b, 0) AS BIGINT) AS storage_used_bytes,
       FMT AS storage_used_formatted
FROM (VALUES (0, 'over_1tb', '>= 1 TB'), (1, 'over_500gb_to_1tb', '>= 500 GB e < 1 TB'),
             (2, 'over_100gb_to_500gb', '>= 100 GB e < 500 GB'), (3, 'under_100gb', '< 100 GB')) t(o, name, label)
LEFT JOIN (SELECT tier, count(*) AS site_count, sum(storage_used_bytes) AS b FROM priority GROUP BY tier) a ON a.tier = t.name
""".replace("FMT", fmt_size("CAST(coalesce(a.b, 0) AS BIGINT)"))

QUERIES["priority_summary"] = PRI + f"""
SELECT *, {fmt_size('total_storage_used_bytes')} AS total_storage_used_formatted FROM (
  SELECT count(*) AS sites, count_if(site_url <> '') AS sites_with_url, count_if(site_url = '') AS sites_without_url,
         count_if(tier = 'over_1tb') AS over_1tb_sites, count_if(tier = 'over_500gb_to_1tb') AS over_500gb_to_1tb_sites,
         count_if(tier = 'over_100gb_to_500gb') AS over_100gb_to_500gb_sites, count_if(tier = 'under_100gb') AS under_100gb_sites,
         CAST(coalesce(sum(storage_used_bytes), 0) AS BIGINT) AS total_storage_used_bytes
  FROM priority)"""

QUERIES["storage_limits"] = PRI + f"""
SELECT {display_name('site_name', 'site_url')} AS site_display_name, owner,
       {gb('storage_used_bytes')} AS storage_used_gb, {gb('storage_allocated_bytes')} AS storage_allocated_gb,
       coalesce(CAST(storage_used_bytes AS DOUBLE) / nullif(CAST(storage_allocated_bytes AS DOUBLE), 0.0) * 100.0, 0.0) AS quota_usage_percent,
       CASE WHEN storage_allocated_bytes IS NULL OR storage_allocated_bytes <= 0 THEN 'Sem limite reportado'
            WHEN storage_allocated_bytes >= {25 * TIB} THEN 'Limite alto/padrao reportado'
            ELSE 'Limite especifico aparente' END AS limit_status,
       site_url
FROM dash_priority"""

QUERIES["quota_kpis"] = PRI + f"""
SELECT count_if(storage_allocated_bytes > 0) AS sites_with_limit, count_if(storage_allocated_bytes <= 0) AS sites_without_limit,
       count_if(storage_allocated_bytes > 0 AND storage_allocated_bytes < {25 * TIB}) AS sites_specific_limit
FROM dash_priority"""

QUERIES["inactive_priority_sites"] = PRI + f"""
SELECT rank, site_name, owner, site_url, last_activity_date,
       CASE WHEN d IS NULL THEN 'Sem atividade registrada' WHEN d > 180 THEN 'Inativo' WHEN d > 90 THEN 'Pouco ativo'
            ELSE 'Ativo' END AS activity_status,
       storage_used_formatted, file_count, active_file_count
FROM (SELECT *, date_diff('day', CAST(TRY_CAST(last_activity_date AS TIMESTAMP) AS DATE), {AS_OF}) AS d FROM dash_priority)"""


# --------------------------------------------------------------------------- change feed, sync state, stats

CHANGES = f"""
ch AS (
  SELECT json_extract_string(props, '$.k') AS id, CAST(user_id AS VARCHAR) AS drive_id,
         CAST(user_id % 20 AS VARCHAR) AS site_id, 'item-' || json_extract_string(props, '$.k') AS name,
         CAST(floor(value * 100) AS BIGINT) AS size_bytes, {iso('ts')} AS modified_at, {iso('ts')} AS collected_at,
         CAST(floor(event_id / 100) AS BIGINT) AS page_seq, event_id AS row_idx, event_type = 'error' AS tomb
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
),
cho AS (SELECT *, page_seq * 20000000 + CASE WHEN tomb THEN 10000000 ELSE 0 END + row_idx AS o FROM ch),
lastu AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY drive_id, id ORDER BY o DESC) AS rn FROM cho WHERE NOT tomb)
  WHERE rn = 1
),
lastany AS (SELECT drive_id, id, arg_max(collected_at, o) AS collected_at, max(CASE WHEN tomb THEN o END) AS dead FROM cho GROUP BY drive_id, id)"""

QUERIES["apply_changes"] = with_(CHANGES) + f"""
SELECT u.drive_id, u.id, u.site_id, u.name, u.size_bytes, {fmt_size('u.size_bytes')} AS formatted_size, u.modified_at,
       CASE WHEN a.dead > u.o THEN 'deleted' ELSE 'ok' END AS status, a.collected_at,
       CASE WHEN a.dead > u.o THEN '{{}}' ELSE NULL END AS raw_json
FROM lastu u JOIN lastany a ON a.drive_id = u.drive_id AND a.id = u.id"""

PAGES = f"""
pg AS (SELECT user_id AS u, CAST(floor(event_id / 100) AS BIGINT) AS page_seq, max(ts) AS ts FROM events GROUP BY 1, 2),
lastpg AS (SELECT u, max(page_seq) AS last_page FROM pg GROUP BY u),
plog AS (
  SELECT CAST(p.u AS VARCHAR) AS drive_id, CAST(p.u % 20 AS VARCHAR) AS site_id, 'lib-' || CAST(p.u AS VARCHAR) AS library_name,
         p.page_seq, {iso('p.ts')} AS collected_at,
         CASE WHEN p.page_seq = l.last_page AND p.u % 10 <> 0 THEN NULL
              ELSE 'next:' || CAST(p.u AS VARCHAR) || ':' || CAST(p.page_seq + 1 AS VARCHAR) END AS next_link,
         CASE WHEN p.page_seq = l.last_page AND p.u % 10 <> 0
              THEN 'delta:' || CAST(p.u AS VARCHAR) || ':' || CAST(p.page_seq AS VARCHAR) END AS delta_link
  FROM pg p JOIN lastpg l ON l.u = p.u
),
sync AS (
  SELECT drive_id, site_id, library_name, CAST(NULL AS VARCHAR) AS mode,
         CASE WHEN delta_link IS NOT NULL THEN 'done' WHEN next_link IS NOT NULL THEN 'in_progress' ELSE 'pending' END AS status,
         CAST(0 AS INTEGER) AS attempts,
         CASE WHEN delta_link IS NOT NULL THEN NULL ELSE next_link END AS next_link, delta_link,
         CASE WHEN delta_link IS NULL AND next_link IS NULL THEN 'Resposta delta sem @odata.nextLink nem @odata.deltaLink' END AS last_error,
         collected_at AS created_at, collected_at AS updated_at, CAST(NULL AS VARCHAR) AS last_started_at,
         CASE WHEN delta_link IS NOT NULL THEN collected_at END AS last_completed_at
  FROM plog WHERE (drive_id, page_seq) IN (SELECT drive_id, max(page_seq) FROM plog GROUP BY drive_id)
)"""

QUERIES["sync_state"] = with_(PAGES) + "SELECT * FROM sync"
QUERIES["sync_status_counts"] = with_(PAGES) + "SELECT status, count(*) AS total FROM sync GROUP BY status"

ERRORS = """
errs AS (
  SELECT event_id AS id, CAST(user_id % 20 AS VARCHAR) AS site_id,
         ([401, 403, 404, 410, 423, 429, 503])[event_id % 7 + 1] AS status_code, false AS resolved
  FROM events WHERE event_type = 'error'
)"""

STATS_BASE = with_(SITES, DRIVES, ITEMS, PAGES, ERRORS)

QUERIES["catalog_stats"] = STATS_BASE + f"""
SELECT *, {fmt_size('total_bytes')} AS total_formatted FROM (
  SELECT (SELECT count(*) FROM sites) AS sites, (SELECT count(*) FROM drives) AS drives,
         (SELECT count(*) FROM items WHERE item_type = 'folder' AND status <> 'deleted') AS folders,
         (SELECT count(*) FROM items WHERE item_type = 'file' AND status <> 'deleted') AS files,
         (SELECT CAST(coalesce(sum(size_bytes), 0) AS BIGINT) FROM items WHERE item_type = 'file' AND status <> 'deleted') AS total_bytes,
         (SELECT count(*) FROM errs WHERE NOT resolved AND coalesce(status_code, 0) <> 423) AS open_errors,
         (SELECT count(DISTINCT site_id) FROM errs WHERE NOT resolved AND status_code = 423) AS blocked_sites,
         (SELECT max(updated_at) FROM sync) AS last_delta_checkpoint)"""

QUERIES["export_summary"] = STATS_BASE + f"""
SELECT *, {fmt_size('total_bytes')} AS total_formatted FROM (
  SELECT (SELECT count(*) FROM sites) AS sites, (SELECT count(*) FROM drives) AS drives,
         (SELECT count(*) FROM items WHERE item_type = 'folder' AND status <> 'deleted') AS folders,
         (SELECT count(*) FROM items WHERE item_type = 'file' AND status <> 'deleted') AS files,
         (SELECT CAST(coalesce(sum(size_bytes), 0) AS BIGINT) FROM items WHERE item_type = 'file' AND status <> 'deleted') AS total_bytes,
         (SELECT count(*) FROM errs WHERE NOT resolved) AS open_errors)"""


# --------------------------------------------------------------------------- audit, storage metrics, URLs, layers

def norm_url(x: str) -> str:
    return f"rtrim(lower(trim(coalesce({x}, ''))), '/')"


COLLECTED = """
coll AS (
  SELECT s.id AS site_id, s.name AS site_name, s.web_url AS site_url, coalesce(d.drives, 0) AS drives,
         coalesce(i.files, 0) AS files, CAST(coalesce(i.b, 0) AS BIGINT) AS collected_storage_bytes
  FROM sites s
  LEFT JOIN (SELECT site_id, count(DISTINCT id) AS drives FROM drives GROUP BY site_id) d ON d.site_id = s.id
  LEFT JOIN (SELECT site_id, count(*) AS files, sum(size_bytes) AS b FROM items
             WHERE item_type = 'file' AND status <> 'deleted' GROUP BY site_id) i ON i.site_id = s.id
)"""

AUDIT = COLLECTED + f""",
by_url AS (
  SELECT * FROM (
    SELECT *, {norm_url('site_url')} AS u, row_number() OVER (PARTITION BY {norm_url('site_url')} ORDER BY site_id DESC) AS rn
    FROM coll WHERE site_url IS NOT NULL AND site_url <> '') WHERE rn = 1
),
expected AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS site_id,
         CASE WHEN s_suppkey % 10 = 0 THEN 'https://h.example/sites/missing-' || CAST(s_suppkey AS VARCHAR)
              WHEN s_suppkey % 3 = 1 THEN upper('https://h.example/sites/' || CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '' END) || '/'
              ELSE 'https://h.example/sites/' || CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '' END END AS site_url,
         s_name AS site_name,
         CAST(greatest(floor(s_acctbal), 0) AS BIGINT) * 4294967296 AS expected_storage_bytes
  FROM supplier
),
audit AS (
  SELECT e.site_id, e.site_url, e.site_name, e.expected_storage_bytes, {fmt_size('e.expected_storage_bytes')} AS expected_storage_formatted,
         CASE WHEN c.u IS NULL THEN 'missing'
              WHEN e.expected_storage_bytes <> 0 AND CAST(coalesce(c.collected_storage_bytes, 0) AS DOUBLE) / CAST(e.expected_storage_bytes AS DOUBLE) < 0.8 THEN 'under_collected'
              ELSE 'ok' END AS status,
         CASE WHEN c.u IS NULL THEN '' ELSE c.site_id END AS collected_site_id,
         CASE WHEN c.u IS NULL THEN '' ELSE c.site_name END AS collected_site_name,
         coalesce(c.drives, 0) AS drives, coalesce(c.files, 0) AS files,
         coalesce(c.collected_storage_bytes, 0) AS collected_storage_bytes,
         {fmt_size('coalesce(c.collected_storage_bytes, 0)')} AS collected_storage_formatted,
         CASE WHEN e.expected_storage_bytes = 0 THEN 1.0
              ELSE {round_ratio('coalesce(c.collected_storage_bytes, 0)', 'e.expected_storage_bytes', 4, True)} END AS collected_vs_expected_ratio,
         greatest(e.expected_storage_bytes - coalesce(c.collected_storage_bytes, 0), 0) AS missing_storage_bytes,
         {fmt_size('greatest(e.expected_storage_bytes - coalesce(c.collected_storage_bytes, 0), 0)')} AS missing_storage_formatted
  FROM expected e LEFT JOIN by_url c ON c.u = {norm_url('e.site_url')}
)"""

AUDIT_BASE = with_(SITES, DRIVES, ITEMS, AUDIT)
QUERIES["collected_per_site"] = AUDIT_BASE + "SELECT * FROM coll"
QUERIES["site_audit"] = AUDIT_BASE + "SELECT * FROM audit"
QUERIES["audit_rollup"] = AUDIT_BASE + """
SELECT count(*) AS expected_sites, count_if(status = 'missing') AS missing_sites,
       count_if(status = 'under_collected') AS under_collected_sites, count_if(status = 'ok') AS ok_sites FROM audit"""

METRICS = """
per AS (
  SELECT l_suppkey AS s_suppkey, sum(sz) AS used, count(*) AS versions, sum(CASE WHEN l_returnflag = 'R' THEN sz ELSE 0 END) AS vb
  FROM (SELECT l_suppkey, l_returnflag, CASE WHEN l_quantity = 1 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) * 1048576 END AS sz FROM lineitem)
  GROUP BY 1
),
metrics AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS site_id,
         'https://h.example/sites/' || CAST(s.s_suppkey AS VARCHAR) || CASE WHEN s.s_suppkey % 2 = 0 THEN '/' ELSE '' END AS site_url,
         CASE WHEN s.s_suppkey % 9 = 0 THEN NULL ELSE CAST(p.used AS BIGINT) END AS storage_used_bytes,
         CASE WHEN s.s_suppkey % 9 = 0 THEN NULL ELSE CAST(p.versions AS BIGINT) END AS version_count,
         CASE WHEN s.s_suppkey % 9 = 0 THEN NULL ELSE CAST(p.vb AS BIGINT) END AS version_size_bytes,
         CASE WHEN s.s_suppkey % 9 = 0 THEN 'failed' ELSE 'ok' END AS status,
         CASE WHEN s.s_suppkey % 9 = 0 THEN 'Access denied' END AS message,
         '2001-12-01T00:00:00Z' AS collected_at
  FROM supplier s LEFT JOIN per p ON p.s_suppkey = s.s_suppkey
),
okm AS (
  SELECT m.site_id, coalesce(s.name, m.site_url) AS site_name, m.site_url, m.storage_used_bytes, m.version_count, m.version_size_bytes
  FROM metrics m LEFT JOIN sites s ON s.id = m.site_id WHERE m.status = 'ok'
)"""

MET = with_(SITES, METRICS)
QUERIES["storage_metrics_report"] = MET + """
SELECT m.site_id, s.name AS site_name, m.site_url, m.storage_used_bytes, m.version_count, m.version_size_bytes,
       m.status, m.message, m.collected_at
FROM metrics m LEFT JOIN sites s ON s.id = m.site_id"""
QUERIES["storage_ingest_counts"] = MET + """
SELECT count_if(status = 'ok') AS ok, count_if(status <> 'ok') AS failed, count(*) AS total FROM metrics"""
QUERIES["version_kpis"] = MET + f"""
SELECT *, CASE WHEN storage_used_bytes <> 0 THEN {round_ratio('version_size_bytes * 100', 'storage_used_bytes', 1, True)} ELSE 0.0 END AS version_percent
FROM (SELECT CAST(coalesce(sum(storage_used_bytes), 0) AS BIGINT) AS storage_used_bytes,
             CAST(coalesce(sum(version_count), 0) AS BIGINT) AS version_count,
             CAST(coalesce(sum(version_size_bytes), 0) AS BIGINT) AS version_size_bytes FROM okm)"""
QUERIES["version_table"] = MET + f"""
SELECT site_name, {round_ratio('storage_used_bytes', '1073741824', 2, True)} AS storage_gb,
       {round_ratio('version_size_bytes', '1073741824', 2, True)} AS versoes_gb, version_count,
       CASE WHEN storage_used_bytes > 0 THEN {round_ratio('version_size_bytes * 100', 'storage_used_bytes', 1, True)} END AS pct_versoes,
       site_url
FROM okm"""


def url_parts(u: str) -> dict:
    rest = f"regexp_replace({u}, '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    path = f"regexp_extract({rest}, '^(?://[^/?#]*)?([^?#]*)', 1)"
    seg = f"regexp_extract(rtrim({path}, '/'), '([^/]*)$', 1)"
    host = f"regexp_extract({rest}, '^//([^/?#]*)', 1)"
    ext = f"nullif(lower(regexp_extract(coalesce({seg}, ''), '(?s)^.+\\.([^.]+)$', 1)), '')"
    return {"seg": seg, "host": host, "ext": ext}


_P = url_parts("url")
PAGE_PROFILE = f"""
prof AS (
  SELECT page_id, url, {norm_url('url')} AS normalized_url, {_P['host']} AS host, {_P['seg']} AS path_segment,
         {_P['ext']} AS path_extension, {display_name('NULL', 'url')} AS display_name
  FROM pages
)"""
QUERIES["page_urls"] = with_(PAGE_PROFILE) + f"SELECT *, {shorten('display_name')} AS label FROM prof"
QUERIES["page_hosts"] = with_(PAGE_PROFILE) + """
SELECT host, count(*) AS pages, count(DISTINCT normalized_url) AS distinct_urls,
       count_if(path_extension IS NOT NULL) AS pages_with_extension FROM prof GROUP BY host"""

QUERIES["bronze_sites"] = with_(SITES) + """
SELECT id AS site_id, name AS site_name, web_url AS site_url, host_name, discovered_at, processed_at,
       CAST(json_object('id', id, 'displayName', s_name, 'webUrl', web_url, 'siteCollection', json_object('hostname', 'h.example')) AS VARCHAR) AS raw_json,
       s_name AS raw_displayName, id AS raw_id, 'h.example' AS raw_siteCollection_hostname, web_url AS raw_webUrl
FROM (SELECT s.*, x.s_name FROM sites s JOIN supplier x ON CAST(x.s_suppkey AS VARCHAR) = s.id)"""

SILVER_DIMS = """
sil_sites AS (
  SELECT id AS site_id, trim(coalesce(name, '(sem nome)')) AS site_name, trim(coalesce(web_url, '')) AS site_url,
         trim(coalesce(host_name, '')) AS host_name, TRY_CAST(discovered_at AS TIMESTAMP) AS discovered_at,
         TRY_CAST(processed_at AS TIMESTAMP) AS processed_at, processed_at IS NOT NULL AS is_processed
  FROM sites
)"""
QUERIES["silver_sites"] = with_(SITES, SILVER_DIMS) + "SELECT * FROM sil_sites"
QUERIES["silver_drives"] = with_(SITES, DRIVES, SILVER_DIMS) + """
SELECT d.id AS drive_id, d.site_id, s.site_name, trim(coalesce(d.name, '(sem nome)')) AS drive_name,
       lower(trim(coalesce(d.drive_type, 'unknown'))) AS drive_type, trim(coalesce(d.web_url, '')) AS drive_url,
       TRY_CAST(d.discovered_at AS TIMESTAMP) AS discovered_at, TRY_CAST(d.processed_at AS TIMESTAMP) AS processed_at,
       d.processed_at IS NOT NULL AS is_processed
FROM drives d LEFT JOIN sil_sites s ON s.site_id = d.site_id"""
QUERIES["silver_files"] = LAKEHOUSE + """
SELECT file_id, drive_id, site_id, site_name, site_url, drive_name, drive_type, library_name, parent_id, parent_path, full_path,
       file_name, extension, extension_category, mime_type, size_bytes, size_bytes / 1024.0 AS size_kb,
       size_bytes / 1048576.0 AS size_mb, size_bytes / 1073741824.0 AS size_gb, created_at, CAST(created_at AS DATE) AS created_date,
       modified_at, CAST(modified_at AS DATE) AS modified_date, last_accessed_at, days_since_modified, usage_status, web_url,
       status, collected_at
FROM silver_files2"""


# --------------------------------------------------------------------------- site id resolution

RESOLVE = """
req AS (
  SELECT trim(CASE WHEN c_custkey % 5 = 0 THEN 'h.example,sc' || CAST(c_custkey AS VARCHAR) || ',' || CAST(c_custkey AS VARCHAR)
                   WHEN c_custkey % 4 = 0 THEN upper('SID-' || CAST(c_custkey AS VARCHAR))
                   ELSE CAST(c_custkey AS VARCHAR) END) AS site_id
  FROM customer
),
sl AS (
  SELECT 'h.example,sc' || k || ',' || k AS id,
         'sid-' || k AS sp1, 'col-' || CAST(c_nationkey AS VARCHAR) AS sp2
  FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '' END || CAST(c_custkey AS VARCHAR) AS k FROM customer) AS named
),
rkeys AS (
  SELECT k, max(id) AS resolved_site_id FROM (
    SELECT id, lower(id) AS k FROM sl
    UNION ALL SELECT id, lower(sp1) FROM sl
    UNION ALL SELECT id, lower(sp2) FROM sl
    UNION ALL SELECT id, unnest(string_split(lower(id), ',')) FROM sl
  ) WHERE k IS NOT NULL AND k <> '' GROUP BY k
),
direct AS (SELECT r.site_id, r.site_id AS resolved_site_id FROM req r WHERE r.site_id <> '' AND r.site_id IN (SELECT id FROM sl)),
mapped AS (
  SELECT r.site_id, k.resolved_site_id FROM req r LEFT JOIN rkeys k ON k.k = lower(r.site_id)
  WHERE r.site_id <> '' AND r.site_id NOT IN (SELECT id FROM sl)
)"""

QUERIES["site_id_resolution"] = with_(RESOLVE) + """
SELECT * FROM direct UNION ALL SELECT * FROM mapped WHERE resolved_site_id IS NOT NULL"""

QUERIES["site_id_errors"] = with_(RESOLVE) + """
SELECT 'site' AS entity_type, site_id AS entity_id, site_id, 'resolve_site_id' AS operation, 404 AS status_code,
       'Site ID nao encontrado no Graph: ' || site_id AS message, false AS retryable
FROM mapped WHERE resolved_site_id IS NULL"""


# --------------------------------------------------------------------------- result types

def _bigint_count_if(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


QUERIES = {name: _bigint_count_if(sql) for name, sql in QUERIES.items()}

QUERIES["version_chart"] = MET + f"""
SELECT site_id, site_name, site_url, version_count, version_size_bytes, {gb('version_size_bytes')} AS version_gb,
       {shorten('site_name')} AS site_label
FROM okm ORDER BY version_size_bytes DESC NULLS LAST, site_id LIMIT 10"""
QUERIES = {name: _bigint_count_if(sql) for name, sql in QUERIES.items()}


# --------------------------------------------------------------------------- sync-state transitions

SYNC_DRIVES = """
users AS (SELECT DISTINCT user_id FROM events),
sync_drives AS (
  SELECT CAST(user_id AS VARCHAR) AS id, CAST(user_id % 20 AS VARCHAR) AS site_id, 'lib-' || CAST(user_id AS VARCHAR) AS name FROM users
  UNION ALL
  SELECT CAST(user_id + 1000000 AS VARCHAR), CAST((user_id + 1000000) % 20 AS VARCHAR), 'lib-' || CAST(user_id + 1000000 AS VARCHAR)
  FROM users WHERE user_id % 7 = 0
)"""

QUERIES["sync_prepared"] = with_(PAGES, SYNC_DRIVES) + """
SELECT drive_id, site_id, library_name, mode,
       CASE WHEN status IN ('in_progress', 'done') THEN 'pending' ELSE status END AS status,
       attempts, next_link, delta_link,
       CASE WHEN status = 'in_progress' THEN coalesce(last_error, 'Retomado apos interrupcao')
            WHEN status = 'done' THEN NULL ELSE last_error END AS last_error,
       created_at,
       CASE WHEN status IN ('in_progress', 'done') THEN '2025-01-01T00:00:00Z' ELSE updated_at END AS updated_at,
       last_started_at, last_completed_at
FROM sync
UNION ALL
SELECT d.id, d.site_id, d.name, CAST(NULL AS VARCHAR), 'pending', CAST(0 AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR), '2025-01-01T00:00:00Z', '2025-01-01T00:00:00Z', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM sync_drives d WHERE d.id NOT IN (SELECT drive_id FROM sync)"""

NEXT_ERRORS = f"""
nerr AS (
  SELECT event_id AS id, CAST(user_id AS VARCHAR) AS drive_id,
         ([401, 403, 404, 410, 423, 429, 503])[event_id % 7 + 1] AS status_code,
         'error ' || CAST(event_id AS VARCHAR) AS message,
         {iso('ts + INTERVAL 1 YEAR')} AS created_at
  FROM events WHERE event_type = 'error'
),
lasterr AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY created_at DESC, id DESC) AS rn FROM nerr) WHERE rn = 1
)"""

QUERIES["sync_after_failures"] = with_(PAGES, NEXT_ERRORS) + """
SELECT s.drive_id, s.site_id, s.library_name, s.mode,
       CASE WHEN e.drive_id IS NULL OR NOT (s.updated_at IS NULL OR e.created_at > s.updated_at) THEN s.status
            WHEN e.status_code = 410 THEN 'pending'
            WHEN e.status_code IN (401, 403, 404) THEN 'failed' ELSE 'pending' END AS status,
       s.attempts,
       CASE WHEN e.drive_id IS NOT NULL AND (s.updated_at IS NULL OR e.created_at > s.updated_at) AND e.status_code = 410 THEN NULL ELSE s.next_link END AS next_link,
       CASE WHEN e.drive_id IS NOT NULL AND (s.updated_at IS NULL OR e.created_at > s.updated_at) AND e.status_code = 410 THEN NULL ELSE s.delta_link END AS delta_link,
       CASE WHEN e.drive_id IS NOT NULL AND (s.updated_at IS NULL OR e.created_at > s.updated_at) THEN substr(e.message, 1, 2000) ELSE s.last_error END AS last_error,
       s.created_at,
       CASE WHEN e.drive_id IS NOT NULL AND (s.updated_at IS NULL OR e.created_at > s.updated_at) THEN e.created_at ELSE s.updated_at END AS updated_at,
       s.last_started_at, s.last_completed_at
FROM sync s LEFT JOIN lasterr e ON e.drive_id = s.drive_id"""
QUERIES = {name: _bigint_count_if(sql) for name, sql in QUERIES.items()}

QUERIES["reset_site_counts"] = with_(SITES, DRIVES, ITEMS, PAGES, ERRORS) + """
SELECT (SELECT count(*) FROM sites WHERE id = '7') AS sites,
       (SELECT count(*) FROM drives WHERE site_id = '7') AS drives,
       (SELECT count(*) FROM items WHERE site_id = '7') AS items,
       (SELECT count(*) FROM sync WHERE site_id = '7') AS drive_sync_state,
       (SELECT count(*) FROM errs WHERE site_id = '7') AS errors"""

QUERIES["drive_roots"] = with_(SITES, DRIVES, ITEMS) + """
SELECT drive_id, arg_max(full_path, collected_at) AS root_path
FROM items WHERE parent_id IS NULL AND item_type = 'folder' AND status <> 'deleted' GROUP BY drive_id"""

QUERIES["bronze_files"] = with_(SITES, DRIVES, ITEMS) + """
SELECT id AS file_id, drive_id, site_id, library_name, parent_id, parent_path, full_path, name AS file_name, item_type,
       extension, mime_type, size_bytes, formatted_size, created_at, modified_at, last_accessed_at, file_count,
       folder_total_size_bytes, folder_total_size_formatted, web_url, status, collected_at, CAST(NULL AS VARCHAR) AS raw_json
FROM items WHERE item_type = 'file'"""

QUERIES["bronze_drives"] = with_(SITES, DRIVES) + """
SELECT id AS drive_id, site_id, name AS drive_name, drive_type, web_url AS drive_url, discovered_at, processed_at,
       CAST(NULL AS VARCHAR) AS raw_json
FROM drives"""

QUERIES["apply_changes_incremental"] = QUERIES["apply_changes"]
QUERIES["pending_count"] = with_(PAGES) + "SELECT count(*) AS pending FROM sync WHERE status = 'pending'"
QUERIES["run_outcome"] = f"""
SELECT CASE WHEN (SELECT open_errors FROM ({QUERIES["catalog_stats"]}) AS s) > 0
              OR (SELECT count(*) FROM ({QUERIES["sync_status_counts"]}) AS c WHERE status IN ('failed', 'in_progress')) > 0
            THEN 'completed_with_errors' ELSE 'completed' END AS outcome"""

from oracle_feed_sql import feed_queries  # noqa: E402

from oracle_io_sql import io_queries  # noqa: E402

QUERIES |= feed_queries(with_, iso, fmt_size, PAGES)
QUERIES |= io_queries(
    with_, iso, fmt_size, QUERIES,
    {"sites": SITES, "drives": DRIVES, "items": ITEMS, "inventory": _inv("inv", "items"), "rollup": ROLLUP, "priority": PRI, "metrics": MET, "changes": CHANGES},
)
