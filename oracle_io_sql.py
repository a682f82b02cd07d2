"""DuckDB SQL of the queries that write and read back, of the merges and of
the tree operators after a batch of moves."""

from __future__ import annotations


def io_queries(with_, iso, fmt_size, known: dict[str, str], cte: dict[str, str]) -> dict[str, str]:
    sites, drives, items = cte["sites"], cte["drives"], cte["items"]
    parts = with_(sites, drives, items, cte["inventory"]) + """
SELECT (n - 1) // 10000 AS part_no, count(*) AS n_rows, CAST(sum(tamanho_bytes) AS BIGINT) AS bytes,
       arg_min(caminho_item, n) AS first_path, arg_max(caminho_item, n) AS last_path
FROM (SELECT *, row_number() OVER (ORDER BY site_url NULLS FIRST, biblioteca NULLS FIRST, caminho_item NULLS FIRST, id_drive, id_item) AS n FROM inv)
GROUP BY 1"""
    tables = {
        "01_resumo_por_site": "client_site_summary", "02_resumo_por_extensao": "client_extension_summary",
        "03_top_1000_maiores_arquivos": "client_largest_files", "04_top_1000_arquivos_antigos": "client_old_files",
        "05_inventario_arquivos_cliente": "client_file_list",
    }
    report = " UNION ALL ".join(
        f"SELECT '{stem}' AS name, (SELECT count(*) FROM ({known[query]})) AS n_rows, CAST(0 AS BIGINT) AS differing" for stem, query in tables.items()
    )
    none = "CAST(NULL AS VARCHAR) AS tier"
    priority = cte["priority"] + f"""
SELECT 'csv' AS source, rank, site_id, {none} FROM priority UNION ALL SELECT 'json', rank, site_id, NULL FROM priority
UNION ALL SELECT 'json_by_tier', rank, site_id, tier FROM priority
UNION ALL SELECT 'ids', NULL, site_id, NULL FROM priority WHERE site_id <> ''
UNION ALL SELECT 'ids_by_tier', NULL, site_id, tier FROM priority WHERE site_id <> ''"""
    ids = """
SELECT id, CAST(min(list) AS INTEGER) AS list FROM (
  SELECT 'id-' || CAST(c_custkey * 2 AS VARCHAR) AS id, 0 AS list FROM customer WHERE c_custkey <= 3
  UNION ALL SELECT 'id-' || CAST(c_custkey % 1000 AS VARCHAR), 1 FROM customer WHERE c_custkey = 1 OR (c_custkey % 5 <> 0 AND c_custkey % 7 <> 0)
  UNION ALL SELECT 'id-' || CAST(c_custkey AS VARCHAR), 2 FROM customer WHERE c_custkey % 3 = 0
) GROUP BY id"""
    runs = """
SELECT CAST(k AS BIGINT) AS id, 'crawl' AS command, '2001-01-01T00:00:00Z' AS started_at, '2002-01-01T00:00:00Z' AS finished_at,
       CASE WHEN k = 1 OR k = 0 AND (SELECT count(*) FROM events WHERE event_type = 'error') > 0 THEN 'completed_with_errors' ELSE 'completed' END AS status
FROM range(3) r(k)"""
    errors = f"""
SELECT event_id AS id, 'drive' AS entity_type, CAST(user_id AS VARCHAR) AS entity_id, CAST(user_id AS VARCHAR) AS drive_id,
       CAST(user_id % 20 AS VARCHAR) AS site_id, 'drive_delta' AS operation, CAST(([401, 403, 404, 410, 423, 429, 503])[event_id % 7 + 1] AS INTEGER) AS status_code,
       substr(repeat('error ' || CAST(event_id AS VARCHAR) || ' ', event_id % 900), 1, 4000) AS message, event_id % 7 > 2 AS retryable,
       false AS resolved, {iso('ts')} AS created_at, {iso('ts')} AS updated_at
FROM events WHERE event_type = 'error'"""
    listed = """
listed AS (SELECT s.id, x.s_suppkey AS k, x.s_name, s.web_url, s.host_name FROM sites s JOIN supplier x ON CAST(x.s_suppkey AS VARCHAR) = s.id),
drive_list AS (
  SELECT id, site_id, CASE WHEN CAST(site_id AS BIGINT) % 3 = 0 THEN id ELSE name END AS name, drive_type, web_url, CAST(site_id AS BIGINT) AS k FROM drives
)"""
    # the batch of moves
    touched = """
numbered AS (SELECT *, TRY_CAST(regexp_extract(id, '^[NS](\\d+)$', 1) AS BIGINT) AS num, TRY_CAST(split_part(id, '-', 1) AS BIGINT) % 12 AS h FROM items),
flagged AS (
  SELECT *, coalesce(item_type = 'folder' AND id LIKE 'N%' AND num % 5 = 1, false) AS renamed,
         coalesce(item_type = 'folder' AND id LIKE 'S%' AND num % 10 = 0, false) AS moved,
         coalesce(item_type = 'folder' AND id LIKE 'N%' AND status = 'deleted' AND num % 2 = 0, false) AS back,
         coalesce(item_type = 'file' AND h IN (0, 6), false) AS hit FROM numbered
),
stepped AS (
  SELECT id, drive_id, item_type, CASE WHEN renamed THEN 'X' || name ELSE name END AS name, CASE WHEN moved THEN 'T' ELSE parent_id END AS parent_id,
         CASE WHEN moved THEN library_name ELSE parent_path END AS parent_path, full_path, renamed OR moved OR back AS own,
         CASE WHEN back THEN 'ok' WHEN hit AND h = 0 THEN 'deleted' ELSE status END AS status,
         size_bytes + CASE WHEN hit THEN 1000 ELSE 0 END AS size_bytes FROM flagged
),
after_items AS (SELECT * REPLACE (CASE WHEN own THEN parent_path || '/' || name ELSE full_path END AS full_path) FROM stepped)"""
    paths = with_(sites, drives, items, touched, """
lf AS (SELECT * FROM after_items WHERE item_type = 'folder' AND status <> 'deleted'),
tree(drive_id, id, path) AS (
  SELECT f.drive_id, f.id, f.full_path FROM lf f LEFT JOIN lf p ON p.drive_id = f.drive_id AND p.id = f.parent_id WHERE p.id IS NULL
  UNION ALL
  SELECT c.drive_id, c.id, t.path || '/' || c.name FROM tree t JOIN lf c ON c.drive_id = t.drive_id AND c.parent_id = t.id
)""") + """
SELECT i.drive_id, i.id, i.item_type, coalesce(t.path, i.parent_path) AS parent_path,
       CASE WHEN t.path IS NOT NULL THEN t.path || '/' || i.name ELSE i.full_path END AS full_path
FROM after_items i LEFT JOIN tree t ON t.drive_id = i.drive_id AND t.id = i.parent_id"""
    tree = cte["rollup"].partition("rolled AS")[0].rstrip().rstrip(",").replace("FROM items", "FROM after_items")
    rollup = with_(sites, drives, items, touched, tree) + "SELECT drive_id, id, file_count, folder_total_size_bytes FROM folder_final"
    carried = with_(cte["changes"], """
early AS (
  SELECT DISTINCT drive_id, id FROM ch WHERE NOT tomb AND page_seq <= (SELECT max(page_seq) // 2 FROM ch)
)""") + f"""
SELECT u.drive_id, u.id, u.size_bytes, CASE WHEN a.dead > u.o THEN 'deleted' ELSE 'ok' END AS status,
       CASE WHEN e.id IS NULL THEN 0 ELSE CAST(u.id AS BIGINT) END AS file_count,
       CASE WHEN e.id IS NULL THEN 0 ELSE CAST(u.id AS BIGINT) * 3 END AS folder_total_size_bytes,
       CASE WHEN e.id IS NOT NULL THEN {fmt_size('CAST(u.id AS BIGINT) * 3')} END AS folder_total_size_formatted
FROM lastu u JOIN lastany a ON a.drive_id = u.drive_id AND a.id = u.id LEFT JOIN early e ON e.drive_id = u.drive_id AND e.id = u.id"""
    first, later = "'2001-01-01T00:00:00Z'", "'2002-01-01T00:00:00Z'"
    return {
        "export_parts": parts,
        "client_report_read_back": report,
        "layer_read_back": known["silver_drives"],
        "report_from_file": known["site_priority"],
        "priority_read_back": priority,
        "id_lists": ids,
        "metrics_read_back": cte["metrics"] + "SELECT * FROM metrics",
        "run_log": runs,
        "error_log": errors,
        "sites_with_url": with_(sites) + """
SELECT id, web_url, name FROM sites WHERE CAST(id AS BIGINT) % 6 > 1 AND web_url <> ''""",
        "folder_depths": with_(sites, drives, items) + """
SELECT CAST(length(full_path) - length(replace(full_path, '/', '')) AS BIGINT) AS depth, item_type, count(*) AS items FROM items GROUP BY ALL""",
        "ingest_sites": with_(sites, drives, listed) + "SELECT id, s_name AS name, web_url, host_name FROM listed",
        "ingest_drives": with_(sites, drives, listed) + "SELECT id, site_id, name, drive_type, web_url FROM drive_list",
        "ingest_user_drives": """
SELECT 'user:' || CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 4 <> 0 THEN c_name WHEN c_custkey % 8 <> 0 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@h.example'
            ELSE CAST(c_custkey AS VARCHAR) END AS name,
       CASE WHEN c_custkey % 8 <> 0 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@h.example' ELSE '' END AS web_url,
       'OneDrive for Business' AS host_name
FROM customer""",
        "sites_merged": with_(sites, drives, listed) + f"""
SELECT id, CASE WHEN k % 5 < 2 THEN 'New ' || s_name ELSE s_name END AS name, web_url, host_name,
       CASE WHEN k % 5 = 0 THEN {later} ELSE {first} END AS discovered_at, CAST(NULL AS VARCHAR) AS processed_at
FROM listed""",
        "drives_merged": with_(sites, drives, listed) + f"""
SELECT id, CASE WHEN k % 4 < 2 THEN 'moved-' || site_id ELSE site_id END AS site_id, name, drive_type, web_url,
       CASE WHEN k % 4 = 0 THEN {later} ELSE {first} END AS discovered_at, CAST(NULL AS VARCHAR) AS processed_at
FROM drive_list""",
        "rebuilt_paths": paths,
        "rollup_updated": rollup,
        "rollup_carried": carried,
    }
