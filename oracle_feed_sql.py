"""DuckDB SQL of the change-feed store's queries: every page and event is
applied in order, whatever order it landed in."""

from __future__ import annotations


def feed_queries(with_, iso, fmt_size, pages: str) -> dict[str, str]:
    rows = f"""
ev AS (SELECT *, json_extract_string(props, '$.k') AS k, CAST(floor(event_id / 100) AS BIGINT) AS page_seq FROM events),
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id, page_seq ORDER BY event_id) - 1 AS row_idx FROM ev),
raw AS (
  SELECT p.k AS id, l.drive_id, l.site_id, l.library_name, event_id, p.row_idx, l.page_seq, l.collected_at,
         CASE WHEN event_id % 11 <> 0 THEN 'item-' || k || (['.PDF', '.docx', '', '.tar.gz'])[event_id % 4 + 1] ELSE k END AS name,
         CASE WHEN event_id % 13 <> 0 THEN CAST(floor(value * 100) AS BIGINT) ELSE 0 END AS size_bytes,
         CASE WHEN event_id % 10 IN (0, 1) THEN 'folder' ELSE 'file' END AS item_type,
         event_id % 50 = 7 AS is_root, event_type = 'error' AS is_tombstone, {iso('p.ts')} AS modified_at
  FROM placed p JOIN plog l ON l.drive_id = CAST(p.user_id AS VARCHAR) AND l.page_seq = p.page_seq WHERE k IS NOT NULL
),
pathed AS (
  SELECT *, CASE WHEN is_root OR event_id % 4 = 0 THEN '' WHEN event_id % 4 IN (1, 2) THEN library_name
                 ELSE library_name || '/dir-' || id || '/sub' END AS parent_path FROM raw
),
rec AS (
  SELECT drive_id, id, site_id, library_name, CASE WHEN NOT is_root THEN CAST(event_id % 17 AS VARCHAR) END AS parent_id, parent_path,
         CASE WHEN parent_path = '' THEN name ELSE parent_path || '/' || name END AS full_path, name, item_type,
         CASE WHEN item_type = 'file' AND name LIKE '%.PDF' THEN 'pdf' WHEN item_type = 'file' AND name LIKE '%.docx' THEN 'docx'
              WHEN item_type = 'file' AND name LIKE '%.tar.gz' THEN 'gz' END AS extension,
         CASE WHEN event_id % 3 <> 0 THEN 'application/x' END AS mime_type, size_bytes, {fmt_size('size_bytes')} AS formatted_size,
         modified_at, 'https://h.example/' || CAST(event_id AS VARCHAR) AS web_url, collected_at, page_seq, row_idx, is_tombstone
  FROM pathed
)"""
    # the fold: the last upsert, and a tombstone after it
    fold = """
ranked AS (SELECT *, page_seq * 20000000 + CASE WHEN is_tombstone THEN 10000000 ELSE 0 END + row_idx AS o FROM counted),
ups AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY drive_id, id ORDER BY o DESC) AS rn FROM ranked WHERE NOT is_tombstone) WHERE rn = 1
),
tombs AS (SELECT drive_id, id, max(o) AS dead, arg_max(collected_at, o) AS dead_at FROM ranked WHERE is_tombstone GROUP BY drive_id, id),
folded AS (
  SELECT u.drive_id, u.id, u.site_id, u.library_name, u.parent_id, u.parent_path, u.full_path, u.name, u.item_type, u.extension, u.mime_type,
         u.size_bytes, u.formatted_size, u.modified_at, u.web_url, CASE WHEN t.dead > u.o THEN 'deleted' ELSE 'ok' END AS status,
         CASE WHEN t.dead > u.o THEN t.dead_at ELSE u.collected_at END AS collected_at, u.page_seq
  FROM ups u LEFT JOIN tombs t ON t.drive_id = u.drive_id AND t.id = u.id
)"""
    every = "counted AS (SELECT * FROM rec)"
    middle = "middle AS (SELECT max(page_seq) // 2 AS m FROM plog)"
    fenced = """
fences AS (
  SELECT drive_id, max(page_seq) AS fence FROM plog, middle
  WHERE site_id = '7' AND page_seq <= m AND page_seq % 5 <> 2 GROUP BY drive_id
),
counted AS (SELECT r.* FROM rec r LEFT JOIN fences f ON f.drive_id = r.drive_id WHERE f.fence IS NULL OR r.page_seq > f.fence)"""
    errs = """
errs AS (
  SELECT CAST(user_id AS VARCHAR) AS drive_id, CAST(user_id % 20 AS VARCHAR) AS site_id, CAST(floor(event_id / 100) AS BIGINT) AS seq, event_id AS no,
         ([401, 403, 404, 410, 423, 429, 503])[event_id % 7 + 1] AS code, 'error ' || CAST(event_id AS VARCHAR) AS message, TS AS tm
  FROM events WHERE event_type = 'error'
)""".replace("TS", iso("ts"))
    sync = f"""
claims AS (
  SELECT CAST(user_id AS VARCHAR) AS drive_id, CAST(user_id % 20 AS VARCHAR) AS site_id, CAST(floor(event_id / 100) AS BIGINT) AS seq,
         event_id AS no, CAST(event_id % 7 + 1 AS INTEGER) AS attempt, {iso('ts')} AS tm
  FROM events WHERE event_type <> 'error' AND event_id % 31 = 0
),
known AS (
  SELECT drive_id, site_id, page_seq AS seq FROM plog UNION ALL
  SELECT drive_id, site_id, seq FROM errs WHERE no % 2 = 0 UNION ALL SELECT drive_id, site_id, seq FROM claims WHERE no % 2 = 0
),
resets AS (
  SELECT drive_id, any_value(site_id) AS site_id, max(seq) AS seq, any_value(site_id) = '7' AS whole FROM known, middle
  WHERE seq <= m AND site_id IN ('3', '7') GROUP BY drive_id
),
-- o: order; then for each field a struct where the event sets it
marks AS (
  SELECT drive_id, page_seq * 3 * 10000000000 AS o, site_id, library_name AS lib, collected_at AS tm,
         {{'v': CASE WHEN delta_link IS NOT NULL THEN 'done' WHEN next_link IS NOT NULL THEN 'in_progress' ELSE 'pending' END}} AS status,
         CASE WHEN next_link IS NOT NULL OR delta_link IS NOT NULL THEN {{'v': CASE WHEN delta_link IS NULL THEN next_link END}} END AS nl,
         CASE WHEN delta_link IS NOT NULL THEN {{'v': delta_link}} END AS dl,
         CASE WHEN delta_link IS NOT NULL THEN {{'v': CAST(NULL AS VARCHAR)}}
              WHEN next_link IS NULL THEN {{'v': 'Resposta delta sem @odata.nextLink nem @odata.deltaLink'}} END AS le,
         CASE WHEN delta_link IS NOT NULL THEN {{'v': collected_at}} END AS done_at,
         CAST(NULL AS STRUCT(v VARCHAR)) AS start_at, CAST(NULL AS STRUCT(v INTEGER)) AS att
  FROM plog
  UNION ALL
  SELECT drive_id, (seq * 3 + 1) * 10000000000 + no, site_id, NULL, tm,
         {{'v': CASE WHEN code IN (401, 403, 404) THEN 'failed' ELSE 'pending' END}},
         CASE WHEN code = 410 THEN {{'v': CAST(NULL AS VARCHAR)}} END, CASE WHEN code = 410 THEN {{'v': CAST(NULL AS VARCHAR)}} END,
         {{'v': CASE WHEN code = 410 THEN 'Delta token expirado/invalido. Proxima tentativa fara carga completa.' ELSE message END}}, NULL, NULL, NULL
  FROM errs
  UNION ALL
  SELECT drive_id, (seq * 3 + 1) * 10000000000 + no, site_id, NULL, tm, {{'v': 'in_progress'}}, NULL, NULL, NULL, NULL, {{'v': tm}}, {{'v': attempt}}
  FROM claims
  UNION ALL
  SELECT drive_id, (seq * 3 + 2) * 10000000000, site_id, NULL, '2024-12-31T00:00:00Z', {{'v': 'pending'}}, {{'v': NULL}}, {{'v': NULL}}, {{'v': NULL}},
         CASE WHEN whole THEN {{'v': CAST(NULL AS VARCHAR)}} END, CASE WHEN whole THEN {{'v': CAST(NULL AS VARCHAR)}} END,
         CASE WHEN whole THEN {{'v': 0}} END
  FROM resets
)"""
    state = """
SELECT drive_id, arg_max(site_id, o) AS site_id, arg_max(lib, o) FILTER (WHERE lib IS NOT NULL) AS library_name, CAST(NULL AS VARCHAR) AS mode,
       (arg_max(status, o)).v AS status, coalesce((arg_max(att, o) FILTER (WHERE att IS NOT NULL)).v, 0) AS attempts,
       (arg_max(nl, o) FILTER (WHERE nl IS NOT NULL)).v AS next_link, (arg_max(dl, o) FILTER (WHERE dl IS NOT NULL)).v AS delta_link,
       (arg_max(le, o) FILTER (WHERE le IS NOT NULL)).v AS last_error, arg_min(tm, o) AS created_at, arg_max(tm, o) AS updated_at,
       (arg_max(start_at, o) FILTER (WHERE start_at IS NOT NULL)).v AS last_started_at,
       (arg_max(done_at, o) FILTER (WHERE done_at IS NOT NULL)).v AS last_completed_at
FROM marks GROUP BY drive_id"""
    relists = """
done AS (SELECT drive_id, page_seq AS to_seq, collected_at AS to_at FROM plog WHERE delta_link IS NOT NULL),
relists AS (
  SELECT d.drive_id, max(e.seq) AS from_seq, any_value(to_at) AS to_at FROM done d JOIN errs e ON e.drive_id = d.drive_id
  WHERE e.code = 410 AND e.seq < d.to_seq GROUP BY d.drive_id
)"""
    return {
        "ingest_pages": with_(pages, rows) + "SELECT * FROM rec",
        "ingest_page_log": with_(pages) + "SELECT * FROM plog",
        "feed_items": with_(pages, rows, every, fold) + "SELECT * EXCLUDE (page_seq) FROM folded",
        "log_after_reset": with_(pages, rows, middle, fenced, fold) + "SELECT * EXCLUDE (page_seq) FROM folded",
        "sync_events": with_(pages, middle, errs, sync) + state,
        "reconciled_items": with_(pages, rows, every, fold, errs, relists) + """
SELECT f.drive_id, f.id, f.name, CASE WHEN f.status = 'ok' AND f.page_seq <= r.from_seq THEN 'deleted' ELSE f.status END AS status,
       CASE WHEN f.status = 'ok' AND f.page_seq <= r.from_seq THEN r.to_at ELSE f.collected_at END AS collected_at
FROM folded f LEFT JOIN relists r ON r.drive_id = f.drive_id""",
    }
