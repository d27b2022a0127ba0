"""Independent SQL answers (DuckDB dialect) for every registered query.

The oracle never sees JSON: it restates the envelope rules of
``daystream.sources.envelopes`` column by column on the provided tables
and computes each answer directly, so a parser or routing bug in the
engine shows up as a mismatch.
"""

from __future__ import annotations

# Rules shared by the log-side answers.
_LOG = """
ev AS (
  SELECT event_id AS i, user_id AS u, event_type, epoch_us(ts) // 1000 AS tsm FROM events
), rec AS (
  SELECT *, i % 211 = 0 AS malformed,
    event_type IN ('view', 'click', 'purchase') AS is_page,
    (event_type = 'signup' AND i % 97 <> 0)
      OR (event_type IN ('view', 'click', 'purchase') AND i % 53 = 0) AS is_start,
    event_type = 'error' AS is_err,
    CAST(i % 4 AS INTEGER) AS src_partition, CAST(i // 4 AS BIGINT) AS src_offset,
    tsm // 86400000 AS batch_id
  FROM ev
), pages AS (
  SELECT concat('mid_', u) AS mid, CAST(u AS VARCHAR) AS user_id,
    CAST(u % 27 AS VARCHAR) AS province_id, concat('ch_', i % 4) AS channel,
    CAST(i % 2 AS VARCHAR) AS is_new, concat('md_', i % 7) AS model,
    concat('os_', i % 3) AS operate_system, concat('v', i % 6) AS version_code,
    concat('ba_', i % 5) AS brand, event_type AS page_id,
    CASE WHEN i % 3 = 0 THEN NULL WHEN i % 3 = 1 AND i % 5 = 0 THEN '' ELSE 'home' END
      AS last_page_id,
    CAST(i % 50 AS VARCHAR) AS page_item, 'sku_id' AS page_item_type,
    CAST(i % 9000 AS BIGINT) AS during_time,
    CASE WHEN i % 4 = 0 THEN 'promotion' ELSE 'query' END AS sourceType, tsm AS ts,
    src_partition, src_offset, i
  FROM rec WHERE NOT malformed AND is_page
)"""

_PAGE_COLS = ("mid, user_id, province_id, channel, is_new, model, operate_system, "
              "version_code, brand, page_id, last_page_id, page_item, page_item_type, "
              "during_time, sourceType")

# Dimension answers: the second version wins unless its type is dropped
# (key % 6 in 4, 5); user keys with c_custkey % 7 = 0 have only dropped
# changes, hence no dimension row.
_DIMS = """
udim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id,
    CASE WHEN c_custkey % 6 IN (4, 5) THEN 'U'
         WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS user_gender,
    CASE WHEN c_custkey % 6 IN (4, 5) THEN DATE '1990-01-01'
         ELSE DATE '1950-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER) END AS bday
  FROM customer WHERE c_custkey % 7 <> 0
), uage AS (
  SELECT user_id, user_gender, strftime(bday, '%Y-%m-%d') AS birthday,
    CAST(year(DATE '2024-01-31') - year(bday)
         - CASE WHEN month(DATE '2024-01-31') * 100 + day(DATE '2024-01-31')
                     < month(bday) * 100 + day(bday) THEN 1 ELSE 0 END AS VARCHAR) AS user_age
  FROM udim
), pdim AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS province_id,
    CASE WHEN n_nationkey % 6 IN (4, 5) THEN concat(n_name, '_v1') ELSE n_name END
      AS province_name,
    concat('ISO_', n_nationkey) AS province_iso_code,
    concat('CN-', n_nationkey) AS province_3166_2,
    CASE WHEN n_nationkey % 6 IN (4, 5) THEN '0'
         ELSE CAST(110000 + n_nationkey * 10000 AS VARCHAR) END AS province_area_code
  FROM nation
)"""

_FIRST = """
sfp AS (
  SELECT *, strftime(epoch_ms(ts), '%Y-%m-%d') AS dt, strftime(epoch_ms(ts), '%H') AS hr
  FROM pages WHERE last_page_id IS NULL
), firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid
                                 ORDER BY ts, src_partition, src_offset) AS rn
    FROM sfp) WHERE rn = 1
)"""

_DAU = """
dau AS (
  SELECT f.mid, f.user_id, f.province_id, f.channel, f.is_new, f.model, f.operate_system,
    f.version_code, f.brand, f.page_id, f.page_item, f.page_item_type, f.sourceType,
    f.during_time, u.user_gender, u.user_age, p.province_name, p.province_iso_code,
    p.province_3166_2, p.province_area_code, f.dt, f.hr, f.ts
  FROM firsts f LEFT JOIN uage u ON f.user_id = u.user_id
  LEFT JOIN pdim p ON f.province_id = p.province_id
)"""

_CHG = """
chg AS (
  SELECT 'order_info' AS tbl, o_orderkey AS k, 0 AS slot, o_orderkey % 6 AS t6 FROM orders
  UNION ALL SELECT 'order_detail', l_orderkey * 8 + l_linenumber, 2,
                   (l_orderkey * 8 + l_linenumber) % 6 FROM lineitem
  UNION ALL SELECT 'sku_info', p_partkey, 4, p_partkey % 6 FROM part
  UNION ALL SELECT 'user_info', c_custkey, 6,
                   CASE WHEN c_custkey % 7 = 0 THEN 4 ELSE 0 END FROM customer
  UNION ALL SELECT 'user_info', c_custkey, 7,
                   CASE WHEN c_custkey % 7 = 0 THEN 4 ELSE c_custkey % 6 END FROM customer
  UNION ALL SELECT 'base_province', n_nationkey, 8, 0 FROM nation
  UNION ALL SELECT 'base_province', n_nationkey, 9, n_nationkey % 6 FROM nation
), ops AS (
  SELECT tbl AS "table", CAST(k AS VARCHAR) AS id, CAST(k % 4 AS INTEGER) AS src_partition,
    CAST((k // 4) * 16 + slot AS BIGINT) AS src_offset,
    ['bootstrap-insert', 'insert', 'update', 'delete', 'bootstrap-start', 'INSERT'][t6 + 1]
      AS type,
    CASE t6 WHEN 0 THEN 'I' WHEN 1 THEN 'I' WHEN 2 THEN 'U' WHEN 3 THEN 'D' END AS op
  FROM chg
)"""

_FACT_TABLES = "('order_info', 'order_detail', 'base_province')"
_DIM_TABLES = "('user_info', 'base_province')"

_LEDGER = """
ranges AS (
  SELECT batch_id, 'ODS_BASE_LOG' AS topic, src_partition AS partition,
    min(src_offset) AS from_offset, max(src_offset) + 1 AS until_offset
  FROM rec GROUP BY batch_id, src_partition
), ledger AS (
  SELECT 'g1' AS group_id, topic, partition, arg_max(until_offset, batch_id) AS until_offset,
    max(batch_id) AS batch_id
  FROM ranges GROUP BY topic, partition
)"""

# Epoch day of 2024-01-15 (last day restored in the two-phase scenarios).
_SPLIT_DAY = 19737


def _w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE_SQL: dict[str, str] = {
    "parse_envelope": _w(_LOG) + """
SELECT src_partition, src_offset,
  CASE WHEN malformed THEN NULL ELSE tsm END AS ts,
  malformed AS is_dead,
  NOT malformed AND is_err AS has_err,
  NOT malformed AND is_page AS has_page,
  NOT malformed AND is_start AS has_start,
  CAST(CASE WHEN NOT malformed AND event_type = 'view' THEN i % 4 ELSE -1 END AS INTEGER)
    AS n_displays,
  CAST(CASE WHEN NOT malformed AND event_type = 'click' THEN 1 + i % 3 ELSE -1 END AS INTEGER)
    AS n_actions,
  CASE WHEN malformed THEN NULL ELSE concat('mid_', u) END AS mid
FROM rec""",

    "parse_page_log": _w(_LOG) + f"SELECT {_PAGE_COLS}, ts FROM pages",
    "page_log": _w(_LOG) + f"SELECT {_PAGE_COLS}, ts FROM pages",
    "session_first_pages": _w(_LOG) + f"SELECT {_PAGE_COLS}, ts FROM pages "
                                      "WHERE last_page_id IS NULL",

    "display_log": _w(_LOG) + f"""
SELECT {_PAGE_COLS},
  CASE WHEN p % 2 = 1 THEN 'query' ELSE 'promotion' END AS display_type,
  CAST((i + p) % 100 AS VARCHAR) AS display_item, 'sku_id' AS display_item_type,
  CAST(p AS VARCHAR) AS display_order, CAST(p % 5 + 1 AS VARCHAR) AS display_pos_id, ts
FROM (SELECT *, unnest(range(1, i % 4 + 1)) AS p FROM pages WHERE page_id = 'view')""",

    "action_log": _w(_LOG) + f"""
SELECT {_PAGE_COLS},
  CASE p WHEN 1 THEN 'favor_add' WHEN 2 THEN 'cart_add' ELSE 'get_coupon' END AS action_id,
  CAST((i * 3 + p) % 100 AS VARCHAR) AS action_item, 'sku_id' AS action_item_type,
  ts + p AS action_ts, ts
FROM (SELECT *, unnest(range(1, i % 3 + 2)) AS p FROM pages WHERE page_id = 'click')""",

    "start_log": _w(_LOG) + """
SELECT concat('mid_', u) AS mid, CAST(u AS VARCHAR) AS user_id,
  CAST(u % 27 AS VARCHAR) AS province_id, concat('ch_', i % 4) AS channel,
  CAST(i % 2 AS VARCHAR) AS is_new, concat('md_', i % 7) AS model,
  concat('os_', i % 3) AS operate_system, concat('v', i % 6) AS version_code,
  concat('ba_', i % 5) AS brand,
  CASE WHEN i % 2 = 0 THEN 'icon' ELSE 'notice' END AS entry,
  CAST(i % 20 AS VARCHAR) AS open_ad_id,
  CAST(i % 5000 + 100 AS BIGINT) AS loading_time_ms, CAST(i % 3000 AS BIGINT) AS open_ad_ms,
  CAST(CASE WHEN i % 4 = 0 THEN NULL ELSE i % 1000 END AS BIGINT) AS open_ad_skip_ms,
  tsm AS ts
FROM rec WHERE NOT malformed AND NOT is_err AND is_start""",

    "error_log": _w(_LOG) + """
SELECT src_partition, src_offset, CAST(1000 + i % 7 AS VARCHAR) AS error_code,
  concat('mid_', u) AS mid, CAST(tsm AS VARCHAR) AS ts_text
FROM rec WHERE NOT malformed AND is_err""",

    "dead_letter": _w(_LOG) + """
SELECT src_partition, src_offset, CASE WHEN i % 3 = 0 THEN 'empty' ELSE 'corrupt' END AS reason
FROM rec WHERE malformed""",

    "log_route_counts": _w(_LOG) + """
SELECT count(*) AS n_records,
  count_if(malformed) AS n_dead,
  count_if(NOT malformed AND is_err) AS n_error,
  count_if(NOT malformed AND is_page) AS n_page,
  count_if(NOT malformed AND is_start) AS n_start,
  count_if(NOT malformed AND is_page AND is_start) AS n_page_and_start,
  count_if(NOT malformed AND NOT is_err AND NOT is_page AND NOT is_start) AS n_neither,
  CAST(sum(CASE WHEN NOT malformed AND event_type = 'view' THEN i % 4 ELSE 0 END) AS BIGINT)
    AS n_display_rows,
  CAST(sum(CASE WHEN NOT malformed AND event_type = 'click' THEN 1 + i % 3 ELSE 0 END)
    AS BIGINT) AS n_action_rows
FROM rec""",

    "route_all_topics": _w(_LOG) + """
SELECT topic, CAST(sum(n) AS BIGINT) AS messages FROM (
  SELECT 'DWD_DEAD_LETTER_20220629' AS topic, CASE WHEN malformed THEN 1 ELSE 0 END AS n FROM rec
  UNION ALL SELECT 'DWD_ERROR_LOG_TOPIC_20220629',
    CASE WHEN NOT malformed AND is_err THEN 1 ELSE 0 END FROM rec
  UNION ALL SELECT 'DWD_PAGE_LOG_TOPIC_20220629',
    CASE WHEN NOT malformed AND is_page THEN 1 ELSE 0 END FROM rec
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC_20220629',
    CASE WHEN NOT malformed AND event_type = 'view' THEN i % 4 ELSE 0 END FROM rec
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC_20220629',
    CASE WHEN NOT malformed AND event_type = 'click' THEN 1 + i % 3 ELSE 0 END FROM rec
  UNION ALL SELECT 'DWD_START_LOG_TOPIC_20220629',
    CASE WHEN NOT malformed AND is_start THEN 1 ELSE 0 END FROM rec
) GROUP BY topic HAVING sum(n) > 0""",

    "cdc_op_map": _w(_CHG) + """
SELECT src_partition, src_offset, "table", type, op FROM ops WHERE op IS NOT NULL""",

    "cdc_fact_route": _w(_CHG) + f"""
SELECT concat('DWD_', upper("table"), '_', op, '_20220629') AS topic,
  src_partition, src_offset, id
FROM ops WHERE op IS NOT NULL AND "table" IN {_FACT_TABLES}""",

    "cdc_route_counts": _w(_CHG) + f"""
SELECT target, count(*) AS messages FROM (
  SELECT concat('DWD_', upper("table"), '_', op, '_20220629') AS target
  FROM ops WHERE op IS NOT NULL AND "table" IN {_FACT_TABLES}
  UNION ALL
  SELECT concat('DIM:', upper("table")) FROM ops
  WHERE op IS NOT NULL AND "table" IN {_DIM_TABLES}
) GROUP BY target""",

    "dim_latest": _w(_CHG) + f"""
SELECT "table", id, op, src_partition, src_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY "table", id ORDER BY src_offset DESC) AS rn
  FROM ops WHERE op IS NOT NULL AND "table" IN {_DIM_TABLES}
) WHERE rn = 1""",

    "dau_first_seen": _w(_LOG, _FIRST) + f"SELECT {_PAGE_COLS}, ts, dt FROM firsts",

    "date_parts": _w(_LOG) + """
SELECT src_partition, src_offset, ts, strftime(epoch_ms(ts), '%Y-%m-%d') AS dt,
  strftime(epoch_ms(ts), '%H') AS hr FROM pages""",

    "user_age": _w(_DIMS) + "SELECT user_id, user_gender, birthday, user_age FROM uage",

    "dau_user_join": _w(_LOG, _DIMS, _FIRST, _DAU) + """
SELECT dt, mid, user_id, user_gender, user_age FROM dau""",

    "dau_province_join": _w(_LOG, _DIMS, _FIRST, _DAU) + """
SELECT dt, mid, province_id, province_name, province_iso_code, province_3166_2,
  province_area_code FROM dau""",

    "dau_info": _w(_LOG, _DIMS, _FIRST, _DAU) + "SELECT * FROM dau",

    "dau_seen_mids": _w(_LOG, _DIMS, _FIRST, _DAU) + "SELECT DISTINCT dt, mid FROM dau",

    "dau_new_only": _w(_LOG, _DIMS, _FIRST, _DAU) + """
SELECT * FROM dau d WHERE dt >= '2024-01-10'
  AND NOT EXISTS (SELECT 1 FROM dau s WHERE s.dt <= '2024-01-15'
                  AND s.dt = d.dt AND s.mid = d.mid)""",

    "dau_new_only_indexed": _w(_LOG, _DIMS, _FIRST, _DAU) + """
SELECT * FROM dau d WHERE dt >= '2024-01-10'
  AND NOT EXISTS (SELECT 1 FROM dau s WHERE s.dt <= '2024-01-15'
                  AND s.dt = d.dt AND s.mid = d.mid)""",

    "dau_upsert": _w(_LOG, _DIMS, _FIRST, _DAU) + "SELECT * FROM dau",

    "dau_funnel_counts": _w(_LOG, _DIMS, _FIRST, _DAU) + """
SELECT 'pages' AS stage, count(*) AS rows FROM pages
UNION ALL SELECT 'session_first', count(*) FROM pages WHERE last_page_id IS NULL
UNION ALL SELECT 'first_seen', count(*) FROM firsts
UNION ALL SELECT 'user_matched', count(u.user_id) FROM firsts f
  LEFT JOIN udim u ON f.user_id = u.user_id
UNION ALL SELECT 'province_matched', count(p.province_id) FROM firsts f
  LEFT JOIN pdim p ON f.province_id = p.province_id""",

    "project_by_name": _w(_LOG) + """
SELECT mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand,
  page_id, page_item, page_item_type, sourceType, during_time,
  CAST(NULL AS VARCHAR) AS user_gender, CAST(NULL AS VARCHAR) AS user_age,
  CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS province_iso_code,
  CAST(NULL AS VARCHAR) AS province_3166_2, CAST(NULL AS VARCHAR) AS province_area_code,
  CAST(NULL AS VARCHAR) AS dt, CAST(NULL AS VARCHAR) AS hr, ts
FROM pages""",

    "offset_ranges": _w(_LOG, _LEDGER) + "SELECT * FROM ranges",

    "offset_ledger_save": _w(_LOG, _LEDGER) + "SELECT * FROM ledger",

    "offset_ledger_read": _w(_LOG, _LEDGER) + "SELECT partition, until_offset FROM ledger",

    "read_from_offsets": _w(_LOG) + f"""
, saved AS (
  SELECT src_partition, max(src_offset) + 1 AS until_offset FROM rec
  WHERE batch_id <= {_SPLIT_DAY} GROUP BY src_partition
)
SELECT r.src_partition AS partition, r.src_offset AS "offset"
FROM rec r LEFT JOIN saved s ON r.src_partition = s.src_partition
WHERE r.src_offset >= coalesce(s.until_offset, 0)""",
}

# Broken copies: of every 97th page position, and of every change whose offset
# is a multiple of 97; they keep the partition, their offset is 2n + 1 and the good one's 2n.
_BAD_CHANGE = """
bad AS (
  SELECT src_partition, src_offset * 2 + 1 AS src_offset, (src_offset // 97) % 6 AS kind
  FROM ops WHERE src_offset % 97 = 0
)"""

ORACLE_SQL.update({
    "page_dead_letter": _w(_LOG) + """
SELECT src_partition, src_offset * 2 + 1 AS src_offset,
  ['corrupt', 'empty', 'missing_mid', 'missing_ts'][1 + (src_offset * 4 + src_partition) // 97 % 4] AS reason
FROM pages WHERE (src_offset * 4 + src_partition) % 97 = 0""",

    "cdc_dead_letter": _w(_CHG, _BAD_CHANGE) + """
SELECT src_partition, src_offset, ['corrupt', 'empty', 'missing_table', 'missing_type', 'missing_data',
  'missing_id'][1 + kind] AS reason FROM bad""",

    "ledger_restart": _w(_LOG) + """
SELECT 'g1' AS group_id, 'ODS_BASE_LOG' AS topic, src_partition AS partition,
  max(src_offset) + 1 AS until_offset, CAST(0 AS BIGINT) AS batch_id
FROM rec GROUP BY src_partition""",

    "dim_store_batches": _w(_CHG) + f"""
SELECT "table", id, op, src_partition, src_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY "table", id ORDER BY src_offset DESC) AS rn
  FROM ops WHERE op IS NOT NULL AND "table" IN {_DIM_TABLES}
) WHERE rn = 1 AND op <> 'D'""",

    "dim_store_fenced": _w(_CHG) + f"""
SELECT "table", id, op, src_partition, src_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY "table", id ORDER BY src_offset DESC) AS rn
  FROM ops WHERE op IS NOT NULL AND "table" IN {_DIM_TABLES}
) WHERE rn = 1 AND op <> 'D'""",

    "dim_point_lookup": _w(_LOG, _FIRST, _CHG) + """
SELECT "table", id, op, src_partition, src_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY "table", id ORDER BY src_offset DESC) AS rn
  FROM ops WHERE op IS NOT NULL AND "table" = 'user_info'
) WHERE rn = 1 AND op <> 'D' AND id IN (SELECT user_id FROM firsts)""",

    "stream_dau_state_restore": _w(_LOG, _FIRST) + """
SELECT dt, mid, count(*) AS rows FROM firsts GROUP BY dt, mid""",

    "stream_dau_ledger": _w(_LOG) + """
SELECT 'dwd_dau' AS group_id, 'DWD_PAGE_LOG_TOPIC_20220629' AS topic, src_partition AS partition,
  max(src_offset * 2 + CASE WHEN (src_offset * 4 + src_partition) % 97 = 0 THEN 1 ELSE 0 END) + 1 AS until_offset
FROM pages GROUP BY src_partition""",

    "stream_cdc_split": _w(_CHG, _BAD_CHANGE) + f"""
SELECT target, count(*) AS rows FROM (
  SELECT concat('DWD_', upper("table"), '_', op, '_20220629') AS target
  FROM ops WHERE op IS NOT NULL AND "table" IN {_FACT_TABLES}
  UNION ALL SELECT 'DWD_DEAD_LETTER_20220629' FROM bad
  UNION ALL SELECT concat('DIM:', upper("table")) FROM (
    SELECT DISTINCT "table", id FROM ops WHERE op IS NOT NULL AND "table" IN {_DIM_TABLES})
) GROUP BY target""",

    "route_payloads": _w(_LOG) + """
, base AS (
  SELECT *, CAST(NULL AS VARCHAR) AS none FROM pages
), starts AS (
  SELECT concat('mid_', u) AS mid, CAST(u AS VARCHAR) AS user_id, CAST(u % 27 AS VARCHAR) AS province_id,
    concat('ch_', i % 4) AS channel, CAST(i % 2 AS VARCHAR) AS is_new, concat('md_', i % 7) AS model,
    concat('os_', i % 3) AS operate_system, concat('v', i % 6) AS version_code, concat('ba_', i % 5) AS brand, *
  FROM rec WHERE NOT malformed AND NOT is_err AND is_start
), views AS (SELECT *, unnest(range(1, i % 4 + 1)) AS p FROM base WHERE page_id = 'view'),
clicks AS (SELECT *, unnest(range(1, i % 3 + 2)) AS p FROM base WHERE page_id = 'click'),
every AS (
  SELECT 'DWD_PAGE_LOG_TOPIC_20220629' AS topic, src_partition, src_offset, mid, user_id, province_id, channel, is_new, model,
    operate_system, version_code, brand, page_id, last_page_id, page_item, page_item_type, CAST(during_time AS VARCHAR) AS during_time, sourceType,
    none AS display_type, none AS display_item, none AS display_order, none AS display_pos_id, none AS action_id, none AS action_item, none AS action_ts,
    none AS entry, none AS open_ad_id, none AS loading_time_ms, none AS open_ad_ms, none AS open_ad_skip_ms, CAST(ts AS VARCHAR) AS ts FROM base
  UNION ALL
  SELECT 'DWD_PAGE_DISPLAY_TOPIC_20220629', src_partition, src_offset, mid, user_id, province_id, channel, is_new, model,
    operate_system, version_code, brand, page_id, last_page_id, page_item, page_item_type, CAST(during_time AS VARCHAR), sourceType,
    CASE WHEN p % 2 = 1 THEN 'query' ELSE 'promotion' END, CAST((i + p) % 100 AS VARCHAR), CAST(p AS VARCHAR), CAST(p % 5 + 1 AS VARCHAR),
    none, none, none, none, none, none, none, none, CAST(ts AS VARCHAR) FROM views
  UNION ALL
  SELECT 'DWD_PAGE_ACTION_TOPIC_20220629', src_partition, src_offset, mid, user_id, province_id, channel, is_new, model,
    operate_system, version_code, brand, page_id, last_page_id, page_item, page_item_type, CAST(during_time AS VARCHAR), sourceType,
    none, none, none, none, CASE p WHEN 1 THEN 'favor_add' WHEN 2 THEN 'cart_add' ELSE 'get_coupon' END, CAST((i * 3 + p) % 100 AS VARCHAR), CAST(ts + p AS VARCHAR),
    none, none, none, none, none, CAST(ts AS VARCHAR) FROM clicks
  UNION ALL
  SELECT 'DWD_START_LOG_TOPIC_20220629', src_partition, src_offset, mid, user_id, province_id, channel, is_new, model,
    operate_system, version_code, brand, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    CASE WHEN i % 2 = 0 THEN 'icon' ELSE 'notice' END, CAST(i % 20 AS VARCHAR), CAST(i % 5000 + 100 AS VARCHAR), CAST(i % 3000 AS VARCHAR),
    CASE WHEN i % 4 = 0 THEN NULL ELSE CAST(i % 1000 AS VARCHAR) END, CAST(tsm AS VARCHAR) FROM starts
) SELECT * FROM every""",

    "cdc_fact_payloads": """
WITH image AS (
  SELECT 'ORDER_INFO' AS t, o_orderkey AS k, 0 AS slot, o_orderkey % 6 AS t6, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS order_status,
    o_totalprice AS total_amount, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time, CAST(NULL AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS sku_id,
    CAST(NULL AS VARCHAR) AS sku_num, CAST(NULL AS DOUBLE) AS order_price, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS region_id,
    CAST(NULL AS VARCHAR) AS area_code, CAST(NULL AS VARCHAR) AS iso_code, CAST(NULL AS VARCHAR) AS iso_3166_2 FROM orders
  UNION ALL SELECT 'ORDER_DETAIL', l_orderkey * 8 + l_linenumber, 2, (l_orderkey * 8 + l_linenumber) % 6, NULL, NULL, NULL, NULL,
    CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), l_extendedprice, NULL, NULL, NULL, NULL, NULL FROM lineitem
  UNION ALL SELECT 'BASE_PROVINCE', n_nationkey, s, CASE WHEN s = 8 THEN 0 ELSE n_nationkey % 6 END, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    CASE WHEN s = 8 THEN concat(n_name, '_v1') ELSE n_name END, CAST(n_regionkey AS VARCHAR),
    CASE WHEN s = 8 THEN '0' ELSE CAST(110000 + n_nationkey * 10000 AS VARCHAR) END, concat('ISO_', n_nationkey), concat('CN-', n_nationkey)
    FROM nation, (VALUES (8), (9)) v(s)
)
SELECT concat('DWD_', t, '_', ['I', 'I', 'U', 'D'][t6 + 1], '_20220629') AS topic, CAST(k AS VARCHAR) AS key, CAST(k AS VARCHAR) AS id,
  CAST(k % 4 AS INTEGER) AS src_partition, CAST((k // 4) * 16 + slot AS BIGINT) AS src_offset, * EXCLUDE (t, k, slot, t6)
FROM image WHERE t6 < 4""",
})
ORACLE_SQL["cdc_replay_routing"] = _w(_CHG) + f"""
SELECT target, count(*) AS rows FROM (
  SELECT concat('DWD_', upper("table"), '_', op, '_20220629') AS target
  FROM ops WHERE op IS NOT NULL AND "table" IN {_FACT_TABLES}
  UNION ALL SELECT concat('DIM:', upper("table")) FROM (
    SELECT DISTINCT "table", id FROM ops WHERE op IS NOT NULL AND "table" IN {_DIM_TABLES})
) GROUP BY target"""
ORACLE_SQL["read_from_offsets_pruned"] = ORACLE_SQL["read_from_offsets"]
ORACLE_SQL["ledger_fenced"] = ORACLE_SQL["ledger_restart"]
ORACLE_SQL["stream_funnel_log"] = ORACLE_SQL["dau_funnel_counts"]
ORACLE_SQL["stream_log_restart"] = ORACLE_SQL["route_all_topics"]
# The streaming forms must give the batch answers.
ORACLE_SQL["stream_route_counts"] = ORACLE_SQL["route_all_topics"]
for _name in ("stream_dau_info", "stream_dau_state_rows", "stream_dau_late_rows", "dau_upsert_versions"):
    ORACLE_SQL[_name] = ORACLE_SQL["dau_info"]
