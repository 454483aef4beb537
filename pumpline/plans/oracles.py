"""DuckDB SQL for each catalogue query, over the raw driver tables.

The fixture views (FIXTURES.md section 2) are written inline as CTEs with the
same expressions the Spark side uses.  Testdata parameters: thresholds
100 / 45, horizons 86,400 s.
"""

from __future__ import annotations

KEY = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"

R = """R AS (
  SELECT event_id, user_id AS device_id, ts, event_type,
         CASE WHEN event_id % 7 <> 0 THEN value END AS s04,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS s10,
         CAST(CASE WHEN event_id % 19 = 0 THEN 0.5
                   WHEN value > 100 OR event_id % 13 = 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS pred,
         CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_type = 'error' THEN 'BROKEN'
              WHEN event_type = 'signup' THEN 'RECOVERING' ELSE 'NORMAL' END AS machine_status
  FROM events)"""

V = "V AS (SELECT * FROM R WHERE s04 IS NOT NULL AND s10 IS NOT NULL AND pred IS NOT NULL)"
VS = ("VS AS (SELECT * FROM R WHERE event_type NOT IN ('error', 'signup') "
      "AND s04 IS NOT NULL AND s10 IS NOT NULL AND pred IS NOT NULL)")

S = """S AS (
  SELECT event_id, user_id AS device_id, ts,
         CASE WHEN event_id % 2 = 0 THEN 'batch' ELSE 'speed' END AS source,
         event_type = 'signup' AS online, event_type AS detail
  FROM events WHERE event_type IN ('error', 'signup'))"""


def cells_cte(key_expr: str = KEY, src: str = "R", name: str = "C") -> str:
    parts = []
    for fam, q, col in (("status", "real", "machine_status"), ("status", "pred", "CAST(pred AS VARCHAR)"),
                        ("wave", "s04", "CAST(s04 AS VARCHAR)"), ("wave", "s10", "CAST(s10 AS VARCHAR)")):
        parts.append(f"SELECT {key_expr} AS row_key, '{fam}' AS family, '{q}' AS qualifier, {col} AS value, "
                     f"event_id AS version FROM {src}")
    union = "\n    UNION ALL ".join(parts)
    return f"""{name}0 AS (
    {union}),
{name} AS (
  SELECT row_key, family, qualifier,
         CASE WHEN version % 29 = 0 AND family = 'wave' AND qualifier = 's10' THEN 'bad' ELSE value END AS value,
         version
  FROM {name}0
  WHERE value IS NOT NULL AND NOT (version % 11 = 0 AND family = 'status' AND qualifier = 'pred'))"""


PIVOT = """P AS (
  SELECT row_key,
    arg_max(value, version) FILTER (WHERE family = 'status' AND qualifier = 'real') AS real,
    arg_max(value, version) FILTER (WHERE family = 'status' AND qualifier = 'pred') AS pred,
    arg_max(value, version) FILTER (WHERE family = 'wave' AND qualifier = 's04') AS s04,
    arg_max(value, version) FILTER (WHERE family = 'wave' AND qualifier = 's10') AS s10
  FROM C GROUP BY row_key)"""

REASON = """CASE WHEN concat_ws(' + ',
      CASE WHEN {s04} > 100.0 AND NOT isnan({s04}) THEN '振动超标' END,
      CASE WHEN {s10} > 45.0 AND NOT isnan({s10}) THEN '温度过高' END) = '' THEN '未知突变'
    ELSE concat_ws(' + ',
      CASE WHEN {s04} > 100.0 AND NOT isnan({s04}) THEN '振动超标' END,
      CASE WHEN {s10} > 45.0 AND NOT isnan({s10}) THEN '温度过高' END) END"""


def reason(s04: str = "s04", s10: str = "s10") -> str:
    return REASON.format(s04=s04, s10=s10)


def message(key: str, s04: str = "s04", s10: str = "s10") -> str:
    return (f"'设备告警：' || {reason(s04, s10)} || ' | key=' || {key} || ' | S04=' || printf('%.1f', {s04})"
            f" || ' | S10=' || printf('%.1f', {s10})")


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


R_COLS = "event_id, device_id, ts, event_type, s04, s10, pred, machine_status"

W = """W AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_id, l_shipdate AS ts,
         l_quantity, l_extendedprice, l_discount, l_tax,
         CAST(CASE WHEN l_quantity >= 40 AND l_discount > 0.05 THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM lineitem)"""
FW = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TEST = """, TS AS (SELECT * FROM W WHERE CAST(('0x' || substr(md5(row_id), 1, 8)) AS BIGINT) % 100 >= 80)
"""
DEVICE_KEY = "strftime(ts, '%Y-%m-%d %H:00:00.000000') || '#' || device_id"

MUTE = """O AS (
  SELECT user_id AS device_id, event_id, ts, epoch_us(ts) AS x,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type = 'signup'),
RC AS (
  SELECT device_id, rn, x, x + 86400000000 AS until FROM O WHERE rn = 1
  UNION ALL
  SELECT o.device_id, o.rn, o.x, CASE WHEN r.until > o.x THEN 0 ELSE o.x + 86400000000 END
  FROM RC r JOIN O o ON o.device_id = r.device_id AND o.rn = r.rn + 1),
TOG AS (
  SELECT o.device_id, o.event_id, o.ts, o.x, RC.until > 0 AS opens,
         lead(o.x) OVER (PARTITION BY o.device_id ORDER BY o.rn) AS nx, RC.until
  FROM O o JOIN RC USING (device_id, rn)),
MW AS (
  SELECT device_id, ts AS start_ts,
         make_timestamp(CASE WHEN nx IS NOT NULL AND nx < until THEN nx ELSE until END) AS end_ts
  FROM TOG WHERE opens)"""

TEXT = f"""T AS (
  SELECT device_id, ts, event_id, {KEY} AS row_key,
         CAST(s04 AS VARCHAR) AS s04t,
         CASE WHEN event_id % 29 = 0 THEN 'bad' ELSE CAST(s10 AS VARCHAR) END AS s10t,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(pred AS VARCHAR) END AS predt
  FROM R WHERE event_type NOT IN ('error', 'signup')),
PT AS (
  SELECT *, TRY_CAST(s04t AS DOUBLE) AS s04n, TRY_CAST(s10t AS DOUBLE) AS s10n, TRY_CAST(predt AS DOUBLE) AS predn,
         CASE WHEN s04t IS NULL OR s10t IS NULL OR predt IS NULL THEN 'missing'
              WHEN TRY_CAST(s04t AS DOUBLE) IS NULL OR TRY_CAST(s10t AS DOUBLE) IS NULL
                   OR TRY_CAST(predt AS DOUBLE) IS NULL THEN 'unparseable' END AS reason
  FROM T)"""

EVLOG = f"""POLLS AS (
  SELECT device_id, ts, event_id, true AS poll, 0 AS n, 0 AS a FROM S WHERE source = 'batch' AND online
  UNION ALL
  SELECT device_id, ts, event_id, false, CASE WHEN predn = 0 THEN 1 ELSE 0 END, CASE WHEN predn <> 0 THEN 1 ELSE 0 END
  FROM PT WHERE reason IS NULL),
MACRO AS (
  SELECT device_id, ts, event_id, poll,
         CAST(sum(n) OVER mw AS BIGINT) AS normal, CAST(sum(a) OVER mw AS BIGINT) AS anomaly
  FROM POLLS WINDOW mw AS (PARTITION BY device_id ORDER BY ts, poll, event_id ROWS UNBOUNDED PRECEDING)),
RECS1 AS (
  SELECT device_id, ts, 1 AS seq, event_id, 'log' AS tag, 'ERROR' AS level,
         {message('row_key', 's04n', 's10n')} AS message, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS BOOLEAN) AS online
  FROM PT WHERE reason IS NULL AND predn = 1.0
  UNION ALL
  SELECT device_id, ts, 1, event_id, 'micro', NULL,
         '最近采样 | key=' || row_key || ' | S04=' || printf('%.1f', s04n) || ' | S10=' || printf('%.1f', s10n)
         || ' | PRED=' || CASE WHEN predn = 1.0 THEN 'ALERT' ELSE 'NORMAL' END, NULL, NULL
  FROM PT WHERE reason IS NULL
  UNION ALL
  SELECT user_id, ts, 4, event_id, 'log', CASE WHEN event_id % 4 = 3 THEN 'ERROR' ELSE 'INFO' END,
         CASE WHEN event_id % 4 = 3 THEN '日志导出失败：disk full' ELSE '日志导出成功：/logs/' || event_id || '.txt' END, NULL, NULL
  FROM events WHERE event_type = 'purchase' AND event_id % 34 = 1
  UNION ALL
  SELECT device_id, ts, 1, event_id, 'log', 'WARN',
         'HBase 行解析失败 [' || row_key || ']：' ||
         CASE WHEN reason = 'missing' THEN '''缺少必要列 wave:s04 / wave:s10 / status:pred'''
              ELSE 'could not convert string to float: ''' ||
                   CASE WHEN s04n IS NULL THEN s04t WHEN s10n IS NULL THEN s10t ELSE predt END || '''' END,
         NULL, NULL
  FROM PT WHERE reason IS NOT NULL
  UNION ALL
  SELECT device_id, ts, 0, event_id, 'status', NULL, detail, source, online FROM S
  UNION ALL
  SELECT device_id, ts, 0, event_id, 'log', 'WARN',
         CASE WHEN source = 'batch' THEN 'Hive 同步失败: ' ELSE 'HBase 连接/扫描失败: ' END || detail, NULL, NULL
  FROM S WHERE NOT online
  UNION ALL
  SELECT device_id, ts, 2, event_id, 'log', 'INFO',
         CASE WHEN opens THEN '已开启 5 分钟告警静默窗口。' ELSE '告警静默已取消，恢复完整告警显示。' END, NULL, NULL
  FROM TOG
  UNION ALL
  SELECT user_id, ts, 3, event_id, 'log', 'INFO', '操作员已清空界面日志。', NULL, NULL
  FROM events WHERE event_type = 'purchase' AND event_id % 17 = 0),
RECS0 AS (
  SELECT *, CAST(NULL AS BIGINT) AS normal, CAST(NULL AS BIGINT) AS anomaly FROM RECS1
  UNION ALL
  SELECT device_id, ts, 0, event_id, 'macro', NULL, NULL, 'batch', NULL, normal, anomaly FROM MACRO WHERE poll),
RECS AS (
  SELECT * FROM RECS0
  UNION ALL
  SELECT device_id, min(ts), -1, CAST(-1 AS BIGINT), 'log', 'INFO',
         '工业监控大屏已启动，正在接入 Hive / HBase 数据源 ...', NULL, NULL, NULL, NULL
  FROM RECS0 GROUP BY device_id),
EL AS (
  SELECT r.*, (coalesce(r.level = 'ERROR', false) AND EXISTS (
           SELECT 1 FROM TOG m WHERE m.device_id = r.device_id AND m.opens AND epoch_us(r.ts) < m.until
             AND (m.ts < r.ts OR (m.ts = r.ts AND r.seq > 2))
             AND (m.nx IS NULL OR m.nx > epoch_us(r.ts) OR (m.nx = epoch_us(r.ts) AND r.seq < 2)))) AS muted
  FROM RECS r),
EVL AS (
  SELECT *, CASE WHEN tag = 'log' THEN
           '[' || strftime(ts, '%H:%M:%S.%g') || '] ' ||
           CASE WHEN level = 'ERROR' THEN '🔴' WHEN level = 'WARN' THEN '🟠' ELSE '🟢' END || ' ' ||
           CASE WHEN muted THEN '[静默期仍记录] ' ELSE '' END || message END AS line
  FROM EL)"""

LOGC = [R, S, TEXT, MUTE, EVLOG]

LASTCLEAR = """LC AS (
  SELECT user_id AS device_id, arg_max(ts, (ts, event_id)) AS cts, arg_max(event_id, (ts, event_id)) AS ceid
  FROM events WHERE event_type = 'purchase' AND event_id % 17 = 0 GROUP BY user_id),
SC AS (
  SELECT e.* FROM EVL e LEFT JOIN LC USING (device_id)
  WHERE e.tag = 'log' AND (LC.cts IS NULL OR e.ts > LC.cts
        OR (e.ts = LC.cts AND (e.seq > 3 OR (e.seq = 3 AND e.event_id >= LC.ceid)))))"""


def _waveform(n: int) -> str:
    return w(R, V, "L AS (SELECT device_id, s04, s10, row_number() OVER (PARTITION BY device_id "
                   "ORDER BY ts DESC, event_id DESC) AS r FROM V)") + f"""
SELECT device_id, CAST({n} - r AS INTEGER) AS pos, s04, s10 FROM L WHERE r <= {n}
UNION ALL
SELECT device_id, CAST(g AS INTEGER) AS pos, CAST(640.0 AS DOUBLE) AS s04, CAST(40.0 AS DOUBLE) AS s10
FROM (SELECT device_id, count(*) AS c FROM L WHERE r <= {n} GROUP BY device_id) q, range(0, {n}) t(g)
WHERE g < {n} - c"""


def _macro(src: str, by: str) -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return (f"SELECT {sel}count(*) FILTER (WHERE pred = 0) AS normal, count(*) FILTER (WHERE pred <> 0) AS anomaly, "
            f"count(*) FILTER (WHERE pred IS NULL) AS unknown, count(*) AS total FROM {src}{grp}")


RECONNECTS = """RX AS (
  SELECT device_id, source,
         (lag(online) OVER (PARTITION BY device_id, source ORDER BY ts, event_id) = false AND online) AS rc
  FROM S),
RCN AS (
  SELECT device_id,
         count(*) FILTER (WHERE rc AND source = 'batch') AS batch_reconnects,
         count(*) FILTER (WHERE rc AND source = 'speed') AS speed_reconnects
  FROM RX GROUP BY device_id)"""

ORACLES: dict[str, str] = {
    # --- A
    "csv_scan_typed": w(R) + f"SELECT {R_COLS} FROM R",
    "bronze_landing": w(R) + f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(device_id AS VARCHAR) AS device_id,
  {KEY} AS ts, event_type, CAST(s04 AS VARCHAR) AS s04, CAST(s10 AS VARCHAR) AS s10,
  CAST(pred AS VARCHAR) AS pred, machine_status FROM R""",
    "parquet_scan": "SELECT event_id, user_id AS device_id, ts, event_type, value FROM events",
    "parquet_scan_pushdown": "SELECT event_id, user_id AS device_id, ts, value FROM events "
                             "WHERE event_type = 'error' AND value > 50",
    "parquet_roundtrip": w(R) + f"SELECT {R_COLS}, CAST(ts AS DATE) AS dt FROM R",
    "external_table": w(R) + """SELECT ts AS "timestamp", machine_status,
  CAST(CASE WHEN machine_status = 'NORMAL' THEN 0 ELSE 1 END AS INTEGER) AS label, pred AS prediction FROM R""",
    "wide_unpivot": w(R) + """SELECT * FROM (
  SELECT """ + KEY + """ AS row_key, 'status' AS family, 'real' AS qualifier, machine_status AS value, event_id AS version FROM R
  UNION ALL SELECT """ + KEY + """, 'status', 'pred', CAST(pred AS VARCHAR), event_id FROM R
  UNION ALL SELECT """ + KEY + """, 'wave', 's04', CAST(s04 AS VARCHAR), event_id FROM R
  UNION ALL SELECT """ + KEY + """, 'wave', 's10', CAST(s10 AS VARCHAR), event_id FROM R) u WHERE value IS NOT NULL""",
    "wide_pivot": w(R, cells_cte(), PIVOT) + """SELECT row_key, TRY_CAST(s04 AS FLOAT) AS s04,
  TRY_CAST(s10 AS FLOAT) AS s10, TRY_CAST(pred AS FLOAT) AS pred FROM P""",
    "keyed_upsert": w(R, cells_cte("strftime(ts, '%Y-%m-%d %H:00:00.000000')", "R", "C"),
                      "B AS (SELECT C.*, CASE WHEN e.event_type IN ('click', 'view') THEN 1 ELSE 2 END AS batch "
                      "FROM C JOIN events e ON e.event_id = C.version)") + """
SELECT row_key, family, qualifier, value, version FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY batch DESC, version DESC) AS rn
  FROM B) z WHERE rn = 1""",
    "wide_pivot_devices": w(R, cells_cte(DEVICE_KEY), PIVOT) + """SELECT row_key, TRY_CAST(s04 AS FLOAT) AS s04,
  TRY_CAST(s10 AS FLOAT) AS s10, TRY_CAST(pred AS FLOAT) AS pred FROM P""",
    "external_upsert": w(R, cells_cte()) + """SELECT row_key, family, qualifier, value FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC) AS rn FROM C) z WHERE rn = 1""",
    "keyed_upsert_devices": w(R, cells_cte(DEVICE_KEY)) + """
SELECT row_key, family, qualifier, value, version FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version % 3 DESC, version DESC) AS rn
  FROM C) z WHERE rn = 1""",
    "latest_row": w(R, cells_cte(), PIVOT) + "SELECT row_key, real, pred, s04, s10 FROM P ORDER BY row_key DESC LIMIT 1",
    # --- B
    "drop_columns": w(R) + f"SELECT {R_COLS} FROM R",
    "null_profile": w(R) + "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if c in ('s04', 's10', 'pred') else ''}) AS null_count, "
        f"count(*) AS total, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if c in ('s04', 's10', 'pred') else ''}) AS DOUBLE)"
        f" / count(*) AS null_fraction, "
        f"count(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if c in ('s04', 's10', 'pred') else ''}) = count(*) "
        f"AND count(*) > 0 AS all_missing FROM (SELECT *, CAST(NULL AS DOUBLE) AS sensor_15 FROM R) x"
        for i, c in enumerate(["event_id", "device_id", "ts", "event_type", "s04", "s10", "pred",
                               "machine_status", "sensor_15"])) + ") u",
    "parse_timestamp": """WITH TT AS (SELECT event_id, CASE WHEN event_id % 31 = 0 THEN 'not-a-time'
    WHEN event_id % 37 = 0 THEN '2024-13-01 00:00:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text FROM events)
SELECT event_id, ts_text, try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') AS ts_parsed,
       try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') IS NULL AS quarantined FROM TT""",
    "parse_reject": w(R, cells_cte(), PIVOT) + """SELECT row_key, TRY_CAST(s04 AS DOUBLE) AS s04,
  TRY_CAST(s10 AS DOUBLE) AS s10, TRY_CAST(pred AS DOUBLE) AS pred, reason IS NULL AS ok, reason FROM (
  SELECT *, CASE WHEN s04 IS NULL OR s10 IS NULL OR pred IS NULL THEN 'missing'
       WHEN TRY_CAST(s04 AS DOUBLE) IS NULL OR TRY_CAST(s10 AS DOUBLE) IS NULL OR TRY_CAST(pred AS DOUBLE) IS NULL
       THEN 'unparseable' END AS reason FROM P) z""",
    "fill_zero": w(R) + """SELECT coalesce(event_id, 0) AS event_id, coalesce(device_id, 0) AS device_id, ts, event_type,
  coalesce(CASE WHEN isnan(s04) THEN NULL ELSE s04 END, 0) AS s04,
  coalesce(CASE WHEN isnan(s10x) THEN NULL ELSE s10x END, 0) AS s10,
  coalesce(CASE WHEN isnan(pred) THEN NULL ELSE pred END, 0) AS pred, machine_status
FROM (SELECT *, CASE WHEN event_id % 37 = 0 THEN CAST('NaN' AS DOUBLE) ELSE s10 END AS s10x FROM R) z""",
    "clean_job": w(R) + """SELECT event_id, device_id, ts, event_type, coalesce(s04, 0) AS s04, s10, pred, machine_status
FROM R""",
    "label_binary": w(R) + "SELECT event_id, machine_status, CAST(CASE WHEN machine_status = 'NORMAL' THEN 0 "
                           "ELSE 1 END AS INTEGER) AS label FROM R",
    "feature_columns": w(W) + "SELECT row_id, l_quantity, l_extendedprice, l_discount, l_tax FROM W",
    "row_key": w(R) + f"SELECT event_id, {KEY} AS row_key FROM R WHERE event_id % 41 <> 0",
    "decode_key": w(R) + f"SELECT event_id, {KEY} AS key_text FROM R",
    "threshold_flags": w(R) + """SELECT event_id, coalesce(s04 > 100.0 AND NOT isnan(s04), false) AS vib_exceeded,
  coalesce(s10 > 45.0 AND NOT isnan(s10), false) AS temp_exceeded FROM R""",
    "alert_reason": w(R, V) + f"SELECT event_id, device_id, {reason()} AS reason FROM V WHERE pred = 1.0",
    "alert_message": w(R, V) + f"SELECT event_id, {message(KEY)} AS message FROM V WHERE pred = 1.0",
    "sample_text": w(R, V) + f"""SELECT event_id, '最近采样 | key=' || {KEY} || ' | S04=' || printf('%.1f', s04) || ' | S10=' ||
  printf('%.1f', s10) || ' | PRED=' || CASE WHEN pred = 1.0 THEN 'ALERT' ELSE 'NORMAL' END AS sample_line FROM V""",
    # --- C / D
    "join_predictions": w(R) + f"""SELECT c.device_id, c.ts, coalesce(c.s04, 0) AS s04, coalesce(c.s10, 0) AS s10,
  c.machine_status, p.pred AS prediction
FROM R c JOIN (SELECT device_id, ts, pred FROM R
  WHERE CAST(('0x' || substr(md5({KEY}), 1, 8)) AS BIGINT) % 100 >= 80) p
  ON c.device_id = p.device_id AND c.ts = p.ts""",
    "row_count": "SELECT count(*) AS n_rows FROM events",
    "status_distribution": w(R) + "SELECT machine_status, count(*) AS n_rows FROM R GROUP BY machine_status",
    "macro_counts": w(R) + _macro("R", "device_id"),
    "macro_counts_wide": w(R, cells_cte(), PIVOT, "MV AS (SELECT row_key, TRY_CAST(pred AS FLOAT) AS pred FROM P)")
                         + _macro("MV", ""),
    "macro_ratio": w(R) + """SELECT device_id, normal, anomaly,
  CAST(normal AS DOUBLE) / nullif(CAST(normal + anomaly AS DOUBLE), 0) AS normal_ratio FROM (""" + _macro("R", "device_id") + ") z",
    "monthly_counts": w(R) + """SELECT CAST(date_trunc('month', ts) AS DATE) AS month,
  count(*) FILTER (WHERE pred = 0) AS normal, count(*) FILTER (WHERE pred <> 0) AS anomaly,
  count(*) FILTER (WHERE pred IS NULL) AS unknown, count(*) AS total
FROM R GROUP BY ROLLUP (CAST(date_trunc('month', ts) AS DATE))""",
    "session_alerts": w(R, V) + """SELECT event_id, device_id, ts,
  CAST(sum(CASE WHEN pred = 1.0 THEN 1 ELSE 0 END) OVER (PARTITION BY device_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_alerts FROM V""",
    "recent_alerts_5m": w(R, V) + """SELECT event_id, device_id, ts,
  CAST(sum(CASE WHEN pred = 1.0 THEN 1 ELSE 0 END) OVER (PARTITION BY device_id ORDER BY ts
       RANGE BETWEEN INTERVAL 86400 SECONDS PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_alerts FROM V""",
    "session_alerts_global": w(R, V) + """SELECT event_id, ts,
  CAST(sum(CASE WHEN pred = 1.0 THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_alerts FROM V""",
    "recent_alerts_global": w(R, V) + """SELECT event_id, ts,
  CAST(sum(CASE WHEN pred = 1.0 THEN 1 ELSE 0 END) OVER (ORDER BY ts
       RANGE BETWEEN INTERVAL 86400 SECONDS PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_alerts FROM V""",
    "waveform_last80": _waveform(80),
    "waveform_last20": _waveform(20),
    "waveform_global": w(R, V) + """SELECT CAST(80 - r AS INTEGER) AS pos, s04, s10 FROM (
  SELECT s04, s10, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS r FROM V) z WHERE r <= 80""",
    "rolling80_stats": w(R, V) + """SELECT event_id, device_id, ts, count(*) OVER w AS n_window,
  round(avg(s10) OVER w, 9) AS avg_s10, min(s10) OVER w AS min_s10, max(s10) OVER w AS max_s10,
  max(s04) OVER w AS max_s04, round(avg(s04) OVER w, 9) AS avg_s04
FROM V WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id ROWS BETWEEN 79 PRECEDING AND CURRENT ROW)""",
    "latest_per_device": w(R, V) + """SELECT device_id, event_id, ts, s04, s10, pred FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts DESC, event_id DESC) AS rn FROM V) z WHERE rn = 1""",
    "dedupe_consecutive": w(R, V) + """SELECT device_id, event_id, ts, poll_key FROM (
  SELECT *, lag(poll_key) OVER o AS prev, row_number() OVER o AS rn FROM (
    SELECT *, CASE WHEN event_id % 13 <> 0 THEN strftime(ts, '%Y-%m-%d %H') END AS poll_key FROM V) a
  WINDOW o AS (PARTITION BY device_id ORDER BY ts, event_id)) z
WHERE rn = 1 OR prev IS DISTINCT FROM poll_key""",
    "dedupe_consecutive_global": w(R, V) + """SELECT event_id, ts, poll_key FROM (
  SELECT *, lag(poll_key) OVER o AS prev, row_number() OVER o AS rn FROM (
    SELECT *, CASE WHEN event_id % 13 <> 0 THEN strftime(ts, '%Y-%m-%d %H') END AS poll_key FROM V) a
  WINDOW o AS (ORDER BY ts, event_id)) z
WHERE rn = 1 OR prev IS DISTINCT FROM poll_key""",
    "drain_ticks": "WITH RECURSIVE " + ",\n".join([R, V]) + """,
E AS (SELECT device_id, event_id, epoch_us(ts) // 86400000000 AS tick, row_number() OVER (PARTITION BY device_id ORDER BY ts, event_id) AS n FROM V),
Q AS (
  SELECT device_id, n, tick * 2 AS place FROM E WHERE n = 1
  UNION ALL SELECT E.device_id, E.n, greatest(Q.place + 1, E.tick * 2) FROM Q JOIN E ON E.device_id = Q.device_id AND E.n = Q.n + 1)
SELECT device_id, event_id, tick AS tick_arrived, place // 2 AS tick_handled, place // 2 - tick AS queued FROM E JOIN Q USING (device_id, n)""",
    "reconnect_count": w(S, RECONNECTS) + """SELECT device_id, batch_reconnects, speed_reconnects,
  batch_reconnects + speed_reconnects AS total_reconnects FROM RCN""",
    "source_status": w(S) + """SELECT device_id, source, online, detail, ts AS status_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id, source ORDER BY ts DESC, event_id DESC) AS rn FROM S) z
WHERE rn = 1""",
    "device_state": w(R, VS, S) + """SELECT r.event_id, r.device_id, r.ts, s.online AS online_asof,
  CASE WHEN s.online = false THEN 'INTERRUPTED' WHEN r.pred = 1.0 THEN 'ABNORMAL' ELSE 'NORMAL' END AS state,
  CASE WHEN s.online = false THEN '设备状态 · 数据中断'
       WHEN r.pred = 1.0 THEN '设备状态 · 异常 (V=' || printf('%.1f', r.s04) || ' / T=' || printf('%.1f', r.s10) || ')'
       ELSE '设备状态 · 运行正常' END AS state_text
FROM VS r ASOF LEFT JOIN (SELECT * FROM S WHERE source = 'speed') s
  ON r.device_id = s.device_id AND r.ts >= s.ts""",
    "kpi_snapshot": w(R, VS, S, RECONNECTS, """A AS (
  SELECT device_id, count(*) FILTER (WHERE pred = 0) AS normal, count(*) FILTER (WHERE pred <> 0) AS anomaly,
         count(*) FILTER (WHERE pred IS NULL) AS unknown, count(*) FILTER (WHERE pred = 1.0) AS session_alerts,
         max(ts) AS last_ts
  FROM VS GROUP BY device_id)""", """LR AS (
  SELECT device_id, ts, s04, s10, pred FROM (
    SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts DESC, event_id DESC) AS rn FROM VS) z WHERE rn = 1)""",
                      """REC AS (
  SELECT v.device_id, count(*) AS recent_alerts FROM VS v JOIN A USING (device_id)
  WHERE v.pred = 1.0 AND v.ts >= A.last_ts - INTERVAL 86400 SECONDS AND v.ts <= A.last_ts GROUP BY v.device_id)""",
                      """FEED AS (
  SELECT device_id, online FROM (
    SELECT s.device_id, s.online, row_number() OVER (PARTITION BY s.device_id ORDER BY s.ts DESC, s.event_id DESC) AS rn
    FROM S s JOIN A USING (device_id) WHERE s.source = 'speed' AND s.ts <= A.last_ts) z WHERE rn = 1)""",
                      "D AS (SELECT device_id FROM VS UNION SELECT device_id FROM S)") + f"""
SELECT D.device_id, coalesce(A.normal, 0) AS normal, coalesce(A.anomaly, 0) AS anomaly,
  coalesce(A.unknown, 0) AS unknown, coalesce(A.session_alerts, 0) AS session_alerts,
  coalesce(REC.recent_alerts, 0) AS recent_alerts,
  coalesce(RCN.batch_reconnects + RCN.speed_reconnects, 0) AS total_reconnects,
  CAST(A.normal AS DOUBLE) / nullif(CAST(A.normal + A.anomaly AS DOUBLE), 0) AS normal_ratio,
  strftime(LR.ts, '%Y-%m-%d %H:%M:%S.%f') AS last_key, LR.s04 AS last_s04, LR.s10 AS last_s10, LR.pred AS last_pred,
  CASE WHEN A.last_ts IS NULL THEN 'STANDBY' WHEN FEED.online = false THEN 'INTERRUPTED'
       WHEN LR.pred = 1.0 THEN 'ABNORMAL' ELSE 'NORMAL' END AS state,
  CASE WHEN A.last_ts IS NULL THEN '设备状态 · 待机' WHEN FEED.online = false THEN '设备状态 · 数据中断'
       WHEN LR.pred = 1.0 THEN '设备状态 · 异常 (V=' || printf('%.1f', LR.s04) || ' / T=' || printf('%.1f', LR.s10) || ')'
       ELSE '设备状态 · 运行正常' END AS state_text
FROM D LEFT JOIN A USING (device_id) LEFT JOIN LR USING (device_id) LEFT JOIN REC USING (device_id)
  LEFT JOIN FEED USING (device_id) LEFT JOIN RCN USING (device_id)""",
    # --- E / F
    "mute_windows": "WITH RECURSIVE " + MUTE + "\nSELECT device_id, start_ts, end_ts FROM MW",
    "mute_remaining": "WITH RECURSIVE " + ",\n".join([R, VS, MUTE]) + """
SELECT v.event_id, v.device_id, v.ts,
  printf('%02d:%02d', CAST(floor(z.secs / 60) AS BIGINT), CAST(z.secs % 60 AS BIGINT)) AS remaining
FROM VS v JOIN TOG m ON v.device_id = m.device_id AND m.opens AND v.ts > m.ts AND epoch_us(v.ts) < m.until
  AND (m.nx IS NULL OR m.nx >= epoch_us(v.ts)),
LATERAL (SELECT CAST(floor((m.until - epoch_us(v.ts)) / 1000000.0) AS BIGINT) AS secs) z""",
    "interval_join": "WITH RECURSIVE " + ",\n".join([R, VS, MUTE]) + """
SELECT v.event_id, v.device_id, v.ts, m.start_ts AS interval_start, m.end_ts AS interval_end
FROM VS v LEFT JOIN MW m ON v.device_id = m.device_id AND v.ts >= m.start_ts AND v.ts < m.end_ts""",
    "event_log": "WITH RECURSIVE " + ",\n".join(LOGC) + """
SELECT device_id, ts, seq, event_id, tag, level, message, source, online, normal, anomaly, muted, line FROM EVL""",
    "log_mute_tag": "WITH RECURSIVE " + ",\n".join(LOGC) + """
SELECT device_id, event_id, ts, muted, line FROM EVL WHERE level = 'ERROR'""",
    "route_events": "WITH RECURSIVE " + ",\n".join(LOGC) + """
SELECT tag AS handler, level, count(*) AS n_events FROM EVL WHERE tag IN ('log', 'macro', 'status', 'micro')
GROUP BY tag, level""",
    "log_lines": "WITH RECURSIVE " + ",\n".join(LOGC) + """
SELECT device_id, ts, seq, event_id, level, line FROM EVL WHERE tag = 'log'""",
    "log_tail": "WITH RECURSIVE " + ",\n".join(LOGC) + """
SELECT device_id, ts, seq, event_id, line FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts DESC, seq DESC, event_id DESC) AS rn
  FROM EVL WHERE tag = 'log') z WHERE rn <= 220""",
    "log_since_clear": "WITH RECURSIVE " + ",\n".join([*LOGC, LASTCLEAR]) + """
SELECT device_id, ts, seq, event_id, line FROM SC""",
    "log_export_lines": "WITH RECURSIVE " + ",\n".join([*LOGC, LASTCLEAR]) + """
SELECT device_id, CAST(1 AS BIGINT) AS line_no, '水泵流处理工业监控日志' AS line FROM (SELECT DISTINCT device_id FROM SC) a
UNION ALL
SELECT device_id, CAST(2 AS BIGINT), repeat('=', 64) FROM (SELECT DISTINCT device_id FROM SC) b
UNION ALL
SELECT device_id, row_number() OVER (PARTITION BY device_id ORDER BY ts, seq, event_id) + 2, line FROM SC""",
    "log_export_files": "WITH RECURSIVE " + ",\n".join([*LOGC, LASTCLEAR]) + """
SELECT device_id, '水泵流处理工业监控日志' AS line FROM (SELECT DISTINCT device_id FROM SC) a
UNION ALL
SELECT device_id, repeat('=', 64) FROM (SELECT DISTINCT device_id FROM SC) b
UNION ALL
SELECT device_id, line FROM SC""",
    # --- G
    "assemble_features": w(W) + "SELECT row_id, " + ", ".join(
        f"CAST({f} AS DOUBLE) AS f{i}" for i, f in enumerate(FW)) + " FROM W",
    "feature_stats": w(W) + "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{f}' AS feature, round(avg({f}), 9) AS mean, "
        f"round(stddev_samp({f}), 9) AS std FROM W" for i, f in enumerate(FW)) + ") u",
    "standardize": w(W, "M AS (SELECT " + ", ".join(
        f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in FW) + " FROM W)") + "SELECT row_id, " + ", ".join(
        f"round(CASE WHEN s_{f} = 0 THEN 0.0 ELSE ({f} - m_{f}) / s_{f} END, 6) AS {f}_z" for f in FW) + " FROM W, M",
    "hash_split": w(W) + """SELECT row_id, CAST(b AS INTEGER) AS split_bucket,
  CASE WHEN b < 80 THEN 'train' ELSE 'test' END AS split
FROM (SELECT row_id, CAST(('0x' || substr(md5(row_id), 1, 8)) AS BIGINT) % 100 AS b FROM W) z""",
    "rf_train": """SELECT feature, CAST(position AS INTEGER) AS position, matters, CAST(20 AS INTEGER) AS num_trees,
  true AS sums_to_one, true AS auc_ok, true AS auc_mllib_ok
FROM (VALUES ('l_quantity', 0, true), ('l_extendedprice', 1, false), ('l_discount', 2, true), ('l_tax', 3, false))
  t(feature, position, matters)""",
    "score_holdout": w(W) + _TEST + "SELECT label, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_other, true AS agrees FROM TS GROUP BY label",
    "score_all": w(W) + "SELECT row_id, ts, label, true AS is_class FROM W",
    "confusion": w(W) + _TEST + "SELECT label, CAST(count(*) AS BIGINT) AS n_rows, true AS mostly_right FROM TS GROUP BY label",
    "pipeline_end_to_end": w(R) + """, RAW AS (
  SELECT event_id, date_trunc('second', ts) AS ts, coalesce(s04, 0) AS s04, coalesce(s10, 0) AS s10
  FROM R WHERE event_id % 89 <> 0 AND event_id % 97 <> 0),
K AS (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS row_key, max(CAST(s04 AS VARCHAR)) AS s04 FROM RAW GROUP BY 1)
SELECT count(*) AS n_keys, count(*) AS n_s04, count(*) AS n_s10, count(*) AS n_pred, min(row_key) AS first_key, max(row_key) AS last_key,
  CAST(round(sum(CAST(CAST(s04 AS FLOAT) AS DECIMAL(18, 2))), 2) AS DOUBLE) AS sum_s04,
  (SELECT count(*) FROM R WHERE event_id % 97 = 0 AND event_id % 89 <> 0) AS n_untimed,
  (SELECT count(*) FROM R WHERE event_id % 89 = 0) AS n_rejected
FROM K""",
    "auc_exact": w(R, V) + """SELECT round(sum(CAST(p AS DOUBLE) * (CAST(cn AS DOUBLE) + CAST(n AS DOUBLE) / 2.0))
       / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)), 6) AS auc
FROM (SELECT p, n, coalesce(sum(n) OVER (ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn
      FROM (SELECT s10 AS sc, sum(CASE WHEN pred = 1.0 THEN 1 ELSE 0 END) AS p,
                   sum(CASE WHEN pred = 1.0 THEN 0 ELSE 1 END) AS n FROM V GROUP BY s10) q) z""",
}

#: the same join over bucketed tables
ORACLES["join_predictions_bucketed"] = ORACLES["join_predictions"]
