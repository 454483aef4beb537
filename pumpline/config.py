"""Parameters and fixed values.

Numbers are arguments of the operators; the defaults are the monitoring
settings of the original pump dashboard.  The texts under FIXED VALUES are
output strings that must be reproduced exactly for result parity.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # alerting
    vib_threshold: float = 650.0          # s04 strictly above -> vibration exceeded
    temp_threshold: float = 45.0          # s10 strictly above -> temperature high
    alert_pred: float = 1.0               # speed layer alerts only on pred == 1.0
    recent_horizon_s: int = 300           # trailing alert count, inclusive at the edge
    # waveform buffers
    buffer_len: int = 80
    seed_s04: float = 640.0
    seed_s10: float = 40.0
    # conflation tick of the speed view (one refresh per tick and device)
    tick_ms: int = 100
    # events a consumer takes in one tick; the rest waits for the next
    drain_cap: int = 200
    # rows in one call of the external store's writer
    put_rows: int = 1000
    # pause before a failed stream is started again
    retry_s: float = 2.0
    # mute windows
    mute_s: int = 300
    # event log
    log_keep: int = 220
    # skew control: width of the time buckets that split a device's history
    bucket_s: int = 3600
    # model
    num_trees: int = 20
    max_depth: int = 5
    seed: int = 42
    train_pct: int = 80
    # parts of the training rows (the forest bags per part): they follow the rows, so
    # that the model does not follow the cluster, and are never fewer than the first
    train_partitions: int = 16
    train_rows_per_part: int = 1_000_000

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT_PARAMS = Params()

# Settings used on the driver's test tables (FIXTURES.md section 2): event spacing
# there is hours, so the 300 s horizons would never overlap.
TESTDATA_PARAMS = Params(vib_threshold=100.0, temp_threshold=45.0,
                         recent_horizon_s=86400, mute_s=86400, tick_ms=86_400_000, drain_cap=2)

# ---------------------------------------------------------------------------
# FIXED VALUES (output texts of the dashboard; must stay byte-identical)
# ---------------------------------------------------------------------------
REASON_VIBRATION = "振动超标"
REASON_TEMPERATURE = "温度过高"
REASON_UNKNOWN = "未知突变"
REASON_JOINER = " + "
ALERT_PREFIX = "设备告警："
SAMPLE_PREFIX = "最近采样 | "
STATE_ALERT = "ALERT"
STATE_NORMAL = "NORMAL"
MARK_ERROR = "🔴"
MARK_WARN = "🟠"
MARK_OTHER = "🟢"
MUTE_TAG = "[静默期仍记录] "
MSG_MUTE_ON = "已开启 5 分钟告警静默窗口。"
MSG_MUTE_OFF = "告警静默已取消，恢复完整告警显示。"
MSG_CLEARED = "操作员已清空界面日志。"
MSG_EXPORT_OK = "日志导出成功："
MSG_EXPORT_FAIL = "日志导出失败："
MSG_STARTED = "工业监控大屏已启动，正在接入 Hive / HBase 数据源 ..."
MSG_SPEED_FAIL = "HBase 连接/扫描失败: "
MSG_BATCH_FAIL = "Hive 同步失败: "
MSG_ROW_FAIL = "HBase 行解析失败 "
MSG_MISSING_CELLS = "缺少必要列 wave:s04 / wave:s10 / status:pred"
EXPORT_HEADER = "水泵流处理工业监控日志"
EXPORT_RULE = "=" * 64
NORMAL_STATUS = "NORMAL"
STATE_TEXT_STANDBY = "设备状态 · 待机"
STATE_TEXT_INTERRUPTED = "设备状态 · 数据中断"
STATE_TEXT_ABNORMAL = "设备状态 · 异常 (V={s04} / T={s10})"
STATE_TEXT_NORMAL = "设备状态 · 运行正常"
# wide-column layout: (family, qualifier) in put order
WIDE_CELLS = (("status", "real"), ("status", "pred"), ("wave", "s04"), ("wave", "s10"))
# index columns a CSV export may carry that must never become features
INDEX_COLUMNS = ("Unnamed: 0", "_c0")
