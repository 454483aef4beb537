"""Column expressions shared by batch and streaming operators.

All of these are built-in Spark expressions, so they stay inside whole-stage
code generation; none of them calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pumpline import config as C

KEY_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exceeds(x, threshold: float) -> Column:
    """Strict ``x > threshold``; NaN and NULL never exceed (Spark orders NaN high)."""
    x = col(x)
    return F.coalesce((x > F.lit(float(threshold))) & ~F.isnan(x), F.lit(False))


def is_alert(pred, alert_value: float = C.DEFAULT_PARAMS.alert_pred) -> Column:
    return F.coalesce(col(pred) == F.lit(float(alert_value)), F.lit(False))


def alert_reason(s04, s10, vib: float, temp: float) -> Column:
    """Reason text of an alert: the exceeded signals joined by ' + ', else 'unknown'."""
    parts = F.concat_ws(
        C.REASON_JOINER,
        F.when(exceeds(s04, vib), F.lit(C.REASON_VIBRATION)),
        F.when(exceeds(s10, temp), F.lit(C.REASON_TEMPERATURE)),
    )
    return F.when(parts == "", F.lit(C.REASON_UNKNOWN)).otherwise(parts)


def _wide_text(ax) -> Column:
    """A whole double of 1e28 or more: its shortest digits, filled up with zeros."""
    text = ax.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, "^([0-9.]+)", 1), r"\.0?", "")
    exponent = F.regexp_extract(text, "E([0-9]+)$", 1).try_cast("int")
    return F.concat(F.rpad(digits, exponent + 1, "0"), F.lit(".0"))


def fixed1(x) -> Column:
    """Text of ``x`` with one decimal, rounded like Python's ``f"{x:.1f}"``.

    Python rounds the exact binary value half-to-even; Spark's decimal casts and
    ``format_string`` round the shortest decimal text half-up (6.55 -> 6.6 instead
    of 6.5).  10*|x| is split exactly into s + t (the two products by 8 and 2 are
    exact, TwoSum recovers the rounding error), and the sign of the distance to
    the nearest half-integer decides the rounding.
    """
    x = col(x)
    ax = F.abs(x)
    a = ax * F.lit(8.0)
    b = ax * F.lit(2.0)
    big = ax >= F.lit(float(1 << 52))
    whole = F.when(ax < F.lit(1e28), F.concat(ax.try_cast("decimal(38,0)").cast("string"), F.lit(".0"))).otherwise(_wide_text(ax))
    a, b = F.when(~big, a).otherwise(0.0), F.when(~big, b).otherwise(0.0)
    s = a + b
    bb = s - a
    t = (a - (s - bb)) + (b - bb)
    k = F.floor(s)
    d = (s - (k.cast("double") + F.lit(0.5))) + t
    n = (F.when(d > 0, k + 1).when(d < 0, k)
         .otherwise(F.when(k % 2 == 0, k).otherwise(k + 1)))
    body = F.concat(F.floor(n / 10).cast("string"), F.lit("."), (n % 10).cast("string"))
    # from 2^52 on a double is a whole number: its decimal text, no long arithmetic
    body = F.when(ax < F.lit(float(1 << 52)), body).otherwise(whole)
    # sign bit, negative zero included (Python prints -0.0); the text form keeps it
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return (F.when(F.isnan(x), F.lit("nan"))
            .when(ax == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
            .otherwise(F.concat(sign, body)))


def alert_message(reason, key, s04, s10) -> Column:
    return F.concat(F.lit(C.ALERT_PREFIX), col(reason), F.lit(" | key="), col(key),
                    F.lit(" | S04="), fixed1(s04), F.lit(" | S10="), fixed1(s10))


def sample_state(pred, alert_value: float = C.DEFAULT_PARAMS.alert_pred) -> Column:
    return F.when(is_alert(pred, alert_value), F.lit(C.STATE_ALERT)).otherwise(F.lit(C.STATE_NORMAL))


def row_key(ts, device=None) -> Column:
    """Fixed-width text of the timestamp: lexicographic order = time order.

    With ``device`` the key ends in ``#<device>``: devices that share an instant
    keep apart, while time order and the date prefix stay.  A null device or time
    gives a null key (quarantined, see ``clean.with_row_key``).
    """
    key = F.date_format(col(ts), KEY_FORMAT)
    return key if device is None else F.concat(key, F.lit("#"), col(device).cast("string"))


def clock_text(ts) -> Column:
    """``HH:MM:SS.mmm`` with the milliseconds truncated."""
    return F.date_format(col(ts), "HH:mm:ss.SSS")


def level_mark(level) -> Column:
    lv = F.upper(col(level))
    return (F.when(lv == "ERROR", F.lit(C.MARK_ERROR))
            .when(lv == "WARN", F.lit(C.MARK_WARN))
            .otherwise(F.lit(C.MARK_OTHER)))


def log_line(ts, level, message, muted) -> Column:
    lv = F.upper(col(level))
    tag = F.when(F.coalesce(col(muted), F.lit(False)) & (lv == "ERROR"), F.lit(C.MUTE_TAG)).otherwise(F.lit(""))
    return F.concat(F.lit("["), clock_text(ts), F.lit("] "), level_mark(level), F.lit(" "), tag, col(message))


def remaining_text(until, now) -> Column:
    """``MM:SS`` of whole seconds left (minutes are not capped at 99)."""
    secs = F.floor(seconds_between(now, until))
    return F.format_string("%02d:%02d", F.floor(secs / 60).cast("long"), (secs % 60).cast("long"))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ, independent of the session zone."""
    c = col(ts)
    return (F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("long"))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ, independent of the session zone."""
    c = col(ts)
    day = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    in_minute = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")  # seconds with their fraction, as a decimal
    return ((day * 24 + F.hour(c)) * 60 + F.minute(c)) * 60_000_000 + in_minute


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds as a double (microsecond exact)."""
    return (epoch_micros(end) - epoch_micros(start)).cast("double") / F.lit(1e6)


def plus_seconds(ts, seconds: int) -> Column:
    return col(ts) + F.make_dt_interval(secs=F.lit(int(seconds)))


def time_bucket(ts, width_s: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(int(width_s))).cast("long")


def hash_bucket(key) -> Column:
    """0..99 from the first 32 bits of md5(key): stable under any partitioning."""
    return (F.conv(F.substring(F.md5(col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100).cast("int")


def state_text(state, s04, s10) -> Column:
    """Device-state label: interrupted / abnormal with both signals / normal."""
    pre, post = C.STATE_TEXT_ABNORMAL.split("{s04}")
    mid, end = post.split("{s10}")
    st = col(state)
    return (F.when(st == "STANDBY", F.lit(C.STATE_TEXT_STANDBY))
            .when(st == "INTERRUPTED", F.lit(C.STATE_TEXT_INTERRUPTED))
            .when(st == "ABNORMAL", F.concat(F.lit(pre), fixed1(s04), F.lit(mid), fixed1(s10), F.lit(end)))
            .when(st == "NORMAL", F.lit(C.STATE_TEXT_NORMAL)))
