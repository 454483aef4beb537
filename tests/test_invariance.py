"""Same answers however the input is partitioned."""

import pytest

from pumpline.config import TESTDATA_PARAMS as P
from pumpline.operators import eventlog, monitor
from pumpline.sources import testdata as td
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_operators_ignore_input_partitioning(spark, parts):
    r = monitor.valid_samples(td.readings(spark, SF_SMALL))
    s = td.source_status(spark, SF_SMALL)
    base = {
        "session": monitor.session_alerts(r, P).select("event_id", "session_alerts"),
        "recent": monitor.recent_alerts(r, P).select("event_id", "recent_alerts"),
        "state": monitor.device_state(r, s, P).select("event_id", "state"),
        "mute": eventlog.windows_only(eventlog.mute_windows(td.mute_toggles(spark, SF_SMALL), P)),
        "wave": monitor.waveform_last(r, 20, P),
    }
    rp, sp = r.repartition(parts), s.repartition(parts)
    moved = {
        "session": monitor.session_alerts(rp, P).select("event_id", "session_alerts"),
        "recent": monitor.recent_alerts(rp, P).select("event_id", "recent_alerts"),
        "state": monitor.device_state(rp, sp, P).select("event_id", "state"),
        "mute": eventlog.windows_only(eventlog.mute_windows(td.mute_toggles(spark, SF_SMALL).repartition(parts), P)),
        "wave": monitor.waveform_last(rp, 20, P),
    }
    for k in base:
        assert _rows(base[k]) == _rows(moved[k]), k
