"""Checks of event-time streams: what closed by the end of the given events (2.15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.catalog import add
from checks.oracle import dbl
from checks.tables import plain
from ledgerlark.session import staging_path
from ledgerlark.streaming import events


def _closed(t, result):
    found = events.closed(t.spark, f"{t.folder}/events.parquet", result, staging_path(t.spark, "events"))
    return plain(found)


#: The watermark stands a day before the latest event; ids that come again count once.
ONCE = """(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts) AS place FROM events) WHERE place = 1)"""
MARK = "(SELECT DATE_TRUNC('milliseconds', MAX(ts)) - INTERVAL 1 DAY FROM events)"
TOTAL = dbl("SUM(CAST(value AS DECIMAL(18,4)))")

add("x15_daily_events", lambda t: _closed(t, events.daily_events),
    f"""SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS events, {TOTAL} AS total FROM {ONCE} GROUP BY 1, 2
        HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= {MARK}""")
add("x15_user_sessions", lambda t: _closed(t, events.user_sessions).withColumns({
        "started": F.col("started").cast("timestamp_ntz"), "ended": F.col("ended").cast("timestamp_ntz")}),
    f"""SELECT user_id, MIN(ts) AS started, MAX(ts) AS ended, COUNT(*) AS events, {TOTAL} AS total FROM
            (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM
                (SELECT *, CASE WHEN ts <= LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM {ONCE}))
        GROUP BY user_id, session HAVING MAX(ts) + INTERVAL 2 HOUR <= {MARK}""")
