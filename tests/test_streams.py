"""Event-time streams: restarts, late and repeated events; keyed upserts that are replayed."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.sources import tables as io
from ledgerlark.streaming import events, upserts

START = datetime(2024, 1, 1)


def event(number, hours, user=1, kind="view", value=1.25):
    return (number, START + timedelta(hours=hours), user, kind, value, None)


def put(spark, folder, rows):
    """One more file of events."""
    spark.createDataFrame(rows, schemas.EVENTS).coalesce(1).write.mode("append").parquet(folder)


def take(spark, folder, out, result=events.daily_events, files=1):
    stream = result(events.read_events(spark, folder, files_per_batch=files))
    return events.append_available(stream, f"{out}/closed", f"{out}/checkpoint")


def days(spark, out):
    rows = spark.read.parquet(f"{out}/closed").collect()
    assert len({(r.day, r.event_type) for r in rows}) == len(rows)
    return {(r.day.day, r.event_type): (r.events, float(r.total)) for r in rows}


def test_a_restarted_stream_goes_on_and_ends_where_one_run_ends(spark, tmp_path):
    folder, parts, whole = (str(tmp_path / x) for x in ("in", "parts", "whole"))
    files = [[event(day * 100 + i, day * 24 + i, user=i % 3, kind="view" if i % 2 else "click") for i in range(20)] for day in range(6)]
    for rows in files[:3]:
        put(spark, folder, rows)
    take(spark, folder, parts)
    assert set(days(spark, parts)) == {(1, "view"), (1, "click")}
    take(spark, folder, parts)  # nothing new
    assert len(days(spark, parts)) == 2
    for rows in files[3:]:
        put(spark, folder, rows)
    take(spark, folder, parts)
    take(spark, folder, whole, files=2)
    want = {(day, kind): (10, 12.5) for day in range(1, 5) for kind in ("view", "click")}
    assert days(spark, parts) == days(spark, whole) == want


def test_late_events_are_counted_and_repeated_ones_dropped(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, [event(1, 1), event(2, 2), event(2, 3), event(None, 4), event(None, 5)])
    put(spark, folder, [event(2, 20), event(3, 23), event(4, 80)])
    take(spark, folder, out)
    put(spark, folder, [event(5, 3), event(6, 30), (7, None, 1, "view", 1.0, None), event(8, 81), event(4, 90)])
    query = take(spark, folder, out)
    assert events.late_events(query) >= 2  # 3 and 30 hours, where the watermark stands at 56
    put(spark, folder, [event(9, 300)])
    take(spark, folder, out)
    # Day 1: 1, 2, 3 and one of the events without id; day 4: 4 and 8.
    assert days(spark, out) == {(1, "view"): (4, 5.0), (4, "view"): (2, 2.5)}


def test_sessions_close_when_the_gap_is_behind_the_watermark(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, [event(1, 0), event(2, 1.5), event(3, 3.5), event(7, 5.6), event(4, 0.5, user=2), event(5, 30.0), event(6, 31.9, user=None)])
    take(spark, folder, out, events.user_sessions)
    got = {(r.user_id, r.started, r.ended, r.events) for r in spark.read.parquet(f"{out}/closed").collect()}
    at = [START + timedelta(hours=h) for h in (0, 3.5, 5.6, 0.5)]
    assert got == {(1, at[0], at[1], 3), (1, at[2], at[2], 1), (2, at[3], at[3], 1)}


def test_no_events(spark, tmp_path):
    put(spark, str(tmp_path / "in"), [])
    assert events.closed(spark, str(tmp_path / "in"), events.daily_events, str(tmp_path / "out")).count() == 0


def test_a_replayed_batch_changes_nothing_also_without_keys(spark, tmp_path):
    path = str(tmp_path / "target")
    upserts.write_target(spark.createDataFrame([("a", 1), (None, 2)], "k string, n int"), path, "k", 4)
    batch = spark.createDataFrame([("a", 5, 1), (None, 7, 1), (None, 8, 2), ("b", 9, 1)], "k string, n int, seq int")
    for _ in range(3):
        upserts.apply_batch(batch, path, "k", ["seq"], 4)
        assert sorted((str(r.k), r.n) for r in upserts.read_target(spark, path).collect()) == [("None", 8), ("a", 5), ("b", 9)]


def test_star_versions(spark, tmp_path):
    folder = str(tmp_path / "star")
    sales = spark.createDataFrame([(1, datetime(2024, 5, 1).date())], "order_id long, date_key date")
    for n in range(4):
        io.write_star(spark, folder, {"dim": spark.range(n + 1)}, sales)
        assert io.read_star(spark, folder, "dim").count() == n + 1
        if n == 0:
            (tmp_path / "star" / "v-other").mkdir()  # an unfinished load of someone else
    kept = sorted(p.name for p in (tmp_path / "star").iterdir() if p.is_dir())
    assert len(kept) == 3 and "v-other" in kept and not list((tmp_path / "star").glob(".CURRENT-*"))
    assert io.read_star(spark, folder, "fact_sales").select(F.max("year")).first()[0] == 2024
