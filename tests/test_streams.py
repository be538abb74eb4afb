"""Streams over several files, one a trigger, in and out of order."""

import uuid
from datetime import datetime, timedelta

from tallyforge.streaming import streams as S

T0 = datetime(2024, 1, 1)


def files(spark, tmp_path, parts):
    """One file per part, in the order of their names and times."""
    folder = tmp_path / uuid.uuid4().hex
    for i, rows in enumerate(parts):
        df = spark.createDataFrame([(k, T0 + timedelta(minutes=m), u, t, 1.0) for k, m, u, t in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
        df.coalesce(1).write.parquet(str(folder / f"raw{i}"))
        part = next((folder / f"raw{i}").glob("part-*.parquet"))
        target = folder / f"events-{i}.parquet"
        part.rename(target)
        import os

        os.utime(target, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    return str(folder), str(folder / "events-0.parquet")


def test_windows_over_triggers_and_late_rows(spark, tmp_path):
    parts = [[(1, 5, 1, "a"), (2, 30, 1, "a")], [(3, 50, 1, "a"), (4, 70, 1, "b")], [(5, 4_000, 1, "a")], [(8, 4_005, 1, "a")], [(6, 10, 1, "a"), (7, 4_010, 1, "a")]]
    folder, sample = files(spark, tmp_path, parts)
    stream = S.arriving(spark, sample, folder, "events-*.parquet", files_per_trigger=1)
    out = S.run_to_table(S.windowed_counts(stream, "ts", ["event_type"], "value", "1 hour", "1 day"), str(tmp_path / "w"), "update", ["window_start", "event_type"])
    got = {(r.window_start, r.event_type): r.n for r in out.collect()}
    hour = lambda h: T0 + timedelta(hours=h)
    # The row of minute 10 in the last file is days behind the newest and no longer counts.
    assert got == {(hour(0), "a"): 3, (hour(1), "b"): 1, (hour(66), "a"): 3}


def test_streaks_over_triggers(spark, tmp_path):
    parts = [[(1, 1, 1, "a"), (2, 2, 1, "a"), (3, 1, 2, "x")], [(5, 9, 1, "a")], [(4, 5, 1, "b"), (6, 3, 2, "y")], [(7, 10, 1, "a")]]
    folder, sample = files(spark, tmp_path, parts)
    stream = S.arriving(spark, sample, folder, "events-*.parquet", files_per_trigger=1)
    out = S.run_to_table(S.unchanged_streaks(stream, "user_id", "ts", "event_id", "event_type"), str(tmp_path / "s"), "update", ["user_id"])
    # The b of minute 5 arrives after minute 9: it is seen, but breaks nothing.
    assert {r.user_id: (r.last_value, r.streak, r.n_seen) for r in out.collect()} == {1: ("a", 3, 5), 2: ("y", 0, 2)}
