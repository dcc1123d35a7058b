"""Alarm states over several micro-batches against a plain walk through the periods."""

import random

from radiolith.streaming import alarms

PERIOD = 300


def changes(points, limit):
    """(name, start, from, to) of every period that ends up to the limit."""
    sums = {}
    for second, name, value in points:
        at = (name, second // PERIOD * PERIOD)
        sums[at] = sums.get(at, 0) + value
    out = []
    for name in {n for n, _ in sums}:
        own = sorted(s for n, s in sums if n == name)
        state = "OK"
        for start in range(own[0], own[-1] + 2 * PERIOD, PERIOD):
            now = "ALARM" if sums.get((name, start), 0) > 0 else "OK"
            if now != state and start + PERIOD <= limit:
                out.append((name, start, state, now))
            state = now
    return sorted(out)


def test_changes_over_micro_batches(spark, tmp_path):
    pick = random.Random(3)
    points = sorted((pick.randrange(0, 40000) + 0, pick.choice("ab"), pick.choice([1.0, 0.0, -2.0, 0.5])) for _ in range(90))
    points.append((100_003, "end", 1.0))  # lets the watermark pass all others
    found = []
    for part in range(4):  # in time order, some points of a part up to eight minutes late
        own = points[part * 23 : part * 23 + 23]
        frame = spark.createDataFrame(own, "s long, name string, value double").selectExpr("timestamp_seconds(s) AS ts", "name", "value")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        read = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
        alarms.start_alarm_changes(read, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        found.append(spark.read.parquet(str(tmp_path / "out")).count())
    got = spark.read.parquet(str(tmp_path / "out")).selectExpr("name", "unix_seconds(period_start) AS s", "from_state", "to_state")
    assert sorted(tuple(r) for r in got.collect()) == changes(points, 100_003 - 600)
    assert len(set(found)) > 2
