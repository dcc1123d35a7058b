"""Alarms as states: a metric is in ALARM in a period whose sum exceeds the threshold, and OK in any other.

Only changes of state are emitted, when the watermark passes the period's end, so that late points have had their time.
A period without points is OK: each period with points sets a timer for its own end and one for the end of the next, so
an alarm ends even if nothing arrives any more. A metric's state holds the sums of its open periods and of the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from radiolith.streaming.jobs import AVAILABLE_NOW

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGES = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("period_start_ms", T.LongType()), T.StructField("from_state", T.StringType()), T.StructField("to_state", T.StringType())]
)


class AlarmStates(StatefulProcessor):
    """Per metric: sums by period, and a change of state at the end of a period that differs from the one before."""

    def __init__(self, period_ms: int, threshold: float) -> None:
        self.period_ms, self.threshold = period_ms, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        period = T.StructType([T.StructField("start", T.LongType())])
        total = T.StructType([T.StructField("total", T.DoubleType())])
        self.sums = handle.getMapState("sums", period, total)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        added: dict[int, float] = {}
        for row in rows:
            start = row["ts_ms"] // self.period_ms * self.period_ms
            added[start] = added.get(start, 0.0) + (row["value"] or 0.0)
        for start, value in added.items():
            if self.sums.containsKey((start,)):
                value += self.sums.getValue((start,))[0]
            self.sums.updateValue((start,), (value,))
            # Twice the same timer is one.
            self.handle.registerTimer(start + self.period_ms)
            self.handle.registerTimer(start + 2 * self.period_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        start = expiredTimerInfo.getExpiryTimeInMs() - self.period_ms
        before, now = self._state(start - self.period_ms), self._state(start)
        if self.sums.containsKey((start - self.period_ms,)):
            self.sums.removeKey((start - self.period_ms,))
        if before != now:
            yield Row(name=key[0], period_start_ms=start, from_state=before, to_state=now)

    def _state(self, start: int) -> str:
        return "ALARM" if self.sums.containsKey((start,)) and self.sums.getValue((start,))[0] > self.threshold else "OK"

    def close(self) -> None:
        pass


def alarm_changes(points: DataFrame, period_seconds: int = 300, lateness: str = "10 minutes", threshold: float = 0) -> DataFrame:
    """Changes of state of each metric, from a stream of points (``ts, name, value``): name, period start and both states."""
    marked = points.withWatermark("ts", lateness).selectExpr("name", "ts", "unix_millis(ts) AS ts_ms", "value")
    changes = marked.groupBy("name").transformWithState(
        statefulProcessor=AlarmStates(period_seconds * 1000, threshold), outputStructType=_CHANGES, outputMode="Append", timeMode="EventTime"
    )
    return changes.selectExpr("name", "timestamp_millis(period_start_ms) AS period_start", "from_state", "to_state")


def start_alarm_changes(points: DataFrame, target: str, checkpoint: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Append changes of state to a table; timers need the RocksDB state store, which is set for this query only."""
    conf = points.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        return (
            alarm_changes(points, **options)
            .writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or AVAILABLE_NOW))
            .start()
        )
    finally:
        if before is None:
            conf.unset(_PROVIDER)
        else:
            conf.set(_PROVIDER, before)
