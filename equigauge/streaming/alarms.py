"""Alarms over consecutive periods on a stream of period metrics.

State per key is a few numbers: the last period seen and, per rule, how many
periods in a row breached. A period without rows leaves no input, so a timer
reports it once the watermark has passed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from equigauge.operators.monitor import BREACHING, PERIOD_SECONDS, AlarmRule

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Alarms(StatefulProcessor):
    """Counts breaches in a row; ``names`` and ``needed`` follow the rule order."""

    def __init__(self, key: str, kind, names, needed, missing, seconds: int):
        self.key, self.kind, self.seconds = key, kind, seconds
        self.names, self.needed, self.missing = names, needed, missing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        counts = T.StructType([T.StructField("counts", T.ArrayType(T.IntegerType()))])
        last = T.StructType([T.StructField("last", T.LongType())])
        self.counts = handle.getValueState("counts", counts)
        self.last = handle.getValueState("last", last)

    def _run(self, key, rows: list[tuple[int, list[bool]]], until: int | None) -> pd.DataFrame:
        """Walk from the last known period over ``rows``, filling gaps up to ``until``."""
        last = self.last.get()[0] if self.last.exists() else None
        counts = list(self.counts.get()[0]) if self.counts.exists() else [0] * len(self.names)
        out = []

        def step(start: int, breaches: list[bool]) -> None:
            for i, hit in enumerate(breaches):
                counts[i] = counts[i] + 1 if hit else 0
                out.append((key, self.names[i], start, hit, counts[i] >= self.needed[i]))

        for start, breaches in [*sorted(rows), *([(until, None)] if until is not None else [])]:
            if last is not None:
                for gap in range(last + self.seconds, start, self.seconds):
                    step(gap, self.missing)
                    last = gap
            if breaches is not None:
                step(start, breaches)
                last = start
        self.last.update((last,))
        self.counts.update((counts,))
        frame = pd.DataFrame(out, columns=[self.key, "rule", "start", "breach", "alarm"])
        frame["window_start"] = pd.to_datetime(frame.pop("start"), unit="s", utc=True)
        return frame[[self.key, "rule", "window_start", "breach", "alarm"]]

    def _wake(self) -> None:
        """Be called when the period after the last known one is over."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t if isinstance(t, int) else t[0])
        self.handle.registerTimer((self.last.get()[0] + 2 * self.seconds) * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = []
        for batch in rows:
            starts = batch["start"].astype("int64").tolist()
            seen += list(zip(starts, [list(map(bool, b)) for b in batch["breaches"]], strict=True))
        yield self._run(key[0], seen, None)
        self._wake()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expired = expiredTimerInfo.getExpiryTimeInMs() // 1000
        watermark = timerValues.getCurrentWatermarkInMs() // 1000
        upto = max(expired, watermark) // self.seconds * self.seconds
        yield self._run(key[0], [], upto)
        self._wake()

    def close(self) -> None:
        pass


def stream_alarms(
    windows: DataFrame,
    rules: Sequence[AlarmRule],
    key: str,
    seconds: int = PERIOD_SECONDS,
) -> DataFrame:
    """Breach and alarm state of every rule in every closed period of every key.

    ``windows`` comes from :func:`stream_windows`, one row per key and period,
    so a busy key brings no more rows than a quiet one. Needs the RocksDB state
    store (``PROVIDER``).
    """
    breaches = F.array(*[F.coalesce(F.expr(r.condition), F.lit(False)) for r in rules])
    rows = windows.select(
        key,
        "event_time",
        F.unix_seconds("window_start").alias("start"),
        breaches.alias("breaches"),
    )
    kind = windows.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("rule", T.StringType()),
            T.StructField("window_start", T.TimestampType()),
            T.StructField("breach", T.BooleanType()),
            T.StructField("alarm", T.BooleanType()),
        ]
    )
    processor = _Alarms(
        key,
        kind.simpleString(),
        [r.name for r in rules],
        [r.periods for r in rules],
        [r.missing == BREACHING for r in rules],
        seconds,
    )
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
    )
