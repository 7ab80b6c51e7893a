"""Extension: the ordered checks on a stream of candles, with each dataset's last row and recent times as state.

Rows of a dataset come in the order of ``_seq``, within a batch in any order. One that comes after a later ``_seq`` is
told as LATE_ROW and compared with nothing, as its neighbours are gone. Times older than the watermark are dropped by
Spark, and the times seen so far are forgotten by a timer once the watermark has passed their hour, so that a dataset's
state is its last row and the times of the hours within ``lateness``, an entry an hour. What is told is what the batch checks tell of the same rows,
if repeated times come within ``lateness`` of each other.

The session's state store has to be RocksDB's (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wickwork.functions.times import DAY, IST_MICROS, MINUTE, RESOLUTIONS
from wickwork.operators.schema import KEYS, SEQ

LATE = "LATE_ROW"
HOUR = 60 * MINUTE


class OrderedChecks(StatefulProcessor):
    """Rows are compared as arrays. The state's calls are one for each dataset, and two for each hour that a batch has times in, not for each row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seq long, us long")
        # an hour's times, ascending, with each one's first seq and whether its repetition was told: arrays as bytes
        self.seen = handle.getMapState("seen", "hour long", "us binary, seq binary, told binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seq, us = (np.concatenate(x) for x in zip(*((f["seq"].to_numpy(np.int64), f["us"].to_numpy(np.int64)) for f in rows), strict=True))
        order = np.argsort(seq, kind="stable")
        seq, us = seq[order], us[order]
        before = self.last.get() if self.last.exists() else None
        late = int(np.searchsorted(seq, before[0])) if before else 0
        found = [(seq[:late], us[:late], LATE)]
        seq, us = seq[late:], us[late:]
        if len(seq):
            found += [*self._gaps(key, seq, us, before), *self._repeated(seq, us)]
            self.last.update((int(seq[-1]), int(us[-1])))
            self.handle.registerTimer((int(us.max()) // HOUR + 1) * HOUR // 1000 + 1)
        for s, u, code in found:
            if len(s):
                yield pd.DataFrame({"symbol": key[0], "resolution": key[1], "seq": s, "us": u, "code": code})

    @staticmethod
    def _gaps(key: tuple, seq: np.ndarray, us: np.ndarray, before: tuple | None) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        if before is None:
            earlier, seq, us = us[:-1], seq[1:], us[1:]
        else:
            earlier = np.concatenate([[before[1]], us[:-1]])
        gap, minutes = us - earlier, RESOLUTIONS.get(key[1])
        yield seq[gap < 0], us[gap < 0], "TS_NOT_SORTED"
        if minutes:
            within = (gap > minutes * MINUTE) & ((us + IST_MICROS) // DAY == (earlier + IST_MICROS) // DAY)
            yield seq[within], us[within], "WITHIN_DAY_GAPS"

    def _repeated(self, seq: np.ndarray, us: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        """Each time that came before, in this batch or an earlier one, once: with its first row's seq."""
        times, at, n = np.unique(us, return_index=True, return_counts=True)
        first, hours = seq[at], times // HOUR
        starts = np.flatnonzero(np.diff(hours, prepend=hours[0] - 1))
        for a, b in zip(starts, [*starts[1:], len(times)], strict=True):
            hour = (int(hours[a]),)
            old = self.seen.getValue(hour) if self.seen.containsKey(hour) else (b"", b"", b"")
            t0, s0, told0 = (np.frombuffer(bytes(x), kind) for x, kind in zip(old, (np.int64, np.int64, np.bool_), strict=True))
            # stored rows come first, so that a time's first row is theirs
            both, index, inverse = np.unique(np.concatenate([t0, times[a:b]]), return_index=True, return_inverse=True)
            firsts = np.concatenate([s0, first[a:b]])[index]
            count = np.bincount(inverse, np.concatenate([np.ones(len(t0)), n[a:b]]), len(both))
            told = np.zeros(len(both), np.bool_)
            told[inverse[: len(t0)]] = told0
            new = (count > 1) & ~told
            yield firsts[new], both[new], "DUPLICATE_TIMESTAMPS"
            self.seen.updateValue(hour, (both.tobytes(), firsts.tobytes(), (told | new).tobytes()))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for (hour,) in list(self.seen.keys()):
            if (hour + 1) * HOUR <= passed:
                self.seen.removeKey((hour,))
        yield from ()

    def close(self) -> None:
        """Nothing is open."""


def ordered_stream(candles: DataFrame, lateness: str = "7 days") -> DataFrame:
    """(symbol, resolution, seq, us, code) as they are found: TS_NOT_SORTED, DUPLICATE_TIMESTAMPS, WITHIN_DAY_GAPS and LATE_ROW."""
    rows = candles.where("ts is not null").withWatermark("ts", lateness).select(*KEYS, F.col(SEQ).alias("seq"), F.unix_micros("ts").alias("us"), "ts")
    return rows.groupBy(*KEYS).transformWithStateInPandas(statefulProcessor=OrderedChecks(), outputStructType="symbol string, resolution string, seq long, us long, code string", outputMode="Append", timeMode="EventTime")
