"""The first day a vendor has data for, for many datasets at once: a bisection in rounds, one job a round.

Each round asks for the middle of every dataset's open days, a window of a few days long. A window with candles moves
the high end before it and counts as found, any other moves the low end past it: where data has gaps the answer is what
bisecting finds, which needn't be the first day of all. A request that failed counts as no data, a refused token stops all.
Rounds are written once, so that no request is made again when a later one fails.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.functions import times
from wickwork.operators.schema import KEYS, SchemaError
from wickwork.plans.scratch import kept
from wickwork.sources.payloads import AuthError, Fetch, VendorError, bad_width, with_status

WINDOW_DAYS = 5


def earliest(requests: DataFrame, answer: Callable[[DataFrame], DataFrame], window_days: int = WINDOW_DAYS) -> DataFrame:
    """(symbol, resolution, earliest) from (symbol, resolution, oldest, newest), one row a dataset; null where nothing was found.

    answer turns (symbol, resolution, from_date, to_date) into those of (symbol, resolution) whose window has candles.
    """
    state = kept(requests.select(*KEYS, F.col("oldest").alias("low"), F.col("newest").alias("high"), "newest", F.lit(None).cast("date").alias("earliest")))
    middle = times.midpoint(F.col("low"), F.col("high"))
    while state.where("low <= high").head(1):
        asks = state.where("low <= high").select(*KEYS, middle.alias("from_date"), F.least(F.date_add(middle, window_days - 1), F.col("newest")).alias("to_date"))
        hits = answer(asks).select(*KEYS).distinct().withColumn("hit", F.lit(True))
        met, is_open, hit = state.join(hits, KEYS, "left"), F.col("low") <= F.col("high"), F.coalesce("hit", F.lit(False))
        state = kept(met.select(
            *KEYS, F.when(is_open & ~hit, F.date_add(middle, 1)).otherwise(F.col("low")).alias("low"), F.when(is_open & hit, F.date_sub(middle, 1)).otherwise(F.col("high")).alias("high"),
            "newest", F.when(is_open & hit, middle).otherwise(F.col("earliest")).alias("earliest"),
        ))
    return state.select(*KEYS, "earliest")


def stored_answer(candles: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Answers from candles that are here: a window's days meet the datasets' days, without a range join."""
    days = kept(candles.select(*KEYS, times.ist_date(F.col("ts")).alias("day")).distinct())
    return lambda asks: asks.select(*KEYS, F.explode(F.sequence("from_date", "to_date")).alias("day")).join(days, [*KEYS, "day"])


def asked(asks: DataFrame, fetch: Fetch, pause: float = 0.0, tasks: int = 1) -> DataFrame:
    """asks with the vendor's payload, each asked once, in so many tasks whose pauses together keep one request a pause."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for symbol, resolution, a, b in zip(*(batch[c].to_pylist() for c in (*KEYS, "from_date", "to_date")), strict=True):
                try:
                    payloads.append(fetch(symbol, resolution, a, b))
                except VendorError as error:
                    payloads.append(json.dumps({"s": "error", "message": str(error)}))
                if pause:
                    time.sleep(pause * tasks)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in (*KEYS, "from_date", "to_date")), pa.array(payloads, pa.string())], [*KEYS, "from_date", "to_date", "payload"])

    return kept(asks.select(*KEYS, "from_date", "to_date").repartition(tasks).mapInArrow(run, "symbol string, resolution string, from_date date, to_date date, payload string"))


def live_answer(fetch: Fetch, pause: float = 0.25, tasks: int = 1) -> Callable[[DataFrame], DataFrame]:
    """Answers from a vendor's function, fetched inside tasks."""

    def answer(asks: DataFrame) -> DataFrame:
        parsed = with_status(asked(asks, fetch, pause, tasks))
        if refused := parsed.where("status = 'auth'").head(1):
            raise AuthError(f"the vendor refused {refused[0].symbol} as unauthenticated")
        if broken := parsed.where(bad_width()).head(1):
            raise SchemaError(f"{broken[0].symbol} has a candle without six fields")
        return parsed.where((F.col("status") == "ok") & (F.size("candles") > 0))

    return answer
