"""Extension: the row checks on a stream of candles, with late repeats dropped inside a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.operators.schema import COLUMNS, KEYS
from wickwork.operators.validate import row_flags


def flagged_stream(candles: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Candles with ``codes``; exact repeats that come within ``lateness`` are dropped once, state is bounded by it."""
    once = candles.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([*KEYS, *COLUMNS])
    codes = F.array(*(F.when(flag, F.lit(code)) for code, flag in row_flags().items()))
    return once.withColumn("codes", F.filter(codes, lambda x: x.isNotNull()))


def issue_counts(candles: DataFrame, window: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """(window, symbol, resolution, code, n), final once the watermark has passed the window."""
    rows = flagged_stream(candles, lateness).select("ts", *KEYS, F.explode("codes").alias("code"))
    return rows.groupBy(F.window("ts", window), *KEYS, "code").agg(F.count("*").alias("n"))
