"""Extension: days that were asked for and have no bar, as intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.functions.times import ist_date
from wickwork.operators.schema import KEYS


def missing_days(requests: DataFrame, candles: DataFrame) -> DataFrame:
    """(symbol, resolution, from_date, to_date, days): runs of consecutive requested days (start to end, both included) without a candle.

    Requested days and days with candles meet by equality, a day a row; requests may overlap.
    """
    wanted = requests.where("start <= end").select(*KEYS, F.explode(F.sequence("start", "end")).alias("day")).distinct()
    held = candles.select(*KEYS, ist_date(F.col("ts")).alias("day")).distinct()
    gone = wanted.join(held, [*KEYS, "day"], "left_anti")
    # consecutive days less their places are one date
    place = F.row_number().over(Window.partitionBy(*KEYS).orderBy("day"))
    return gone.withColumn("run", F.date_sub("day", place)).groupBy(*KEYS, "run").agg(F.min("day").alias("from_date"), F.max("day").alias("to_date"), F.count("*").alias("days")).drop("run")
