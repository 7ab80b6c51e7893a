"""Candles and payloads derived from the driver's tables, with defects at fixed places so that every check finds some."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.functions.times import DAY, declared, ntz_micros
from wickwork.operators.schema import COLUMNS, KEYS, SEQ


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar for each event, resolution 1; defects where the id divides by a prime."""
    e = table(spark, sf_dir, "events").withColumn("us", ntz_micros(F.col("ts")))
    at = lambda n: F.col("event_id") % n == 0
    o, c = F.col("value"), F.col("value") + (F.col("event_id") % 7 - 3) * 0.01
    high, low = F.greatest(o, c) + 0.05, F.least(o, c) - 0.05
    return e.select(
        F.col("event_type").alias("symbol"), F.lit("1").alias("resolution"), F.col("event_id").alias(SEQ),
        F.timestamp_micros(F.when(at(109), F.col("us") - F.pmod("us", F.lit(DAY))).otherwise(F.col("us"))).alias("ts"),
        o.alias("open"), F.when(at(127), math.inf).when(at(97), low - 1).otherwise(high).alias("high"), F.when(at(101), 0.0).when(at(131), F.least(o, c) + 0.02).otherwise(low).alias("low"),
        F.when(~at(103), c).alias("close"), F.when(at(107), -1).when(~at(113), F.col("event_id") % 1000).cast("long").alias("volume"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of an hour, resolution 60; days from the 15th on lie 90 days later."""
    hour = 3_600_000_000
    e = table(spark, sf_dir, "events").withColumn("us", ntz_micros(F.col("ts"))).withColumn("h", F.floor(F.col("us") / hour))
    order = F.struct("us", "event_id")
    g = e.groupBy("event_type", "h").agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("volume"), F.max(F.dayofmonth("ts")).alias("d"))
    ts = F.timestamp_micros(F.col("h") * hour + F.when(F.col("d") >= 15, 90 * DAY).otherwise(0))
    return g.select(F.col("event_type").alias("symbol"), F.lit("60").alias("resolution"), F.col("h").alias(SEQ), ts.alias("ts"), "open", "high", "low", "close", "volume")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of a day, resolution 1D, from orders by priority."""
    o = table(spark, sf_dir, "orders").withColumn("us", ntz_micros(F.col("o_orderdate").cast("timestamp_ntz")))
    key = F.col("o_orderkey")
    g = o.groupBy("o_orderpriority", "us").agg(F.min_by("o_totalprice", key).alias("open"), F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", key).alias("close"), F.count("*").alias("volume"))
    return g.select(F.col("o_orderpriority").alias("symbol"), F.lit("1D").alias("resolution"), F.floor(F.col("us") / DAY).alias(SEQ), F.timestamp_micros("us").alias("ts"), "open", "high", "low", "close", "volume")


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick(spark, sf_dir).unionByName(hourly(spark, sf_dir)).unionByName(daily(spark, sf_dir)).select(*KEYS, SEQ, *COLUMNS)


def doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of overlapping chunks: every 5th event came twice, every 10th the second time with another close."""
    t = tick(spark, sf_dir)
    again = t.where(F.col(SEQ) % 5 == 0).withColumn("close", F.when(F.col(SEQ) % 10 == 0, F.col("close") + 10).otherwise(F.col("close"))).withColumn(SEQ, F.col(SEQ) + 1_000_000_000_000)
    return t.unionByName(again)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor answers: a chunk for each 500 events of a type; some fail, in each of the ways that vendors do."""
    e = table(spark, sf_dir, "events").withColumn("chunk", F.floor(F.col("event_id") / 500).cast("int")).withColumn("ts", declared(F.col("ts")))
    row = F.array(*(x.cast("string") for x in (F.unix_seconds("ts"), F.lit(10), F.lit(12), F.lit(9), F.lit(11), F.col("event_id"))))
    g = e.groupBy(F.col("event_type").alias("symbol"), "chunk").agg(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))).alias("rows"), F.min(F.to_date("ts")).alias("from_date"), F.max(F.to_date("ts")).alias("to_date"))
    ok = F.to_json(F.struct(F.lit("ok").alias("s"), F.transform("rows", lambda x: x["r"]).alias("candles")))
    kind = F.col("chunk") % 7
    payload = (
        F.when(kind == 1, '{"s":"ok","candles":[]}').when(kind == 2, '{"s":"error","code":429,"message":"rate limit exceeded"}').when(kind == 3, '{"s":"error","code":-99,"message":"something broke"}')
        .when(kind == 4, '{"s":"ok"}').when(kind == 5, '{"s":"error","code":-16,"message":"Invalid key"}').otherwise(ok)
    )
    return g.select("symbol", F.lit("1").alias("resolution"), "chunk", "from_date", "to_date", payload.alias("payload"))
