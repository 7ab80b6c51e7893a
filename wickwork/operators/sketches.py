"""Extension: mergeable sketches of a dataset's returns and times, for limits that outliers don't move.

A day of a dataset has a KLL sketch of its returns and a HyperLogLog sketch of its times. Sketches of days, datasets or
snapshots are merged without the rows, so that added days cost what they hold. With K a quantile's rank is within
RANK_ERROR of the asked one (99 % of the time), and with LG_K the number of times within TIMES_ERROR.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.functions import times
from wickwork.operators import validate
from wickwork.operators.schema import KEYS, SEQ

K, LG_K = 400, 14
RANK_ERROR, TIMES_ERROR = 0.01, 0.03


def day_sketches(df: DataFrame, rules: validate.Rules = validate.Rules()) -> DataFrame:
    """(symbol, resolution, day, rows, returns, times); a day's first return is that from the day before. Returns that are null or infinite are left out."""
    d = validate.with_order(df, rules)
    change = F.when(F.abs("_change") < math.inf, F.col("_change"))
    return d.groupBy(*KEYS, times.ist_date(F.col("ts")).alias("day")).agg(F.count("*").alias("rows"), F.kll_sketch_agg_double(change, K).alias("returns"), F.hll_sketch_agg(F.unix_micros("ts"), LG_K).alias("times"))


def merged(sketches: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """by, rows, returns, times: the sketches of each group as one."""
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("returns", K).alias("returns"), F.hll_union_agg("times").alias("times"))


def summary(sketches: DataFrame, width: float = 3.0) -> DataFrame:
    """The sketches' other columns with n_returns, n_times, the quartiles of the returns, and the limits ``width`` quartile distances outside of them."""
    n = F.kll_sketch_get_n_double("returns")
    # a sketch without returns has no quantiles
    q = lambda p: F.when(n > 0, F.kll_sketch_get_quantile_double("returns", F.lit(p)))
    out = sketches.withColumns({"n_returns": n, "n_times": F.hll_sketch_estimate("times"), "q1": q(0.25), "median": q(0.5), "q3": q(0.75)})
    away = (F.col("q3") - F.col("q1")) * width
    return out.withColumns({"low": F.col("q1") - away, "high": F.col("q3") + away}).drop("returns", "times")


def robust_outliers(df: DataFrame, limits: DataFrame, rules: validate.Rules = validate.Rules()) -> DataFrame:
    """(symbol, resolution, _seq, ts, change) of rows whose return lies outside its dataset's limits: D22 without moments."""
    d = validate.with_order(df, rules).join(limits.select(*KEYS, F.col("low").alias("_low"), F.col("high").alias("_high")), KEYS)
    return d.where((F.col("_change") < F.col("_low")) | (F.col("_change") > F.col("_high"))).select(*KEYS, SEQ, "ts", F.col("_change").alias("change"))
