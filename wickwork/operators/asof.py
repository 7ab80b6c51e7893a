"""Extension: as-of join. Each left row meets the last right row of its keys that isn't later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.functions.times import DAY


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], *, prefix: str = "right_", tie: str | None = None, tolerance_micros: int | None = None, exact: bool = True, width_micros: int = DAY) -> DataFrame:
    """left's rows with right's other columns, prefixed; null where no right row is early enough.

    Both sides are dealt together by keys and blocks of time ``width_micros`` wide, so that large datasets spread and
    nothing is joined by inequality. A block begins with the last right row of the blocks before it, one row a block.
    Right rows of the same time: the one with the largest ``tie``. exact: whether equal times meet. Left rows without a
    time meet nothing, and null keys equal each other.
    """
    others = [c for c in right.columns if c not in by]
    key = F.struct(*by).alias("_key")  # never null itself, so that plain equality serves the join and the window alike
    no = lambda kind: F.lit(None).cast(kind)
    r = right.where("ts is not null").select(key, "ts", F.struct(*others).alias("_r"), (F.col(tie) if tie else F.lit(0)).alias("_tie"), F.lit(0 if exact else 2).alias("_side"))
    rows = left.select(key, "ts", F.struct(*left.columns).alias("_l"), no(r.schema["_r"].dataType).alias("_r"), no(r.schema["_tie"].dataType).alias("_tie"), F.lit(1).alias("_side"))
    rows = rows.unionByName(r.withColumn("_l", no(rows.schema["_l"].dataType))).withColumn("_block", F.floor(F.unix_micros("ts") / width_micros))
    # a row for each block of either side; only right rows are summed up
    ends = rows.where("_r is not null").groupBy("_key", "_block").agg(F.max_by("_r", F.struct("ts", "_tie")).alias("_end"))
    ends = ends.unionByName(rows.where("_l is not null").select("_key", "_block").distinct(), allowMissingColumns=True).groupBy("_key", "_block").agg(F.first("_end", ignorenulls=True).alias("_end"))
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_key", "_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    met = rows.join(carried, ["_key", "_block"], "left")
    w = Window.partitionBy("_key", "_block").orderBy("ts", "_side", F.col("_tie").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("_met", F.when(F.col("ts").isNotNull(), F.coalesce(F.last("_r", ignorenulls=True).over(w), "_carried"))).where("_l is not null")
    if tolerance_micros is not None:
        met = met.withColumn("_met", F.when(F.unix_micros("ts") - F.unix_micros("_met.ts") <= tolerance_micros, F.col("_met")))
    return met.select("_l.*", *(F.col(f"_met.{c}").alias(f"{prefix}{c}") for c in others))
