"""Extension: moving means over datasets of any size, block by block of ``_seq``.

An exponential mean is a chain of associative steps (decay, sum). Inside a block it is a running sum in closed form;
a block as a whole is one such step, and those of a dataset, one row a block, are chained in order by one task. A
moving window looks back into the block before, so the last rows of each block are dealt to the next as well. Neither
depends on the size of a block but for rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.operators.schema import KEYS, SEQ

BLOCK = 4096
#: A block's largest factor; more would leave the range of a double.
LARGEST = 1e200


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(symbol, resolution, block, decay, sum, first) by dataset and block, to the mean that each block begins with."""
    key, mean = None, None
    for batch in batches:
        out = []
        for symbol, resolution, decay, total, first in zip(*(batch[c].to_pylist() for c in (*KEYS, "decay", "sum", "first")), strict=True):
            if (symbol, resolution) != key:
                key, mean = (symbol, resolution), None
            out.append(mean)
            if first is not None:
                mean = decay * (first if mean is None else mean) + total
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in (*KEYS, "block")), pa.array(out, pa.float64())], [*KEYS, "_block", "_before"])


def exponential_mean(df: DataFrame, column: str, alpha: float, name: str = "ewm", block: int = BLOCK) -> DataFrame:
    """df with the mean m = (1 - alpha) m + alpha x, row by row in the order of ``_seq``, beginning with the first x.

    Rows without x keep the mean so far; it is null before the first x.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha has to be over 0 and at most 1")
    keep = max(1 - alpha, 1e-300)  # at 1 nothing is kept that a double could show
    size = max(1, min(block, int(math.log(LARGEST) / -math.log(keep))))
    blocks = Window.partitionBy(*KEYS, "_block").orderBy(SEQ)
    d = df.withColumn("_block", F.floor(F.col(SEQ) / size)).withColumn("_x", F.col(column).cast("double"))
    d = d.withColumn("_k", F.count("_x").over(blocks.rowsBetween(Window.unboundedPreceding, 0)))  # which x of the block it is
    power = lambda k: F.pow(F.lit(keep), k)
    d = d.withColumn("_sum", F.coalesce(F.sum(F.col("_x") * power(-F.col("_k"))).over(blocks.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)) * power(F.col("_k")) * alpha)
    ends = d.groupBy(*KEYS, "_block").agg(power(F.max("_k")).alias("decay"), F.max_by("_sum", SEQ).alias("sum"), F.min_by("_x", F.when(F.col("_x").isNotNull(), F.col(SEQ))).alias("first"))
    ordered = ends.select(*KEYS, F.col("_block").alias("block"), "decay", "sum", "first").repartition(*KEYS).sortWithinPartitions(*KEYS, "block")
    chained = ordered.mapInArrow(_chain, "symbol string, resolution string, _block long, _before double")
    firsts = F.min_by("_x", F.when(F.col("_x").isNotNull(), F.col(SEQ))).over(Window.partitionBy(*KEYS, "_block"))
    met = d.withColumn("_first", firsts).join(chained, [*KEYS, "_block"], "left")
    start = F.coalesce("_before", F.when(F.col("_k") > 0, F.col("_first")))
    return met.withColumn(name, power(F.col("_k")) * start + F.col("_sum")).select(*df.columns, name)


def moving(df: DataFrame, column: str, rows: int, block: int = BLOCK) -> DataFrame:
    """df with moving_mean and moving_std (of a sample) over the last so many rows; ``_seq`` has to count rows from 0 (schema.resequenced)."""
    size = max(block, rows)
    at = F.col(SEQ) % size
    spread = F.when(at > size - rows, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = df.withColumn("_ahead", F.explode(spread)).withColumn("_block", F.floor(F.col(SEQ) / size) + F.col("_ahead"))
    w = Window.partitionBy(*KEYS, "_block").orderBy(SEQ).rowsBetween(1 - rows, 0)
    out = d.withColumns({"moving_mean": F.avg(column).over(w), "moving_std": F.stddev_samp(column).over(w)})
    return out.where("_ahead = 0").drop("_ahead", "_block")
