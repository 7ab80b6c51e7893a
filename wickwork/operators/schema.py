"""The canonical candle relation and its strict, value-preserving normaliser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["symbol", "resolution"]
PRICES = ["open", "high", "low", "close"]
COLUMNS = ["ts", *PRICES, "volume"]
SEQ = "_seq"
CANONICAL = T.StructType([T.StructField("ts", T.TimestampType()), *(T.StructField(p, T.DoubleType()) for p in PRICES), T.StructField("volume", T.LongType())])
#: Rows of a dataset and range that are sent to all tasks when rows are numbered; more meet the rows in a join.
FEW_STARTS = 100_000
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"


class SchemaError(ValueError):
    """Data that can't be made canonical without changing or losing values."""


def empty_candles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CANONICAL)


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in COLUMNS if c not in df.columns]


def strict_double(c: Column, kind: T.DataType) -> Column:
    """A number, or null; NaN counts as missing."""
    if isinstance(kind, T.StringType):
        return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def strict_long(c: Column, kind: T.DataType) -> Column:
    """A whole number in range, or null."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(kind, T.StringType):
        exact = F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("long"))
        x = strict_double(c, kind)
        return F.coalesce(exact, F.when((x == F.floor(x)) & (F.abs(x) < 2.0**63), x.try_cast("long")))
    x = strict_double(c, kind)
    return F.when((x == F.floor(x)) & (F.abs(x) < 2.0**63), x.try_cast("long"))


def cast_strictly(df: DataFrame) -> DataFrame:
    """Canonical columns (others stay), and ``_destroyed``: the columns whose value a cast would lose."""
    lost, out = [], {}
    for c in [*PRICES, "volume"]:
        kind = df.schema[c].dataType
        out[c] = (strict_long if c == "volume" else strict_double)(F.col(c), kind)
        was_null = F.col(c).isNull() | (F.isnan(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.lit(False))
        lost.append(F.when(~was_null & out[c].isNull(), F.lit(c)))
    return df.withColumn("_destroyed", F.filter(F.array(*lost), lambda x: x.isNotNull())).withColumns(out)


def check_destroyed(df: DataFrame) -> None:
    """Raise for values present in the source that aren't numbers: one aggregate, and the first five of a column that has any."""
    cast = cast_strictly(df.withColumns({f"_raw_{c}": F.col(c).cast("string") for c in [*PRICES, "volume"]}))
    bad = cast.where(F.size("_destroyed") > 0).select(F.explode("_destroyed").alias("column"), F.coalesce(*(F.when(F.array_contains("_destroyed", c), F.col(f"_raw_{c}")) for c in [*PRICES, "volume"])).alias("value"))
    for row in bad.groupBy("column").agg(F.count("*").alias("n")).orderBy("column").collect():
        values = [r.value for r in bad.where(F.col("column") == row.column).select("value").distinct().orderBy("value").limit(5).collect()]
        raise SchemaError(f"column {row.column!r}: {row.n} value(s) present but not numeric, such as {values}; they are not turned into missing ones")


def normalise(df: DataFrame, check: bool = True, ordered: bool = True) -> DataFrame:
    """Six columns, with any keys and ``_seq`` before them, in time order; no value is replaced, filled or dropped.

    With ordered=False rows stay where they are, without a shuffle, for callers that deal them anew.
    """
    if missing := missing_columns(df):
        raise SchemaError(f"missing column(s) {missing}; required are {COLUMNS}")
    if not isinstance(df.schema["ts"].dataType, T.TimestampType):
        raise SchemaError(f"ts must be an instant, not {df.schema['ts'].dataType.simpleString()}: no zone is assumed")
    if check:
        check_destroyed(df)
    extra = [c for c in [*KEYS, SEQ] if c in df.columns]
    order = [*(c for c in extra if c != SEQ), F.col("ts").asc_nulls_last(), *([SEQ] if SEQ in extra else [])]
    out = cast_strictly(df).select(*extra, *COLUMNS)
    return out.sort(*order) if ordered else out


def resequenced(df: DataFrame) -> DataFrame:
    """``_seq`` anew from 0 in each dataset, in time order.

    Rows are dealt by ranges of (dataset, time, ``_seq``) and written once. A row's place in its range less the place
    where its dataset begins there, plus the dataset's rows in ranges before, is its number: however large a dataset
    is, no task has more than a range, and only a row for each dataset of a range is summed.
    """
    from wickwork.plans.scratch import kept

    order = [F.col(k).asc_nulls_first() for k in KEYS] + [F.col("ts").asc_nulls_last(), F.col(SEQ).asc_nulls_last()]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = kept(placed.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    parts = placed.groupBy(*KEYS, "_range").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*KEYS).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*(F.col(k).alias(f"_{k}") for k in KEYS), F.col("_range").alias("_in"), (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    same = (F.col("_range") == F.col("_in")) & F.col(KEYS[0]).eqNullSafe(F.col(f"_{KEYS[0]}")) & F.col(KEYS[1]).eqNullSafe(F.col(f"_{KEYS[1]}"))
    few = parts.limit(FEW_STARTS + 1).count() <= FEW_STARTS
    return placed.join(F.broadcast(starts) if few else starts, same).withColumn(SEQ, F.col("_place") + F.col("_start")).select(*df.columns)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n rows of each dataset in time order."""
    place = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.col("ts").asc_nulls_last(), SEQ))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def assert_canonical(df: DataFrame) -> None:
    """The schema exactly, and every dataset in time order."""
    found = [(f.name, f.dataType) for f in df.schema if f.name not in (*KEYS, SEQ)]
    if found != [(f.name, f.dataType) for f in CANONICAL]:
        raise SchemaError(f"not canonical: {df.schema.simpleString()}")
    if SEQ in df.columns:
        before = F.lag("ts").over(Window.partitionBy(*KEYS).orderBy(SEQ))
        if df.select((F.col("ts") < before).alias("back")).where("back").limit(1).count():
            raise SchemaError("rows are not in time order")
