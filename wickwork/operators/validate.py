"""The validator: 22 checks over many datasets at once, as flags on rows.

All flags need one exchange, by (symbol, resolution): lag, counts of equal times and the moments of the
returns share that clustering. If a dataset is too large for a task, rows are dealt by blocks instead. An issue's count and samples both come from the flagged rows alone, so a
clean dataset sends nothing to the second shuffle.
"""

from __future__ import annotations

import datetime
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.functions import times
from wickwork.operators.schema import KEYS, PRICES, SEQ, missing_columns

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
# The codes with their severities, and the limits.
SEVERITY = {
    "SCHEMA_MISSING_COLUMNS": ERROR, "EMPTY_DATASET": ERROR, "TZ_NAIVE": ERROR, "TZ_NOT_IST": ERROR, "TS_NOT_SORTED": ERROR, "DUPLICATE_TIMESTAMPS": ERROR,
    "OHLC_HIGH_TOO_LOW": ERROR, "OHLC_LOW_TOO_HIGH": ERROR, "OHLC_HIGH_BELOW_LOW": ERROR, "NON_POSITIVE_PRICE": ERROR, "NULL_PRICE": ERROR, "NON_FINITE_PRICE": ERROR,
    "NULL_VOLUME": ERROR, "NEGATIVE_VOLUME": ERROR, "TS_NOT_MINUTE_ALIGNED": WARNING, "WITHIN_DAY_GAPS": WARNING, "TRADING_CALENDAR_NOT_CONFIGURED": WARNING,
    "EXCESSIVE_DATA_GAP": ERROR, "IMPLAUSIBLE_DATA_GAP": ERROR, "SESSION_WINDOW_NOT_CHECKED": INFO, "OUTSIDE_SESSION_WINDOW": WARNING, "EXTREME_RETURN": WARNING,
}
MAX_SAMPLES = 5
ABSURD_GAP_DAYS = 30
LEAST_ROWS_FOR_RETURNS = 30
#: Datasets whose moments, a row each, are sent to all tasks; more meet the rows in a join.
FEW_DATASETS = 100_000


@dataclass(frozen=True)
class Rules:
    """interval: minutes of a bar, "resolution" to take them from each dataset's resolution, None to skip those checks.

    block: if any dataset has more rows than this, rows are dealt by dataset and blocks of so many sequence
    numbers; else, or with None, by dataset alone, in a single exchange. The results are the same.
    """

    interval: int | str | None = "resolution"
    sigma: float = 10.0
    session: tuple[datetime.time, datetime.time] | None = None
    max_session_gap_days: float | None = None
    source_zone: str = times.IST
    block: int | None = 250_000


def row_extremes() -> dict[str, Column]:
    """top and bottom: the larger and smaller of open and close that is there; missing: whether any price is."""
    o, h, l, c = map(F.col, PRICES)  # noqa: E741
    return {"top": F.greatest(o, c), "bottom": F.least(o, c), "missing": o.isNull() | h.isNull() | l.isNull() | c.isNull()}


def row_flags() -> dict[str, Column]:
    """Checks that need nothing but the row; prices are null or numbers, never NaN."""
    o, h, l, c = map(F.col, PRICES)  # noqa: E741
    no = lambda x: F.coalesce(x, F.lit(False))
    top, bottom, null = row_extremes().values()
    return {
        "OHLC_HIGH_TOO_LOW": no(h < top),
        "OHLC_LOW_TOO_HIGH": no(l > bottom),
        "OHLC_HIGH_BELOW_LOW": no(h < l),
        "NON_POSITIVE_PRICE": no(F.least(o, h, l, c) <= 0),
        "NULL_PRICE": null,
        "NON_FINITE_PRICE": ~null & no(F.greatest(*(F.abs(p) for p in (o, h, l, c))) == math.inf),
        "NULL_VOLUME": F.col("volume").isNull(),
        "NEGATIVE_VOLUME": no(F.col("volume") < 0),
    }


def _clean_nan(df: DataFrame) -> DataFrame:
    return df.withColumns({p: F.nanvl(F.col(p), F.lit(None).cast("double")) for p in PRICES})


def _change() -> Column:
    before, close = F.col("_close"), F.col("close")
    return F.when(before == 0, F.when(close > 0, math.inf).when(close < 0, -math.inf)).otherwise(close / before - 1)


def _shape(df: DataFrame) -> tuple[int, int]:
    """Rows of the largest dataset and the number of datasets, by an aggregate of the keys alone."""
    return tuple(df.groupBy(*KEYS).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first())


def _by_dataset(df: DataFrame) -> DataFrame:
    w, every = Window.partitionBy(*KEYS).orderBy(SEQ), Window.partitionBy(*KEYS)
    d = df.withColumns({"_ts": F.lag("ts").over(w), "_close": F.lag("close").over(w)}).withColumn("_change", _change())
    return d.withColumns({"_mean": F.avg("_change").over(every), "_dev": F.stddev_samp("_change").over(every), "_rows": F.count("*").over(every), "_endless": F.max(F.abs("_change")).over(every) == math.inf})


def _by_block(df: DataFrame, size: int, datasets: int) -> DataFrame:
    """The same columns; the first row of a block gets its predecessor from the last rows of the blocks, one row each."""
    d = df.withColumn("_block", F.floor(F.col(SEQ) / size))
    ends = d.groupBy(*KEYS, "_block").agg(F.max_by(F.struct("ts", "close"), SEQ).alias("_end"))
    renamed = [F.col(k).alias(f"_{k}") for k in KEYS]
    same = F.col(KEYS[0]).eqNullSafe(F.col(f"_{KEYS[0]}")) & F.col(KEYS[1]).eqNullSafe(F.col(f"_{KEYS[1]}"))
    carried = ends.select(*KEYS, "_block", F.lag("_end").over(Window.partitionBy(*KEYS).orderBy("_block")).alias("_carried"))
    w = Window.partitionBy(*KEYS, "_block").orderBy(SEQ)
    first = F.row_number().over(w) == 1
    # by plain equality, whose exchange the window can use; rows without a key stay, but a block of theirs begins anew
    d = d.join(carried, [*KEYS, "_block"], "left")
    d = d.withColumns({"_ts": F.when(first, F.col("_carried.ts")).otherwise(F.lag("ts").over(w)), "_close": F.when(first, F.col("_carried.close")).otherwise(F.lag("close").over(w))})
    d = d.withColumn("_change", _change()).drop("_block", "_carried")
    moments = d.groupBy(*KEYS).agg(F.avg("_change").alias("_mean"), F.stddev_samp("_change").alias("_dev"), F.count("*").alias("_rows"), (F.max(F.abs("_change")) == math.inf).alias("_endless"))
    moments = moments.select(*renamed, "_mean", "_dev", "_rows", "_endless")
    # sent to the tasks, so that a large dataset's rows stay in their blocks
    return d.join(F.broadcast(moments) if datasets <= FEW_DATASETS else moments, same).drop(*(f"_{k}" for k in KEYS))


def with_order(df: DataFrame, rules: Rules) -> DataFrame:
    """df with what the ordered checks need: time since the row before, equal times, z-score of the return."""
    same = Window.partitionBy(*KEYS, "ts")
    d = _clean_nan(df)
    largest, datasets = _shape(df) if rules.block else (0, 0)
    d = _by_block(d, rules.block, datasets) if rules.block and largest > rules.block else _by_dataset(d)
    d = d.withColumn("_gap", F.unix_micros("ts") - F.unix_micros("_ts"))
    d = d.withColumns({"_same": F.count("*").over(same), "_first": F.row_number().over(same.orderBy(SEQ)) == 1})
    minutes = times.resolution_minutes(F.col("resolution")) if rules.interval == "resolution" else F.lit(rules.interval)
    return d.withColumn("_step", minutes.cast("long") * times.MINUTE)


def order_flags(rules: Rules) -> dict[str, Column]:
    no = lambda x: F.coalesce(x, F.lit(False))
    late, same_day = no(F.col("_gap") > F.col("_step")), times.ist_day(F.col("ts")) == times.ist_day(F.col("_ts"))
    across = late & ~no(same_day)
    flags = {
        "TS_NOT_SORTED": no(F.col("_gap") < 0),
        "DUPLICATE_TIMESTAMPS": (F.col("_same") > 1) & F.col("_first"),
        "TS_NOT_MINUTE_ALIGNED": F.col("_step").isNotNull() & F.coalesce(times.ist_second(F.col("ts")) != 0, F.lit(True)),
        "WITHIN_DAY_GAPS": late & no(same_day),
        "IMPLAUSIBLE_DATA_GAP": across & (F.col("_gap") > ABSURD_GAP_DAYS * times.DAY),
        "EXTREME_RETURN": no((F.col("_rows") > LEAST_ROWS_FOR_RETURNS) & ~no(F.col("_endless")) & (F.col("_dev") > 0) & (F.abs((F.col("_change") - F.col("_mean")) / F.col("_dev")) > rules.sigma)),
    }
    if rules.max_session_gap_days is None:
        flags["TRADING_CALENDAR_NOT_CONFIGURED"] = across
    else:
        flags["EXCESSIVE_DATA_GAP"] = across & (F.col("_gap") > rules.max_session_gap_days * times.DAY)
    if rules.session:
        start, end = map(times.time_micros, rules.session)
        at = times.ist_time_micros(F.col("ts"))
        flags["OUTSIDE_SESSION_WINDOW"] = no((at < start) | (at > end))
    return flags


def flagged(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """df (keys, _seq and the six columns) with ``codes``, the row's codes, and the helpers of the ordered checks."""
    codes = F.array(*(F.when(flag, F.lit(code)) for code, flag in {**row_flags(), **order_flags(rules)}.items()))
    return with_order(df, rules).withColumn("codes", F.filter(codes, lambda x: x.isNotNull()))


def violations(df: DataFrame, code: str, rules: Rules = Rules()) -> DataFrame:
    """The rows of one code. A check of single rows is a plain filter, without any exchange."""
    if code in row_flags():
        return _clean_nan(df).where(row_flags()[code]).select(*KEYS, SEQ, "ts")
    return with_order(df, rules).where(order_flags(rules)[code]).select(*KEYS, SEQ, "ts")


def _severity(code: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in SEVERITY.items() for x in pair)), code)


def structural(df: DataFrame, rules: Rules = Rules()) -> list[tuple[str, bool]]:
    """(code, whether it ends validation) that the schema alone shows."""
    if missing_columns(df):
        return [("SCHEMA_MISSING_COLUMNS", True)]
    if not isinstance(df.schema["ts"].dataType, T.TimestampType):
        return [("TZ_NAIVE", True)]
    zone = df.schema["ts"].metadata.get("source_zone", rules.source_zone)
    return [("TZ_NOT_IST", False)] if zone != times.IST else []


def issues(df: DataFrame, rules: Rules = Rules(), requested: DataFrame | None = None) -> DataFrame:
    """(symbol, resolution, code, severity, n): one row for each dataset and code with any finding.

    requested (symbol, resolution): datasets that are to be there; those without rows are EMPTY_DATASET.
    """
    found = structural(df, rules)
    if found and found[0][0] == "SCHEMA_MISSING_COLUMNS":
        keys = df.select(*(F.col(k) if k in df.columns else F.lit(None).cast("string").alias(k) for k in KEYS)).distinct()
        return keys.select(*KEYS, F.lit("SCHEMA_MISSING_COLUMNS").alias("code"), F.lit(ERROR).alias("severity"), F.lit(len(missing_columns(df))).cast("long").alias("n"))
    counts = [df.groupBy(*KEYS).agg(F.count("*").alias("n")).select(*KEYS, F.lit(code).alias("code"), "n") for code, _ in found]
    if not any(ends for _, ends in found):
        rows = flagged(df, rules)
        counts.append(rows.select(*KEYS, F.explode("codes").alias("code")).groupBy(*KEYS, "code").agg(F.count("*").alias("n")))
        if rules.session is None:
            counts.append(df.select(*KEYS).distinct().select(*KEYS, F.lit("SESSION_WINDOW_NOT_CHECKED").alias("code"), F.lit(1).cast("long").alias("n")))
    if requested is not None:
        counts.append(requested.select(*KEYS).distinct().join(df.select(*KEYS), KEYS, "left_anti").select(*KEYS, F.lit("EMPTY_DATASET").alias("code"), F.lit(1).cast("long").alias("n")))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out.select(*KEYS, "code", _severity(F.col("code")).alias("severity"), "n")


def samples(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(symbol, resolution, code, samples): the first five times of each issue, in row order."""
    rows = flagged(df, rules).select(*KEYS, SEQ, "ts", F.explode("codes").alias("code"))
    place = F.row_number().over(Window.partitionBy(*KEYS, "code").orderBy(SEQ))
    first = rows.withColumn("place", place).where(F.col("place") <= MAX_SAMPLES)
    return first.groupBy(*KEYS, "code").agg(F.transform(F.array_sort(F.collect_list(F.struct(SEQ, "ts"))), lambda x: x["ts"]).alias("samples"))


def envelope(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per dataset: rows, first and last time by position, repeated rows, missing bars, largest cross-day gap in days."""
    d = with_order(df, rules)
    late, same_day = F.col("_gap") > F.col("_step"), times.ist_day(F.col("ts")) == times.ist_day(F.col("_ts"))
    return d.groupBy(*KEYS).agg(
        F.count("*").alias("row_count"),
        F.min_by("ts", SEQ).alias("first_ts"),
        F.max_by("ts", SEQ).alias("last_ts"),
        F.count_if(F.col("_same") > 1).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(late & same_day, F.bround(F.col("_gap") / F.col("_step") - 1))), F.lit(0)).cast("long").alias("missing_bars"),
        F.max(F.when(late & ~same_day, F.col("_gap") / times.DAY)).alias("largest_gap_days"),
    )


def by_severity(found: DataFrame, severity: str) -> DataFrame:
    return found.where(F.col("severity") == severity)


def codes_not_found(found: DataFrame) -> DataFrame:
    """(code): the checks that found nothing in any dataset."""
    return found.sparkSession.createDataFrame([(c,) for c in SEVERITY], "code string").join(found.select("code").distinct(), "code", "left_anti")


def usable(found: DataFrame) -> DataFrame:
    """Per dataset with issues: whether none is an ERROR."""
    return found.groupBy(*KEYS).agg((F.count_if(F.col("severity") == ERROR) == 0).alias("usable"))


#: What each code says of its count; {rows} and {days} are of the dataset's envelope.
MESSAGES = {
    "SCHEMA_MISSING_COLUMNS": "required columns are missing", "EMPTY_DATASET": "the dataset was requested and has no rows", "TZ_NAIVE": "times have no zone", "TZ_NOT_IST": "times are of another zone than the exchange",
    "TS_NOT_SORTED": "rows are earlier than the row before", "DUPLICATE_TIMESTAMPS": "times occur more than once, in {rows} rows", "OHLC_HIGH_TOO_LOW": "highs are below open or close",
    "OHLC_LOW_TOO_HIGH": "lows are above open or close", "OHLC_HIGH_BELOW_LOW": "highs are below the low", "NON_POSITIVE_PRICE": "rows have a price that is not positive", "NULL_PRICE": "rows lack a price",
    "NON_FINITE_PRICE": "rows have an infinite price", "NULL_VOLUME": "rows lack a volume", "NEGATIVE_VOLUME": "rows have a negative volume", "TS_NOT_MINUTE_ALIGNED": "times are not on a whole minute",
    "WITHIN_DAY_GAPS": "gaps within a day", "TRADING_CALENDAR_NOT_CONFIGURED": "gaps across days are not judged without a calendar, the largest of {days} days",
    "EXCESSIVE_DATA_GAP": "gaps across days exceed the limit, the largest of {days} days", "IMPLAUSIBLE_DATA_GAP": "gaps no calendar explains, the largest of {days} days",
    "SESSION_WINDOW_NOT_CHECKED": "no session window was given", "OUTSIDE_SESSION_WINDOW": "rows lie outside the session", "EXTREME_RETURN": "returns are further from the mean than the limit",
}


def with_messages(found: DataFrame, about: DataFrame) -> DataFrame:
    """issues with a column message; about: the datasets' envelope."""
    text = F.element_at(F.create_map(*(F.lit(x) for pair in MESSAGES.items() for x in pair)), F.col("code"))
    days = F.coalesce(F.round("largest_gap_days", 1).cast("decimal(18,1)").cast("string"), F.lit("?"))
    text = F.replace(F.replace(text, F.lit("{rows}"), F.coalesce(F.col("duplicate_rows").cast("string"), F.lit("?"))), F.lit("{days}"), days)
    met = found.join(about.select(*KEYS, "duplicate_rows", "largest_gap_days"), KEYS, "left")
    return met.select(*found.columns, F.concat(F.col("n").cast("string"), F.lit(" "), text).alias("message"))


def report_rows(found: DataFrame, about: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """Per dataset, as one row: the envelope, whether it is usable, and its issues with messages and samples (first: of samples)."""
    told = with_messages(found, about)
    told = told.join(first, [*KEYS, "code"], "left") if first is not None else told.withColumn("samples", F.lit(None).cast("array<timestamp>"))
    told = told.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("code", "severity", "message", F.col("n").alias("count"), "samples"))).alias("issues"))
    out = about.join(told, KEYS, "full").withColumn("issues", F.coalesce("issues", F.expr("array()").cast(told.schema["issues"].dataType)))
    return out.withColumn("usable", ~F.exists("issues", lambda i: i["severity"] == ERROR))


def to_dict(report: DataFrame) -> dict[tuple[str, str], dict]:
    """report_rows by dataset, as plain values: a table of a row a dataset."""
    return {(r.symbol, r.resolution): r.asDict(recursive=True) for r in report.collect()}


def report_text(found: DataFrame, about: DataFrame) -> str:
    """A plain report of every dataset, from tables of a few rows each."""
    lines = []
    issues_of: dict[tuple, list] = {}
    for r in with_messages(found, about).orderBy(*KEYS, "severity", "code").collect():
        issues_of.setdefault((r.symbol, r.resolution), []).append(r)
    for r in about.withColumns({"a": times.iso(F.col("first_ts")), "b": times.iso(F.col("last_ts"))}).orderBy(*KEYS).collect():
        own = issues_of.get((r.symbol, r.resolution), [])
        lines.append(f"{r.symbol} {r.resolution}: {r.row_count} rows, {r.a} to {r.b}, {'NOT usable' if any(x.severity == ERROR for x in own) else 'usable'}")
        lines += [f"  [{x.severity}] {x.code}: {x.message}" for x in own]
    return "\n".join(lines)
