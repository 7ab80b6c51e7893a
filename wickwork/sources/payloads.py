"""Vendor payloads to candles: date chunks, error classes, positional rows, coverage.

A payload table has one row a chunk: symbol, resolution, chunk (its number), from_date, to_date, payload
(JSON text). Rows are cast from text after parsing, so one bad value never nulls its neighbours.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.functions.texts import vendor_status
from wickwork.functions.times import RESOLUTIONS
from wickwork.operators.clean import conflicting_timestamps, drop_exact_duplicate_rows
from wickwork.operators.schema import COLUMNS, KEYS, SEQ, SchemaError, cast_strictly

# Days that one request may span.
INTRADAY_DAYS, DAILY_DAYS = 100, 366
ROW_STRIDE = 1_000_000  # candles of a chunk that _seq leaves room for


#: A vendor's function: symbol, resolution, first day, last day -> JSON text.
Fetch = Callable[[str, str, datetime.date, datetime.date], str]


class AuthError(PermissionError):
    """The vendor refused the token: the whole run stops."""


class VendorError(RuntimeError):
    """One request failed; what a vendor's function raises for it. Any other exception stops the run."""


def max_days(resolution: Column) -> Column:
    return F.when(resolution == "1D", DAILY_DAYS).otherwise(INTRADAY_DAYS)


def check_resolution(resolution: str) -> None:
    if resolution not in RESOLUTIONS:
        raise ValueError(f"resolution {resolution!r} isn't one of {list(RESOLUTIONS)}")


def plan_chunks(requests: DataFrame) -> DataFrame:
    """(symbol, resolution, start, end) to its chunks: contiguous, inclusive, at most max_days long each."""
    days = max_days(F.col("resolution"))
    checked = F.when(F.col("end") < F.col("start"), F.raise_error(F.lit("end is before start")).cast("date")).otherwise(F.col("start"))
    starts = F.sequence(checked, F.col("end"), F.make_dt_interval(days))
    chunks = requests.select(*KEYS, "start", "end", F.posexplode(starts).alias("chunk", "from_date"))
    return chunks.select(*KEYS, "chunk", "from_date", F.least(F.date_add("from_date", days - 1), F.col("end")).alias("to_date"))


def with_status(payloads: DataFrame) -> DataFrame:
    """payloads with ``status`` and ``candles`` (rows of text, null unless ok)."""
    status = vendor_status(F.col("payload"))
    rows = F.from_json("payload", "candles array<array<string>>")["candles"]
    return payloads.withColumn("status", status).withColumn("candles", F.when(F.col("status") == "ok", F.coalesce(rows, F.array().cast("array<array<string>>"))))


def bad_width() -> Column:
    """Whether a chunk has a candle that hasn't six fields."""
    return F.exists("candles", lambda r: F.size(r) != 6)


def candles_of(parsed: DataFrame) -> DataFrame:
    """Canonical columns, keys, _seq and ``_destroyed`` of every candle."""
    rows = parsed.select(*KEYS, "chunk", F.posexplode("candles").alias("_row", "r"))
    named = rows.select(
        *KEYS, (F.col("chunk").cast("long") * ROW_STRIDE + F.col("_row")).alias(SEQ), F.timestamp_seconds(F.get("r", 0).cast("decimal(20,6)")).alias("ts"),
        *(F.get("r", i).alias(c) for i, c in enumerate(COLUMNS) if i),
    )
    return cast_strictly(named)


def chunk_report(parsed: DataFrame) -> DataFrame:
    """(symbol, resolution, chunk, from_date, to_date, status, rows, ok), one row a chunk."""
    return parsed.select(*KEYS, "chunk", "from_date", "to_date", "status", F.coalesce(F.size("candles"), F.lit(0)).cast("long").alias("rows"), (F.col("status") == "ok").alias("ok"))


def coverage(chunks: DataFrame) -> DataFrame:
    """Per dataset: chunks requested, failed and empty, rows received, and whether all came."""
    return chunks.groupBy(*KEYS).agg(
        F.count("*").alias("requested"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("ok") & (F.col("rows") == 0)).alias("empty"),
        F.sum("rows").cast("long").alias("received"), (F.count_if(~F.col("ok")) == 0).alias("complete"),
    )


def fetch(payloads: DataFrame, refused: str = "raise") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candles without exact duplicates, chunk report, coverage with rows removed and conflicting times).

    A malformed row stops the run, and so does an authentication error, unless refused is "record": then it is
    recorded as the other failed chunks are.
    """
    if refused not in ("raise", "record"):
        raise ValueError(f"refused is raise or record, not {refused!r}")
    parsed = with_status(payloads)
    seen = parsed.agg(F.min(F.when(F.col("status") == "auth", F.col("chunk"))).alias("auth"), F.min(F.when(bad_width(), F.col("chunk"))).alias("width")).first()
    if refused == "raise" and seen.auth is not None:
        raise AuthError(f"the vendor refused chunk {seen.auth} as unauthenticated")
    if seen.width is not None:
        raise SchemaError(f"chunk {seen.width} has a candle without six fields")
    rows = candles_of(parsed)
    if lost := rows.where(F.size("_destroyed") > 0).head(1):
        raise SchemaError(f"values present but not numeric in {lost[0]['_destroyed']} of {lost[0].symbol}")
    rows = rows.drop("_destroyed")
    kept = drop_exact_duplicate_rows(rows)
    after = kept.groupBy(*KEYS).agg(F.count("*").alias("rows"))
    about = coverage(chunk_report(parsed)).join(after, KEYS, "left").join(conflicting_timestamps(rows).withColumnRenamed("n", "conflicting"), KEYS, "left")
    about = about.withColumns({"rows": F.coalesce("rows", F.lit(0)), "conflicting": F.coalesce("conflicting", F.lit(0))})
    return kept, chunk_report(parsed), about.withColumn("removed", F.col("received") - F.col("rows"))


def earliest_available(candles: DataFrame, oldest: Column, window_days: int = 5) -> DataFrame:
    """Per dataset the first day of the earliest probe window that holds a candle (not the candle's own day)."""
    from wickwork.functions.times import ist_date

    first = candles.groupBy(*KEYS).agg(F.min(ist_date(F.col("ts"))).alias("first"))
    return first.select(*KEYS, F.greatest(oldest, F.date_sub("first", window_days - 1)).alias("earliest"))


def probe_earliest(has_data: Callable[[datetime.date, datetime.date], bool], newest: datetime.date, oldest: datetime.date, window_days: int = 5) -> datetime.date | None:
    """For one live dataset: bisect the days between oldest and newest by has_data(first day, last day); a VendorError counts as no data.

    wickwork.sources.probe does the same for many at once.
    """
    low, high, found, day = oldest, newest, None, datetime.timedelta(days=1)
    while low <= high:
        middle = low + ((high - low).days // 2) * day
        try:
            hit = bool(has_data(middle, min(middle + (window_days - 1) * day, newest)))
        except VendorError:
            hit = False
        if hit:
            found, high = middle, middle - day
        else:
            low = middle + day
    return found
