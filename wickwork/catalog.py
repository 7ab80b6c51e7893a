"""Registry of the candle queries: name -> function, and name -> the same in DuckDB SQL.

"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.functions import instruments, texts, times
from wickwork.operators import clean, sketches, validate
from wickwork.operators.asof import as_of
from wickwork.operators.intervals import missing_days
from wickwork.operators.rolling import exponential_mean, moving
from wickwork.operators.schema import COLUMNS, KEYS, PRICES, SEQ, cast_strictly, first_rows, normalise, resequenced
from wickwork.plans import store
from wickwork.plans.scratch import kept, shared_folder
from wickwork.sources import payloads, probe, tables
from wickwork.sources.tables import table
from wickwork.streaming.ordered import ordered_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

RULES = validate.Rules(sigma=3.0, session=(datetime.time(9, 15), datetime.time(15, 30)))
BOUNDED = validate.Rules(sigma=3.0, max_session_gap_days=0.02)

TICK = """
tick as (
  select event_type as symbol, '1' as resolution, event_id as seq, epoch_us(case when event_id % 109 = 0 then date_trunc('day', ts) else ts end) as us,
    value as open,
    case when event_id % 127 = 0 then 'inf'::double when event_id % 97 = 0 then least(value, c) - 0.05::double - 1 else greatest(value, c) + 0.05::double end as high,
    case when event_id % 101 = 0 then 0.0::double when event_id % 131 = 0 then least(value, c) + 0.02::double else least(value, c) - 0.05::double end as low,
    case when event_id % 103 <> 0 then c end as close,
    case when event_id % 107 = 0 then -1 when event_id % 113 <> 0 then event_id % 1000 end::bigint as volume
  from (select *, value + (event_id % 7 - 3) * 0.01::double as c from events)
)"""
CANDLES = TICK + """, hourly as (
  select event_type as symbol, '60' as resolution, h as seq, h * 3600000000 + case when max(day(ts)) >= 15 then 7776000000000 else 0 end as us,
    first(value order by us, event_id) as open, max(value) as high, min(value) as low, last(value order by us, event_id) as close, count(*) as volume
  from (select *, epoch_us(ts) as us, epoch_us(ts) // 3600000000 as h from events) group by event_type, h
), daily as (
  select o_orderpriority as symbol, '1D' as resolution, us // 86400000000 as seq, us,
    first(o_totalprice order by o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low, last(o_totalprice order by o_orderkey) as close, count(*) as volume
  from (select *, epoch_us(o_orderdate::timestamp) as us from orders) group by o_orderpriority, us
), candles as (
  select * from tick union all select * from hourly union all select * from daily
)"""
DOUBLED = TICK + """, doubled as (
  select * from tick union all
  select symbol, resolution, seq + 1000000000000, us, open, high, low, case when seq % 10 = 0 then close + 10 else close end, volume from tick where seq % 5 = 0
)"""
ORDERED = CANDLES + """, step as (
  select *, lag(us) over w as before, case when resolution <> '1D' then resolution::bigint * 60000000 end as step, lag(close) over w as c0,
    count(*) over (partition by symbol, resolution, us) as same, row_number() over (partition by symbol, resolution, us order by seq) as nth, count(*) over (partition by symbol, resolution) as n_rows
  from candles window w as (partition by symbol, resolution order by seq)
), moved as (
  select *, us - before as gap, (us + 19800000000) // 86400000000 = (before + 19800000000) // 86400000000 as same_day,
    case when c0 = 0 then case when close > 0 then 'inf'::double when close < 0 then '-inf'::double end else close / c0 - 1 end as r
  from step
), ordered as (
  select *, avg(case when not isinf(r) then r end) over k as mean, stddev_samp(case when not isinf(r) then r end) over k as dev, coalesce(max(abs(r)) over k = 'inf'::double, false) as endless
  from moved window k as (partition by symbol, resolution)
)"""
TIME_OF_DAY = "((us + 19800000000) % 86400000000)"
CONDITION = {
    "TS_NOT_SORTED": "gap < 0",
    "DUPLICATE_TIMESTAMPS": "same > 1 and nth = 1",
    "OHLC_HIGH_TOO_LOW": "high < greatest(open, close)",
    "OHLC_LOW_TOO_HIGH": "low > least(open, close)",
    "OHLC_HIGH_BELOW_LOW": "high < low",
    "NON_POSITIVE_PRICE": "least(open, high, low, close) <= 0",
    "NULL_PRICE": "(open is null or high is null or low is null or close is null)",
    "NON_FINITE_PRICE": "close is not null and greatest(abs(open), abs(high), abs(low), abs(close)) = 'inf'::double",
    "NULL_VOLUME": "volume is null",
    "NEGATIVE_VOLUME": "volume < 0",
    "TS_NOT_MINUTE_ALIGNED": "step is not null and us // 1000000 % 60 <> 0",
    "WITHIN_DAY_GAPS": "gap > step and same_day",
    "TRADING_CALENDAR_NOT_CONFIGURED": "gap > step and not same_day",
    "EXCESSIVE_DATA_GAP": "gap > step and not same_day and gap > 0.02 * 86400000000",
    "IMPLAUSIBLE_DATA_GAP": "gap > step and not same_day and gap > 30 * 86400000000",
    "OUTSIDE_SESSION_WINDOW": f"({TIME_OF_DAY} < 33300000000 or {TIME_OF_DAY} > 55800000000)",
    "EXTREME_RETURN": "n_rows > 30 and not endless and dev > 0 and abs((r - mean) / dev) > 3",
}
NUMBER = {code: i + 1 for i, code in enumerate(validate.SEVERITY)}


def _add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


def _us(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*KEYS, F.col(SEQ).alias("seq"), F.unix_micros("ts").alias("us"), *more)


# --- D: the validator -----------------------------------------------------------------------------
def _violations(code: str) -> Callable[[SparkSession, str], DataFrame]:
    rules = BOUNDED if code == "EXCESSIVE_DATA_GAP" else RULES
    return lambda spark, d: _us(validate.violations(tables.candles(spark, d), code, rules))


for _code, _where in CONDITION.items():
    _add(f"d{NUMBER[_code]:02d}_{_code.lower()}", _violations(_code), f"with {ORDERED} select symbol, resolution, seq, us from ordered where {_where}")

_counts = " union all ".join(f"select symbol, resolution, '{c}' as code, '{validate.SEVERITY[c]}' as severity from ordered where {w}" for c, w in CONDITION.items() if c != "EXCESSIVE_DATA_GAP")
_add(
    "d00_validation_issues",
    lambda spark, d: validate.issues(tables.candles(spark, d), RULES),
    f"with {ORDERED}, flagged as ({_counts}) select symbol, resolution, code, severity, count(*) as n from flagged group by all",
)


def _envelope(spark: SparkSession, d: str) -> DataFrame:
    e = validate.envelope(tables.candles(spark, d), RULES)
    return e.select(*KEYS, "row_count", times.iso(F.col("first_ts")).alias("first_ts"), times.iso(F.col("last_ts")).alias("last_ts"), "duplicate_rows", "missing_bars", F.round("largest_gap_days", 6).alias("largest_gap_days"))


_iso = lambda us: f"strftime(make_timestamp({us} + 19800000000), '%Y-%m-%dT%H:%M:%S') || case when ({us}) % 1000000 <> 0 then '.' || lpad((({us}) % 1000000)::varchar, 6, '0') else '' end || '+05:30'"
_add(
    "d00_report_envelope",
    _envelope,
    f"""with {ORDERED}, e as (
      select symbol, resolution, count(*) as row_count, arg_min(us, seq) as a, arg_max(us, seq) as b, count(*) filter (where same > 1) as duplicate_rows,
        coalesce(sum(round_even(gap / step - 1, 0)) filter (where gap > step and same_day), 0)::bigint as missing_bars,
        round(max(gap / 86400000000) filter (where gap > step and not same_day), 6) as largest_gap_days
      from ordered group by symbol, resolution
    ) select symbol, resolution, row_count, {_iso("a")} as first_ts, {_iso("b")} as last_ts, duplicate_rows, missing_bars, largest_gap_days from e""",
)
_add(
    "d00_issue_samples",
    lambda spark, d: validate.samples(tables.candles(spark, d), RULES).select(*KEYS, "code", F.array_join(F.transform("samples", lambda t: F.unix_micros(t).cast("string")), ",").alias("samples")),
    f"with {ORDERED}, flagged as ({_counts.replace('select symbol', 'select seq, us, symbol')}), first as (select *, row_number() over (partition by symbol, resolution, code order by seq) as k from flagged) "
    "select symbol, resolution, code, string_agg(us::varchar, ',' order by seq) as samples from first where k <= 5 group by symbol, resolution, code",
)
_add(
    "d00_issue_messages",
    lambda spark, d: validate.with_messages(validate.issues(tables.candles(spark, d), RULES), validate.envelope(tables.candles(spark, d), RULES)),
    f"""with {ORDERED}, flagged as ({_counts}), found as (select symbol, resolution, code, severity, count(*) as n from flagged group by all), e as (
      select symbol, resolution, count(*) filter (where same > 1) as rows_, max(gap / 86400000000) filter (where gap > step and not same_day) as days from ordered group by all
    ), texts as (select unnest({list(validate.MESSAGES)}) as code, unnest({list(validate.MESSAGES.values())!r}) as text)
    select symbol, resolution, code, severity, n, n || ' ' || replace(replace(text, '{{rows}}', rows_::varchar), '{{days}}', coalesce(round(days, 1)::decimal(18, 1)::varchar, '?')) as message
    from found join e using (symbol, resolution) join texts using (code)""",
)
_add(
    "d00_usable_datasets",
    lambda spark, d: validate.usable(validate.issues(tables.candles(spark, d), RULES)),
    f"with {ORDERED}, flagged as ({_counts}) select symbol, resolution, count(*) filter (where severity = 'ERROR') = 0 as usable from flagged group by all",
)
_add(
    "d01_schema_missing_columns",
    lambda spark, d: validate.issues(table(spark, d, "events").withColumnRenamed("event_type", "symbol")).select("symbol", "code", "n"),
    f"select distinct event_type as symbol, 'SCHEMA_MISSING_COLUMNS' as code, {5}::bigint as n from events",
)


def _requested(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "nation").select(F.col("n_name").alias("symbol"), F.lit("1").alias("resolution")).union(tables.tick(spark, d).select(*KEYS))
    return validate.issues(tables.candles(spark, d), RULES, requested=wanted).where("code = 'EMPTY_DATASET'").select(*KEYS, "code", "severity", "n")


_add("d02_empty_dataset", _requested, "select n_name as symbol, '1' as resolution, 'EMPTY_DATASET' as code, 'ERROR' as severity, 1::bigint as n from nation where n_name not in (select event_type from events)")


def _naive(spark: SparkSession, d: str) -> DataFrame:
    e = tables.tick(spark, d).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return validate.issues(e)


_add("d03_tz_naive", _naive, "select event_type as symbol, '1' as resolution, 'TZ_NAIVE' as code, 'ERROR' as severity, count(*) as n from events group by 1")
_add(
    "d04_tz_not_ist",
    lambda spark, d: validate.issues(tables.tick(spark, d).withMetadata("ts", {"source_zone": "UTC"})).where("code = 'TZ_NOT_IST'"),
    "select event_type as symbol, '1' as resolution, 'TZ_NOT_IST' as code, 'ERROR' as severity, count(*) as n from events group by 1",
)
_add(
    "d20_session_window_not_checked",
    lambda spark, d: validate.issues(tables.candles(spark, d), BOUNDED).where("code = 'SESSION_WINDOW_NOT_CHECKED'"),
    f"with {CANDLES} select distinct symbol, resolution, 'SESSION_WINDOW_NOT_CHECKED' as code, 'INFO' as severity, 1::bigint as n from candles",
)
_add(
    "f12_severity_histogram",
    lambda spark, d: validate.issues(tables.candles(spark, d), RULES).groupBy("severity").agg(F.count("*").alias("n")),
    f"with {ORDERED}, flagged as ({_counts}), i as (select distinct symbol, resolution, code, severity from flagged) select severity, count(*) as n from i group by 1",
)



# --- E, F: the ordered and row-wise primitives themselves -------------------------------------------
def _primitives(spark: SparkSession, d: str) -> DataFrame:
    o = validate.with_order(tables.candles(spark, d), validate.Rules(block=1000))
    z = F.when(~F.coalesce("_endless", F.lit(False)) & (F.col("_dev") > 0), F.round(instruments.z_score(F.col("_change"), F.col("_mean"), F.col("_dev")), 4))
    same_day = times.ist_day(F.col("ts")) == times.ist_day(F.col("_ts"))
    # Spark's round forgets the sign of what it rounds to zero
    change = F.when((F.col("_change") < 0) & (F.round("_change", 9) == 0), -0.0).otherwise(F.round("_change", 9))
    return _us(o.withColumns({"gap": F.col("_gap"), "same_day": same_day, "change": change, "z": z, "repeated": F.col("_same") > 1}), "gap", "same_day", "change", "z", "repeated")


_add(
    "e01_ordered_primitives",
    _primitives,
    f"with {ORDERED} select symbol, resolution, seq, us, gap, same_day, round(r, 9) as change, case when not endless and dev > 0 then round(abs((r - mean) / dev), 4) end as z, same > 1 as repeated from ordered",
)
_add(
    "e04_sorted_datasets",
    lambda spark, d: validate.with_order(tables.candles(spark, d), RULES).groupBy(*KEYS).agg((~F.coalesce(F.bool_or(F.col("_gap") < 0), F.lit(False))).alias("sorted")),
    f"with {ORDERED} select symbol, resolution, not coalesce(bool_or(gap < 0), false) as sorted from ordered group by all",
)
_add(
    "f04_row_extremes",
    lambda spark, d: _us(tables.candles(spark, d).withColumns(validate.row_extremes()), "top", "bottom", "missing"),
    f"with {CANDLES} select symbol, resolution, seq, us, greatest(open, close) as top, least(open, close) as bottom, open is null or high is null or low is null or close is null as missing from candles",
)

# --- A, C: payloads and chunks --------------------------------------------------------------------
STATUS = """answers as (
  select event_type as symbol, event_id // 500 as chunk, (event_id // 500) % 7 as kind, count(*) as n, min(ts::date) as from_date, max(ts::date) as to_date from events group by all
), parsed as (
  select *, case when kind in (0, 1, 6) then 'ok' when kind = 2 then 'rate_limit' when kind = 5 then 'auth' else 'data_error' end as status, case when kind in (0, 6) then n else 0 end as got from answers
)"""


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return payloads.with_status(tables.payloads(spark, d))


_add(
    "a03_chunk_report",
    lambda spark, d: payloads.chunk_report(_parsed(spark, d)).select("symbol", F.col("chunk").cast("long").alias("chunk"), F.date_format("from_date", "yyyy-MM-dd").alias("from_date"), "status", "rows", "ok"),
    f"with {STATUS} select symbol, chunk::bigint as chunk, from_date::varchar as from_date, status, got as rows, status = 'ok' as ok from parsed",
)
_add(
    "f11_coverage",
    lambda spark, d: payloads.coverage(payloads.chunk_report(_parsed(spark, d))).drop("resolution"),
    f"with {STATUS} select symbol, count(*) as requested, count(*) filter (where status <> 'ok') as failed, count(*) filter (where status = 'ok' and got = 0) as empty, sum(got)::bigint as received, count(*) filter (where status <> 'ok') = 0 as complete from parsed group by symbol",
)
_add(
    "a05_payload_candles",
    lambda spark, d: payloads.candles_of(_parsed(spark, d)).select("symbol", F.unix_micros("ts").alias("us"), *PRICES, "volume"),
    "select event_type as symbol, epoch_us(ts) // 1000000 * 1000000 as us, 10.0::double as open, 12.0::double as high, 9.0::double as low, 11.0::double as close, event_id as volume from events where event_id // 500 % 7 in (0, 6)",
)
_add(
    "a03_fetch_without_duplicates",
    lambda spark, d: payloads.fetch(tables.payloads(spark, d), refused="record")[2].select("symbol", "requested", "failed", "rows", "removed", "conflicting"),
    f"""with {STATUS}, rows_ as (select event_type as symbol, epoch_us(ts) // 1000000 as s, event_id from events where event_id // 500 % 7 in (0, 6)),
    d as (select symbol, count(*) as n from (select distinct * from rows_) group by 1), x as (select symbol, count(*) as n from (select symbol, s from (select distinct * from rows_) group by all having count(*) > 1) group by 1)
    select p.symbol, count(*) as requested, count(*) filter (where status <> 'ok') as failed, any_value(coalesce(d.n, 0)) as rows, (sum(got) - any_value(coalesce(d.n, 0)))::bigint as removed, any_value(coalesce(x.n, 0)) as conflicting
    from parsed p left join d using (symbol) left join x using (symbol) group by p.symbol""",
)


def _earliest(spark: SparkSession, d: str) -> DataFrame:
    e = payloads.earliest_available(tables.candles(spark, d), F.lit("1996-01-01").cast("date"))
    return e.select(*KEYS, F.date_format("earliest", "yyyy-MM-dd").alias("earliest"))


_add("a10_earliest_available", _earliest, f"with {CANDLES} select symbol, resolution, greatest(date '1996-01-01', min(make_timestamp(us + 19800000000)::date) - 4)::varchar as earliest from candles group by all")


def _probed(spark: SparkSession, d: str) -> DataFrame:
    """What bisecting the payloads' days finds, some of whose chunks failed, or empty; one request of two days a dataset and round."""
    answers = tables.payloads(spark, d)
    candles = payloads.candles_of(payloads.with_status(answers)).select(*KEYS, "ts")
    first, last = F.lit("2023-12-01").cast("date"), F.lit("2024-02-15").cast("date")
    wanted = answers.select(*KEYS).distinct().select(*KEYS, first.alias("oldest"), last.alias("newest"))
    return probe.earliest(wanted, probe.stored_answer(candles), 2).select(*KEYS, F.coalesce(F.date_format("earliest", "yyyy-MM-dd"), F.lit("")).alias("earliest"))


_add(
    "a10_probe_rounds",
    _probed,
    """with recursive held as (
      select distinct event_type as symbol, make_timestamp(epoch_us(ts) // 1000000 * 1000000 + 19800000000)::date as day from events where event_id // 500 % 7 in (0, 6)
    ), rounds as (
      select distinct event_type as symbol, date '2023-12-01' as low, date '2024-02-15' as high, null::date as earliest, 0 as k from events
      union all
      select symbol, case when hit then low else middle + 1 end, case when hit then middle - 1 else high end, case when hit then middle else earliest end, k + 1 from (
        select r.*, low + ((high - low) // 2)::int as middle, exists (select 1 from held h where h.symbol = r.symbol and h.day between r.low + ((r.high - r.low) // 2)::int and least(r.low + ((r.high - r.low) // 2)::int + 1, date '2024-02-15')) as hit
        from rounds r where low <= high
      )
    ) select symbol, '1' as resolution, arg_max(coalesce(earliest::varchar, ''), k) as earliest from rounds group by symbol""",
)


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    span = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("symbol")).agg(F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))
    both = span.withColumn("resolution", F.explode(F.array(F.lit("1"), F.lit("1D"))))
    return payloads.plan_chunks(both).select(*KEYS, F.col("chunk").cast("long").alias("chunk"), F.date_format("from_date", "yyyy-MM-dd").alias("from_date"), F.date_format("to_date", "yyyy-MM-dd").alias("to_date"))


_add(
    "c01_plan_chunks",
    _chunks,
    """with span as (select o_orderpriority as symbol, min(o_orderdate::date) as a, max(o_orderdate::date) as b from orders group by 1),
    r as (select * from span, (select '1' as resolution, 100 as days union all select '1D', 366)), c as (select *, unnest(range(0, (b - a) // days + 1)) as chunk from r)
    select symbol, resolution, chunk::bigint as chunk, (a + (chunk * days)::int)::varchar as from_date, least(a + (chunk * days + days - 1)::int, b)::varchar as to_date from c""",
)
_add(
    "c04_normalise",
    lambda spark, d: _us(resequenced(normalise(tables.candles(spark, d).withColumn("extra", F.lit(1)), ordered=False)), *PRICES, "volume"),
    f"with {CANDLES} select symbol, resolution, row_number() over (partition by symbol, resolution order by us nulls last, seq) - 1 as seq, us, open, high, low, close, volume from candles",
)


def _strict(spark: SparkSession, d: str) -> DataFrame:
    t = tables.tick(spark, d)
    word = F.when(F.col(SEQ) % 11 == 0, "bad").when(F.col(SEQ) % 13 == 0, "1.5d").when(F.col(SEQ) % 17 == 0, "")
    dirty = t.withColumns({"open": F.coalesce(word, F.col("open").cast("string")), "volume": F.when(F.col(SEQ) % 19 == 0, 10.5).otherwise(F.col("volume").cast("double"))})
    return cast_strictly(dirty).select("symbol", F.explode("_destroyed").alias("column")).groupBy("symbol", "column").agg(F.count("*").alias("n"))


_add(
    "c06_strict_casts",
    _strict,
    """select event_type as symbol, col as column, count(*) as n from (
      select event_type, 'open' as col from events where event_id % 11 = 0 or event_id % 13 = 0 or event_id % 17 = 0 union all select event_type, 'volume' from events where event_id % 19 = 0) group by all""",
)

# --- H, B: duplicates, cleaning, hashes, storage --------------------------------------------------
_add("h02_exact_duplicates", lambda spark, d: _us(clean.drop_exact_duplicate_rows(tables.doubled(spark, d)), "close"), f"with {DOUBLED} select symbol, resolution, min(seq) as seq, us, close from doubled group by symbol, resolution, us, open, high, low, close, volume")
_add("h03_conflicts", lambda spark, d: clean.conflicting_timestamps(tables.doubled(spark, d)), f"with {DOUBLED} select symbol, resolution, count(*) as n from (select symbol, resolution, us from (select distinct symbol, resolution, us, open, high, low, close, volume from doubled) group by all having count(*) > 1) group by all")
for _keep, _order in (("first", "seq"), ("last", "seq desc")):
    _add(
        f"h04_conflicts_keep_{_keep}",
        lambda spark, d, keep=_keep: _us(clean.drop_conflicting_duplicate_timestamps(tables.doubled(spark, d), keep), "close"),
        f"with {DOUBLED} select symbol, resolution, seq, us, close from doubled qualify row_number() over (partition by symbol, resolution, us order by {_order}) = 1",
    )
_add(
    "h04_conflicts_keep_none",
    lambda spark, d: _us(clean.drop_conflicting_duplicate_timestamps(tables.doubled(spark, d), False), "close"),
    f"with {DOUBLED} select symbol, resolution, seq, us, close from doubled qualify count(*) over (partition by symbol, resolution, us) = 1",
)
_add(
    "h06_codes_not_found",
    lambda spark, d: validate.codes_not_found(validate.issues(tables.candles(spark, d), RULES)),
    f"with {ORDERED}, flagged as ({_counts}) select unnest({list(validate.SEVERITY)}) as code except select code from flagged",
)
_add(
    "h08_sort_by_timestamp",
    lambda spark, d: _us(clean.clean(tables.doubled(spark, d), ["sort_by_timestamp"])[0], "close"),
    f"with {DOUBLED} select symbol, resolution, row_number() over (partition by symbol, resolution order by us, seq) - 1 as seq, us, close from doubled",
)
_add("h07_clean", lambda spark, d: _us(clean.clean(tables.doubled(spark, d), ["drop_exact_duplicate_rows", "drop_conflicting_duplicate_timestamps"])[0], "close"), SQL["h04_conflicts_keep_first"])


def _new_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/candles-{uuid.uuid4().hex}"


def _roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars stored through the gates and read back, with their manifests."""
    root = _new_root(spark)
    bars = tables.daily(spark, d)
    store.write(bars, root, source="orders", found=validate.issues(bars, validate.Rules(interval=None)), force=True)
    back = store._data(spark, root).groupBy(*KEYS).agg(F.count("*").alias("rows"), F.round(F.sum("close"), 2).alias("close_sum"))
    return back.join(store.manifests(spark, root), KEYS).select(*KEYS, "rows", "row_count", "close_sum", "validation_status", "fetch_status", "forced", "is_authoritative")


_add(
    "b01_store_roundtrip",
    _roundtrip,
    f"with {CANDLES} select symbol, resolution, count(*) as rows, count(*) as row_count, round(sum(close), 2) as close_sum, 'valid' as validation_status, 'unknown' as fetch_status, true as forced, false as is_authoritative from daily group by all",
)
_price = lambda c: f"coalesce(case when isinf({c}) then {c}::varchar else format('{{:.9e}}', {c}) end, '')"
_add(
    "b07_day_hashes",
    lambda spark, d: store.day_hashes(tables.candles(spark, d)),
    f"""with {CANDLES}, line as (
      select symbol, resolution, us, (us + 19800000000) // 86400000000 as day, concat_ws(',', us::varchar, {', '.join(map(_price, PRICES))}, coalesce(volume::varchar, '')) as line from candles
    ), days as (
      select symbol, resolution, day, sha256(string_agg(line, chr(10) order by us, line)) as h from line group by all
    ) select symbol, resolution, sha256(string_agg(h, '' order by day)) as hash from days group by all""",
)


def _manifests(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned and stored with all findings by force; what the manifests say of it."""
    rows, record = clean.clean(tables.candles(spark, d), ["drop_exact_duplicate_rows"])
    rows = kept(rows)  # they are read by each check and by the write
    out = store.write(rows, _new_root(spark), source="events", found=validate.issues(rows, RULES), cleaning=record, force=True)
    return out.select(
        *KEYS, "timezone", "row_count", "day_hash", "content_hash", "validation_status", F.array_join("validation_error_codes", ",").alias("codes"), F.size("failed_chunks").alias("failed_chunks"), "rows_before_cleaning", "rows_after_cleaning", "is_authoritative"
    )


_add(
    "b04_manifests",
    _manifests,
    SQL["b07_day_hashes"].replace(f"with {CANDLES}", f"with {ORDERED}").replace(
        "select symbol, resolution, sha256(string_agg(h, '' order by day)) as hash from days group by all",
        f"""select symbol, resolution, '{times.IST}' as timezone, any_value(c.n) as row_count, sha256(string_agg(h, '' order by day)) as day_hash, null::varchar as content_hash, any_value(case when e.codes is null then 'valid' else 'invalid' end) as validation_status,
      any_value(coalesce(e.codes, '')) as codes, 0 as failed_chunks, any_value(k.n) as rows_before_cleaning, any_value(k.n_distinct) as rows_after_cleaning, false as is_authoritative
      from days join (select symbol, resolution, count(*) as n from candles group by all) c using (symbol, resolution)
      cross join (select count(*) as n, count(distinct (symbol, resolution, us, open, high, low, close, volume)) as n_distinct from candles) k
      left join (select symbol, resolution, string_agg(distinct code, ',' order by code) as codes from ({_counts}) where severity = 'ERROR' group by all) e using (symbol, resolution) group by all""",
    ),
)


_add(
    "b07_exact_hashes",
    lambda spark, d: store.exact_hashes(tables.candles(spark, d)),
    f"""with {CANDLES}, line as (
      select symbol, resolution, us, seq, concat_ws(',', {_iso("us")}, {', '.join(map(lambda c: f"coalesce(case when isinf({c}) then {c}::varchar else format('{{:.10g}}', {c}) end, '')", PRICES))}, coalesce(volume::varchar, '')) || chr(10) as line from candles
    ) select symbol, resolution, sha256('{",".join(COLUMNS)}' || chr(10) || string_agg(line, '' order by us nulls last, seq)) as content_hash from line group by all""",
)


def _integrity(spark: SparkSession, d: str) -> DataFrame:
    """Everything is stored, then the daily bars again with other closes: each dataset's latest rows are checked, all in one job."""
    root, rows = _new_root(spark), tables.candles(spark, d)
    again = tables.daily(spark, d).withColumn("close", F.col("close") + 1)
    for some in map(kept, (rows, again)):
        store.write(some, root, source="tables", found=validate.issues(some, RULES), force=True)
    return store.verify_store(spark, root).join(store.manifests(spark, root).select(*KEYS, "row_count", "day_hash"), KEYS)


_add(
    "b08_store_integrity",
    _integrity,
    SQL["b07_day_hashes"].replace("coalesce(volume::varchar, '')) as line from candles", "coalesce(volume::varchar, '')) as line from (select * replace (case when resolution = '1D' then close + 1 else close end as close) from candles)").replace(
        "select symbol, resolution, sha256(string_agg(h, '' order by day)) as hash from days group by all",
        "select symbol, resolution, sha256(string_agg(h, '' order by day)) as day_hash, any_value(n) as row_count, true as unchanged from days join (select symbol, resolution, count(*) as n from candles group by all) using (symbol, resolution) group by all",
    ),
)


def _authority(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "invalid").otherwise("valid").alias("validation_status"),
        F.element_at(F.array(F.lit("complete"), F.lit("partial"), F.lit("unknown"), F.lit(None).cast("string")), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("fetch_status"), (F.col("o_orderkey") % 5 == 0).alias("forced"),
    )
    return o.select("o_orderkey", store.is_authoritative().alias("is_authoritative"))


_add("b05_authority", _authority, "select o_orderkey, o_orderkey % 3 <> 0 and o_orderkey % 4 = 0 and o_orderkey % 5 <> 0 as is_authoritative from orders")

# --- N: extensions beyond candles' own operators ------------------------------------------------------
def _as_of(spark: SparkSession, d: str) -> DataFrame:
    """Every event with the bar of an hour that was open when it came."""
    ticks = tables.tick(spark, d).select("symbol", SEQ, "ts", "close")
    met = as_of(ticks, tables.hourly(spark, d).select("symbol", "ts", "open", "close"), ["symbol"], prefix="bar_", tolerance_micros=6 * 3_600_000_000)
    return met.select("symbol", F.col(SEQ).alias("seq"), F.unix_micros("ts").alias("us"), F.unix_micros("bar_ts").alias("bar_us"), "bar_open", "bar_close")


_add(
    "n01_as_of_join",
    _as_of,
    f"""with {CANDLES} select t.symbol, t.seq, t.us, case when t.us - h.us <= 21600000000 then h.us end as bar_us, case when t.us - h.us <= 21600000000 then h.open end as bar_open, case when t.us - h.us <= 21600000000 then h.close end as bar_close
    from tick t asof left join hourly h on t.symbol = h.symbol and t.us >= h.us""",
)
_add(
    "n02_exponential_mean",
    lambda spark, d: exponential_mean(tables.hourly(spark, d), "close", 0.2, "mean", block=100).select("symbol", F.col(SEQ).alias("seq"), F.round("mean", 6).alias("mean")),
    f"""with {CANDLES}, x as (select symbol, seq, close, row_number() over (partition by symbol order by seq) - 1 as k from hourly)
    select a.symbol, a.seq, round(sum(b.close * pow(0.8::double, a.k - b.k) * case when b.k = 0 then 1 else 0.2::double end), 6) as mean from x a join x b on a.symbol = b.symbol and b.k <= a.k group by a.symbol, a.seq""",
)
_add(
    "n03_moving_windows",
    lambda spark, d: moving(resequenced(tables.tick(spark, d)), "open", 20, block=500).select("symbol", F.col(SEQ).alias("seq"), F.round("moving_mean", 6).alias("mean"), F.round("moving_std", 6).alias("std")),
    f"""with {TICK}, x as (select symbol, open, row_number() over (partition by symbol order by us nulls last, seq) - 1 as seq from tick)
    select symbol, seq, round(avg(open) over w, 6) as mean, round(stddev_samp(open) over w, 6) as std from x window w as (partition by symbol order by seq rows 19 preceding)""",
)


def _missing(spark: SparkSession, d: str) -> DataFrame:
    bars = tables.hourly(spark, d)
    wanted = bars.select(*KEYS).distinct().select(*KEYS, F.lit("2023-12-25").cast("date").alias("start"), F.lit("2024-06-30").cast("date").alias("end"))
    found = missing_days(wanted, bars)
    return found.select(*KEYS, F.date_format("from_date", "yyyy-MM-dd").alias("from_date"), F.date_format("to_date", "yyyy-MM-dd").alias("to_date"), "days")


_add(
    "n04_missing_days",
    _missing,
    f"""with {CANDLES}, gone as (
      select symbol, day::date as day from (select distinct symbol from hourly), unnest(range(timestamp '2023-12-25', timestamp '2024-07-01', interval 1 day)) t(day)
      where (symbol, day::date) not in (select symbol, make_timestamp(us + 19800000000)::date from hourly)
    ), runs as (select *, day - row_number() over (partition by symbol order by day)::int as run from gone)
    select symbol, '60' as resolution, min(day)::varchar as from_date, max(day)::varchar as to_date, count(*) as days from runs group by symbol, run""",
)

# --- G: order -------------------------------------------------------------------------------------
_add(
    "g02_first_five",
    lambda spark, d: _us(first_rows(tables.tick(spark, d), 5)),
    f"with {TICK} select symbol, resolution, seq, us from tick qualify row_number() over (partition by symbol, resolution order by us nulls last, seq) <= 5",
)



def _sketched(spark: SparkSession, d: str) -> DataFrame:
    """Each dataset's returns as a sketch merged from days: how many, and whether its quartiles have the ranks they should, by counting."""
    rows = tables.hourly(spark, d)
    about = sketches.summary(sketches.merged(sketches.day_sketches(rows)))
    c = validate.with_order(rows, validate.Rules()).where("_change is not null").select(*KEYS, F.col("_change").alias("c"))
    near = lambda q, p: F.abs(F.avg((F.col("c") <= F.col(q)).cast("double")) - p) <= sketches.RANK_ERROR + 2 / F.count("*")
    met = c.join(about, KEYS).groupBy(*KEYS, "rows", "n_returns", "n_times").agg((near("q1", 0.25) & near("median", 0.5) & near("q3", 0.75)).alias("ranks_hold"))
    return met.select(*KEYS, "rows", "n_returns", (F.abs(F.col("n_times") / F.col("rows") - 1) <= sketches.TIMES_ERROR).alias("times_hold"), "ranks_hold")


_add("n05_sketches", _sketched, f"with {CANDLES} select symbol, resolution, count(*) as rows, count(*) - 1 as n_returns, true as times_hold, true as ranks_hold from hourly group by all")



def _streamed(spark: SparkSession, d: str) -> DataFrame:
    """The ordered checks of the events as two runs of a stream with state: what they tell together is what the batch checks tell."""
    root, name = _new_root(spark), "spark.sql.streaming.stateStore.providerClass"
    rows, before = tables.tick(spark, d), spark.conf.get(name)
    middle = rows.agg(F.floor(F.avg(SEQ))).first()[0]
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for part in (F.col(SEQ) <= middle, F.col(SEQ) > middle):
            rows.where(part).write.mode("append").parquet(f"{root}/in")
            # lateness spans the table, so that no row is too late to be compared
            told = ordered_stream(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), "400 days")
            told.writeStream.format("parquet").option("checkpointLocation", f"{root}/at").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    finally:
        spark.conf.set(name, before)
    return spark.read.schema("symbol string, resolution string, seq long, us long, code string").parquet(f"{root}/out")


_add(
    "n06_ordered_stream",
    _streamed,
    f"with {ORDERED} " + " union all ".join(f"select symbol, resolution, seq, us, '{c}' as code from ordered where resolution = '1' and {CONDITION[c]}" for c in ("TS_NOT_SORTED", "DUPLICATE_TIMESTAMPS", "WITHIN_DAY_GAPS")),
)

# --- I: scalar functions --------------------------------------------------------------------------
_add("it01_epoch_to_ist", lambda spark, d: table(spark, d, "events").select("event_id", times.iso(times.epoch_to_instant(times.ntz_micros(F.col("ts")) / 1_000_000)).alias("t")).select("event_id", F.substring("t", 1, 19).alias("t")), "select event_id, strftime(make_timestamp(epoch_us(ts) + 19800000000), '%Y-%m-%dT%H:%M:%S') as t from events")
_add("c10_iso_times", lambda spark, d: tables.tick(spark, d).select(F.col(SEQ).alias("seq"), times.iso(F.col("ts")).alias("t")), f"with {TICK} select seq, {_iso('us')} as t from tick")
_add(
    "it08_time_parts",
    lambda spark, d: tables.tick(spark, d).select(F.col(SEQ).alias("seq"), F.date_format(times.ist_date(F.col("ts")), "yyyy-MM-dd").alias("day"), times.ist_second(F.col("ts")).cast("long").alias("second"), times.ist_time_micros(F.col("ts")).alias("of_day")),
    f"with {TICK} select seq, make_timestamp(us + 19800000000)::date::varchar as day, us // 1000000 % 60 as second, {TIME_OF_DAY} as of_day from tick",
)
_add("it07_resolution_minutes", lambda spark, d: tables.candles(spark, d).groupBy("resolution").agg(F.count("*").alias("n")).select("resolution", "n", times.resolution_minutes(F.col("resolution")).cast("long").alias("minutes")), f"with {CANDLES} select resolution, count(*) as n, case when resolution <> '1D' then resolution::bigint end as minutes from candles group by 1")
_add("it10_midpoints", lambda spark, d: table(spark, d, "orders").select("o_orderkey", F.date_format(times.midpoint(F.lit("1995-01-01").cast("date"), F.to_date("o_orderdate")), "yyyy-MM-dd").alias("middle")), "select o_orderkey, (date '1995-01-01' + ((o_orderdate::date - date '1995-01-01') // 2)::int)::varchar as middle from orders")
_add("it09_parse_dates", lambda spark, d: table(spark, d, "orders").select("o_orderkey", F.date_format(times.parse_date(F.when(F.col("o_orderkey") % 4 == 0, "2026-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))), "yyyy-MM-dd").alias("day")), "select o_orderkey, case when o_orderkey % 4 <> 0 then o_orderdate::date::varchar end as day from orders")
_add("im01_round_to_tick", lambda spark, d: table(spark, d, "part").select("p_partkey", instruments.round_to_tick(F.col("p_retailprice") + 0.017, F.when(F.col("p_partkey") % 5 != 0, 0.05)).alias("price")), "select p_partkey, case when p_partkey % 5 <> 0 then round_even(round_even((p_retailprice + 0.017::double) / 0.05::double, 0)::double * 0.05::double, 10)::double else p_retailprice + 0.017::double end as price from part")
_add("im02_lots", lambda spark, d: table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", instruments.lots_for_quantity(F.col("l_quantity") - 25, F.lit(7)).alias("lots")), "select l_orderkey, l_linenumber, floor((l_quantity - 25) / 7)::bigint as lots from lineitem")


def _roles(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("symbol"), F.element_at(F.array(*map(F.lit, ("SIGNAL", "EXECUTION", "SIGNAL_AND_EXECUTION"))), (F.col("p_partkey") % 3 + 1).cast("int")).alias("role"),
        F.when(F.col("p_size") > 40, "INDEX").otherwise("FUTURE").alias("kind"), (F.col("p_size") - 1).alias("lot_size"), (F.col("p_retailprice") - 950).alias("tick_size"),
    )
    return p.join(instruments.violations(p), "symbol").select("symbol", "broken", instruments.is_tradable(F.col("role")).alias("tradable"), instruments.can_generate_signals(F.col("role")).alias("signals"))


_add(
    "im05_roles_and_invariants",
    _roles,
    """with p as (select p_partkey::varchar as symbol, p_partkey % 3 as r, p_size > 40 as idx, p_size - 1 as lot, p_retailprice - 950 as tick from part),
    b as (select *, 'lot_size' as broken from p where lot < 1 union all select *, 'tick_size' from p where tick <= 0 union all select *, 'index_role' from p where idx and r <> 0)
    select symbol, broken, r > 0 as tradable, r <> 1 as signals from b""",
)
_add("is01_safe_symbols", lambda spark, d: table(spark, d, "pages").select("page_id", texts.safe_symbol(F.col("url")).alias("name")), "select page_id, translate(url, ':/', '__') as name from pages")
_add("is02_vendor_status", lambda spark, d: _parsed(spark, d).select("symbol", F.col("chunk").cast("long").alias("chunk"), "status"), f"with {STATUS} select symbol, chunk::bigint as chunk, status from parsed")
_secret = lambda concat, word, text, sha: concat("Auth_Code=", word, "&ACCESS_TOKEN=", word, "'&secret_key=k\"", ' appIdHash": "', sha, '" a literal-secret and ', text)


def _scrubbed(spark: SparkSession, d: str) -> DataFrame:
    """Each of the four patterns and a known secret, around real texts."""
    text = _secret(lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)), F.substring_index("text", " ", 1), F.col("text"), F.sha2("text", 256))
    return table(spark, d, "conversations").select("conv_id", "turn", texts.sha256_hex(texts.scrub(text, ("literal-secret", "short"))).alias("clean"))


def _scrub_sql() -> str:
    marks = {"word": "string_split(text, ' ')[1]", "text": "text", "sha": "sha256(text)"}
    text = _secret(lambda *parts: " || ".join(marks[p[1:]] if p[:1] == "@" else "'" + p.replace("'", "''") + "'" for p in parts), "@word", "@text", "@sha")
    out = f"replace({text}, 'literal-secret', '{texts.REDACTED}')"
    for pattern in texts.SECRET_PATTERNS:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '\\1{texts.REDACTED}', 'g')"
    return f"select conv_id, turn, sha256({out}) as clean from conversations"


_add("is04_scrub", _scrubbed, _scrub_sql())


def _codes(spark: SparkSession, d: str) -> DataFrame:
    name = F.element_at(F.array(F.lit("auth_code"), F.lit("authcode"), F.lit("code"), F.lit("other")), (F.col("page_id") % 4 + 1).cast("int"))
    url = F.concat(F.substring_index("url", "#", 1), F.lit("?x=1&"), name, F.lit("=a%20b"), F.col("page_id").cast("string"), F.lit("&state=s"))
    return table(spark, d, "pages").select("page_id", texts.auth_code(url).alias("code"))


_add("is06_auth_codes", _codes, "select page_id, case when page_id % 4 < 3 then 'a b' || page_id::varchar end as code from pages")
_add("is10_sha256", lambda spark, d: table(spark, d, "part").select("p_partkey", texts.sha256_hex(F.col("p_name")).alias("h")), "select p_partkey, sha256(p_name) as h from part")

