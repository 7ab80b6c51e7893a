"""Operators on hand-made candles: one defect for each code, normalising, cleaning, payloads, storage."""

from __future__ import annotations

import datetime
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wickwork.functions import instruments, texts, times
from wickwork.operators import clean, schema, validate
from wickwork.plans import pipeline, store
from wickwork.sources import payloads, provider

DDL = "symbol string, resolution string, _seq long, us long, open double, high double, low double, close double, volume long"
NINE_FIFTEEN = 1_767_239_100  # 2026-01-01 09:15 in India


def bars(spark, n=40, change=None, starts=(NINE_FIFTEEN,), resolution="1", step=60):
    rows, price, seq = [], 24000.0, 0
    for start in starts:
        for i in range(n):
            close = price + (i % 5 - 2)
            rows.append(["X", resolution, seq, (start + step * i) * 1_000_000, price, max(price, close) + 1, min(price, close) - 1, close, 100 + i])
            price, seq = close, seq + 1
    if change:
        rows = change(rows) or rows
    return spark.createDataFrame([tuple(r) for r in rows], DDL).select("symbol", "resolution", "_seq", F.timestamp_micros("us").alias("ts"), "open", "high", "low", "close", "volume")


def found(df, **rules):
    return {r.code: (r.severity, r.n) for r in validate.issues(df, validate.Rules(**rules)).collect()}


def put(row, column, value):
    index = DDL.replace(",", "").split()[::2].index(column)

    def change(rows):
        rows[row][index] = value

    return change


def test_good_bars_are_usable(spark):
    assert found(bars(spark)) == {"SESSION_WINDOW_NOT_CHECKED": ("INFO", 1)}


@pytest.mark.parametrize(
    ("column", "value", "code"),
    [
        ("high", 1.0, "OHLC_HIGH_TOO_LOW"), ("low", 1e9, "OHLC_LOW_TOO_HIGH"), ("high", 5.0, "OHLC_HIGH_BELOW_LOW"), ("low", 0.0, "NON_POSITIVE_PRICE"), ("low", -5.0, "NON_POSITIVE_PRICE"),
        ("close", None, "NULL_PRICE"), ("close", math.nan, "NULL_PRICE"), ("high", math.inf, "NON_FINITE_PRICE"), ("low", -math.inf, "NON_FINITE_PRICE"), ("volume", -1, "NEGATIVE_VOLUME"), ("volume", None, "NULL_VOLUME"),
    ],
)
def test_value_defects(spark, column, value, code):
    out = found(bars(spark, change=put(7, column, value)))
    assert out[code] == ("ERROR", 1)
    assert (code != "NULL_PRICE") or "NON_FINITE_PRICE" not in out


def test_order_defects(spark):
    def swap(rows):
        rows[3][3], rows[4][3] = rows[4][3], rows[3][3]

    assert found(bars(spark, change=swap))["TS_NOT_SORTED"] == ("ERROR", 1)
    assert found(bars(spark, change=lambda r: r + [[*r[5][:2], 99, *r[5][3:]]]))["DUPLICATE_TIMESTAMPS"] == ("ERROR", 1)
    assert found(bars(spark, change=lambda r: r[:10] + r[12:]))["WITHIN_DAY_GAPS"] == ("WARNING", 1)
    assert "WITHIN_DAY_GAPS" not in found(bars(spark, change=lambda r: r[:10] + r[12:]), interval=None)
    assert found(bars(spark, starts=(NINE_FIFTEEN + 17,)))["TS_NOT_MINUTE_ALIGNED"] == ("WARNING", 40)
    assert validate.envelope(bars(spark, change=lambda r: r[:10] + r[12:])).first().missing_bars == 2


def test_gaps_between_days(spark):
    day = 86400
    one = found(bars(spark, 10, starts=(NINE_FIFTEEN, NINE_FIFTEEN + day)))
    assert one["TRADING_CALENDAR_NOT_CONFIGURED"][0] == "WARNING" and "IMPLAUSIBLE_DATA_GAP" not in one
    assert found(bars(spark, 10, starts=(NINE_FIFTEEN, NINE_FIFTEEN + 120 * day)))["IMPLAUSIBLE_DATA_GAP"][0] == "ERROR"
    week = found(bars(spark, 10, starts=(NINE_FIFTEEN, NINE_FIFTEEN + 7 * day)), max_session_gap_days=4)
    assert week["EXCESSIVE_DATA_GAP"][0] == "ERROR" and "TRADING_CALENDAR_NOT_CONFIGURED" not in week
    assert "EXCESSIVE_DATA_GAP" not in found(bars(spark, 10, starts=(NINE_FIFTEEN, NINE_FIFTEEN + 3 * day)), max_session_gap_days=4)
    assert "IMPLAUSIBLE_DATA_GAP" not in found(bars(spark, 10, starts=(NINE_FIFTEEN, NINE_FIFTEEN + 120 * day), resolution="1D", step=day))


def test_session_and_returns(spark):
    window = (datetime.time(9, 15), datetime.time(15, 40))
    assert not found(bars(spark), session=window)
    assert found(bars(spark, 30, starts=(NINE_FIFTEEN + 380 * 60,)), session=window)["OUTSIDE_SESSION_WINDOW"] == ("WARNING", 24)

    def jump(rows):
        rows[100][7] *= 3
        rows[100][5] = rows[100][7] + 1

    assert found(bars(spark, 200, change=jump))["EXTREME_RETURN"][0] == "WARNING"

    def endless(rows):
        jump(rows)
        rows[50][7] = 0.0

    assert "EXTREME_RETURN" not in found(bars(spark, 200, change=endless))


def test_blocks_change_nothing(spark):
    from tests.conftest import SMALL
    from wickwork.sources import tables

    df, sort = tables.candles(spark, SMALL), lambda d: sorted(map(tuple, d.collect()), key=repr)
    largest, datasets = validate._shape(df)
    assert largest > 100 and datasets == df.select("symbol", "resolution").distinct().count()
    for block in (7, 100):
        rules = validate.Rules(sigma=3.0, block=None)
        assert sort(validate.issues(df, validate.Rules(sigma=3.0, block=block))) == sort(validate.issues(df, rules))
        assert sort(validate.samples(df, validate.Rules(sigma=3.0, block=block))) == sort(validate.samples(df, rules))


def test_samples_are_bounded(spark):
    def low(rows):
        for r in rows:
            r[6] = r[4] + 5

    df = bars(spark, 200, change=low)
    assert found(df)["OHLC_LOW_TOO_HIGH"][1] == 200
    assert len(validate.samples(df).where("code = 'OHLC_LOW_TOO_HIGH'").first().samples) == 5
    assert "OHLC_LOW_TOO_HIGH: 200 lows are above open or close" in validate.report_text(validate.issues(df), validate.envelope(df))


def test_structural_codes(spark):
    df = bars(spark)
    assert set(found(df.drop("volume"))) == {"SCHEMA_MISSING_COLUMNS"}
    assert set(found(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")))) == {"TZ_NAIVE"}
    assert found(df, source_zone="UTC")["TZ_NOT_IST"] == ("ERROR", 40)
    wanted = spark.createDataFrame([("Y", "1")], "symbol string, resolution string")
    assert {r.code for r in validate.issues(df, requested=wanted).collect()} == {"EMPTY_DATASET", "SESSION_WINDOW_NOT_CHECKED"}


def test_normalise(spark):
    df = bars(spark).withColumn("extra", F.lit(1))
    out = schema.normalise(df.orderBy(F.rand(3)))
    assert out.columns == ["symbol", "resolution", "_seq", *schema.COLUMNS] and [r._seq for r in out.collect()] == list(range(40))
    schema.assert_canonical(out)
    with pytest.raises(schema.SchemaError, match="volume"):
        schema.normalise(df.drop("volume"))
    with pytest.raises(schema.SchemaError, match="instant"):
        schema.normalise(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    for bad in ("bad", "N/A", "1.5d", ""):
        with pytest.raises(schema.SchemaError, match="open"):
            schema.normalise(df.withColumn("open", F.when(F.col("_seq") == 3, bad).otherwise(F.col("open").cast("string"))))
    with pytest.raises(schema.SchemaError, match="volume"):
        schema.normalise(df.withColumn("volume", F.lit(10.5)))
    kept = schema.normalise(df.withColumn("close", F.lit(math.nan)).withColumn("volume", F.lit(None).cast("long"))).first()
    assert kept.close is None and kept.volume is None
    assert schema.empty_candles(spark).schema == schema.CANONICAL


def test_cleaning(spark):
    def twice(rows):
        return rows + [[*rows[5][:2], 50, *rows[5][3:]], [*rows[6][:2], 51, *rows[6][3:7], rows[6][7] + 10, rows[6][8]]]

    df = bars(spark, change=twice)
    same, record = clean.clean(df)
    assert same.count() == 42 and record.to_dict()["rows_removed"] == 0
    assert clean.clean(df, ["drop_exact_duplicate_rows"])[1].to_dict() == {"operations": ["drop_exact_duplicate_rows"], "rows_before": 42, "rows_after": 41, "rows_removed": 1}
    assert clean.conflicting_timestamps(df).first().n == 1
    for keep, left in (("first", 40), ("last", 40), (False, 38)):
        assert clean.drop_conflicting_duplicate_timestamps(df, keep).count() == left
    with pytest.raises(ValueError, match="unknown"):
        clean.clean(df, ["fill_gaps"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([1.0, 2.0, None])), min_size=1, max_size=12))
def test_exact_dedup_keeps_one_of_each(spark, values):
    rows = [("X", "1", i, t * 60_000_000, 1.0, 2.0, 0.5, c, 1) for i, (t, c) in enumerate(values)]
    df = spark.createDataFrame(rows, DDL).withColumn("ts", F.timestamp_micros("us")).drop("us")
    out = clean.drop_exact_duplicate_rows(df).collect()
    assert len(out) == len(set(values)) and {(r._seq) for r in out} == {min(i for i, w in enumerate(values) if w == v) for v in set(values)}


def answer(n, base=NINE_FIFTEEN, close=None):
    return json.dumps({"s": "ok", "candles": [[base + 60 * i, 24000 + i, 24005 + i, 23995 + i, close if close and i == 1 else 24001 + i, 1000 + i] for i in range(n)]})


def answers(spark, texts_):
    day = datetime.date(2026, 1, 1)
    return spark.createDataFrame([("X", "1", i, day, day, t) for i, t in enumerate(texts_)], provider.SCHEMA)


def test_payloads(spark):
    rows, chunks, about = payloads.fetch(answers(spark, [answer(5)] * 4))
    assert (rows.count(), about.first().removed, about.first().conflicting) == (5, 15, 0)
    assert times.iso(F.col("ts")) is not None and rows.select(F.min(times.iso(F.col("ts")))).first()[0] == "2026-01-01T09:15:00+05:30"
    a, b = answer(3), answer(3, close=99999.0)
    assert payloads.fetch(answers(spark, [a, b, a, b]))[2].first().conflicting == 1
    got = payloads.fetch(answers(spark, [answer(2), '{"s":"error","code":-99,"message":"x"}', '{"s":"ok","candles":[]}', '{"s":"ok"}', "[1]", '{"s":"error","message":"corporate"}']))
    assert [r.status for r in got[1].orderBy("chunk").collect()] == ["ok", "data_error", "ok", "data_error", "data_error", "rate_limit"]
    assert (got[2].first().failed, got[2].first().empty, got[2].first().complete) == (4, 1, False)
    with pytest.raises(payloads.AuthError):
        payloads.fetch(answers(spark, [answer(2), '{"s":"error","code":-16,"message":"Invalid"}']))
    about = payloads.fetch(answers(spark, [answer(2), '{"s":"error","code":-16,"message":"Invalid"}']), refused="record")[2].first()
    assert (about.requested, about.failed, about.rows) == (2, 1, 2)
    with pytest.raises(schema.SchemaError, match="six"):
        payloads.fetch(answers(spark, ['{"s":"ok","candles":[[1,2,3,4]]}']))
    with pytest.raises(schema.SchemaError, match="numeric"):
        payloads.fetch(answers(spark, ['{"s":"ok","candles":[[1767239100,"bad",3,4,5,6]]}']))


@pytest.mark.parametrize(("resolution", "end", "n"), [("1", "2026-12-31", 4), ("1", "2026-01-05", 1), ("1D", "2026-12-31", 1)])
def test_chunk_plans(spark, resolution, end, n):
    r = spark.createDataFrame([("X", resolution, datetime.date(2026, 1, 1), datetime.date.fromisoformat(end))], "symbol string, resolution string, start date, end date")
    chunks = payloads.plan_chunks(r).orderBy("chunk").collect()
    assert len(chunks) == n and chunks[-1].to_date.isoformat() == end
    assert all(b.from_date - a.to_date == datetime.timedelta(days=1) for a, b in zip(chunks, chunks[1:]))


def test_provider_reads_a_partition_a_chunk(spark):
    def fetch(symbol, resolution, a, b):
        return json.dumps({"s": "ok", "candles": [[1767239100 + a.toordinal() * 60, 1, 2, 0.5, 1, (b - a).days]]})

    source = provider.provider("fake_vendor", fetch)
    got = provider.read_payloads(spark, source, symbol="X", resolution="1", start="2026-01-01", end="2026-12-31")
    assert got.count() == 4 and payloads.fetch(got)[0].count() == 4
    with pytest.raises(Exception, match="end is before start"):
        provider.read_payloads(spark, source, symbol="X", resolution="1", start="2026-02-01", end="2026-01-01").count()


def test_probes(spark):
    day = datetime.date
    for first in (day(2026, 1, 1), day(2026, 3, 17), day(2026, 6, 29)):
        assert payloads.probe_earliest(lambda a, b, f=first: b >= f, day(2026, 6, 30), day(2025, 1, 1)) == max(first - datetime.timedelta(days=4), day(2025, 1, 1))
    assert payloads.probe_earliest(lambda a, b: False, day(2026, 6, 30), day(2025, 1, 1)) is None
    assert payloads.earliest_available(bars(spark), F.lit("2020-01-01").cast("date")).first().earliest == day(2025, 12, 28)


def test_store(spark, tmp_path):
    root = str(tmp_path / "store")
    df = bars(spark)
    bad = bars(spark, change=put(1, "low", 0.0))
    with pytest.raises(store.UnvalidatedDataError):
        store.write(bad, root, source="t", found=validate.issues(bad))
    part = spark.createDataFrame([("X", "1", 4, 1)], "symbol string, resolution string, requested long, failed long")
    with pytest.raises(store.IncompleteAcquisitionError):
        store.write(df, root, source="t", found=validate.issues(df), coverage=part)
    assert not (tmp_path / "store").exists()
    with pytest.raises(FileNotFoundError):
        store.read(spark, root, "X", "1")
    whole = spark.createDataFrame([("X", "1", 4, 0)], "symbol string, resolution string, requested long, failed long")
    for coverage, force, wanted in ((whole, False, True), (None, False, False), (whole, True, False)):
        m = store.write(df, root, source="t", found=validate.issues(df), coverage=coverage, force=force).first()
        assert m.is_authoritative is wanted
    back, manifest = store.read(spark, root, "X", "1")
    assert back.count() == 40 and manifest["row_count"] == 40 and manifest["is_authoritative"] is False
    assert store.verify_integrity(spark, root, "X", "1") and store.revalidate(spark, root, "X", "1") == 0 and store.revalidate(spark, root, "X", "5") == 2
    assert json.loads(store.manifest_json(manifest))["source"] == "t" and manifest["content_hash"] is None and manifest["failed_chunks"] == []
    assert store.write(df, root, source="t", found=validate.issues(df), force=True, exact=True).first().content_hash == store.content_hash(df) and store.verify_integrity(spark, root, "X", "1", exact=True)
    import pyarrow.parquet as pq

    assert all(str(pq.read_schema(p).field("ts").type).startswith("timestamp[us") for p in (tmp_path / "store/data").rglob("*.parquet"))
    df.withColumn("close", F.col("close") + 0.5).drop("_seq").write.mode("overwrite").partitionBy("symbol", "resolution").parquet(f"{root}/data/snapshot={store.snapshots(spark, root)[-1]}")
    assert not store.verify_integrity(spark, root, "X", "1")


def test_hashes(spark):
    df, other = bars(spark), bars(spark, change=put(5, "close", 24000.0001))
    assert store.content_hash(df) == store.content_hash(df.orderBy(F.rand(1))) != store.content_hash(other)
    assert store.day_hashes(df).first().hash != store.day_hashes(other).first().hash


def test_pipeline(spark, tmp_path):
    out = pipeline.download(answers(spark, [answer(5)] * 2), str(tmp_path / "a"), source="fake", operations=["drop_exact_duplicate_rows"])
    assert out.refusal is None and pipeline.exit_code(out) == 0 and "stored" in out.summary()
    out = pipeline.download(answers(spark, [answer(5), '{"s":"error","code":429,"message":"rate limit"}']), str(tmp_path / "b"), source="fake")
    assert "failed chunks" in out.refusal and pipeline.exit_code(out) == 1
    forced = pipeline.download(answers(spark, [answer(5), '{"s":"error","code":429,"message":"rate limit"}']), str(tmp_path / "b"), source="fake", operations=["sort_by_timestamp"], force=True).manifests.first()
    assert len(forced.failed_chunks) == 1 and forced.failed_chunks[0].status != "ok" and (forced.rows_before_cleaning, forced.rows_after_cleaning) == (5, 5) and forced.cleaning == ["sort_by_timestamp"]
    assert pipeline.download(answers(spark, ['{"s":"ok","candles":[]}']), str(tmp_path / "c"), source="fake").refusal == "refused: no rows"


def test_scalars(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first().v
    assert value(instruments.round_to_tick(F.lit(280.117), F.lit(0.01))) == 280.12
    assert value(instruments.lots_for_quantity(F.lit(-7), F.lit(2))) == -4
    assert value(times.iso(times.epoch_to_instant(F.lit(NINE_FIFTEEN)))) == "2026-01-01T09:15:00+05:30"
    assert value(times.iso(F.timestamp_micros(F.lit(NINE_FIFTEEN * 1_000_000 + 5)))) == "2026-01-01T09:15:00.000005+05:30"
    assert value(texts.auth_code(F.lit("https://x/?code=c&auth_code=a%20b"))) == "a b" and value(texts.auth_code(F.lit("https://x/?auth_code=&code=z"))) == "z"
    assert value(texts.scrub(F.lit('access_token=abc&x=1 and "secret-literal"'), ("secret-literal", "short"))) == f'access_token={texts.REDACTED}&x=1 and "{texts.REDACTED}"'
    assert value(texts.safe_symbol(F.lit("NSE:A/B"))) == "NSE_A_B" and value(texts.trading_mode(F.lit(" Paper "))) == "paper"
    assert len(value(texts.run_id())) == 12
    for refused in (texts.trading_mode(F.lit("live")), instruments.require_tradable(F.lit("SIGNAL"), F.lit(1))):
        with pytest.raises(Exception, match="refused|not tradable"):
            value(refused)
    with pytest.raises(times.NaiveTimestampError):
        times.require_instant(spark.range(1).select(F.lit("2026-01-01").cast("timestamp_ntz").alias("t")).schema["t"].dataType)


def test_registry(spark, tmp_path):
    pytest.importorskip("yaml")
    p = tmp_path / "i.yaml"
    p.write_text("signal_instruments:\n  - {symbol: 'NSE:I', name: Index, kind: INDEX, role: SIGNAL}\nexecution_candidates:\n  - {symbol: null, name: F, kind: FUTURE, role: EXECUTION, lot_size: null, verified: false}\n")
    signals, candidates = instruments.load_registry(spark, str(p))
    assert instruments.signal(signals, "NSE:I").count() == 1 and candidates.first().lot_size == 1 and not instruments.violations(signals).count()
    for broken in (lambda: instruments.signal(signals, "Z"), lambda: instruments.selected_execution_instrument(candidates), lambda: instruments.require_verified(candidates, "Z")):
        with pytest.raises(instruments.RegistryError):
            broken()


def test_stream(spark, tmp_path):
    from wickwork.streaming.checks import issue_counts

    source = str(tmp_path / "in")
    df = bars(spark, change=put(7, "low", 0.0))
    df.union(df).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    q = issue_counts(stream).writeStream.format("memory").queryName("stream_issues").outputMode("complete").start()
    try:
        q.processAllAvailable()
        assert {(r.code, r.n) for r in spark.table("stream_issues").collect()} == {("NON_POSITIVE_PRICE", 1)}
    finally:
        q.stop()


def test_sorting_keeps_ties(spark):
    df = bars(spark)
    back = df.withColumn("_seq", 100 - F.col("_seq"))
    rows, record = clean.clean(back.union(back.withColumn("_seq", F.col("_seq") + 500).withColumn("close", F.lit(1.0))), ["sort_by_timestamp"])
    got = rows.orderBy("_seq").collect()
    assert [r._seq for r in got] == list(range(80)) and [r.ts for r in got] == sorted(r.ts for r in got) and all(r.close == 1.0 for r in got[1::2]) and record.to_dict()["rows_removed"] == 0


def test_reports_as_values(spark):
    df = bars(spark, change=put(3, "low", 99999.0))
    report = validate.to_dict(validate.report_rows(validate.issues(df), validate.envelope(df), validate.samples(df)))["X", "1"]
    assert report["usable"] is False and report["row_count"] == 40
    found = {i["code"]: i for i in report["issues"]}
    assert found["OHLC_LOW_TOO_HIGH"]["message"] == "1 lows are above open or close" and len(found["OHLC_LOW_TOO_HIGH"]["samples"]) == 1
    clean_one = validate.to_dict(validate.report_rows(validate.issues(bars(spark)), validate.envelope(bars(spark))))["X", "1"]
    assert clean_one["usable"] is True


def test_command_line(spark, tmp_path, capsys):
    answers(spark, [answer(5)]).write.parquet(str(tmp_path / "p"))
    run = lambda *a: pipeline.main([str(tmp_path / "store"), *a])
    assert run("--payloads", str(tmp_path / "p"), "--no-persist") == 0 and "not stored" in capsys.readouterr().out and not (tmp_path / "store").exists()
    assert run("--payloads", str(tmp_path / "p"), "--clean", "sort_by_timestamp") == 0
    for wrong in ((), ("--fetch", "m:f"), ("--fetch", "m:f", "--check", "X", "1")):
        with pytest.raises(SystemExit) as refused:
            run(*wrong)
        assert refused.value.code == 2


def test_a_dataset_of_300_000_rows_is_no_single_task(spark):
    from wickwork.operators import validate

    rows = spark.range(300_000).select(F.lit("big").alias("symbol"), F.lit("1").alias("resolution"), F.col("id").alias("_seq"), F.timestamp_micros(F.col("id") * 60_000_000).alias("ts"), *(F.lit(1.0).alias(p) for p in ("open", "high", "low", "close")), F.lit(1).cast("long").alias("volume"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = validate.with_order(rows, validate.Rules()).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.count_if((F.col("_gap") == 60_000_000) & (F.col("_same") == 1)).alias("gaps")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.gaps for r in out) == 299_999 and max(r.n for r in out) < 200_000
