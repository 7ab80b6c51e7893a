"""Extensions: as-of joins, moving means, missing days, ordered checks on a stream; each against plain Python."""

from __future__ import annotations

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from wickwork.operators import validate
from wickwork.operators.asof import as_of
from wickwork.operators.intervals import missing_days
from wickwork.operators.rolling import exponential_mean, moving

MINUTE = 60_000_000


@pytest.mark.parametrize(("exact", "tolerance", "width"), [(True, None, MINUTE), (False, None, 7 * MINUTE), (True, 3 * MINUTE, 10**15), (False, 90_000_000, MINUTE)])
def test_as_of(spark, exact, tolerance, width):
    rng = random.Random(7)
    left = [(rng.choice(["a", "b", None, "only left"]), rng.choice([None, *range(0, 200)]), i) for i in range(400)]
    right = [(rng.choice(["a", "a", "b", None, "only right"]), rng.choice([None, *range(0, 200, 3)]), rng.randint(0, 3), i) for i in range(120)]
    ts = lambda df: df.withColumn("ts", F.timestamp_micros(F.col("m") * MINUTE)).drop("m")
    out = as_of(ts(spark.createDataFrame(left, "k string, m long, id int")), ts(spark.createDataFrame(right, "k string, m long, t int, v int")), ["k"], tie="v", exact=exact, tolerance_micros=tolerance, width_micros=width)
    assert out.columns == ["k", "id", "ts", "right_t", "right_v", "right_ts"]
    wanted = {}
    for k, m, i in left:
        able = [(rm, v) for rk, rm, _, v in right if rk == k and rm is not None and m is not None and (rm <= m if exact else rm < m)]
        best = max(able, default=None)
        wanted[i] = best[1] if best and (tolerance is None or (m - best[0]) * MINUTE <= tolerance) else None
    assert {r.id: r.right_v for r in out.collect()} == wanted
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_as_of_splits_a_hot_dataset(spark):
    """One key of 20,000 rows over 20,000 minutes: no task of the join gets more than a fraction of them."""
    rows = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * MINUTE).alias("ts"), "id")
    out = as_of(rows, rows.where("id % 10 = 0"), ["k"], width_micros=60 * MINUTE).withColumn("task", F.spark_partition_id())
    assert out.where("right_id <> id - id % 10").count() == 0
    assert max(r["count"] for r in out.groupBy("task").count().collect()) < 12_000


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
@pytest.mark.parametrize("alpha", [0.05, 0.5, 0.999, 1.0])
def test_exponential_mean(spark, alpha, block):
    rng = random.Random(2)
    rows = [(s, "1", k, None if rng.random() < 0.2 or s == "empty" else rng.uniform(-5, 100)) for s, n in (("a", 300), ("b", 1), ("empty", 5)) for k in range(n)]
    got = {(r.symbol, r._seq): r.ewm for r in exponential_mean(spark.createDataFrame(rows, "symbol string, resolution string, _seq long, x double").repartition(3), "x", alpha, block=block).collect()}
    mean: dict = {}
    for s, _, k, x in rows:
        if x is not None:
            mean[s] = x if s not in mean else (1 - alpha) * mean[s] + alpha * x
        found, wanted = got[s, k], mean.get(s)
        assert found is wanted is None or abs(found - wanted) <= 1e-9 * max(1, abs(wanted))
    assert len(got) == len(rows)


@pytest.mark.parametrize(("rows", "block"), [(1, 4), (3, 4), (5, 5), (20, 8), (50, 4096)])
def test_moving_windows(spark, rows, block):
    rng = random.Random(4)
    made = [(s, "1", k, None if rng.random() < 0.1 else rng.uniform(0, 9)) for s in "ab" for k in range(40)]
    out = moving(spark.createDataFrame(made, "symbol string, resolution string, _seq long, x double"), "x", rows, block)
    values = {(s, k): x for s, _, k, x in made}
    found = out.collect()
    assert len(found) == len(made)
    for r in found:
        seen = [values[r.symbol, k] for k in range(max(0, r._seq - rows + 1), r._seq + 1) if values[r.symbol, k] is not None]
        assert (r.moving_mean is None) == (not seen) and (not seen or abs(r.moving_mean - statistics.fmean(seen)) < 1e-9)
        assert (r.moving_std is None) == (len(seen) < 2) and (len(seen) < 2 or abs(r.moving_std - statistics.stdev(seen)) < 1e-9)


def test_missing_days(spark):
    d = lambda n: datetime.date(2026, 1, 1) + datetime.timedelta(days=n)
    bars = [("a", "1", datetime.datetime(2026, 1, n, 6)) for n in (3, 4, 9)] + [("a", "1", datetime.datetime(2026, 1, 10, 23))]
    asked = [("a", "1", d(0), d(5)), ("a", "1", d(4), d(12)), ("b", "1", d(0), d(0)), ("b", "1", d(5), d(2)), ("b", "1", d(2), d(3))]
    out = missing_days(spark.createDataFrame(asked, "symbol string, resolution string, start date, end date"), spark.createDataFrame(bars, "symbol string, resolution string, ts timestamp"))
    got = sorted((r.symbol, r.from_date.day, r.to_date.day, r.days) for r in out.collect())
    # 23:00 in UTC on the 10th is the 11th in India
    assert got == [("a", 1, 2, 2), ("a", 5, 8, 4), ("a", 10, 10, 1), ("a", 12, 13, 2), ("b", 1, 1, 1), ("b", 3, 4, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ordered_checks_on_a_stream(spark, tmp_path):
    """Rows in three batches tell what the batch checks tell of all of them; a late row is told as such."""
    from wickwork.streaming.ordered import LATE, ordered_stream

    rng = random.Random(11)
    base, rows = 1767239100_000_000, []
    for s, step in (("a", 1), ("b", 5), ("c", None)):
        at = base
        for k in range(90):
            at += rng.choice([1, 1, 1, 5, 5, 17, -3, 0, 0]) * MINUTE
            rows.append((s, str(step) if step else "1D", k, at, 1.0, 2.0, 0.5, 1.0, 1))
    ddl = "symbol string, resolution string, _seq long, us long, open double, high double, low double, close double, volume long"
    df = spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_micros("us")).drop("us")
    source, codes = str(tmp_path / "in"), ["TS_NOT_SORTED", "DUPLICATE_TIMESTAMPS", "WITHIN_DAY_GAPS"]
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for i in range(3):
            df.where(f"_seq >= {30 * i} and _seq < {30 * i + 30}").orderBy(F.rand(i)).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(df.schema).parquet(source)
            q = ordered_stream(stream, "2 days").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start(str(tmp_path / "out"))
            q.awaitTermination()
        df.where("symbol = 'a' and _seq = 3").coalesce(1).write.mode("append").parquet(source)
        q = ordered_stream(spark.readStream.schema(df.schema).parquet(source), "2 days").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
    finally:
        spark.conf.set(name, before)
    told = sorted((r.symbol, r.seq, r.code) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    flagged = validate.flagged(df, validate.Rules(session=None)).select("symbol", "_seq", F.explode("codes").alias("code")).where(F.col("code").isin(codes)).collect()
    assert told == sorted([*((r.symbol, r._seq, r.code) for r in flagged), ("a", 3, LATE)]) and len(told) > 40


def test_sketches(spark, tmp_path):
    """Ranks of quantiles and numbers of times within the bounds; merged in any grouping, from manifests too, within them as well."""
    from wickwork.operators import sketches
    from wickwork.plans import store

    rng = random.Random(5)
    rows, at = [], 1767239100_000_000
    for s, n in (("a", 6_000), ("b", 3_000), ("one", 1)):
        close = 100.0
        for k in range(n):
            close *= 1 + rng.gauss(0, 0.001) + (0.5 if k == 77 else 0)
            rows.append((s, "1", k, at + MINUTE * k, close, close, close, close, 1))
    ddl = "symbol string, resolution string, _seq long, us long, open double, high double, low double, close double, volume long"
    df = spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_micros("us")).drop("us")
    days = sketches.day_sketches(df).cache()
    assert days.count() == 9
    changes: dict = {}
    for s, g in (("a", 6_000), ("b", 3_000)):
        closes = [r[7] for r in rows if r[0] == s]
        changes[s] = sorted(b / a - 1 for a, b in zip(closes, closes[1:]))
    halves = sketches.merged(sketches.merged(days.withColumn("half", F.dayofmonth("day") % 2), ["symbol", "resolution", "half"]))
    store.write(df, str(tmp_path / "s"), source="t", found=validate.issues(df), force=True, sketches=days)
    for found in (sketches.merged(days), halves, store.stored_sketches(spark, str(tmp_path / "s")), sketches.merged(store.stored_sketches(spark, str(tmp_path / "s")))):
        out = {r.symbol: r for r in sketches.summary(found).collect()}
        assert set(out) == {"a", "b", "one"} and out["one"].median is None and out["one"].n_returns == 0 and out["one"].rows == 1
        for s, c in changes.items():
            assert out[s].n_returns == len(c) and out[s].rows == len(c) + 1 and abs(out[s].n_times / (len(c) + 1) - 1) <= sketches.TIMES_ERROR
            for q, p in ((out[s].q1, 0.25), (out[s].median, 0.5), (out[s].q3, 0.75)):
                assert abs(sum(x <= q for x in c) / len(c) - p) <= sketches.RANK_ERROR
    limits = sketches.summary(sketches.merged(days), width=20.0)
    assert sorted((r.symbol, r._seq) for r in sketches.robust_outliers(df, limits).collect()) == [("a", 77), ("b", 77)]


def test_the_stream_asks_its_state_by_hours():
    """Two batches of 3,000 rows over four hours: some calls of the state for each hour, none for each row."""
    import pandas as pd

    from wickwork.streaming.ordered import OrderedChecks

    calls = []

    class State(dict):
        def __getattr__(self, name):
            def call(key=None, value=None):
                calls.append(name)
                if name in ("update", "updateValue"):
                    self[None if name == "update" else key] = key if name == "update" else value
                return {"get": lambda: dict.get(self, None), "exists": lambda: None in self, "getValue": lambda: self[key], "containsKey": lambda: key in self}.get(name, lambda: None)()

            return call

        def get(self):
            return self[None]

        def update(self, value):
            self[None] = value

    class Handle:
        getValueState = getMapState = lambda self, *schema: State()
        registerTimer = lambda self, at: calls.append("timer")

    checks, told = OrderedChecks(), []
    checks.init(Handle())
    for k in range(2):
        frame = pd.DataFrame({"seq": range(3000 * k, 3000 * k + 3000), "us": [(i * 4_800_000) for i in range(3000)]})
        told += [r for out in checks.handleInputRows(("a", "1"), iter([frame]), None) for r in out.itertuples(index=False)]
    assert sorted(r.seq for r in told if r.code == "DUPLICATE_TIMESTAMPS") == list(range(3000))
    assert [(r.seq, r.us) for r in told if r.code != "DUPLICATE_TIMESTAMPS"] == [(3000, 0)] and len(calls) < 100
