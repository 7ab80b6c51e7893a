"""Snapshots: interrupted writes, many datasets at once, exact hashes, numbering over tasks."""

from __future__ import annotations

import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wickwork.operators import schema, validate
from wickwork.plans import store
from wickwork.plans.scratch import kept, shared_folder

DDL = "symbol string, resolution string, _seq long, us long, open double, high double, low double, close double, volume long"
NO_CHECKS = validate.Rules(interval=None)


def bars(spark, datasets: int, rows: int, close: float = 1.0):
    made = [(f"S{i}", "1", k, 1767239100_000_000 + 60_000_000 * k, 1.0, 2.0, 0.5, close + k % 7 / 8, k) for i in range(datasets) for k in range(rows)]
    return spark.createDataFrame(made, DDL).withColumn("ts", F.timestamp_micros("us")).drop("us")


def put(df, root, **more):
    return store.write(df, root, source="t", found=validate.issues(df, NO_CHECKS), force=True, **more)


@pytest.mark.parametrize("stop", ["_manifests_of", "_commit"])
def test_interrupted_write_changes_nothing(spark, tmp_path, monkeypatch, stop):
    root = str(tmp_path / "s")
    put(bars(spark, 3, 20), root)
    before = {r.symbol: r.day_hash for r in store.manifests(spark, root).collect()}

    def killed(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store, stop, killed)
        with pytest.raises(KeyboardInterrupt):
            put(bars(spark, 3, 20, close=1.25), root)
    assert {r.symbol: r.day_hash for r in store.manifests(spark, root).collect()} == before
    assert store.verify_store(spark, root).where("not unchanged").count() == 0 and store.verify_integrity(spark, root, "S1", "1")
    assert store.read(spark, root, "S0", "1")[0].agg(F.max("close")).first()[0] == 1.75
    assert len(list((tmp_path / "s/data").iterdir())) == 2  # the unfinished one is still there
    assert store.vacuum(spark, root) == [] and len(store.vacuum(spark, root, datetime.timedelta(0))) == 1
    assert len(list((tmp_path / "s/data").iterdir())) == 1 and store.verify_store(spark, root).count() == 3


def test_a_write_stopped_within_its_data_job_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "s")
    put(bars(spark, 2, 10), root)
    broken = bars(spark, 2, 10).withColumn("close", F.when(F.col("_seq") == 9, F.raise_error(F.lit("a task was killed")).cast("double")).otherwise(2.0))
    good = validate.issues(bars(spark, 2, 10), NO_CHECKS)
    with pytest.raises(Exception, match="a task was killed"):
        store.write(broken, root, source="t", found=good, force=True)
    assert store.verify_store(spark, root).where("unchanged").count() == 2


def test_rows_without_a_key_are_refused(spark, tmp_path):
    root = str(tmp_path / "s")
    df = bars(spark, 2, 5)
    for key in ("symbol", "resolution"):
        bad = df.withColumn(key, F.when(F.col("_seq") != 3, F.col(key)))
        with pytest.raises(Exception, match=f"rows without a {key}"):
            put(bad, root)
    with pytest.raises(FileNotFoundError):
        store.manifests(spark, root)


def test_latest_snapshot_of_each_dataset_is_read(spark, tmp_path):
    root = str(tmp_path / "s")
    put(bars(spark, 4, 10), root)
    put(bars(spark, 2, 12, close=3.0), root)
    rows = {r.symbol: r["count"] for r in store._data(spark, root).groupBy("symbol").count().collect()}
    assert rows == {"S0": 12, "S1": 12, "S2": 10, "S3": 10} == {r.symbol: r.row_count for r in store.manifests(spark, root).collect()}
    assert store.vacuum(spark, root, datetime.timedelta(0)) == []
    put(bars(spark, 4, 5), root)
    assert len(store.vacuum(spark, root, datetime.timedelta(0))) == 2 and len(store.snapshots(spark, root)) == 1
    assert store._data(spark, root).count() == 20


def test_whole_store_is_checked_in_one_job(spark, tmp_path):
    root = str(tmp_path / "s")
    put(bars(spark, 5, 10), root)
    snapshot = store.snapshots(spark, root)[0]
    folder = tmp_path / f"s/data/snapshot={snapshot}"
    bars(spark, 1, 10, close=9.0).drop("symbol", "resolution", "_seq").coalesce(1).write.mode("overwrite").parquet(str(folder / "symbol=S3/resolution=1"))
    for p in (folder / "symbol=S4/resolution=1").iterdir():
        p.unlink()
    assert {r.symbol: r.unchanged for r in store.verify_store(spark, root).collect()} == {"S0": True, "S1": True, "S2": True, "S3": False, "S4": False}
    with pytest.raises(FileNotFoundError):
        store.read(spark, root, "S4", "1")


def plain_hash(rows) -> str:
    """The hash as defined, over collected rows."""
    text = "ts,open,high,low,close,volume\n"
    for r in rows:
        wall = (datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=r.us + 19_800_000_000)).isoformat() + "+05:30" if r.us is not None else ""
        text += ",".join([wall, *("" if p is None else f"{p:.10g}" for p in (r.open, r.high, r.low, r.close)), "" if r.volume is None else str(r.volume)]) + "\n"
    return hashlib.sha256(text.encode()).hexdigest()


def test_exact_hashes_of_all_datasets(spark, tmp_path):
    rng = random.Random(3)
    made = []
    for i in range(12):
        for k in range(rng.randint(1, 300)):
            made.append((f"S{i}", "1", k, 1767239100_000_000 + rng.randint(0, 10**12), rng.uniform(0, 1e6), float("inf") if rng.random() < 0.05 else 2.0, None if rng.random() < 0.1 else 1 / 3, 1e-7, None if rng.random() < 0.1 else k))
    df = spark.createDataFrame(made, DDL).withColumn("ts", F.timestamp_micros("us"))
    found = {r.symbol: r.content_hash for r in store.exact_hashes(df.repartition(5)).collect()}
    by: dict = {}
    for r in df.orderBy("symbol", "ts", "_seq").collect():
        by.setdefault(r.symbol, []).append(r)
    assert found == {s: plain_hash(rows) for s, rows in by.items()}
    assert store.content_hash(df.where("symbol = 'S3'")) == found["S3"]
    m = put(df.drop("us"), str(tmp_path / "s"), exact=True)
    assert {r.symbol: r.content_hash for r in m.collect()} == found
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {r.symbol: r.content_hash for r in store.exact_hashes(df).collect()} == found
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("tasks", ["1", "50"])
def test_numbers_do_not_depend_on_tasks(spark, tasks):
    """A dataset of most rows, ties, null times and keys: the same numbers as a window over each dataset gives."""
    rng = random.Random(1)
    made = [("big", "1", k, rng.choice([None, *range(50)]), 1.0, 1.0, 1.0, float(k), 1) for k in rng.sample(range(10**6), 3000)]
    made += [(s, "5", k, k % 3, 1.0, 1.0, 1.0, 1.0, 1) for s in ("a", "b", None) for k in range(20)]
    df = spark.createDataFrame(made, DDL).withColumn("ts", F.timestamp_micros("us")).drop("us")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        out = schema.resequenced(df)
        assert "RowNumber" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {(r.symbol, r.close if r.symbol == "big" else r.ts, r._seq) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted, at = set(), {}
    key = lambda r: (r[0] or "", r[3] is None, r[3] or 0, r[2])
    for r in sorted(made, key=key):
        n = at[r[0]] = at.get(r[0], -1) + 1
        wanted.add((r[0], r[7] if r[0] == "big" else datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=r[3]), n))
    assert got == wanted


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key):
            return None

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_kept_rows_are_not_made_again(spark):
    runs = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    rows = kept(spark.range(10).mapInArrow(noted, "id long"))
    assert rows.count() == rows.count() == 10 and runs.value == 10


def test_a_large_dataset_is_written_by_several_tasks(spark, tmp_path):
    """A month of one dataset, 40,000 rows, in more than one file, and a small dataset in one."""
    from pyspark.sql import functions as F

    from wickwork.operators import validate
    from wickwork.plans import store

    at = lambda n, s: spark.range(n).select(F.lit(s).alias("symbol"), F.lit("1").alias("resolution"), F.col("id").alias("_seq"), F.timestamp_micros(F.col("id") * 60_000_000).alias("ts"), *(F.rand(1).alias(p) for p in ("open", "high", "low", "close")), F.col("id").alias("volume"))
    rows, before = at(40_000, "big").unionByName(at(9, "small")), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write(rows, str(tmp_path), source="t", found=validate.issues(rows), force=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = lambda s: len(list(tmp_path.glob(f"data/*/symbol={s}/**/*.parquet")))
    assert files("big") > 1 and files("small") == 1
    assert {r.symbol: r.row_count for r in store.manifests(spark, str(tmp_path)).collect()} == {"big": 40_000, "small": 9}
