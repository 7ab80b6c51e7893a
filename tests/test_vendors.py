"""Vendors: probes in rounds, pauses, filters that reach the source, incremental fetches, the command line."""

from __future__ import annotations

import datetime
import json
import sys
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wickwork.plans import pipeline
from wickwork.sources import payloads, probe, provider

DAY = datetime.date
REQUEST = "symbol string, resolution string, oldest date, newest date"


def served(first: DAY, last: DAY, log: str | None = None, bad: str | None = None):
    """A vendor that has a candle at 09:15 each day from first to last, notes its requests in a folder and fails where the file bad exists."""

    def fetch(symbol: str, resolution: str, a: DAY, b: DAY) -> str:
        if log:
            Path(log, f"{time.time_ns()}-{uuid.uuid4().hex}").write_text(f"{symbol} {resolution} {a} {b}")
        if symbol == "REFUSED":
            return '{"s":"error","code":-16,"message":"Invalid token"}'
        if symbol == "BROKEN":
            raise payloads.VendorError("rate limit exceeded")
        if symbol == "BUG":
            raise ZeroDivisionError("a fault of the program")
        if bad and Path(bad).exists():
            return '{"s":"error","code":-99,"message":"something broke"}'
        days = [a + datetime.timedelta(days=i) for i in range((b - a).days + 1)]
        return json.dumps({"s": "ok", "candles": [[(d - DAY(1970, 1, 1)).days * 86400 + 13500, 1, 2, 0.5, 1, 1] for d in days if first <= d <= last]})

    return fetch


def requests_in(folder: Path) -> list[str]:
    return [p.read_text() for p in sorted(folder.iterdir())]


def bisected(first: DAY, last: DAY, newest: DAY, oldest: DAY, window: int = 5) -> DAY | None:
    low, high, found = oldest, newest, None
    while low <= high:
        middle = low + datetime.timedelta(days=(high - low).days // 2)
        if middle <= last and min(middle + datetime.timedelta(days=window - 1), newest) >= first:
            found, high = middle, middle - datetime.timedelta(days=1)
        else:
            low = middle + datetime.timedelta(days=1)
    return found


SPANS = [(DAY(2020, 1, 1), DAY(2023, 6, 30)), (DAY(2026, 1, 1), DAY(2026, 6, 30)), (DAY(2026, 6, 30), DAY(2026, 6, 30)), (DAY(2019, 2, 3), DAY(2019, 2, 4)), (DAY(1990, 1, 1), DAY(1991, 1, 1))]


def test_rounds_bisect_many_datasets_at_once(spark, tmp_path):
    """Data that ends before the newest day, too; a round is asked once."""
    newest, oldest = DAY(2026, 6, 30), DAY(2015, 1, 1)
    spans = {f"S{i}": s for i, s in enumerate(SPANS)}

    def fetch(symbol, resolution, a, b):
        Path(str(tmp_path), f"{time.time_ns()}-{symbol}").write_text(symbol)
        return served(*spans[symbol])(symbol, resolution, a, b) if symbol in spans else served(newest, newest)(symbol, resolution, a, b)

    wanted = spark.createDataFrame([*((s, "1", oldest, newest) for s in spans), ("BROKEN", "1D", oldest, newest), ("LATE", "1", newest, oldest)], REQUEST)
    found = {r.symbol: r.earliest for r in probe.earliest(wanted, probe.live_answer(fetch, pause=0, tasks=2)).collect()}
    assert found == {**{s: bisected(*span, newest, oldest) for s, span in spans.items()}, "BROKEN": None, "LATE": None}
    assert found["S0"] is not None and len(list(tmp_path.iterdir())) <= 13 * len(spans) + 13
    for s, (first, last) in spans.items():
        one = payloads.probe_earliest(lambda a, b, first=first, last=last: a <= last and b >= first, newest, oldest)
        assert one == found[s]


def test_stored_candles_answer_as_a_vendor_does(spark):
    newest, oldest = DAY(2026, 1, 31), DAY(2026, 1, 1)
    candles = spark.createDataFrame([("A", "1", datetime.datetime(2026, 1, d, 9)) for d in (7, 8, 20)] + [("B", "1", datetime.datetime(2026, 1, 31, 9))], "symbol string, resolution string, ts timestamp")
    wanted = spark.createDataFrame([(s, "1", oldest, newest) for s in "ABC"], REQUEST)
    found = {r.symbol: r.earliest for r in probe.earliest(wanted, probe.stored_answer(candles), 2).collect()}
    days = {"A": (7, 8, 20), "B": (31,), "C": ()}
    assert found == {s: payloads.probe_earliest(lambda a, b, d=d: any(a <= DAY(2026, 1, x) <= b for x in d), newest, oldest, 2) for s, d in days.items()}


def test_refusals_stop_a_probe_and_faults_are_not_hidden(spark):
    one = lambda s: spark.createDataFrame([(s, "1", DAY(2026, 1, 1), DAY(2026, 1, 9))], REQUEST)
    with pytest.raises(payloads.AuthError):
        probe.earliest(one("REFUSED"), probe.live_answer(served(*SPANS[0]), 0))
    with pytest.raises(Exception, match="a fault of the program"):
        probe.earliest(one("BUG"), probe.live_answer(served(*SPANS[0]), 0))
    with pytest.raises(ZeroDivisionError):
        payloads.probe_earliest(lambda a, b: 1 / 0, DAY(2026, 1, 9), DAY(2026, 1, 1))


@pytest.mark.parametrize("partitions", [0, 1, 3])
def test_pauses_hold_over_all_tasks(spark, tmp_path, partitions):
    """Four chunks at 0.4 s, whether one task reads them or several."""
    source = provider.provider(f"paused{partitions}", served(*SPANS[1], log=str(tmp_path)))
    assert provider.read_payloads(spark, source, symbol="X", resolution="1", start="2026-01-01", end="2026-12-31", pause=0.4, partitions=partitions).count() == 4
    at = [int(p.name.split("-")[0]) / 1e9 for p in sorted(tmp_path.iterdir())]
    assert len(at) == 4 and at[-1] - at[0] >= 1.15 - (0.4 if partitions == 3 else 0)


def test_filters_reach_the_source(spark, tmp_path):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        source = provider.provider("filtered", served(*SPANS[1], log=str(tmp_path)))
        read = provider.read_payloads(spark, source, symbol="X,Y,Z", resolution="1,1D", start="2025-01-01", end="2026-12-31")
        got = read.where((F.col("symbol") == "Y") & (F.col("resolution") == "1") & (F.col("from_date") >= DAY(2026, 1, 1)) & (F.col("to_date") <= DAY(2026, 9, 1)) & (F.length("payload") > 0)).collect()
        assert sorted(r.from_date for r in got) == [DAY(2026, 2, 5), DAY(2026, 5, 16)]
        assert len(requests_in(tmp_path)) == len(got) and all(x.startswith("Y 1 ") for x in requests_in(tmp_path))
        assert read.where("symbol = 'nobody'").count() == 0 and read.where(F.col("symbol").isin("X", "Z") & (F.col("chunk") < 1)).count() == 4
        assert len(requests_in(tmp_path)) == len(got) + 4
        assert read.where(F.upper("symbol") == "X").count() == 8 + 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_increments_ask_for_new_days_only(spark, tmp_path):
    log, bad, out = tmp_path / "log", tmp_path / "bad", str(tmp_path / "out")
    log.mkdir()
    source = provider.provider("incremental", served(DAY(2026, 1, 1), DAY(2026, 12, 31), str(log), str(bad)))

    def run(end: str) -> None:
        rows = provider.stream_payloads(spark, source, symbol="X,Y", resolution="1", start="2026-01-01", end=end)
        rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start(out).awaitTermination()

    def asked() -> list[str]:
        found = sorted(requests_in(log))
        for p in log.iterdir():
            p.unlink()
        return found

    run("2026-04-20")
    assert asked() == [f"{s} 1 {d}" for s in "XY" for d in ("2026-01-01 2026-04-10", "2026-04-11 2026-04-20")]
    run("2026-04-20")
    assert asked() == []
    run("2026-05-01")
    assert asked() == [f"{s} 1 2026-04-21 2026-05-01" for s in "XY"]
    bad.touch()
    with pytest.raises(Exception, match="something broke"):
        run("2026-05-03")
    assert asked()
    bad.unlink()
    run("2026-05-03")
    assert asked() == [f"{s} 1 2026-05-02 2026-05-03" for s in "XY"]
    rows = spark.read.parquet(out)
    assert rows.count() == 8 and rows.select("symbol", "chunk").distinct().count() == 8
    candles, _, coverage = payloads.fetch(rows)
    assert candles.count() == 2 * 123 and {(r.symbol, r.failed) for r in coverage.collect()} == {("X", 0), ("Y", 0)}


def test_command_line_fetches_and_probes(spark, tmp_path, capsys, monkeypatch):
    (tmp_path / "log").mkdir()
    (tmp_path / "fake_vendor_cli.py").write_text("from tests.test_vendors import served, DAY\n" f"fetch = served(DAY(2026, 1, 5), DAY(2026, 4, 20), {str(tmp_path / 'log')!r})\n")
    monkeypatch.syspath_prepend(str(tmp_path))

    def run(symbol: str, *more: str, start: str = "2026-01-01", end: str = "2026-06-30") -> int:
        return pipeline.main([str(tmp_path / "store"), "--fetch", "fake_vendor_cli:fetch", "--symbol", symbol, "--resolution", "1D", "--start", start, "--end", end, *more])

    assert run("X", "--pause", "0") == 0 and "stored" in capsys.readouterr().out
    assert len(requests_in(tmp_path / "log")) == 1
    assert run("REFUSED") == 3 and run("REFUSED", "--probe") == 3
    assert run("BROKEN", "--pause", "0") == 1 and run("X", "--no-persist", "--pause", "0") == 0
    capsys.readouterr()
    # data that ended long before the newest day; a vendor's errors are no data
    assert run("X", "--probe", "--pause", "0") == 0 and capsys.readouterr().out.strip() == str(bisected(DAY(2026, 1, 5), DAY(2026, 4, 20), DAY(2026, 6, 30), DAY(2026, 1, 1)))
    assert run("BROKEN", "--probe", "--pause", "0") == 1 and "no data" in capsys.readouterr().out
    for wrong in (("--probe", "--payloads", "x"), ("--resolution", "7")):
        with pytest.raises(SystemExit) as refused:
            run("X", *wrong)
        assert refused.value.code == 2
    sys.modules.pop("fake_vendor_cli", None)


def test_command_line_pauses(spark, tmp_path, monkeypatch):
    (tmp_path / "log").mkdir()
    (tmp_path / "fake_vendor_slow.py").write_text("from tests.test_vendors import served, DAY\n" f"fetch = served(DAY(2026, 1, 5), DAY(2026, 9, 1), {str(tmp_path / 'log')!r})\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    args = ["--fetch", "fake_vendor_slow:fetch", "--symbol", "X", "--resolution", "1", "--start", "2026-01-01", "--end", "2026-10-01", "--pause", "0.5", "--no-persist"]
    pipeline.main([str(tmp_path / "store"), *args])
    at = [int(p.name.split("-")[0]) / 1e9 for p in sorted((tmp_path / "log").iterdir())]
    assert len(at) == 3 and all(b - a >= 0.45 for a, b in zip(at, at[1:]))
