"""Small functions that no query has: allow-list, provenance, times, tokens."""

from __future__ import annotations

import datetime
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from wickwork.functions import instruments, texts, times
from wickwork.operators import schema, validate
from wickwork.plans import store
from wickwork.sources import payloads, provider


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("resolution", ["7", "", "1d", "D", "1 ", "60m"])
def test_resolutions_off_the_list_are_refused(spark, resolution):
    with pytest.raises(ValueError, match="isn't one of"):
        payloads.check_resolution(resolution)
    source = provider.provider("refusing", lambda *a: "")
    with pytest.raises(Exception, match="isn't one of"):
        provider.read_payloads(spark, source, symbol="X", resolution=resolution, start="2026-01-01", end="2026-01-02").count()


def test_resolutions_on_the_list(spark):
    for resolution in times.RESOLUTIONS:
        payloads.check_resolution(resolution)


def test_provenance(tmp_path):
    assert store.git_revision(str(tmp_path)) == "" == store.git_revision(str(tmp_path / "nowhere"))
    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=n", "-c", "user.email=e@x", *a], check=True, capture_output=True, text=True).stdout.strip()
    run("init")
    (tmp_path / "a").write_text("1")
    run("add", "a")
    run("commit", "-m", "m")
    assert store.git_revision(str(tmp_path)) == run("rev-parse", "HEAD")
    (tmp_path / "a").write_text("2")
    assert store.git_revision(str(tmp_path)) == run("rev-parse", "HEAD") + "-dirty"
    versions = store.software_versions("4.0")
    assert versions["spark"] == "4.0" and versions["python"] == sys.version.split()[0] and versions["pyarrow"][0].isdigit()


def test_times(spark):
    made = times.ist_instant(*(F.lit(x) for x in (2026, 1, 1, 9, 15)), F.lit(0.5).cast("decimal(18,6)"))
    assert value(spark, times.iso(made)) == "2026-01-01T09:15:00.500000+05:30"
    assert value(spark, times.api_date(F.lit(datetime.date(2026, 2, 3)))) == "2026-02-03" and value(spark, times.api_date(F.lit(None).cast("date"))) is None


def test_numbers_and_tokens(spark):
    assert [value(spark, instruments.is_finite(F.lit(x).cast("double"))) for x in (1.0, float("inf"), float("-inf"), float("nan"))] == [True, False, False, False]
    assert value(spark, texts.access_token(F.lit('{"access_token":"a","accessToken":"b"}'))) == "a" and value(spark, texts.access_token(F.lit('{"accessToken":"b"}'))) == "b"
    assert value(spark, texts.access_token(F.lit("not json"))) is None
    assert value(spark, texts.authorization_header(F.lit("client"), F.lit("token"))) == "client:token"
    assert value(spark, texts.sha256_hex(F.lit("abc"))).startswith("ba7816bf")


def test_row_extremes_and_first_rows(spark):
    df = spark.createDataFrame([("X", "1", i, datetime.datetime(2026, 1, 1, 0, 9 - i), 1.0 + i, 9.0, 0.0, None if i == 2 else 2.0, 1) for i in range(5)], "symbol string, resolution string, _seq long, ts timestamp, open double, high double, low double, close double, volume long")
    rows = df.withColumns(validate.row_extremes()).orderBy("_seq").collect()
    assert [(r.top, r.bottom, r.missing) for r in rows] == [(2.0, 1.0, False), (2.0, 2.0, False), (3.0, 3.0, True), (4.0, 2.0, False), (5.0, 2.0, False)]
    assert sorted(r._seq for r in schema.first_rows(df, 2).collect()) == [3, 4]
    found = validate.issues(df)
    assert {r.code for r in validate.codes_not_found(found).collect()} == set(validate.SEVERITY) - {r.code for r in found.collect()}
