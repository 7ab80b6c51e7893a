"""Every candle query against its SQL, and the entry module's contract."""

from __future__ import annotations

import pytest

from tests.conftest import SMALL
from tests.oracle import same
from wickwork import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    same(spark, duck, catalog.QUERIES[name], catalog.SQL[name], SMALL)


def same_on(spark, name: str, folder, **tables: str) -> None:
    """A query and its SQL on other tables, each given as a query on those of SMALL."""
    import duckdb

    with duckdb.connect() as c:
        for t, query in tables.items():
            c.execute(f"copy ({query.format(t=f"read_parquet('{SMALL}/{t}.parquet')")}) to '{folder}/{t}.parquet' (format parquet)")
            c.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
        same(spark, c, catalog.QUERIES[name], catalog.SQL[name], str(folder))


def test_a_probe_that_finds_nothing(spark, tmp_path):
    """Every chunk of these events failed or is empty."""
    same_on(spark, "a10_probe_rounds", tmp_path, events="select * from {t} where event_id between 500 and 999")


def test_changes_keep_their_sign(spark, tmp_path):
    """A change of -2e-16, whose rounding has a sign in SQL: 9.95 + 0.02 after 9.96 + 0.01."""
    import math

    name, events = "e01_ordered_primitives", "select * replace ('one' as event_type, case event_id when 4 then 9.96 when 5 then 9.95 else value end::double as value) from {t} where event_id < 20"
    same_on(spark, name, tmp_path, events=events, orders="select * from {t} limit 1")
    import duckdb

    with duckdb.connect() as c:
        for t in ("events", "orders"):
            c.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet')")
        wanted = {(x[0], x[1]): x[2] for x in c.execute(f"select resolution, seq, change from ({catalog.SQL[name]}) where change = 0").fetchall()}
    got = {(r.resolution, r.seq): r.change for r in catalog.QUERIES[name](spark, str(tmp_path)).where("change = 0").collect()}
    assert {k: math.copysign(1, v) for k, v in got.items()} == {k: math.copysign(1, v) for k, v in wanted.items()} and -1 in (math.copysign(1, v) for v in wanted.values())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["symbol", "resolution", "code", "severity", "n"]
    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_corpus_operators(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as e

    for gone in ("corpus_pipeline", "wickwork.llm"):
        monkeypatch.setitem(sys.modules, gone, None)
    for name in [m for m in sys.modules if m.startswith("wickwork.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    try:
        assert set(importlib.reload(e).queries()) == set(catalog.QUERIES)
    finally:
        monkeypatch.undo()
        importlib.reload(e)


def test_row_checks_need_no_exchange(spark):
    q = catalog.QUERIES["d09_ohlc_high_below_low"]
    from wickwork.operators import validate
    from wickwork.sources import tables

    plan = validate.violations(tables.tick(spark, SMALL), "OHLC_HIGH_BELOW_LOW")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and q(spark, SMALL).count()


def test_validator_has_one_exchange_before_counting(spark):
    from wickwork.operators import validate
    from wickwork.sources import tables

    plan = validate.flagged(tables.tick(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol") == 1 and "SinglePartition" not in plan
