"""op12: whitened rows against numpy on the whole matrix."""

from __future__ import annotations

import numpy as np
import pytest

from tests.conftest import SMALL
from wickwork.llm import whitening
from wickwork.llm.base import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def check(out: list, rows: list[tuple], most: int = 32) -> None:
    """rows (id, vector) that can be used; out: rows of the query's form."""
    x = np.array([[int(np.floor(64 * v)) + 1_000_000 for v in vector] for _, vector in rows])
    n, sums = len(x), [int(s) for s in x.sum(0)]
    away = x - np.array(sums) / n
    covariance = away.T @ away / n
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1], u[:, ::-1]
    k = sum(v > e[0] * 1e-10 for v in e[:most])
    by_row: dict = {}
    for r in out:
        by_row.setdefault(r.component, []).append(r)
    assert sorted(by_row) == list(range(1, k + 1))
    deviation = sorted((i, sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True))) for (i, _), row in zip(rows, x, strict=True))
    for c, found in by_row.items():
        assert sorted((r.vec_id, r.deviation) for r in found) == deviation
        assert all(r.n == n and abs(r.explained - e[c - 1] / e.sum()) < 1e-9 and r.identity_error < 1e-6 for r in found)
        wanted = away @ u[:, c - 1] / np.sqrt(e[c - 1])
        pairs = sorted((r.vec_id, r.whitened) for r in found)
        plain = sorted((i, w) for (i, _), w in zip(rows, wanted, strict=True))
        sign = np.sign(sum(a[1] * b[1] for a, b in zip(pairs, plain, strict=True)))
        assert all(abs(a[1] - sign * b[1]) < 1e-6 for a, b in zip(pairs, plain, strict=True))


def as_query(spark, monkeypatch, df) -> list:
    monkeypatch.setattr(whitening, "table", lambda *a: df)
    return whitening.query(spark, "").collect()


def test_query_equals_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SMALL, "embeddings").collect()]
    check(whitening.query(spark, SMALL).collect(), rows)


def test_many_blocks_equal_one(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=7) * [9, 5, 4, 3, 2, 1.5, 1]], 0) for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    check(as_query(spark, monkeypatch, df), [r[:2] for r in rows])


def test_rows_that_cannot_be_used_repeats_and_other_columns(spark, monkeypatch):
    inf, nan = float("inf"), float("nan")
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-3.0, 0.5]), (2, [7.0, 7.0]), (3, [0.1, -0.1])]
    bad = [(4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [-inf, 1.0]), (9, [1.0]), (10, [1.0, 2.0, 3.0]), (11, [])]
    df = spark.createDataFrame([(*r, 0) for r in good + bad], SCHEMA).withColumnRenamed("label", "index")
    check(as_query(spark, monkeypatch, df), good)


def test_constant_dimension_is_left_out(spark, monkeypatch):
    rows = [(i, [float(i % 5), 3.0, float(i % 3)]) for i in range(60)]
    check(as_query(spark, monkeypatch, spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)), rows)


def test_nearly_dependent_dimensions(spark, monkeypatch):
    """The third is the sum of the others but for one vector in a thousand; the fourth repeats the first."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(2_000):
        a, b = (float(v) for v in rng.integers(-50_000, 50_000, 2))
        rows.append((i, [a, b, a + b + (i % 1000 == 0), a]))
    out = as_query(spark, monkeypatch, spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))
    assert len({r.component for r in out}) == 2 and max(r.identity_error for r in out) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)], [(1, None, 0)], [(1, [], 0)]])
def test_nothing_to_whiten(spark, monkeypatch, rows):
    assert as_query(spark, monkeypatch, spark.createDataFrame(rows, SCHEMA)) == []


def test_null_ids_and_huge_entries(spark, monkeypatch):
    rows = [(None, [1e300, 1.0], 0), (1, [-1e300, 2.0], 0), (2, [0.0, 5.0], 0)]
    out = as_query(spark, monkeypatch, spark.createDataFrame(rows, SCHEMA))
    assert {r.vec_id for r in out} == {None, 1, 2} and all(r.deviation is None for r in out if r.vec_id != 2)
