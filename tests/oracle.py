"""Comparison of a query with its SQL."""

from __future__ import annotations


def rows_of(frame) -> list[tuple]:
    """Rows with columns by name, floats to nine places, sorted."""

    def plain(v):
        if v is None or str(v) in ("nan", "NaT", "<NA>"):
            return None
        if isinstance(v, bool):
            return v
        v = v.item() if hasattr(v, "item") else v
        return round(float(v), 9) if isinstance(v, float) or type(v) is int and abs(v) < 2**53 else v

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(plain, r)) for r in frame.values.tolist()), key=repr)


def same(spark, duck, query, sql: str, folder: str) -> None:
    got, wanted = query(spark, folder).toPandas(), duck.execute(sql).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows_of(got) == rows_of(wanted)
