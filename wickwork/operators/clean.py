"""Cleaning by named operations, each with its audit; the default changes no value and drops no row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.operators.schema import COLUMNS, KEYS, SEQ, normalise, resequenced


@dataclass
class CleaningRecord:
    operations: list[str] = field(default_factory=list)
    rows_before: int = 0
    rows_after: int = 0

    def to_dict(self) -> dict:
        return asdict(self) | {"rows_removed": self.rows_before - self.rows_after}


def drop_exact_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row of each that agree in keys and all six columns: the first by ``_seq``."""
    return df.groupBy(*KEYS, *COLUMNS).agg(F.min(SEQ).alias(SEQ)).select(*df.columns)


def drop_conflicting_duplicate_timestamps(df: DataFrame, keep: str | bool = "first") -> DataFrame:
    """Lossy: one row of each time, the first or the last by ``_seq``; with keep=False none of a repeated time."""
    same = Window.partitionBy(*KEYS, "ts")
    if keep is False:
        return df.withColumn("_n", F.count("*").over(same)).where("_n = 1").drop("_n")
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    order = F.col(SEQ).asc() if keep == "first" else F.col(SEQ).desc()
    return df.withColumn("_n", F.row_number().over(same.orderBy(order))).where("_n = 1").drop("_n")


def sort_by_timestamp(df: DataFrame) -> DataFrame:
    """Time order, rows of equal times as they were. Order is a column here, so ``_seq`` is numbered anew."""
    return resequenced(df)


def conflicting_timestamps(df: DataFrame) -> DataFrame:
    """(symbol, resolution, n): times that still repeat, with different values, after exact duplicates are gone."""
    times = drop_exact_duplicate_rows(df).groupBy(*KEYS, "ts").count().where("count > 1 and ts is not null")
    return times.groupBy(*KEYS).agg(F.count("*").alias("n"))


OPERATIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "drop_exact_duplicate_rows": drop_exact_duplicate_rows,
    "drop_conflicting_duplicate_timestamps": drop_conflicting_duplicate_timestamps,
    "sort_by_timestamp": sort_by_timestamp,
}


def clean(df: DataFrame, operations: Sequence[str] | None = None) -> tuple[DataFrame, CleaningRecord]:
    """Normalise, then the named operations in order."""
    if unknown := [o for o in operations or () if o not in OPERATIONS]:
        raise ValueError(f"unknown cleaning operation(s) {unknown}; known: {sorted(OPERATIONS)}")
    out, record = normalise(df, ordered=not operations), CleaningRecord(rows_before=df.count())
    for name in operations or ():
        out = out.transform(OPERATIONS[name])
        record.operations.append(name)
    record.rows_after = out.count() if operations else record.rows_before
    return out, record
