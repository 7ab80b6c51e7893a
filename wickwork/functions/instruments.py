"""Instruments: tick and lot arithmetic, roles, invariants, and the registry as two small tables."""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "symbol string, name string, kind string, role string, lot_size int, tick_size double, exchange string, notes string"
SIGNAL_ROLES, TRADED_ROLES = ("SIGNAL", "SIGNAL_AND_EXECUTION"), ("EXECUTION", "SIGNAL_AND_EXECUTION")


class RegistryError(LookupError):
    """An instrument is unknown, unverified or not selected."""


def round_to_tick(price: Column, tick: Column) -> Column:
    """Half-even to whole ticks, then to ten places; without a tick the price itself."""
    return F.when(tick.isNull(), price).otherwise(F.bround(F.bround(price / tick) * tick, 10))


def lots_for_quantity(quantity: Column, lot: Column) -> Column:
    """Whole lots, rounded down (also below zero)."""
    return F.floor(quantity / lot).cast("long")


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf)


def z_score(x: Column, mean: Column, deviation: Column) -> Column:
    return F.abs((x - mean) / deviation)


def can_generate_signals(role: Column) -> Column:
    return role.isin(*SIGNAL_ROLES)


def is_tradable(role: Column) -> Column:
    return role.isin(*TRADED_ROLES)


def require_tradable(role: Column, value: Column) -> Column:
    return F.when(is_tradable(role), value).otherwise(F.raise_error(F.concat(F.lit("not tradable: role "), F.coalesce(role, F.lit("null")))))


def violations(instruments: DataFrame) -> DataFrame:
    """Rows that break an invariant, with its name: lots of at least 1, positive ticks, indices only for signals."""
    broken = F.filter(
        F.array(
            F.when(F.coalesce(F.col("lot_size") < 1, F.lit(False)), F.lit("lot_size")),
            F.when(F.coalesce(F.col("tick_size") <= 0, F.lit(False)), F.lit("tick_size")),
            F.when((F.col("kind") == "INDEX") & (F.col("role") != "SIGNAL"), F.lit("index_role")),
        ),
        lambda x: x.isNotNull(),
    )
    return instruments.select("symbol", F.explode(broken).alias("broken"))


def load_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(signal instruments, execution candidates) of a YAML file; missing lots are 1, missing symbols null."""
    import yaml

    data = yaml.safe_load(Path(path).read_text()) or {}

    def rows(key: str, more: tuple[str, ...]) -> list[tuple]:
        items = data.get(key) or []
        items = [{"id": k, **(v or {})} for k, v in items.items()] if isinstance(items, dict) else items
        return [
            (x.get("symbol"), x.get("name") or x.get("id"), str(x.get("kind", "")).upper(), str(x.get("role", "")).upper(), int(x.get("lot_size") or 1), None if x.get("tick_size") is None else float(x["tick_size"]), x.get("exchange"), x.get("notes"))
            + tuple(bool(x.get(m, False)) for m in more)
            for x in items
        ]

    return spark.createDataFrame(rows("signal_instruments", ()), FIELDS), spark.createDataFrame(rows("execution_candidates", ("verified",)), FIELDS + ", verified boolean")


def signal(instruments: DataFrame, symbol: str) -> DataFrame:
    found = instruments.where(F.col("symbol") == symbol)
    if not found.limit(1).count():
        known = sorted(r.symbol or "" for r in instruments.select("symbol").collect())
        raise RegistryError(f"no signal instrument {symbol!r}; known: {known}")
    return found


def selected_execution_instrument(candidates: DataFrame) -> DataFrame:
    raise RegistryError("no execution instrument has been selected")


def require_verified(candidates: DataFrame, symbol: str) -> DataFrame:
    found = candidates.where(F.col("symbol") == symbol)
    if not found.where("verified").limit(1).count():
        raise RegistryError(f"{symbol!r} isn't a verified candidate")
    return found
