"""Fetch, clean, validate, store: one call for many datasets, and its command line."""

from __future__ import annotations

import argparse
import datetime
import importlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wickwork.operators import clean, validate
from wickwork.operators.schema import resequenced
from wickwork.plans import store
from wickwork.plans.scratch import kept
from wickwork.sources import payloads, probe, provider


@dataclass
class Outcome:
    candles: DataFrame
    coverage: DataFrame
    issues: DataFrame
    cleaning: clean.CleaningRecord
    manifests: DataFrame | None = None
    refusal: str | None = None

    def summary(self) -> str:
        lines = [f"{r.symbol} {r.resolution}: {r.requested} chunks, {r.failed} failed, {r.rows} rows, {r.removed} repeated, {r.conflicting} conflicting" for r in self.coverage.collect()]
        return "\n".join([*lines, validate.report_text(self.issues, validate.envelope(self.candles)), self.refusal or ("stored" if self.manifests is not None else "not stored")])


def download(answers: DataFrame, root: str | None, *, source: str, operations: Sequence[str] | None = None, rules: validate.Rules = validate.Rules(), notes: str = "", force: bool = False) -> Outcome:
    """answers: a payload table (wickwork.sources.payloads). With root None nothing is stored. A refusal is returned, not raised."""
    rows, chunks, coverage = payloads.fetch(answers)
    cleaned, record = clean.clean(rows, operations)
    cleaned = kept(resequenced(cleaned))
    found = validate.issues(cleaned, rules, requested=answers.select("symbol", "resolution"))
    out = Outcome(cleaned, coverage, found, record)
    if not cleaned.head(1):
        out.refusal = "refused: no rows"
    elif root is not None:
        try:
            out.manifests = store.write(cleaned, root, source=source, found=found, coverage=coverage, chunks=chunks, cleaning=record, notes=notes, force=force)
        except (store.UnvalidatedDataError, store.IncompleteAcquisitionError) as error:
            out.refusal = str(error)
    return out


def exit_code(outcome: Outcome) -> int:
    """0 if all that was stored is authoritative, else 1."""
    return int(outcome.manifests is None or bool(outcome.manifests.where("not is_authoritative").head(1)))


def _fetcher(name: str) -> payloads.Fetch:
    """The vendor's function (symbol, resolution, first day, last day) -> payload, by "module:function"."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _probe(spark: SparkSession, a: argparse.Namespace) -> int:
    """0 and the first day found, or 1 where no window has candles."""
    asked = spark.createDataFrame([(a.symbol, a.resolution, a.start, a.end)], "symbol string, resolution string, oldest date, newest date")
    found = probe.earliest(asked, probe.live_answer(_fetcher(a.fetch), a.pause, a.partitions)).first().earliest
    print(found or "no data in the probed range")
    return int(found is None)


def main(argv: Sequence[str] | None = None) -> int:
    """Exit codes: 0 authoritative (or, with --no-persist, usable; with --probe, found), 1 not, 2 usage, 3 authentication."""
    p = argparse.ArgumentParser(prog="wickwork", description="Store vendor payloads (Parquet: symbol, resolution, chunk, from_date, to_date, payload, or a vendor's function) as validated candles, or check stored ones.")
    p.add_argument("root")
    p.add_argument("--payloads")
    p.add_argument("--fetch", metavar="MODULE:FUNCTION", help="a vendor's function; needs --symbol, --resolution, --start and --end")
    p.add_argument("--symbol")
    p.add_argument("--resolution")
    p.add_argument("--start", type=datetime.date.fromisoformat)
    p.add_argument("--end", type=datetime.date.fromisoformat)
    p.add_argument("--pause", type=float, default=0.25, help="seconds from one request to the next, over all tasks")
    p.add_argument("--partitions", type=int, default=1, help="tasks that fetch")
    p.add_argument("--probe", action="store_true", help="with --fetch: only find the first day that has data")
    p.add_argument("--check", nargs=2, metavar=("SYMBOL", "RESOLUTION"))
    p.add_argument("--since", type=datetime.date.fromisoformat)
    p.add_argument("--clean", action="append", choices=sorted(clean.OPERATIONS))
    p.add_argument("--force", action="store_true")
    p.add_argument("--no-persist", action="store_true")
    a = p.parse_args(argv)
    if sum(map(bool, (a.payloads, a.fetch, a.check))) != 1 or a.probe and not a.fetch:
        p.error("give one of --payloads, --fetch and --check; --probe goes with --fetch")
    if a.fetch and not (a.symbol and a.resolution and a.start and a.end and a.start <= a.end):
        p.error("--fetch needs --symbol, --resolution, --start and --end in order")
    if a.fetch:
        try:
            payloads.check_resolution(a.resolution)
        except ValueError as error:
            p.error(str(error))
    spark = SparkSession.builder.appName("wickwork").getOrCreate()
    if a.check:
        return store.revalidate(spark, a.root, *a.check)
    try:
        if a.probe:
            return _probe(spark, a)
        if a.fetch:
            options = {"symbol": a.symbol, "resolution": a.resolution, "start": a.start, "end": a.end, "pause": a.pause, "partitions": a.partitions}
            answers = kept(provider.read_payloads(spark, provider.provider("wickwork_cli", _fetcher(a.fetch)), **options))
        else:
            answers = spark.read.parquet(a.payloads)
        if a.since:
            answers = answers.where(answers["to_date"] >= a.since)
        outcome = download(answers, None if a.no_persist else a.root, source=a.payloads or a.fetch, operations=a.clean, force=a.force)
    except payloads.AuthError as error:
        print(error)
        return 3
    print(outcome.summary())
    if a.no_persist:
        return int(outcome.refusal is not None or bool(validate.by_severity(outcome.issues, "ERROR").head(1)))
    return exit_code(outcome)
