"""A vendor as a Spark data source: one partition a chunk, so chunks are read in parallel.

``fetch`` is any picklable function (symbol, resolution, from date, to date) -> JSON text. With a pause chunks are
read by one task, or by as many as ``partitions`` says, which then wait so many times as long: together they make one
request a pause. A VendorError is recorded as a failed chunk. Filters on the columns of a chunk reach the source (where
``spark.sql.python.filterPushdown.enabled`` is on): chunks that they leave out are never requested.
"""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from wickwork.operators.schema import KEYS
from wickwork.sources.payloads import DAILY_DAYS, INTRADAY_DAYS, Fetch, VendorError, check_resolution

SCHEMA = "symbol string, resolution string, chunk int, from_date date, to_date date, payload string"


class Chunks(InputPartition):
    """(symbol, resolution, chunk, first day, last day) of each, and the task's number of how many."""

    def __init__(self, chunks: list[tuple[str, str, int, datetime.date, datetime.date]], task: int = 0, tasks: int = 1) -> None:
        super().__init__(chunks)
        self.task, self.tasks = task, tasks


def chunks_of(symbol: str, resolution: str, start: datetime.date, end: datetime.date) -> list[tuple[str, str, int, datetime.date, datetime.date]]:
    """Contiguous, inclusive chunks, as payloads.plan_chunks makes them."""
    check_resolution(resolution)
    if end < start:
        raise ValueError("end is before start")
    days = datetime.timedelta(days=DAILY_DAYS if resolution == "1D" else INTRADAY_DAYS)
    out, at = [], start
    while at <= end:
        out.append((symbol, resolution, len(out), at, min(at + days - datetime.timedelta(days=1), end)))
        at += days
    return out


def requested(options: dict[str, str]) -> list[tuple[str, str]]:
    """(symbol, resolution) of the options: symbols and resolutions are lists with commas."""
    return [(s, r) for s in options["symbol"].split(",") for r in options["resolution"].split(",")]


#: Filters of Spark that a chunk's columns can answer.
ANSWERS = {
    "EqualTo": lambda x, v: x == v, "GreaterThan": lambda x, v: x > v, "GreaterThanOrEqual": lambda x, v: x >= v, "LessThan": lambda x, v: x < v, "LessThanOrEqual": lambda x, v: x <= v, "In": lambda x, v: x in v,
    "StringStartsWith": lambda x, v: x.startswith(v), "StringEndsWith": lambda x, v: x.endswith(v), "StringContains": lambda x, v: v in x, "IsNotNull": lambda x, v: True,
}
CHUNK_COLUMNS = [*KEYS, "chunk", "from_date", "to_date"]


def answered(fetch: Fetch, chunk: tuple[str, str, int, datetime.date, datetime.date]) -> tuple:
    """The chunk with its payload."""
    symbol, resolution, _, a, b = chunk
    try:
        return *chunk, fetch(symbol, resolution, a, b)
    except VendorError as error:
        return *chunk, json.dumps({"s": "error", "message": str(error)})


def is_ok(payload: str) -> bool:
    """Whether texts.vendor_status would say ok, for use inside a reader."""
    try:
        answer = json.loads(payload)
    except ValueError:
        return False
    return isinstance(answer, dict) and answer.get("s") == "ok" and "candles" in answer


def provider(name: str, fetch: Fetch) -> type[DataSource]:
    """A data source class to register. Options: symbol, resolution (lists with commas), start, end, partitions, pause (seconds)."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]) -> None:
            days = [datetime.date.fromisoformat(options[k]) for k in ("start", "end")]
            self.chunks = [c for s, r in requested(options) for c in chunks_of(s, r, *days)]
            self.pause = float(options.get("pause", "0"))
            self.count = int(options.get("partitions", "0")) or (1 if self.pause else len(self.chunks))

        def partitions(self) -> list[InputPartition]:
            n = max(1, min(self.count, len(self.chunks)))
            return [Chunks(self.chunks[i::n], i, n) for i in range(n)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            for i, chunk in enumerate(partition.value):
                if self.pause and (i or partition.task):
                    time.sleep(self.pause * (partition.tasks if i else partition.task))
                yield answered(fetch, chunk)

    class FilteringReader(Reader):
        """Spark refuses readers with pushFilters where the setting is off."""

        def pushFilters(self, filters: list) -> Iterator:
            for f in filters:
                answer, column = ANSWERS.get(type(f).__name__), ".".join(f.attribute) if hasattr(f, "attribute") else None
                if answer and column in CHUNK_COLUMNS:
                    at = CHUNK_COLUMNS.index(column)
                    self.chunks = [c for c in self.chunks if answer(c[at], getattr(f, "value", None))]
                else:
                    yield f

    class Increments(DataSourceStreamReader):
        """The days up to ``end`` (today where it isn't given) that no committed batch has had yet; the offset is the last day.

        A failed chunk fails its batch, which is asked again by the next run, unless the option failed is "record".
        """

        def __init__(self, options: dict[str, str]) -> None:
            self.options = options
            self.start, self.end = datetime.date.fromisoformat(options["start"]), datetime.date.fromisoformat(options.get("end") or datetime.date.today().isoformat())
            self.pause = float(options.get("pause", "0"))
            self.count = int(options.get("partitions", "0")) or (1 if self.pause else 10_000)
            for _, resolution in requested(options):
                check_resolution(resolution)

        def initialOffset(self) -> dict:
            return {"day": (self.start - datetime.timedelta(days=1)).isoformat()}

        def latestOffset(self) -> dict:
            return {"day": max(self.end, self.start - datetime.timedelta(days=1)).isoformat()}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            a, b = datetime.date.fromisoformat(start["day"]) + datetime.timedelta(days=1), datetime.date.fromisoformat(end["day"])
            # numbered by their first day, so that numbers go on from batch to batch
            found = [(s, r, (first - self.start).days, first, last) for s, r in requested(self.options) for _, _, _, first, last in (chunks_of(s, r, a, b) if a <= b else [])]
            n = max(1, min(self.count, len(found)))
            return [Chunks(found[i::n], i, n) for i in range(n)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            for i, chunk in enumerate(partition.value):
                if self.pause and (i or partition.task):
                    time.sleep(self.pause * (partition.tasks if i else partition.task))
                row = answered(fetch, chunk)
                if self.options.get("failed") != "record" and not is_ok(row[-1]):
                    raise VendorError(f"{chunk[0]} {chunk[1]} from {chunk[3]} to {chunk[4]}: {row[-1][:200]}")
                yield row

        def commit(self, end: dict) -> None:
            """Nothing is held for days that are done."""

    class Provider(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return (FilteringReader if self.options.get("pushdown") == "true" else Reader)(dict(self.options))

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Increments(dict(self.options))

    return Provider


def read_payloads(spark: SparkSession, source: type[DataSource], **options: object) -> DataFrame:
    spark.dataSource.register(source)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format(source.name()).options(pushdown=pushdown, **{k: str(v) for k, v in options.items()}).load()


def stream_payloads(spark: SparkSession, source: type[DataSource], **options: object) -> DataFrame:
    """The same as a stream: a query with a checkpoint and the trigger availableNow asks for the days that are new."""
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).options(**{k: str(v) for k, v in options.items()}).load()
