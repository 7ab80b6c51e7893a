"""Gated Parquet storage of datasets with provenance, in snapshots.

A write makes a folder of its own, ``root/data/snapshot=ID`` (partitioned by symbol and resolution), then the
manifests ``root/manifests/snapshot=ID`` (a JSON row a dataset), and last the empty file ``root/commits/TIME-ID``.
Only snapshots with that file are read, and of each dataset its latest one: a write that was stopped anywhere before
leaves everything as it was. ``vacuum`` deletes what no reader can reach any more.

Nothing passes the driver but the names of the snapshots and, where a write is refused, a few of the reasons.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import os
import platform
import subprocess
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from importlib import metadata

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.functions import times
from wickwork.operators import validate
from wickwork.operators.clean import CleaningRecord
from wickwork.operators.schema import CANONICAL, COLUMNS, KEYS, PRICES, SEQ, assert_canonical, normalise, resequenced
from wickwork.operators.sketches import merged
from wickwork.plans.scratch import kept

MANIFEST = (
    "symbol string, resolution string, source string, fetched_at string, timezone string, row_count long, first_ts string, last_ts string, day_hash string, content_hash string, "
    "validation_status string, error_count long, warning_count long, validation_error_codes array<string>, fetch_status string, chunks_requested long, chunks_failed long, "
    "failed_chunks array<struct<from_date:string,to_date:string,status:string>>, forced boolean, notes string, requested_range map<string,string>, cleaning array<string>, rows_before_cleaning long, "
    "rows_after_cleaning long, software map<string,string>, git_revision string, returns_sketch string, times_sketch string"
)


class UnvalidatedDataError(RuntimeError):
    """The dataset has issues of severity ERROR."""


class IncompleteAcquisitionError(RuntimeError):
    """Chunks of the dataset failed."""


def is_authoritative() -> Column:
    """Valid, completely fetched and not forced. Always computed, never read."""
    return F.coalesce((F.col("validation_status") == "valid") & (F.col("fetch_status") == "complete") & ~F.col("forced"), F.lit(False))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by dataset and time to (symbol, resolution, content_hash); the digest goes on from batch to batch."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"symbol": [key[0]], "resolution": [key[1]], "content_hash": [digest.hexdigest()]}, schema=pa.schema([(c, pa.string()) for c in (*KEYS, "content_hash")]))

    for batch in batches:
        for symbol, resolution, at, *prices, volume in zip(*(batch[c].to_pylist() for c in (*KEYS, "t", *PRICES, "volume")), strict=True):
            if (symbol, resolution) != key:
                if key is not None:
                    yield row()
                key, digest = (symbol, resolution), hashlib.sha256((",".join(COLUMNS) + "\n").encode())
            cells = [at or "", *("" if p is None else f"{p:.10g}" for p in prices), "" if volume is None else str(volume)]
            digest.update((",".join(cells) + "\n").encode())
    if key is not None:
        yield row()


def exact_hashes(df: DataFrame) -> DataFrame:
    """(symbol, resolution, content_hash) of all datasets in one job: SHA-256 over the rows as CSV in time order, with ISO times, ten significant digits, empty for missing.

    A dataset is hashed by the task that it is dealt to, one row after the other, as the hash is defined; no task
    holds more than a batch of rows. Datasets side by side are what spreads.
    """
    order = [F.col("ts").asc_nulls_last(), *([SEQ] if SEQ in df.columns else [])]
    rows = df.repartition(*KEYS).sortWithinPartitions(*KEYS, *order).select(*KEYS, times.iso(F.col("ts")).alias("t"), *PRICES, "volume")
    return rows.mapInArrow(_digests, "symbol string, resolution string, content_hash string")


def content_hash(df: DataFrame) -> str:
    """exact_hashes of one dataset, whose keys aren't needed."""
    found = exact_hashes(df.withColumns({k: F.lit("") for k in KEYS})).first()
    return found.content_hash if found else hashlib.sha256((",".join(COLUMNS) + "\n").encode()).hexdigest()


def day_hashes(df: DataFrame) -> DataFrame:
    """The scalable hash (version "day-sha256"): per dataset a SHA-256 over its days' SHA-256, all on the executors.

    A day's rows are hashed as lines in order of time and then of the line, prices with ten significant digits. A
    day of a dataset is one group, so no task holds more than a day's rows of it.
    """
    price = lambda c: F.when(F.abs(c) == float("inf"), F.when(F.col(c) > 0, "inf").otherwise("-inf")).when(F.col(c).isNotNull() & ~F.isnan(c), F.format_string("%.9e", c))
    line = F.concat_ws(",", *(F.coalesce(x, F.lit("")) for x in (F.unix_micros("ts").cast("string"), *map(price, PRICES), F.col("volume").cast("string"))))
    rows = df.select(*KEYS, times.ist_day(F.col("ts")).alias("day"), "ts", line.alias("line"))
    joined = lambda order, text, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), by)
    days = rows.groupBy(*KEYS, "day").agg(F.sha2(joined("ts", "line", "\n"), 256).alias("h"))
    return days.groupBy(*KEYS).agg(F.sha2(joined("day", "h", ""), 256).alias("hash"))


@contextmanager
def _microseconds(spark: SparkSession) -> Iterator[None]:
    """While it lasts Parquet gets times as 64-bit microseconds, which have statistics to prune by, and not as INT96."""
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def git_revision(folder: str = ".") -> str:
    """The commit, with -dirty if files differ; empty if there is none. Never fails."""
    try:
        run = lambda *a: subprocess.run(["git", "-C", folder, *a], capture_output=True, text=True, timeout=5, check=True).stdout.strip()
        return run("rev-parse", "HEAD") + ("-dirty" if run("status", "--porcelain") else "")
    except (OSError, subprocess.SubprocessError):
        return ""


def software_versions(spark_version: str) -> dict[str, str]:
    def of(name: str) -> str:
        try:
            return metadata.version(name)
        except metadata.PackageNotFoundError:
            return "absent"

    return {"python": platform.python_version(), "spark": spark_version, "pyarrow": of("pyarrow")}


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    files, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def _commit(spark: SparkSession, root: str, snapshot: str) -> None:
    """The one step that makes a snapshot visible: a file is there or it isn't."""
    files, at = _files(spark, f"{root}/commits/{time.time_ns():020d}-{snapshot}")
    files.create(at, False).close()


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Committed snapshots, oldest first."""
    return [name.partition("-")[2] for name in _names(spark, f"{root}/commits")]


def _gate(tally: DataFrame, coverage: DataFrame | None) -> None:
    """Refuse datasets with errors or failed chunks, naming up to 20 of them."""
    listed = lambda bad: sorted((r.symbol, r.resolution) for r in bad.select(*KEYS).limit(20).collect())
    if bad := listed(tally.where("e > 0")):
        raise UnvalidatedDataError(f"refused: validation errors in {bad}")
    if coverage is not None and (bad := listed(coverage.where("failed > 0"))):
        raise IncompleteAcquisitionError(f"refused: failed chunks in {bad}")


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair)).cast("map<string,string>")


def write(
    df: DataFrame, root: str, *, source: str, found: DataFrame, coverage: DataFrame | None = None, chunks: DataFrame | None = None, requested_range: dict[str, str] | None = None,
    cleaning: CleaningRecord | None = None, notes: str = "", force: bool = False, exact: bool = False, sketches: DataFrame | None = None,
) -> DataFrame:
    """Store the datasets of df as a snapshot and return their manifest rows. found: validate.issues of them; coverage, chunks: of payloads.fetch.

    Nothing is written if any dataset has an ERROR or a failed chunk, unless forced, which is recorded. Rows
    without a symbol or resolution are refused in any case. The
    manifests hold the hashes by day; with exact also exact_hashes. Each is one job for all datasets. sketches:
    operators.sketches.day_sketches of df, which the manifests keep merged.
    """
    is_error, spark, snapshot = F.col("severity") == "ERROR", df.sparkSession, uuid.uuid4().hex
    tally = found.groupBy(*KEYS).agg(F.count_if(is_error).alias("e"), F.count_if(F.col("severity") == "WARNING").alias("w"), F.array_sort(F.collect_set(F.when(is_error, F.col("code")))).alias("codes"))
    tally = kept(tally)  # so that what was found isn't looked for again
    if not force:
        _gate(tally, coverage)
    rows = normalise(df, ordered=False)
    assert_canonical(rows.select(*(c for c in rows.columns if c != SEQ)))
    # folders are named by the keys
    rows = rows.withColumns({k: F.coalesce(k, F.raise_error(F.lit(f"refused: rows without a {k}")).cast("string")) for k in KEYS})
    # a task has a range of datasets and times, so that a large dataset is written by many and a small one by few
    ordered = rows.repartitionByRange(*KEYS, F.col("ts").asc_nulls_last()).sortWithinPartitions(*KEYS, F.col("ts").asc_nulls_last(), *([SEQ] if SEQ in rows.columns else []))
    with _microseconds(spark):
        ordered.drop(SEQ).write.option("compression", "snappy").partitionBy(*KEYS).parquet(f"{root}/data/snapshot={snapshot}")
    about = _manifests_of(spark, root, snapshot, tally, coverage, chunks, exact)
    if sketches is None:
        about = about.withColumns({"returns": F.lit(None).cast("binary"), "times": F.lit(None).cast("binary")})
    else:
        about = about.join(merged(sketches).drop("rows"), KEYS, "left")
    about.select(
        *KEYS, F.lit(source).alias("source"), F.lit(datetime.datetime.now(datetime.UTC).isoformat()).alias("fetched_at"), F.lit(times.IST).alias("timezone"), F.col("n").alias("row_count"), F.col("a").alias("first_ts"), F.col("b").alias("last_ts"),
        F.col("hash").alias("day_hash"), "content_hash", F.when(F.col("e") > 0, "invalid").otherwise("valid").alias("validation_status"), F.coalesce("e", F.lit(0)).alias("error_count"), F.coalesce("w", F.lit(0)).alias("warning_count"),
        F.coalesce("codes", F.array().cast("array<string>")).alias("validation_error_codes"), F.when(F.col("requested").isNull(), "unknown").when(F.col("failed") > 0, "partial").otherwise("complete").alias("fetch_status"),
        F.col("requested").alias("chunks_requested"), F.col("failed").alias("chunks_failed"), F.coalesce("lost", F.array().cast("array<struct<from_date:string,to_date:string,status:string>>")).alias("failed_chunks"), F.lit(force).alias("forced"), F.lit(notes).alias("notes"),
        _map(requested_range or {}).alias("requested_range"), F.array(*map(F.lit, cleaning.operations if cleaning else [])).cast("array<string>").alias("cleaning"), F.lit(cleaning and cleaning.rows_before).cast("long").alias("rows_before_cleaning"),
        F.lit(cleaning and cleaning.rows_after).cast("long").alias("rows_after_cleaning"), _map(software_versions(spark.version)).alias("software"), F.lit(git_revision(os.path.dirname(__file__))).alias("git_revision"),
        F.base64("returns").alias("returns_sketch"), F.base64("times").alias("times_sketch"),
    ).write.json(f"{root}/manifests/snapshot={snapshot}")
    _commit(spark, root, snapshot)
    return spark.read.schema(MANIFEST).json(f"{root}/manifests/snapshot={snapshot}").withColumn("is_authoritative", is_authoritative())


def _manifests_of(spark: SparkSession, root: str, snapshot: str, tally: DataFrame, coverage: DataFrame | None, chunks: DataFrame | None, exact: bool) -> DataFrame:
    """What the manifests say of each dataset of a snapshot, from its files: they are what will be read."""
    stored = _read_data(spark, root, [snapshot])
    about = stored.groupBy(*KEYS).agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).select(*KEYS, "n", times.iso(F.col("a")).alias("a"), times.iso(F.col("b")).alias("b"))
    out = about.join(day_hashes(stored), KEYS).join(tally, KEYS, "left")
    out = out.join(exact_hashes(stored), KEYS, "left") if exact else out.withColumn("content_hash", F.lit(None).cast("string"))
    if coverage is None:
        out = out.withColumns({"requested": F.lit(None).cast("long"), "failed": F.lit(None).cast("long")})
    else:
        out = out.join(coverage.select(*KEYS, "requested", "failed"), KEYS, "left")
    if chunks is None:
        return out.withColumn("lost", F.lit(None).cast("array<struct<from_date:string,to_date:string,status:string>>"))
    chunk = F.struct(F.col("from_date").cast("string").alias("from_date"), F.col("to_date").cast("string").alias("to_date"), "status")
    return out.join(chunks.where("not ok").groupBy(*KEYS).agg(F.array_sort(F.collect_list(chunk)).alias("lost")), KEYS, "left")


def _read_data(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Rows of these snapshots, with the column snapshot."""
    schema = T.StructType([*CANONICAL, *(T.StructField(k, T.StringType()) for k in ("snapshot", *KEYS))])
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*(f"{root}/data/snapshot={n}" for n in names))


def _current(spark: SparkSession, root: str) -> DataFrame:
    """Each dataset's latest committed manifest, with the column snapshot."""
    names = snapshots(spark, root)
    if not names:
        raise FileNotFoundError(f"no datasets under {root}")
    read = spark.read.schema(MANIFEST + ", snapshot string").option("basePath", f"{root}/manifests").json([f"{root}/manifests/snapshot={n}" for n in names])
    order = spark.createDataFrame(list(enumerate(names)), "_at long, snapshot string")  # a row a snapshot
    latest = read.join(F.broadcast(order), "snapshot").groupBy(*KEYS).agg(F.max_by(F.struct(*read.columns), "_at").alias("m"))
    return latest.select("m.*")


def _data(spark: SparkSession, root: str) -> DataFrame:
    """The rows of every dataset's latest snapshot."""
    latest = _current(spark, root).select("snapshot", *KEYS)
    return _read_data(spark, root, snapshots(spark, root)).join(latest, ["snapshot", *KEYS], "left_semi").drop("snapshot")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """All datasets' manifests, with authority computed anew: a stored claim counts for nothing."""
    return _current(spark, root).drop("snapshot").withColumn("is_authoritative", is_authoritative())


def stored_sketches(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, resolution, rows, returns, times) of the datasets that were stored with sketches, from the manifests alone."""
    found = _current(spark, root).where("returns_sketch is not null")
    return found.select(*KEYS, F.col("row_count").alias("rows"), F.unbase64("returns_sketch").alias("returns"), F.unbase64("times_sketch").alias("times"))


def read(spark: SparkSession, root: str, symbol: str, resolution: str) -> tuple[DataFrame, dict]:
    """One dataset, pruned to its snapshot and partition, and its manifest; both have to be there."""
    key = (F.col("symbol") == symbol) & (F.col("resolution") == resolution)
    found = _current(spark, root).where(key).withColumn("is_authoritative", is_authoritative()).head(1)
    if not found:
        raise FileNotFoundError(f"no manifest for {symbol} {resolution} under {root}")
    if f"snapshot={found[0].snapshot}" not in _names(spark, f"{root}/data"):
        raise FileNotFoundError(f"no data for {symbol} {resolution} under {root}")
    rows = _read_data(spark, root, [found[0].snapshot]).where(key).drop("snapshot")
    if not rows.head(1):
        raise FileNotFoundError(f"no data for {symbol} {resolution} under {root}")
    manifest = found[0].asDict(recursive=True)
    del manifest["snapshot"]
    return normalise(rows), manifest


def _unchanged(rows: DataFrame, manifest: dict, exact: bool = False) -> bool:
    found = day_hashes(rows).first()
    return bool(found) and found.hash == manifest["day_hash"] and (not exact or content_hash(rows) == manifest["content_hash"])


def verify_integrity(spark: SparkSession, root: str, symbol: str, resolution: str, exact: bool = False) -> bool:
    """Whether the stored rows are those of the manifest, by the hashes of their days; with exact by the serial hash as well."""
    return _unchanged(*read(spark, root, symbol, resolution), exact)


def verify_store(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, resolution, unchanged) of every dataset, in one job: its rows are there and hash as its manifest says."""
    said = manifests(spark, root).select(*KEYS, F.col("day_hash").alias("said"))
    return said.join(day_hashes(_data(spark, root)), KEYS, "left").select(*KEYS, F.coalesce(F.col("hash") == F.col("said"), F.lit(False)).alias("unchanged"))


def vacuum(spark: SparkSession, root: str, older_than: datetime.timedelta = datetime.timedelta(days=1)) -> list[str]:
    """Delete snapshots that no dataset has as its latest, and unfinished ones whose folder is older than that; returns their names.

    A reader that began on a replaced snapshot can fail, so older_than should exceed the longest read.
    """
    names = snapshots(spark, root)
    live = {r.snapshot for r in _current(spark, root).select("snapshot").distinct().collect()} if names else set()
    limit, gone = (time.time() - older_than.total_seconds()) * 1000, []
    for folder in sorted({*_names(spark, f"{root}/data"), *_names(spark, f"{root}/manifests")}):
        name = folder.partition("=")[2]
        paths = [_files(spark, f"{root}/{kind}/{folder}") for kind in ("data", "manifests")]
        if name in live or any(files.exists(at) and files.getFileStatus(at).getModificationTime() > limit for files, at in paths):
            continue
        for commit in (c for c in _names(spark, f"{root}/commits") if c.endswith(name)):
            files, at = _files(spark, f"{root}/commits/{commit}")
            files.delete(at, False)
        for files, at in paths:
            files.delete(at, True)
        gone.append(name)
    return gone


def manifest_json(manifest: dict) -> str:
    return json.dumps(manifest, indent=2, sort_keys=True)


def revalidate(spark: SparkSession, root: str, symbol: str, resolution: str, rules: validate.Rules = validate.Rules()) -> int:
    """0: usable and unchanged since it was written; 1: not; 2: not there."""
    try:
        rows, manifest = read(spark, root, symbol, resolution)
    except FileNotFoundError:
        return 2
    found = validate.issues(resequenced(rows.withColumn(SEQ, F.monotonically_increasing_id())), rules)
    usable = not validate.by_severity(found, "ERROR").head(1)
    return int(not (usable and _unchanged(rows, manifest)))
