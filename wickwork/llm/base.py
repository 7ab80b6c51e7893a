"""What the corpus operators share: word rules, safe table access and cutting of lineage.

A word is a run of ``[^\\x20\\x09-\\x0D]``. ``bytes.split()`` splits at just these characters, which
is why the Python parts work on UTF-8 bytes; the native parts use the patterns below.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that ends a word, and the letters that are lower-cased.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t-\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bounds of met_by_key, met_by_salt and without.
HOT_ROWS, HOT_KEYS, SALTS = 1_000, 100_000, 16
FEW_GONE = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: the session's ``spark.checkpoint.dir``.

    Where that is unset a new temporary folder is used, but on one machine only: on a cluster it would be lost
    with its executor, so there that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="wickwork-"))
    return context.getCheckpointDir()


def cut(df: DataFrame, per_task: int = 0) -> DataFrame:
    """The same rows, read back from files in the shared folder.

    With per_task the rows are read back by as many tasks as hold about that many each: many tasks with few
    rows would fill later shuffles with small files.
    """
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    return out.coalesce(max(1, -(-out.count() // per_task))) if per_task else out


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing will read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def met_by_key(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """rows joined with table, which has one row a key, by key; weight is how many of the rows hold it.

    Keys of many rows are sent to all tasks, so that their rows stay where they are: there can't be more than
    HOT_KEYS of them, as each holds at least that share of all rows. Only the other keys are dealt.
    """
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    is_hot = F.col(weight) >= max(HOT_ROWS, total // HOT_KEYS + 1)
    hot = table.where(is_hot)
    met = rows.join(F.broadcast(hot), key)
    return met.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.where(~is_hot), key))


def row_of(*columns: str) -> Column:
    """With doc_id this tells a row from any of another text (or of whatever the columns hold)."""
    return F.xxhash64(*columns).alias("row")


def without(docs: DataFrame, gone: DataFrame, *columns: str) -> DataFrame:
    """The rows of docs, untouched, that aren't in gone (doc_id, row: row_of the columns).

    Up to FEW_GONE of those are sent to all tasks; more meet the documents in a shuffle.
    """
    gone = cut(gone.select("doc_id", "row").distinct())
    held = docs.select(F.struct(*docs.columns).alias("held"), "doc_id", row_of(*columns))
    few = gone.limit(FEW_GONE + 1).count() <= FEW_GONE
    same = F.col("h.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("h.row") == F.col("g.row"))
    return held.alias("h").join((F.broadcast(gone) if few else gone).alias("g"), same, "left_anti").select("held.*")


def met_by_salt(rows: DataFrame, table: DataFrame, key: str, other: str, salt: Column, few: int, how: str = "inner") -> DataFrame:
    """rows joined with table, which has one row a key, where key equals other or both are null.

    A table of up to ``few`` rows is sent to all tasks. A larger one is joined by key and a salt, each of its
    rows once for every salt, so that a hot key's rows are spread over SALTS tasks.
    """
    if table.limit(few + 1).count() <= few:
        return rows.join(F.broadcast(table), F.col(key).eqNullSafe(F.col(other)), how)
    salted = table.withColumn("table_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    met = rows.withColumn("row_salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(salted, F.col(key).eqNullSafe(F.col(other)) & (F.col("row_salt") == F.col("table_salt")), how)
    return met.drop("row_salt", "table_salt")


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null or blank texts."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RUN))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())
