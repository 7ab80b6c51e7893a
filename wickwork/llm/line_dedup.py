"""Line dedup: lines that many documents share stay only in the document with the largest id.

Lines are exploded with their positions and hashed to 128 bits; the documents of a hash are counted exactly,
in two steps (by hash and document, then by hash), so a line that a third of the corpus holds is spread over
all tasks before it meets in one row. The common hashes meet the lines again: those of many documents are sent
to all tasks (a bounded number), the others are dealt by hash. The texts move once, to meet the positions that
they lose, and are joined again by the positions that are left; time is linear in a text's lines.

Defined results: a null or empty text is one empty line. A document without an id is not counted and
loses no line. Rows that repeat an id count as one document; each loses the same lines, and time is linear in
their number. Very long texts are one row like any other, their lines an array of it. An empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm.base import SPACE, ascii_lower, cut, met_by_key, table


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(40), key).alias("b"))


def shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, row, lost: the positions of the lines that it loses), for rows that lose any; docs has a column row, the hash of the text."""
    lines = docs.where("doc_id is not null").select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    held = cut(keys.select("doc_id", "row", "pos", _hash(F.col("key")).alias("hash")))
    common = held.select("doc_id", "hash").distinct().groupBy("hash").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
    lost = met_by_key(held, cut(common.where(F.col("docs") >= min_docs)), "hash", "docs").where(F.col("doc_id") < F.col("keeper"))
    # a set: rows that repeat give each position once, however often they do
    return lost.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("lost"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per row of docs: doc_id, n_lines (before), n_dropped, kept_text."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    # rows without an id are dealt by their texts; the lines are an array before the exchange, so that they aren't cut again for each position
    met = docs.select("doc_id", "row", F.split("text", "\n").alias("lines")).join(shared_lines(docs, min_chars, min_docs), ["doc_id", "row"], "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    stays = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    return met.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"), F.array_join(stays, "\n").alias("kept_text"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), common as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), marked as (
  select k.*, (c.keeper is not null and k.doc_id < c.keeper) as lost from keyed k left join common c using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not lost), '')) as kept_sha256
from marked group by doc_id
"""
