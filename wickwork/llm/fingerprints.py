"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is the multiset of its words, each with its count S as weight. For every word and each of SAMPLES samples a
hash gives r and c, both of the gamma distribution with shape 2, and b, uniform in [0, 1). With t = floor(ln S / r + b)
the word's mark is ln c - r (t - b + 1), and the sample is the (word, t) of the least mark. The share of equal
samples of two texts has the generalised Jaccard similarity of their word counts as its mean. A fingerprint has 16
bits of each sample as four hexadecimal digits.

The next document is found without a sort of the whole table: rows are dealt once, by blocks of ids about BLOCK
wide, and only the first text of each block goes on to the block before. Words are then counted, and the samples
taken, in the task that holds their text: neither words nor marks are shuffled. r and c come from LEVELS quantiles.
Where ids are so uneven that a block has more than MOST rows, ids are numbered first (by number_ids), texts that
repeat under one id are counted once, and blocks are made of numbers: one more shuffle of the texts, the same rows.

Defined results: a null text is empty. Rows are in the order of doc_id (null first) and then of the text's hash, so
repeated rows follow each other, each the next of the one before; the last row's next is the first, which may be the
row itself. All texts without words have the same fingerprint. An empty table has no rows. Other columns are ignored.
A text is held by one task, as it is in the table; nothing else is gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.llm.base import cut, table, words_of

SAMPLES, LEVELS, AT_ONCE = 64, 4096, 16
#: Rows of a block, of the largest one, and of a task, of which there are no more than MOST_TASKS: beyond, tasks grow and their word counts may spill.
BLOCK, MOST, PER_TASK, MOST_TASKS = 64, 4096, 2048, 200_000
# Bits of a mark: FRACTION of its fraction, SIGN of the sample.
FRACTION, SIGN = 40, 16


def gamma_quantiles(levels: int = LEVELS) -> list[float]:
    """The middle of each of so many equally likely parts of the gamma distribution with shape 2: 1 - exp(-x) (1 + x) = p."""
    out = []
    for i in range(levels):
        p, low, high = (i + 0.5) / levels, 0.0, 64.0
        for _ in range(60):
            x = (low + high) / 2
            low, high = (x, high) if 1 - math.exp(-x) * (1 + x) < p else (low, x)
        out.append((low + high) / 2)
    return out


def _tables(spark: SparkSession) -> tuple[Column, Column]:
    """The quantiles of r and of ln c, as two values of one row each."""
    q = gamma_quantiles()
    one = spark.createDataFrame([(q, [math.log(x) for x in q])], "r array<double>, c array<double>")
    return one.select("r").scalar(), one.select("c").scalar()


def _mark(k: Column, r_of: Column, c_of: Column) -> Column:
    """Sample k's mark of the word with hash ``term`` and log weight ``ls``: a number to take the least of, the sample in its last bits."""
    z = F.xxhash64("term", k)
    part = lambda at, n: F.shiftright(z, at).bitwiseAND(F.lit(n - 1))
    r, c = F.get(r_of, part(0, LEVELS).cast("int")), F.get(c_of, part(12, LEVELS).cast("int"))
    b = (part(24, 1 << 20).cast("double") + 0.5) / float(1 << 20)
    t = F.floor(F.col("ls") / r + b)
    mark = F.floor((c - r * (t.cast("double") - b + 1.0) + 64.0) * float(1 << FRACTION))
    return F.shiftleft(mark, SIGN).bitwiseOR((part(44, 1 << SIGN) + t * 40503).bitwiseAND(F.lit((1 << SIGN) - 1)))


def number_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n, place): every distinct (doc_id, h) with its number of rows and its place in order, from 0.

    Ranges of the order are counted, and the sums of the ranges before are added: no task has more than a range.
    """
    spark = docs.sparkSession
    ids = docs.groupBy("doc_id", "h").agg(F.count("*").alias("n"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    ranged = cut(ids.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("range").agg(F.count("*").alias("rows")).withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))  # a row a range
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return ranged.withColumn("place", place).join(F.broadcast(ranges), "range").select("doc_id", "h", "n", (F.col("place") + F.col("start")).alias("place"))


def _blocked(docs: DataFrame, most: int) -> tuple[DataFrame, int]:
    """docs (doc_id, h, text) with block and copies, and how many tasks to deal them to. A later block has later ids."""
    span = docs.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).first()
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-span.n // PER_TASK), MOST_TASKS))
    low = span.a or 0
    width = max(1.0, float((span.b or 0) - low + 1) * BLOCK / max(1, span.n))
    block = F.coalesce(F.floor((F.col("doc_id").cast("double") - float(low)) / width), F.lit(-1)).alias("block")
    if (docs.groupBy(block).count().agg(F.max("count")).first()[0] or 0) <= most:
        return docs.select("*", block, F.lit(1).cast("long").alias("copies")), tasks
    places = number_ids(docs)
    once = docs.dropDuplicates(["doc_id", "h"]).alias("d").join(places.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.h") == F.col("p.h")))
    return once.select("d.*", F.floor(F.col("place") / BLOCK).alias("block"), F.col("n").alias("copies")), tasks


def with_next(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(block, pos, copies, last, doc_id, text, next): each row's next text; last: whether that is of another block."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    rows, tasks = _blocked(rows, most)
    w = Window.partitionBy("block").orderBy(F.col("doc_id").asc_nulls_first(), "h")
    placed = rows.repartition(tasks, "block").withColumns({"pos": F.row_number().over(w), "after": F.lead("text").over(w)})
    # blocks in order: those of a wide block meet, then one row for each wide block
    blocks = rows.select("block").distinct().withColumn("wide", F.floor(F.col("block") / MOST))
    wide = blocks.groupBy("wide").agg(F.min("block").alias("first"))
    following = F.lead("first").over(Window.orderBy("wide"))
    wide = wide.select("wide", F.coalesce(following, F.min("first").over(Window.partitionBy(F.lit(1)))).alias("next_first"))
    pairs = blocks.withColumn("next_block", F.lead("block").over(Window.partitionBy("wide").orderBy("block"))).join(wide, "wide")
    pairs = pairs.select("block", F.coalesce("next_block", "next_first").alias("next_block"))
    firsts = placed.where("pos = 1").select(F.col("block").alias("next_block"), F.col("text").alias("first_text")).join(pairs, "next_block").drop("next_block")
    # a merge join keeps the blocks where they are, so that no later step deals the texts or their words again
    met = placed.join(firsts.hint("merge"), "block")
    return met.select("block", "pos", "copies", F.col("after").isNull().alias("last"), "doc_id", "text", F.coalesce("after", "first_text").alias("next"))


def edited_text(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by as many of the next text's first."""
    n, m = F.length(text), F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - m), F.substring(following, F.lit(1), m))


def likeness(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / float(SAMPLES)


def _hex(signs: Column) -> Column:
    return F.array_join(F.transform(signs, lambda x: F.lpad(F.hex(x), SIGN // 4, "0")), "")


def fingerprints(docs: DataFrame, most: int = MOST) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    r_of, c_of = _tables(docs.sparkSession)
    rows = with_next(docs, most)
    keys = ["block", "pos", "copies", "last", "doc_id", "n_chars", "sha"]
    # a text that repeats under its id has itself as next, but for its last row: both edits are made
    twins = F.when(F.col("copies") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("own", F.explode(twins)).withColumns({"next": F.when(F.col("own") == 1, F.col("text")).otherwise(F.col("next")), "copies": F.when(F.col("own") == 1, F.col("copies") - 1).otherwise(1)})
    rows = rows.withColumn("last", F.col("last") | (F.col("own") == 1)).withColumn("pos", F.col("pos") * 2 - F.col("own"))
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next")))
    texts = F.when(F.col("last"), F.array("text", "edited", "next")).otherwise(F.array("text", "edited"))
    held = rows.select("block", "pos", "copies", "last", "doc_id", F.length("text").cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("sha"), F.posexplode(texts).alias("of", "body"))
    words = held.select(*keys, "of", F.explode_outer(words_of(F.col("body"))).alias("word"))
    counts = words.groupBy(*keys, F.xxhash64("word").alias("term")).agg(*(F.count_if(F.col("of") == i).alias(f"n{i}") for i in range(3)))
    # groups of words: 0 with another weight in the edited text, 1 there, 2 with the same in both, 3 in the next text
    same = F.col("n0") == F.col("n1")
    none = F.lit(0).cast("long")
    weights = F.array(F.when(same, none).otherwise(F.col("n0")), F.when(same, none).otherwise(F.col("n1")), F.when(same, F.col("n0")).otherwise(none), F.col("n2"))
    weighed = counts.select(*keys, "term", F.posexplode(weights).alias("part", "weight")).where("weight > 0").withColumn("ls", F.log(F.col("weight").cast("double")))
    # a few samples at a time: the code of all at once would be too long for the JVM to compile
    groups = weighed.select(*keys, "part", "term", "ls", F.explode(F.array(*map(F.lit, range(0, SAMPLES, AT_ONCE)))).alias("at"))
    least = groups.groupBy(*keys, "part", "at").agg(*(F.min(_mark(F.col("at") + k, r_of, c_of)).alias(f"m{k}") for k in range(AT_ONCE)))
    least = least.select(*keys, F.struct("part", "at", F.array(*(f"m{k}" for k in range(AT_ONCE))).alias("m")).alias("s"))
    marks = least.groupBy(*keys).agg(F.array_sort(F.collect_list("s")).alias("s"))
    of_part = lambda i: F.flatten(F.transform(F.filter("s", lambda x: x["part"] == i), lambda x: x["m"]))
    marks = marks.withColumns({f"p{i}": of_part(i) for i in range(4)})
    least_of = lambda a, b: F.when(F.size(a) == 0, F.col(b)).when(F.size(b) == 0, F.col(a)).otherwise(F.zip_with(a, b, lambda x, y: F.least(x, y)))
    sign = lambda m: F.transform(m, lambda x: x.bitwiseAND(F.lit((1 << SIGN) - 1)))
    signs = marks.select(*keys, sign(least_of("p0", "p2")).alias("a"), sign(least_of("p1", "p2")).alias("b"), F.when(F.size("p3") > 0, sign(F.col("p3"))).alias("c"))
    signs = signs.withColumn("c", F.coalesce("c", F.lead("a").over(Window.partitionBy("block").orderBy("pos"))))
    out = signs.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), _hex(F.col("a")).alias("fingerprint"), _hex(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"), "copies",
    )
    return out.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
