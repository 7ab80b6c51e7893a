"""Mixing sources to target weights with hash-threshold histograms.

Sizes are summed by source and the leading bits of a hash of the row's id, text and place among its equals. A running sum over the buckets of
one source (at most 2 to the BITS of them) shows which bucket the budget ends in; only the rows of that
bucket are summed again, by the next bits. Three rounds leave a handful of rows, and a row is then taken
if its hash lies under its source's threshold: no sort of rows, and a larger budget always takes a
superset of a smaller one's rows. A source whose target exceeds its size is repeated: each document
whole times, and the rest by threshold.

A source's rows never meet in one task: partial sums are taken before every shuffle. The tables of
thresholds have one row per source; beyond BROADCAST_SOURCES rows they meet the documents by salt.

Defined results: a null text has size 0; null is a source of its own, last in order. Rows that share an id
differ by their text in the hash; rows with the same id and text are numbered, so that any of them can be taken
without the others, however many they are. Which of them have which number doesn't matter to the words taken. With
no words at all every target is 0, with no rows there are none. A very long text is sized within its row.
mix ignores other columns, mixed returns them untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.llm.base import cut, met_by_salt, table, words_of

BITS = 12
ROUNDS = 3
HASH_BITS = 60
BROADCAST_SOURCES = 20_000


def _texts(docs: DataFrame, *columns: Column) -> DataFrame:
    return docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), "source", *columns)


def numbered(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text_md5, source) with copy: 1, 2, ... among those that agree in all three.

    Most tables have no such rows and get 1 throughout. Where there are some, only they are written once and numbered
    in the tasks that hold them, after the counts of the tasks before, so that no group meets in one task.
    """
    keys = ["doc_id", "text_md5", "source"]
    renamed = [F.col(k).alias(f"r_{k}") for k in keys]
    repeated = cut(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*renamed))
    if not repeated.head(1):
        return rows.withColumn("copy", F.lit(1).cast("long"))
    same = F.col("text_md5") == F.col("r_text_md5")
    for k in ("doc_id", "source"):
        same = same & F.col(k).eqNullSafe(F.col(f"r_{k}"))
    again = cut(rows.join(repeated, same, "left_semi").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = again.groupBy(*keys, "part").agg(F.count("*").alias("n"))
    starts = starts.select(*renamed, F.col("part").alias("r_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy(*keys, "part").orderBy(F.lit(1)))
    met = again.withColumn("place", place).join(starts, same & (F.col("part") == F.col("r_part"))).withColumn("copy", (F.col("place") + F.col("start")).cast("long"))
    return rows.join(repeated, same, "left_anti").withColumn("copy", F.lit(1).cast("long")).unionByName(met.select(*rows.columns, "copy"))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h): h is the first 60 bits of the MD5 of the id, the text's MD5 and the row's number among its equals."""
    rows = numbered(cut(_texts(docs, F.size(words_of(F.col("text"))).cast("long").alias("size"))))
    return rows.select("doc_id", "source", "size", hash_of().alias("h"))


def hash_of() -> Column:
    whole = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_md5", F.col("copy").cast("string"))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    A target is weight x level, at most ``most`` times the source's size. With the sources in the order
    of size by weight, the sources that stop at their limit come first, so running sums give the level.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    before = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    ranked = ranked.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "left_w": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)),
    })
    ranked = ranked.withColumn("level", F.when(F.col("cap") / F.col("w") > F.col("left") / F.col("left_w"), F.col("left") / F.col("left_w")))
    level = F.max("level").over(everything)
    return ranked.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.col("w") * level).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, budget, t): rows with h < t have sizes that sum to nearly the budget of their source."""
    at = cut(budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("under")))
    for level in range(1, ROUNDS + 1):
        shift = HASH_BITS - BITS * level
        inside = met_by_salt(rows, at.withColumnRenamed("source", "at_source"), "source", "at_source", F.col("h"), BROADCAST_SOURCES).where(F.shiftright("h", shift + BITS) == F.col("prefix"))
        sums = inside.groupBy("source", "budget", "under", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size"))
        running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("over", F.col("under") + running)
        passed = F.col("over") <= F.col("budget")
        # the first bucket that doesn't fit whole, and the sizes under it; a budget that takes all ends past the last
        found = sums.groupBy("source", "budget").agg(
            F.coalesce(F.min(F.when(~passed, F.col("bucket"))), F.max("bucket") + 1).alias("prefix"),
            F.coalesce(F.max(F.when(passed, F.col("over"))), F.min("under")).alias("under"),
            F.coalesce(F.min(F.when(~passed, F.col("over"))), F.max("over")).alias("with_next"),
        )
        kept = at.alias("x").join(found.alias("f"), F.col("x.source").eqNullSafe(F.col("f.source")), "left")
        at = cut(kept.select(
            F.col("x.source").alias("source"), F.col("x.budget").alias("budget"),
            F.coalesce("f.prefix", F.shiftleft(F.col("x.prefix"), BITS)).alias("prefix"),
            F.coalesce("f.under", "x.under").alias("under"), F.coalesce("f.with_next", "x.under").alias("with_next"),
        ))
    nearer = F.col("with_next") - F.col("budget") < F.col("budget") - F.col("under")
    return at.select("source", "budget", F.shiftleft(F.col("prefix") + nearer.cast("long"), HASH_BITS - BITS * ROUNDS).alias("t"))


def source_plan(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target, whole, t), one row per source, from sized rows."""
    plan = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    ends = thresholds(rows, plan.select("source", "budget"))
    met = plan.alias("p").join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")))
    return cut(met.select(F.col("p.source").alias("mix_source"), "source_size", "target", "whole", "t"))


def with_copies(rows: DataFrame, plan: DataFrame, h: Column, most: int) -> DataFrame:
    """rows (which have a column source) with the columns of the plan and mix_copies."""
    met = met_by_salt(rows, plan, "source", "mix_source", h, BROADCAST_SOURCES)
    return met.withColumn("mix_copies", F.least(F.col("whole") + (h < F.col("t")).cast("long"), F.lit(most)))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, copies (how often the mix takes it), taken (words)."""
    rows = cut(sized(docs))
    met = with_copies(rows, source_plan(rows, weights, most), F.col("h"), most)
    return met.select("doc_id", "source", "size", "source_size", "target", F.col("mix_copies").alias("copies"), (F.col("size") * F.col("mix_copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of docs as the mix takes them: left out, or repeated whole."""
    plan = source_plan(cut(sized(docs)), weights, most)
    rows = numbered(_texts(docs, F.struct(*docs.columns).alias("mix_row"))).select("mix_row", "source", hash_of().alias("mix_h"))
    met = with_copies(rows, plan, F.col("mix_h"), most).select("mix_row", F.explode(F.array_repeat(F.lit(1), F.col("mix_copies").cast("int"))))
    return met.select("mix_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) || ':' || row_number() over (partition by doc_id, coalesce(text, ''), source)), 1, 15))::bigint as h
  from documents
), sizes as (
  select source, sum(size)::bigint as source_size from rows group by source
), ranked as (
  select *, 1 + (row_number() over (order by source nulls last) - 1) % 3 as w, 3 * source_size as cap from sizes
), filled as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over b, 0))::double / (sum(w) over () - coalesce(sum(w) over b, 0))::double as l
  from ranked window b as (order by cap::double / w, source nulls last rows between unbounded preceding and 1 preceding)
), levels as (
  select *, case when cap::double / w > l then l end as level from filled
), plan as (
  select source, source_size, case when level is null then cap::double else w * max(level) over () end as target from levels
), budgets as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from plan
), cells as (
  select source, h >> 24 as cell, sum(size)::bigint as size from rows group by all
), running as (
  select c.*, target - whole * source_size as budget, sum(c.size) over (partition by c.source order by cell)::bigint as upto
  from cells c join budgets p on c.source is not distinct from p.source
), ends as (
  select source,
    max(case when upto <= budget then cell end) as last_in,
    min(case when upto > budget then cell end) as next,
    coalesce(max(case when upto <= budget then upto end), 0) as under,
    min(case when upto > budget then upto end) as with_next, any_value(budget) as budget
  from running group by source
), limits as (
  select *, case when next is null then null when with_next - budget < budget - under then next + 1 else next end as stop from ends
)
select r.doc_id, r.size, p.source_size, p.target,
  (r.size * least(3, p.whole + case when e.stop is null or (r.h >> 24) < e.stop then 1 else 0 end))::bigint as taken
from rows r join budgets p on r.source is not distinct from p.source join limits e on r.source is not distinct from e.source
"""
