"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each text gets counts (words, symbols, repeated lines, words in repeated 8-word windows) and from them
four shares. A share has a fixed grid of cutoffs. Labelled documents are the holdout: for each stratum
(language), share and cutoff they give the good documents n and how many of them, k, the cutoff would
reject. The four shares have a quarter of the risk ALPHA each, as a text goes if any of them rejects it:
a cutoff passes if P(X <= k) <= DELTA / m for X binomial (n, ALPHA / 4), an exact one-sided bound. The
cutoffs of a share are tested from the loosest on and count as certified up to the first that fails, so m,
which corrects for testing together, is the number of strata times four and not that of all cutoffs. With
probability 1 - DELTA no stratum loses more than a share ALPHA of its good documents to the certified rules.
Of the certified cutoffs the one with the best balance of rejected bad and good documents is taken; without
one (under about 1,150 good labelled documents of four languages), the share isn't used in that stratum.

Everything about a text is computed within its row; learning shuffles counts of at most one row for
each stratum, share and cell of the grid, summed before the shuffle.

Defined results: a null text has no words and fails the base rule. A null language is a stratum. If an
id has several labels the worst counts; null labels count for nothing; with no labels only the base
rule holds. Rows that repeat an id are judged each by its text. The holdout has each text of a language once,
with the worst of its labels: copies aren't independent draws and would certify cutoffs by repetition. No
rows give none. A very long text is counted within its row, as others are. rules ignores other columns,
filtered returns them untouched, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.llm.base import SPACE, UPPER, cut, met_by_salt, row_of, table, without, words_of

# The symbols counted, the base rule, the grid, and the risk allowed for all shares together.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
GRID = (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6)
SHARES = ("symbols", "capitals", "repeats", "lines")
ALPHA = 0.02
DELTA = 0.05
GOOD_WEIGHT = 20
BROADCAST_CUTOFFS = 20_000
COUNTS = ("q_words", "q_chars", "q_symbols", "q_capitals", "q_all_lines", "q_dup_lines", "q_repeat_words")


def _removed(text: str, characters: str) -> Column:
    return F.char_length(F.translate(F.col(text), characters, ""))


def counts(docs: DataFrame) -> DataFrame:
    """docs with ``q_...`` columns: the counts of each text."""
    d = docs.withColumn("q_text", F.coalesce("text", F.lit("")))
    d = d.withColumn("q_hash", F.transform(words_of(F.col("q_text")), lambda w: F.xxhash64(w)))
    # the hash of 8 words from those of 1, 2 and 4
    for name, of, step in (("q_2", "q_hash", 1), ("q_4", "q_2", 2), ("q_8", "q_4", 4)):
        rest = F.greatest(F.size(of) - step, F.lit(0))
        d = d.withColumn(name, F.zip_with(F.slice(of, 1, rest), F.slice(of, 1 + step, rest), lambda a, b: F.xxhash64(a, b)))
    d = d.withColumn("q_sorted", F.when(F.size(F.array_distinct("q_8")) < F.size("q_8"), F.array_sort(F.transform("q_8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = lambda j: F.get("q_sorted", j)["h"]
    starts = F.filter(F.transform("q_sorted", lambda x, j: F.when((x["h"] == twin(j - 1)) | (x["h"] == twin(j + 1)), x["i"])), lambda i: i.isNotNull())
    d = d.withColumn("q_starts", F.sort_array(starts))
    covered = F.zip_with("q_starts", F.slice("q_starts", 2, F.greatest(F.size("q_starts"), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    d = d.withColumn("q_lines", F.filter(F.split("q_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    found = {
        "q_text_hash": F.xxhash64("q_text"),
        "q_words": F.size("q_hash"),
        "q_chars": _removed("q_text", SPACE),
        "q_symbols": F.char_length("q_text") - _removed("q_text", SYMBOLS),
        "q_capitals": F.char_length("q_text") - _removed("q_text", UPPER),
        "q_all_lines": F.size("q_lines"),
        "q_dup_lines": F.size("q_lines") - F.size(F.array_distinct("q_lines")),
        "q_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")),
    }
    # as a generator's output: the optimizer would copy the counts' expressions into any filter on them
    return d.select(*docs.columns, F.inline(F.array(F.struct(*(c.cast("long").alias(name) for name, c in found.items())))))


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def share_of(name: str) -> Column:
    return _share(*{"symbols": ("q_symbols", "q_chars"), "capitals": ("q_capitals", "q_chars"), "repeats": ("q_repeat_words", "q_words"), "lines": ("q_dup_lines", "q_all_lines")}[name])


def base_failed() -> Column:
    return (F.col("q_words") < MIN_WORDS) | (100 * F.col("q_repeat_words") > MAX_REPEAT_PERCENT * F.col("q_words"))


def at_most(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) for X binomial (n, p), summed exactly term by term in logarithms."""
    odds, first = math.log(p / (1 - p)), n.cast("double") * math.log(1 - p)

    def step(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1) / j) + odds
        top = F.greatest(a["sum"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(a["sum"] - top) + F.exp(term - top))).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), step)["sum"]


def certified(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, share, cutoff, good, good_rejected, bad_rejected): the cutoffs taken, one row for each stratum and share."""
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    cell = lambda x: F.size(F.filter(F.array(*map(F.lit, GRID)), lambda c: c < x))  # noqa: E731  cutoffs under the share
    shares = F.explode(F.array(*(F.struct(F.lit(s).alias("share"), cell(share_of(s)).alias("cell")) for s in SHARES)))
    # good documents that the base rule rejects anyway aren't the cutoffs' doing
    # copies are no further evidence: of rows of one text the worst label counts, once
    drawn = counted.where(~base_failed()).join(known, "doc_id").groupBy("lang", "q_text_hash", *COUNTS).agg(F.min("quality").alias("quality"))
    held = drawn.select(F.col("lang").alias("stratum"), "quality", shares.alias("x"))
    cells = held.groupBy("stratum", "x.share", "x.cell").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    tests = cells.select("stratum", "share").distinct().select("stratum", "share", F.posexplode(F.array(*map(F.lit, GRID))).alias("i", "cutoff"))
    same = F.col("t.stratum").eqNullSafe(F.col("c.stratum")) & (F.col("t.share") == F.col("c.share"))
    over = F.col("c.cell") > F.col("t.i")
    found = tests.alias("t").join(cells.alias("c"), same).groupBy("t.stratum", "t.share", "cutoff").agg(
        F.sum("good").alias("good"), F.sum(F.when(over, F.col("good")).otherwise(0)).alias("good_rejected"), F.sum(F.when(over, F.col("bad")).otherwise(0)).alias("bad_rejected")
    )
    m = F.count("*").over(Window.partitionBy(F.lit(1))) / len(GRID)  # every stratum and share has all cutoffs
    found = found.withColumn("limit", F.log(F.lit(delta) / m))
    k, n, each = F.col("good_rejected"), F.col("good"), alpha / len(SHARES)
    # more than the expected number never passes and needn't be summed
    passed = F.when(k <= each * n, at_most(k, n, each) <= F.col("limit")).otherwise(False)
    from_loosest = Window.partitionBy("stratum", "share").orderBy(F.col("cutoff").desc())
    found = found.withColumn("certified", F.min(passed).over(from_loosest)).where("certified and bad_rejected > 0")
    best = F.row_number().over(Window.partitionBy("stratum", "share").orderBy((F.col("bad_rejected") - GOOD_WEIGHT * F.col("good_rejected")).desc(), F.col("cutoff").desc()))
    return found.withColumn("best", best).where("best = 1").select("stratum", "share", "cutoff", "good", "good_rejected", "bad_rejected")


def judged(counted: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """counted with base_failed and kept."""
    wide = cutoffs.groupBy("stratum").agg(*(F.min(F.when(F.col("share") == s, F.col("cutoff"))).alias(f"q_max_{s}") for s in SHARES))
    met = met_by_salt(counted, wide, "lang", "stratum", F.xxhash64("doc_id", "q_chars"), BROADCAST_CUTOFFS, "left")
    passed = ~base_failed()
    for s in SHARES:
        passed &= F.coalesce(share_of(s) <= F.col(f"q_max_{s}"), F.lit(True))
    return met.withColumns({"base_failed": base_failed(), "kept": passed})


def rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts, base_failed and kept."""
    counted = cut(counts(docs.select("doc_id", "lang", "text")).drop("text"))
    return judged(counted, cut(certified(counted, labels)))


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, whole and with their own columns.

    The texts are counted once, and the rejected rows then taken out by id and a hash of text and language.
    """
    counted = cut(counts(docs.select("doc_id", "lang", "text", row_of("text", "lang"))).drop("text"))
    return without(docs, judged(counted, cut(certified(counted, labels))).where("not kept"), "text", "lang")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return r.select(
        "doc_id", F.col("q_words").alias("n_words"), F.col("q_chars").alias("word_chars"), F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"), F.col("q_repeat_words").alias("n_repeat_words"), "base_failed", "kept",
    )


# The counts, the tests and the verdict in DuckDB; lgamma gives the binomial terms.
SQL_COUNTED = r"""
words as (
  select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from {documents}
), lines as (
  select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from words
), windows as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') as win from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from words)
), repeated as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as n from windows) where n > 1
), covered as (
  select doc_id, sum(least(8, coalesce(nxt - i, 8)))::bigint as n from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from repeated) group by doc_id
), counted as (
  select w.doc_id, lang, text, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::bigint as n_capitals,
    len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
  from words w join lines using (doc_id) left join covered c using (doc_id)
), base as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    case when word_chars > 0 then n_symbols / word_chars else 0 end as symbols, case when word_chars > 0 then n_capitals / word_chars else 0 end as capitals,
    case when n_words > 0 then n_repeat_words / n_words else 0 end as repeats, case when n_lines > 0 then n_dup_lines / n_lines else 0 end as lines_
  from counted
), held as (
  select lang, quality, unnest(['symbols', 'capitals', 'repeats', 'lines']) as share, unnest([symbols, capitals, repeats, lines_]) as x
  from (
    select lang, text, min(quality) as quality, any_value(symbols) as symbols, any_value(capitals) as capitals, any_value(repeats) as repeats, any_value(lines_) as lines_
    from base join (select doc_id, min(quality) as quality from labels where quality is not null group by 1) using (doc_id) where not base_failed group by lang, text
  )
), tests as (
  select lang, share, cutoff, count(*) filter (where quality = 1) as n, count(*) filter (where quality = 1 and x > cutoff) as k, count(*) filter (where quality = 0 and x > cutoff) as bad
  from held, (select unnest([0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6])::double as cutoff) group by all
), numbered as (
  select *, (select count(*) from (select distinct lang, share from tests)) as m from tests
), passed as (
  select *, k <= 0.005::double * n
    and list_sum(list_transform(range(0, k + 1), lambda j: exp((case when n = 0 then 0 else lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) end) + j * ln(0.005::double) + (n - j) * ln(0.995::double)))) <= 0.05::double / m as passes
  from numbered
), certified as (
  select *, bool_and(passes) over (partition by lang, share order by cutoff desc) as holds from passed
), chosen as (
  select lang, share, cutoff from certified where holds and bad > 0 qualify row_number() over (partition by lang, share order by bad - 20 * k desc, cutoff desc) = 1
), wide as (
  select lang, min(cutoff) filter (where share = 'symbols') as a, min(cutoff) filter (where share = 'capitals') as b, min(cutoff) filter (where share = 'repeats') as c, min(cutoff) filter (where share = 'lines') as d
  from chosen group by lang
), judged as (
  select base.*, not base_failed and coalesce(symbols <= a, true) and coalesce(capitals <= b, true) and coalesce(repeats <= c, true) and coalesce(lines_ <= d, true) as kept
  from base left join wide on base.lang is not distinct from wide.lang
)
"""
SQL = "with " + SQL_COUNTED.replace("{documents}", "documents") + "select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from judged"
