"""MinHash near-dedup with HyperMinHash registers.

Each text becomes its set of word shingles, hashed to 64 bits, and the set a sketch of 128 registers:
the least hash in each of 128 buckets, kept as its count of leading zeros (6 bits) and the 10 bits after
them. Empty registers take the value of the first filled one in a fixed order of their own, so short texts
have full sketches as well. Texts with equal sets are one class, which has a number of its own, and only one
text of it goes on. Bands
of 4 registers make candidates: classes that share a band. A pair's registers then give an estimate of its
Jaccard similarity, corrected for registers that agree by chance; pairs far under the limit go, and the
others are confirmed on the full sets.

No group is expanded into its pairs. In a bucket the first document is compared with all documents of
other components; the links found merge components, and a bucket whose documents are all in one component
is done, as more links in it would change nothing. Buckets of up to 8 documents are settled at once. What
two rounds leave open (documents that no bucket's first ones link) is compared exactly, in blocks: documents
that open buckets chain together are dealt into blocks of about 256, and a task gets the sets of two blocks
and returns only the links between components. So no link is given up and no pair is written but a link.

The members of a bucket are never gathered to be compared with its first one: a bucket is summed up before it
meets them, and the summaries of buckets with many members are sent to all tasks (a bounded number).

With 32 bands a pair at similarity 0.8 shares none with probability under 1e-7.

Defined results: a text without words has an empty set and is linked with nothing. A document without an id
is linked with nothing, has no component and is kept. Rows that repeat an id each belong where their text
belongs, and component_id is the smallest id of all rows reached; rows that repeat an id and a text are one
document, so both are kept or go. No rows give none. linked ignores other columns, deduplicated returns them
untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm.base import cut, met_by_key, row_of, table, without

REGISTERS = 128
BAND = 4
MANTISSA = 10
#: Estimates under this are further from 0.8 than their error reaches.
LEAST_ESTIMATE = 0.5
SMALL_BUCKET = 8
ROUNDS = 2
BLOCK = 256
EDGES_PER_TASK, ROWS_PER_TASK, SETS_PER_TASK = 200_000, 20_000, 4_000


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers, one for each place in a shingle.
PLACE = _mix(np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: For each register, the order in which it looks for a filled one.
ORDER = np.argsort(_mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(7)).reshape(REGISTERS, REGISTERS), axis=1)
SHIFT = np.uint64(64 - REGISTERS.bit_length() + 1)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < width:
        return _mix(np.array([(w * PLACE[:n]).sum() + np.uint64(n)], np.uint64))
    total = w[: n - width + 1] * PLACE[0]
    for i in range(1, width):
        total += w[i : n - width + 1 + i] * PLACE[i]
    return np.unique(_mix(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set that isn't empty, from its sorted hashes."""
    bucket = (hashes >> SHIFT).astype(np.intp)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = hashes[first] & ((np.uint64(1) << SHIFT) - np.uint64(1)) | np.uint64(1)
    top = np.frexp(rest.astype(np.float64))[1].astype(np.uint64)  # bits in use
    top -= (rest < (np.uint64(1) << (top - np.uint64(1)))).astype(np.uint64)  # where the float was rounded up
    zeros = np.minimum(SHIFT - top, np.uint64(63))
    after = np.where(top > MANTISSA, rest >> np.maximum(top, np.uint64(MANTISSA + 1)) - np.uint64(MANTISSA + 1), rest) & np.uint64((1 << MANTISSA) - 1)
    value = np.zeros(REGISTERS, np.uint16)
    value[bucket[first]] = (zeros << np.uint64(MANTISSA) | after).astype(np.uint16)
    if len(first) < REGISTERS:
        filled = np.zeros(REGISTERS, bool)
        filled[bucket[first]] = True
        other = ORDER[np.arange(REGISTERS), filled[ORDER].argmax(axis=1)]
        value = value[np.where(filled, np.arange(REGISTERS), other)]
    return value


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from rows of registers, corrected for agreement by chance."""
    agree = (a == b).mean(axis=1)
    edge = 2.0 ** -np.arange(0, 41)

    def level(size: np.ndarray) -> np.ndarray:  # chance that the least of a bucket's hashes has so many leading zeros
        per = np.maximum(size / REGISTERS, 1.0)[:, None]
        return np.exp(per * np.log1p(-edge[1:])) - np.where(edge[:-1] < 1, np.exp(per * np.log1p(-np.minimum(edge[:-1], 1 - 1e-16))), 0)

    chance = (level(size_a) * level(size_b)).sum(axis=1) / 2**MANTISSA
    return (agree - chance) / (1 - chance)


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, n, s1, s2, regs): the text's hash, the set's size, two sums that stand for it, and the registers as 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, regs = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                h = shingles(text, width)
                n.append(len(h))
                s1.append(int(h.sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(_mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                regs.append(registers(h).view(np.int64) if len(h) else None)
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("row"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(regs, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, ["doc_id", "row", "n", "s1", "s2", "regs"])

    return docs.select("doc_id", row_of("text"), "text").mapInArrow(run, "doc_id long, row long, n long, s1 long, s2 long, regs array<bigint>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(rep, hashes) of docs with columns rep and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                piece = batch.slice(i, 500)
                sets = [shingles(t, width).view(np.int64) for t in piece.column("text").cast(pa.binary()).to_pylist()]
                yield pa.record_batch([piece.column("rep"), pa.array(sets, pa.list_(pa.int64()))], ["rep", "hashes"])

    return docs.select("rep", "text").mapInArrow(run, "rep long, hashes array<bigint>")


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.asarray(batch.column(c).flatten()).reshape(batch.num_rows, -1).view(np.uint16) for c in ("regs_a", "regs_b")]
        near = estimate(*rows, *(np.asarray(batch.column(c)) for c in ("n_a", "n_b"))) >= LEAST_ESTIMATE
        yield batch.select(["a", "b"]).filter(pa.array(near))


def components(links: DataFrame) -> DataFrame:
    """(id, component) for the ids in links (a, b): the least id that each reaches.

    Alternates large and small stars (Kiveris and others, 2014) on tables in the checkpoint folder; a hub's
    links are aggregated before they are shuffled and never gathered in one row.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), EDGES_PER_TASK)
    while True:
        tasks = max(1, -(-edges.count() // EDGES_PER_TASK))
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(2 * tasks).distinct().coalesce(2 * tasks)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(least, "a").coalesce(2 * tasks)
        small = met.select("a", F.col("m").alias("b")).union(met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges = cut(small, EDGES_PER_TASK)
        # stars: no centre is a leaf, and every leaf has one centre
        shape = edges.groupBy("a").agg(F.count("*").alias("n")).coalesce(tasks)
        if not shape.where("n > 1").limit(1).count() and not shape.join(edges.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count():
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def _open(members: DataFrame) -> DataFrame:
    """The members of buckets that still hold several components, with the bucket's size, first member and its component."""
    spans = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("first"), F.min_by("comp", "rep").alias("lead"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    return cut(met_by_key(members, cut(spans.where("c0 < c1").drop("c0", "c1"), EDGES_PER_TASK), "bucket", "n"), EDGES_PER_TASK)


def _pairs(open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of a round across components, and the members of buckets that it doesn't settle."""
    few, many = open_.where(F.col("n") <= SMALL_BUCKET), open_.where(F.col("n") > SMALL_BUCKET)
    x, y = few.select("bucket", F.col("rep").alias("a"), F.col("comp").alias("ca")), few.select("bucket", F.col("rep").alias("b"), F.col("comp").alias("cb"))
    pairs = x.join(y, "bucket").where("a < b and ca <> cb").select("a", "b")
    star = many.where("rep <> first and comp <> lead").select(F.col("first").alias("a"), F.col("rep").alias("b"))
    return pairs.union(star).distinct(), many.where("rep <> first").select("bucket", "rep")


def _between(percent: int):
    """Links across components among the sets of a block or of two."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep, comp = np.asarray(group.column("rep")), np.asarray(group.column("comp"))
        sizes = np.asarray(pa.compute.list_value_length(group.column("hashes")))
        token = np.unique(np.asarray(group.column("hashes").combine_chunks().flatten()), return_inverse=True)[1]
        held = np.bincount(token)
        row = np.repeat(np.arange(len(rep)), sizes)[held[token] > 1]
        token = (np.cumsum(held > 1) - 1)[token[held[token] > 1]]
        order = np.argsort(token, kind="stable")
        row, token = row[order], token[order]
        same = np.zeros((len(rep), len(rep)), np.float32)
        ends = np.searchsorted(token, np.arange(0, (token[-1] if len(token) else 0) + 4097, 4096))
        for a, b in zip(ends, ends[1:]):
            part = np.zeros((len(rep), 4096), np.float32)
            part[row[a:b], token[a:b] % 4096] = 1
            same += part @ part.T
        near = (100 * same >= percent * (sizes[:, None] + sizes[None, :] - same)) & (comp[:, None] != comp[None, :]) & (rep[:, None] < rep[None, :])
        x, y = np.nonzero(near)
        return pa.table({"a": rep[x], "b": rep[y], "same": same[x, y].astype(np.int64)})

    return run


def _rest(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links across components among the documents that open buckets chain together."""
    chained = components(open_.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")))
    chain = chained.union(chained.select("component", "component")).distinct()
    some = open_.select("rep", "comp").distinct().join(chain, F.col("rep") == F.col("id")).select("rep", "comp", "component")
    number = some.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = some.join(number, "component").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = dealt.join(sets, "rep")
    other = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = other.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "comp", "hashes")
    return keys.groupBy("component", "i", "j").applyInArrow(_between(percent), "a long, b long, same long")


def _named(label: DataFrame, classes: DataFrame) -> DataFrame:
    """label with the smallest doc_id of each component, the classes being numbered in no order."""
    ids = label.union(label.select("component", "component")).distinct().toDF("rep", "component").join(classes.select("rep", "least"), "rep")
    least = cut(ids.groupBy("component").agg(F.min("least").alias("doc"), F.count("*").alias("n")), EDGES_PER_TASK)
    return met_by_key(ids.select("rep", "component"), least, "component", "n").select(F.col("rep").alias("id"), "doc")


def _rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """linked, with the text's hash as row."""
    rows = cut(sketched(docs, width), ROWS_PER_TASK)
    full = rows.where("n > 0 and doc_id is not null")
    one = F.min(F.struct("doc_id", "row"))
    classes = full.groupBy("s1", "s2", "n").agg(one.alias("one")).select("s1", "s2", "n", F.col("one.doc_id").alias("least"), F.col("one.row").alias("row"))
    # a number of its own for each class: the same id may stand for several, by several texts
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()), EDGES_PER_TASK)
    text = [F.col("x.doc_id") == F.col("c.least"), F.col("x.row") == F.col("c.row")]
    reps = full.alias("x").join(classes.alias("c"), text).where("x.s1 = c.s1 and x.s2 = c.s2 and x.n = c.n").select("rep", "x.n", "regs").dropDuplicates(["rep"])
    buckets = reps.select("rep", F.posexplode("regs").alias("band", "key")).select("rep", F.xxhash64("band", "key").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(met_by_key(buckets, cut(shared, EDGES_PER_TASK), "bucket", "n").select("rep", "bucket"), EDGES_PER_TASK)
    some = members.select("rep").distinct()
    registers_of = cut(reps.join(some, "rep"), ROWS_PER_TASK)
    texts = docs.select("doc_id", row_of("text"), "text").alias("x").join(classes.join(some, "rep").alias("c"), text).select("rep", "text")
    sets = cut(shingle_sets(texts, width).dropDuplicates(["rep"]), SETS_PER_TASK)
    links = docs.sparkSession.createDataFrame([], "a long, b long, same long")
    label, members = links.select(F.col("a").alias("id"), F.col("b").alias("component")), members.withColumn("comp", F.col("rep"))
    for turn in range(ROUNDS + 1):
        open_ = _open(members)
        if open_.limit(1).count() == 0:
            break
        if turn == ROUNDS:
            found, left = cut(_rest(open_, sets, percent), EDGES_PER_TASK), None
        else:
            pairs, left = _pairs(open_)
            side = lambda c: registers_of.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("regs").alias(f"regs_{c}"))
            near = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_near, "a long, b long")
            of = lambda c: sets.select(F.col("rep").alias(c), F.col("hashes").alias(f"set_{c}"))
            met = near.join(of("b"), "b").join(of("a"), "a").select("a", "b", (F.size("set_a") + F.size("set_b")).alias("both"), F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("same"))
            found = cut(met.where(100 * F.col("same") >= percent * (F.col("both") - F.col("same"))).select("a", "b", "same"), EDGES_PER_TASK)
        links = links.union(found)
        label = _joined(label, found)
        if left is not None:
            members = left.join(label, left["rep"] == label["id"], "left").select("bucket", "rep", F.coalesce("component", "rep").alias("comp"))
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    known = classes.alias("c").join(_named(label, classes).alias("l"), F.col("c.rep") == F.col("l.id"), "left").join(ends.alias("e"), F.col("c.rep") == F.col("e.id"), "left")
    known = known.select("s1", "s2", "c.n", "least", F.coalesce("doc", "least").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = full.select("doc_id", "row", "s1", "s2", "n").join(known, ["s1", "s2", "n"]).select("doc_id", "row", "n", "least", "component", "n_links")
    alone = rows.where("n = 0 or doc_id is null").select("doc_id", "row", "n", F.col("doc_id").alias("least"), F.col("doc_id").alias("component"), F.lit(0).cast("long").alias("n_links"))
    return out.union(alone).select(
        "doc_id", "row", F.col("n").alias("n_shingles"), F.col("least").alias("class_id"), F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"), "n_links"
    )


def _joined(label: DataFrame, found: DataFrame) -> DataFrame:
    """label, (id, component) for the ids that are linked, with more links: only its components are linked anew."""
    known = lambda links, c: links.join(label.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")), c, "left")
    ends = known(known(found.select("a", "b"), "a"), "b").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    new = components(ends).toDF("old", "new")
    moved = label.join(new, label["component"] == new["old"], "left").select("id", F.coalesce("new", "component").alias("component"))
    return cut(moved.union(new.join(label, new["old"] == label["id"], "left_anti")), EDGES_PER_TASK)


def linked(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: doc_id, n_shingles, class_id, component_id, kept, n_links (of its class, as far as confirmed)."""
    return _rows(docs, width, percent).drop("row")


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay: one document of each component."""
    return without(docs, _rows(docs, width, percent).where("not kept"), "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"), width=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select distinct doc_id, unnest(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g
  from words
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), met as (
  select a.doc_id as a, b.doc_id as b, count(*) as same from sets a join sets b on a.g = b.g and a.doc_id < b.doc_id group by all
), links as (
  select a, b from met join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * same >= 80 * (x.n + y.n - same)
), pairs as (
  select a, b from links union all select b, a from links
), reach as (
  select a as id, a as other from pairs union select r.id, pairs.b from reach r join pairs on r.other = pairs.a
), component as (
  select id, min(other) as c from reach group by id
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(c, d.doc_id) as component_id, coalesce(c, d.doc_id) = d.doc_id as kept
from documents d left join sizes s using (doc_id) left join component on component.id = d.doc_id
"""
