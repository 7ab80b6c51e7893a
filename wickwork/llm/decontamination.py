"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over ten consecutive words of which seven or eight count, so a window still matches where a
word at an ignored place was replaced. The hashes of all windows of the test items, one table for each
mask, meet the hashes of all windows of every text: a hash join whose test side is sent to the tasks in
blocks, so the texts are neither shuffled nor dealt by key, however common a passage is. A pass over the texts
holds PASS_BLOCKS blocks; more test items take further passes, each from a table that the one before has written,
so the memory of the driver and of a task doesn't grow with the test side. A
hit fixes how text and item lie to each other; then their words are compared along the whole item, and the
best stretch (a match counts 1, a replaced word -2) decides. A text is contaminated by an item if that
stretch has 13 equal words, or 7 in 10 of the item's if that is less.

Items of 5 to 9 words are looked up whole; shorter ones say nothing and match nothing.

Defined results: null or empty texts and items match nothing. Items that repeat count once each; of equal
matches the smallest item_id is reported. With no items nothing is contaminated, with no documents there are no
rows; rows that repeat are judged alike. Other columns of the documents pass through, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.llm.base import removed, shared_folder, table

# The masks and the rule.
MASKS = ("1101100111", "1110010111", "1011101101", "1111011110")
SPAN = 10
SHORTEST = 5
ENOUGH = 13
SHARE = 0.7
MISMATCH = -2
#: Words of test items that are sent to the tasks at once; with all tables about 600 bytes a word, half of it bitmaps.
BLOCK_WORDS = 100_000
#: Blocks that a pass over the texts holds at once.
PASS_BLOCKS = 4
#: Cells for each window of the items in the table that most windows of the texts miss.
BITMAP = 64
LEAK = "leak_mark"

_ODD = np.array([int.from_bytes(xxhash.xxh3_64_digest(bytes([i])), "big") | 1 for i in range(SPAN)], np.uint64)


def hashed_words(text: bytes | None) -> np.ndarray:
    words = text.lower().split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def windows(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked window that starts at each word."""
    n = len(words) - len(mask) + 1
    total = np.full(max(n, 0), len(mask), np.uint64)
    for i, used in enumerate(mask):
        if used == "1" and n > 0:
            total += words[i : i + n] * _ODD[i]
    return (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


class Items:
    """A block of test items with a sorted table of window hashes for each mask."""

    def __init__(self, items: list[tuple[int, np.ndarray]]) -> None:
        self.items = items
        found: dict[str, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(items):
            if len(words) >= SPAN:
                for mask in MASKS:
                    found[mask].append((windows(words, mask), k))
            elif len(words) >= SHORTEST:
                found["1" * len(words)].append((windows(words, "1" * len(words)), k))
        self.tables = {}
        for mask, parts in found.items():
            keys = np.concatenate([h for h, _ in parts])
            owner = np.concatenate([np.full(len(h), k, np.int32) for h, k in parts])
            place = np.concatenate([np.arange(len(h), dtype=np.int32) for h, _ in parts])
            order = np.argsort(keys, kind="stable")
            shift = np.uint64(64 - (BITMAP * len(keys)).bit_length())
            bitmap = np.zeros(1 << (64 - int(shift)), bool)
            bitmap[keys >> shift] = True
            self.tables[mask] = (keys[order], owner[order], place[order], bitmap, shift)

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item_id, equal words, words of the item, first word in the text), best first."""
        lie = set()
        for mask, (keys, owner, place, bitmap, shift) in self.tables.items():
            h = windows(words, mask)
            at = np.flatnonzero(bitmap[h >> shift])
            if len(at):
                low, high = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
                for p, a, b in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
                    lie.update(zip(owner[a:b].tolist(), (p - place[a:b]).tolist(), strict=True))
        best: dict[int, tuple[int, int, int, int]] = {}
        for k, offset in sorted(lie):
            item_id, item = self.items[k]
            equal = overlap(words, item, offset)
            if equal >= needed(len(item)) and (k not in best or equal > best[k][1]):
                best[k] = (item_id, equal, len(item), max(offset, 0))
        return sorted(best.values(), key=lambda x: (-x[1], x[0]))


def needed(n: int) -> int:
    return min(ENOUGH, math.ceil(SHARE * n))


def overlap(words: np.ndarray, item: np.ndarray, offset: int) -> int:
    """Equal words in the best stretch, if the item starts at word ``offset`` of the text."""
    a, b = max(0, -offset), min(len(item), len(words) - offset)
    same = words[a + offset : b + offset] == item[a:b]
    score = np.concatenate([[0], np.cumsum(np.where(same, 1, MISMATCH))])
    gain = score - np.minimum.accumulate(score)
    end = int(gain.argmax())
    start = int(score[: end + 1].argmin())
    return int(same[start:end].sum())


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    held, words = [], 0
    for row in benchmark.select("item_id", F.encode("text", "utf-8").alias("text")).where("text is not null and item_id is not null").orderBy("item_id", "text").toLocalIterator():
        held.append((row.item_id, hashed_words(bytes(row.text))))
        words += len(held[-1][1])
        if words >= BLOCK_WORDS:
            yield Items(held)
            held, words = [], 0
    if held:
        yield Items(held)


MARK = T.StructType([T.StructField(f, T.LongType()) for f in ("item_id", "equal", "words", "items")])


def marked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row: docs' row, leak_mark): null, or the best item, its equal words and length, and the number of items.

    Up to PASS_BLOCKS blocks are looked up in one pass over the texts, whose words are hashed once in it.
    """
    spark, written = docs.sparkSession, None
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.withColumn(LEAK, F.lit(None).cast(MARK))
    blocks = _blocks(benchmark)
    sent = [spark.sparkContext.broadcast(items) for items in islice(blocks, PASS_BLOCKS)]
    while True:
        rows = rows.mapInArrow(_looked_up(sent), rows.schema)
        following = next(blocks, None)
        if following is None:
            return rows
        folder = f"{shared_folder(spark)}/decontamination-{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        for block in sent:
            block.destroy()
        if written:
            removed(spark, written)
        rows, written = spark.read.parquet(folder), folder
        sent = [spark.sparkContext.broadcast(items) for items in chain([following], islice(blocks, PASS_BLOCKS - 1))]


def _looked_up(blocks: list[Broadcast]):
    """Rows with their marks so far to rows with marks that count these blocks' items too."""
    kind = pa.struct([(f, pa.int64()) for f in MARK.names])

    def mark(text: bytes | None, before: dict | None) -> dict | None:
        words = hashed_words(text)
        found = [dict(zip(MARK.names, (*m[:3], 1), strict=True)) for block in blocks for m in block.value.matches(words)]
        found += [before] if before else []
        best = min(found, key=lambda m: (-m["equal"], m["item_id"]), default=None)
        return best and {**best, "items": sum(m["items"] for m in found)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field("text").cast(pa.binary()).to_pylist()
            yield pa.record_batch([batch.column("row"), pa.array(list(map(mark, texts, batch.column(LEAK).to_pylist())), kind)], ["row", LEAK])

    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that no item contaminates."""
    return marked(docs, benchmark).where(F.col(LEAK).isNull()).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = marked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    leak = F.col(LEAK)
    return m.select(
        "row.doc_id", leak.isNotNull().alias("contaminated"), leak["item_id"].alias("item_id"), F.coalesce(leak["items"], F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(leak["equal"], F.lit(0)).cast("long").alias("equal_words"), leak["words"].alias("item_words"),
    )


def _seed_sql(words: str, owner: str, mask: str, only: str = "") -> str:
    """Window text of a mask at each place of a table of words (owner, place, word, n)."""
    used = ", ".join(f"lead(word, {i}) over o" for i, c in enumerate(mask) if c == "1")
    return f"select {owner}, place, '{mask}' as mask, case when place + {len(mask) - 1} <= n then concat_ws(' ', {used}) end as seed from {words}{only} window o as (partition by {owner} order by place)"


_SHORT = ["1" * n for n in range(SHORTEST, SPAN)]
_DOC_SEEDS = " union all ".join([_seed_sql("doc_words", "d", m) for m in MASKS] + [_seed_sql("doc_words", "d", m, f" where exists (from items where len(w) = {len(m)})") for m in _SHORT])
_ITEM_SEEDS = " union all ".join([_seed_sql("item_words", "k", m, f" where n >= {SPAN}") for m in MASKS] + [_seed_sql("item_words", "k", m, f" where n = {len(m)}") for m in _SHORT])
SQL = rf"""
with docs as materialized (
  select row_number() over () as d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), items as materialized (
  select row_number() over (order by item_id, text) as k, item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from benchmark where text is not null and item_id is not null
), doc_words as materialized (select d, len(w) as n, generate_subscripts(w, 1) as place, unnest(w) as word from docs
), item_words as materialized (select k, len(w) as n, generate_subscripts(w, 1) as place, unnest(w) as word from items
), doc_seeds as ({_DOC_SEEDS}
), item_seeds as ({_ITEM_SEEDS}
), lies as (
  select distinct d, k, x.place - y.place as lie from doc_seeds x join item_seeds y using (mask, seed) where seed is not null
), steps as (
  select d, k, lie, 0 as place, false as same from lies
  union all
  select l.d, l.k, l.lie, i.place, i.word = w.word from lies l join item_words i on i.k = l.k join doc_words w on w.d = l.d and w.place = i.place + l.lie
), sums as (
  select d, k, lie, place, sum(case when place = 0 then 0 when same then 1 else {MISMATCH} end) over o as score, sum(same::int) over o as equal
  from steps window o as (partition by d, k, lie order by place)
), gains as (
  select d, k, lie, place, score - min(score) over o as gain, equal - arg_min(equal, score * 1000000 + place) over o as equal
  from sums window o as (partition by d, k, lie order by place rows unbounded preceding)
), best as (
  select d, k, lie, arg_max(equal, gain * 1000000 - place)::bigint as equal from gains group by d, k, lie
), found as (
  select b.d, b.k, i.item_id, len(i.w) as words, max(equal) as equal from best b join items i using (k)
  where equal >= least({ENOUGH}, ceil({SHARE} * len(i.w))) group by all
), leaks as (
  select d, count(*) as n_items, first(struct_pack(item_id, equal, words) order by equal desc, item_id, k) as top from found group by d
)
select doc_id, l.d is not null as contaminated, top.item_id as item_id, coalesce(n_items, 0)::bigint as n_items,
  coalesce(top.equal, 0)::bigint as equal_words, top.words::bigint as item_words
from docs left join leaks l using (d)
"""
