"""Prefix trie of conversations: what shared beginnings hold, and what computing each of them once would save.

A node is a distinct sequence of the first d turns. Identical conversations are collapsed first, into one weighted
sequence with the list of its ends; sequences that are proper prefixes of others (found by an anti-join) are no
leaves; then only the prefixes of distinct sequences are summed. Turns travel as a SHA-256 and a word count, never
as texts, and a node is the first 128 bits of the SHA-256 of its parent and its last turn, chained over Arrow
batches. No list of a node's conversations is ever built: ends are joined in blocks of ids and hashed as a stream.

What lies under a node is summed without pairs of nodes: every node belongs to its smallest conversation, a running
sum from each sequence's end collects what that sequence owns, and adding those over the sequences of a node gives
its subtree. Common beginnings are summed before they are shuffled, and parents meet their children by met_by_key.

Defined results: turns are ordered by number, null first; equal numbers by the hash of role and text, so repeated
rows are repeated turns. Null roles and texts are empty. Rows without conv_id belong to no conversation and are left
out. Without conversations there are no nodes. Other columns are ignored. A conversation's turns pass one task in
order, 50 bytes each and one at a time, as its chain of hashes has to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.llm.base import cut, met_by_key, table, words_of

#: Ids of a block when ends are joined.
ENDS = 4096
NODE_BYTES = 16
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the turns in order, from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.size(words_of(text)).cast("long").alias("words"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest"))
    return rows.select("conv_id", place.cast("long").alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with the first h turns of conv_id - conv_id % every in place of its own first h; h: its id's CRC-32 modulo most.

    One that loses all its turns stays as a row with a null digest.
    """
    convs = turns.where("pos = 1").select(F.col("conv_id").alias("to"), (F.col("conv_id") - F.col("conv_id") % every).alias("conv_id"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    heads = turns.where(F.col("pos") < most).join(convs, "conv_id").where("pos <= h").select(F.col("to").alias("conv_id"), "pos", "digest", "words")
    own = turns.where(F.col("pos") > F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    every_one = convs.select(F.col("to").alias("conv_id"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return heads.unionByName(own).unionByName(every_one)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, depth, digest, words, last) in order to (conv_id, depth, words, last, up, node)."""
    root = hashlib.sha256().digest()[:NODE_BYTES]
    node = root
    for batch in batches:
        ups, nodes = [], []
        for depth, digest in zip(batch["depth"].to_pylist(), batch["digest"].to_pylist(), strict=True):
            ups.append(node if depth else None)
            node = hashlib.sha256(node + digest).digest()[:NODE_BYTES] if depth else root
            nodes.append(node)
        yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["depth"], batch["words"], batch["last"], pa.array(ups, pa.binary()), pa.array(nodes, pa.binary())], ["conv_id", "depth", "words", "last", "up", "node"])


def chained(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, words, last, up, node): every prefix of every conversation, the textless one included."""
    roots = rows.select("conv_id").distinct().select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    w = Window.partitionBy("conv_id").orderBy("pos")
    placed = rows.where(F.col("digest").isNotNull()).unionByName(roots).select("conv_id", (F.row_number().over(w) - 1).cast("long").alias("depth"), "digest", "words", F.lead("pos").over(w).isNull().alias("last"))
    return placed.mapInArrow(_chain, "conv_id long, depth long, words long, last boolean, up binary, node binary")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first, n, ids) by node and block to (node, conv_id, n, ends_sha256): one digest at a time."""
    node, first, n, digest, names = None, None, 0, hashlib.sha256(), ["node", "conv_id", "n", "ends_sha256"]

    def table_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*done, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], names)

    for batch in batches:
        done = []
        for at, least, count, ids in zip(*(batch[c].to_pylist() for c in ("node", "first", "n", "ids")), strict=True):
            if at != node:
                if node is not None:
                    done.append((node, first, n, digest.hexdigest()))
                node, first, n, digest = at, least, 0, hashlib.sha256()
            digest.update((("," if n else "") + ids).encode())
            n += count
        if done:
            yield table_of(done)
    if node is not None:
        yield table_of([(node, first, n, digest.hexdigest())])


def sequences(chains: DataFrame) -> DataFrame:
    """(node, conv_id, n, ends_sha256): each distinct whole conversation, the smallest id that has it, how many have, and the hash of their ids."""
    ends = chains.where("last").select("node", "conv_id")
    blocks = ends.groupBy("node", F.floor(F.col("conv_id") / ENDS).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select("node", "block", F.get("ids", 0).alias("first"), F.size("ids").cast("long").alias("n"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    ordered = blocks.repartition("node").sortWithinPartitions("node", "block").select("node", "first", "n", "ids")
    return ordered.mapInArrow(_fold, "node binary, conv_id long, n long, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """A row for each node of the conversations of turns_of or rebuilt: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    chains = cut(chained(rows))
    whole = cut(sequences(chains))
    inner = chains.where(~F.col("last")).select("node").distinct()
    flagged = whole.join(inner, "node", "left_anti").withColumn("leaf", F.lit(1)).unionByName(whole.join(inner, "node", "left_semi").withColumn("leaf", F.lit(0)))
    weighted = cut(chains.join(flagged.select("conv_id", "n", "leaf"), "conv_id"))
    nodes = cut(weighted.groupBy("node", "up", "depth", "words").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("leaf").cast("long").alias("n_leaves")))
    owned = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    from_end = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    below = weighted.join(owned, ["conv_id", "depth"], "left").select("node", F.sum(F.coalesce("own", F.lit(0))).over(from_end).alias("saved"), F.lit(0).alias("child"))
    children = nodes.where(F.col("up").isNotNull()).select(F.col("up").alias("node"), F.lit(0).cast("long").alias("saved"), F.lit(1).alias("child"))
    sums = below.unionByName(children).groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.sum("child").cast("long").alias("n_children"))
    full = cut(nodes.join(sums, "node").join(whole.select("node", "ends_sha256"), "node", "left"))
    parents = full.where("n_children > 0").select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("fan"))
    out = met_by_key(full.where(F.col("up").isNotNull()), parents, "up", "fan").unionByName(full.where(F.col("up").isNull()), allowMissingColumns=True)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(cut(turns_of(table(spark, sf_dir, "conversations")))))


SQL = r"""
with t as (
  select conv_id, d, w, row_number() over (partition by conv_id order by turn nulls first, d) as pos
  from (
    select conv_id, turn, sha256(length(role) || ':' || role || text) as d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
  )
), ids as (
  select conv_id as c, conv_id - conv_id % 20 as base,
    xor(list_reduce(range(8 * length(s)), lambda a, k: xor(
      xor(a, case when k % 8 = 0 then ascii(s[k // 8 + 1])::bigint else 0 end) >> 1,
      case when xor(a, case when k % 8 = 0 then ascii(s[k // 8 + 1])::bigint else 0 end) & 1 = 1 then 3988292384 else 0 end
    ), 4294967295::bigint), 4294967295::bigint) % 4 as h
  from (select distinct conv_id, conv_id::varchar as s from conversations where conv_id is not null)
), turns as (
  select c, pos, d, w from ids join t on t.conv_id = base where pos <= h union all select c, pos, d, w from ids join t on t.conv_id = c where pos > h
), path as (
  select c, row_number() over (partition by c order by pos) as depth, w, string_agg(d, '') over (partition by c order by pos) as node from turns
  union all select c, 0, 0, '' from ids
), whole as (
  select node, sha256(string_agg(c::varchar, ',' order by c)) as ends_sha256 from (select c, arg_max(node, depth) as node from path group by c) group by node
), nodes as (
  select node, depth, left(node, length(node) - 64) as up, min(c) as conv_id, count(*) as n_convs, max(w) as w from path group by node, depth
), kids as (
  select up, count(*) as n_children from nodes where depth > 0 group by up
), full_nodes as (
  select n.*, coalesce(k.n_children, 0) as n_children from nodes n left join kids k on k.up = n.node
), above as (
  select left(node, 64 * i) as node, (n_convs - 1) * w as saved, n_children = 0 as leaf from (select *, unnest(range(depth + 1)) as i from full_nodes)
), sums as (
  select node, sum(saved)::bigint as saved_tokens, count(*) filter (where leaf) as n_leaves from above group by node
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, coalesce(w.ends_sha256, sha256('')) as ends_sha256
from full_nodes n join sums s using (node) left join whole w using (node) left join nodes p on n.depth > 0 and p.node = n.up
"""
