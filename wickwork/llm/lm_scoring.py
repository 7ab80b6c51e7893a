"""LM scoring with an Elias-Fano n-gram trie, built and queried shard by shard.

The model is a bigram model with Dirichlet smoothing: log10 of (c(v, w) + MU p(w)) / (c(v) + MU), where p is
the add-one unigram model of the training tokens. Every word has its own bigrams, by a hash of 63 bits.

The logarithm falls into one part for the pair and its second word, and one for the first word alone. So one
shuffle by the second word serves counting and scoring: a batch of texts becomes, for each shard, one row
that holds its bigrams with text and count, sorted and cut into byte planes. A shard's task counts its words
and bigrams from training texts, builds a reversed trie (words, pointers to the contexts they follow, contexts
relative to their word; values quantised to 8 bits, all in one memory map), looks all bigrams up by successor
search and returns sums by text. The number of shards follows the training tokens, so a shard has about
SHARD_TOKENS whatever the corpus; a word with more than a quarter of that is split by the context, and its
count is sent to every task (at most four words a shard).

A bigram's rows in a shard are settled in chunks: first all rows are counted, a chunk of CHUNK bigrams at a
time, then the trie is built and each chunk is looked up in it. A task keeps its rows packed, as they came, and
unpacks one chunk at a time, so what grows with a hot word's texts are bytes that the shuffle has brought.

Defined results: a null text is empty and has one token, the end. Without training texts every count is 0.
A null id counts as the empty text. Rows that repeat an id are texts of their own, no rows give none. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm.base import cut, table
from wickwork.llm.elias_fano import Map, Sequence

HASH_BITS = 63
MU = 1000.0
SHARD_TOKENS = 1_000_000
BATCH_DOCS, BATCH_BYTES = 1024, 2_000_000
DOC_BITS = 10
BIGRAMS, ABOUT = 0, 1
#: Of a text's sums in a shard: its place in the batch, score, base and known words.
SUM_BYTES = 2 + 8 + 8 + 4
#: Bigrams (with their texts) that a task unpacks at a time.
CHUNK = 150_000


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - HASH_BITS)


START, END = (_hash(name) for name in (b" start", b" end"))  # no word has a space


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def planes(x: np.ndarray, n: int) -> bytes:
    """The n low bytes of 64-bit numbers, byte by byte: the high ones of small numbers compress to nothing."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def unplaned(data: memoryview, n: int, count: int) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    out[:, :n] = np.frombuffer(data, np.uint8, n * count).reshape(n, count).T
    return out.view("<u8").ravel()


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n): how often each word (by hash) is in the texts of docs, summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.record_batch([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                w = _words(text)
                held.append(np.fromiter(map(_hash, w), np.uint64, len(w)))
                total += len(w)
                if total >= 3_000_000:
                    yield flush()
                    total = 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


class Totals:
    """The totals of the unigram model, and the counts of words that are split."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, docs: int, tokens: int, types: int) -> None:
        self.docs, self.tokens = docs, tokens
        self.whole = float(tokens + types + 1)
        self.shards = max(1, -(-tokens // SHARD_TOKENS))
        # hash -> c + 1 and c as context
        hashes, plus_one, as_context = (np.concatenate(x) for x in ((np.array([START, END], np.uint64), hashes), ([1, docs + 1], counts + 1), ([docs, 0], counts)))
        order = np.argsort(hashes)
        self.special, self.plus_one, self.as_context = hashes[order], plus_one[order].astype(float), as_context[order].astype(float)
        self.parts = np.maximum(1, -(-4 * plus_one[order].astype(np.int64) // SHARD_TOKENS)).astype(np.uint64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash its place among the special ones, and whether it is one."""
        at = np.minimum(np.searchsorted(self.special, h), len(self.special) - 1)
        return at, self.special[at] == h

    def shard(self, hashes: np.ndarray, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Of bigrams, whose words and contexts are places in hashes."""
        at, special = self.find(hashes)
        parts = np.where(special, self.parts[at], np.uint64(1))
        out = (_mixed(hashes) % np.uint64(self.shards)).astype(np.int32)[word]
        split = np.flatnonzero((parts > 1)[word])
        w, v = hashes[word[split]], hashes[context[split]]
        out[split] = (_mixed(w + _mixed(_mixed(v) % parts[word[split]] + np.uint64(1))) % np.uint64(self.shards)).astype(np.int32)
        return out


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[np.ndarray]:
    """The places of each shard that occurs, in order."""
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=False):
        yield order[a:b]


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.uint64(0))


def _packed(hashes: np.ndarray, word: np.ndarray, context: np.ndarray, doc: np.ndarray, count: np.ndarray) -> bytes:
    """Bigrams sorted by word: the distinct words with how many bigrams each has, the distinct contexts, and the bigrams (count: twice the count, plus 1 if the text trains)."""
    first = np.flatnonzero(np.diff(word, prepend=-1))
    contexts, of = np.unique(context, return_inverse=True)
    sizes = np.array([len(first), len(contexts), len(word)], "<u4").tobytes()
    return sizes + b"".join((planes(_steps(hashes[word[first]]), 8), planes(np.diff(np.append(first, len(word))), 4), planes(_steps(hashes[contexts]), 8), planes(of, 4), planes(doc, 2), planes(count, 4)))


def _unpacked(data: memoryview) -> tuple[np.ndarray, ...]:
    """Words, how many bigrams each has, contexts, and of each bigram its context's place, text and count."""
    words, contexts, n = (int(x) for x in np.frombuffer(data, "<u4", 3))
    out, at = [], 12
    for size, count in ((8, words), (4, words), (8, contexts), (4, n), (2, n), (4, n)):
        out.append(unplaned(data[at:], size, count))
        at += size * count
    return np.cumsum(out[0], dtype=np.uint64), out[1].astype(np.int64), np.cumsum(out[2], dtype=np.uint64), *(x.astype(np.int64) for x in out[3:])


def _rows(sent):
    """Batches of texts to rows (shard, kind, batch, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, task, number = sent.value, TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            texts_of = batch.column("text").cast(pa.binary())
            while at < batch.num_rows:
                size, end = 0, at
                while end < batch.num_rows and end - at < BATCH_DOCS and size < BATCH_BYTES:
                    size += len(texts_of[end].as_buffer() or b"") if texts_of[end].is_valid else 0
                    end += 1
                piece, at = batch.slice(at, end - at), end
                name, number = (task << 32) + number, number + 1
                out: list[tuple[int, int, bytes]] = []
                words = [_words(x) for x in piece.column("text").cast(pa.binary()).to_pylist()]
                n = np.array([len(w) for w in words])
                h = np.fromiter((_hash(w) for doc in words for w in doc), np.uint64, int(n.sum()))
                hashes, ids = np.unique(np.concatenate([np.array([START, END], np.uint64), h]), return_inverse=True)
                start, stop, ids = ids[0], ids[1], ids[2:]
                train = ~np.asarray(piece.column("held_out").to_numpy(zero_copy_only=False), bool)
                # every text as start, words, end
                follow = np.insert(ids, np.cumsum(n), stop)
                before = np.concatenate([[start], follow[:-1]])
                before[before == stop] = start
                of = np.repeat(np.arange(len(n)), n + 1)
                # a bigram and its text in one number
                bits = len(hashes).bit_length()
                key = np.sort(follow.astype(np.uint64) << np.uint64(bits + DOC_BITS) | before.astype(np.uint64) << np.uint64(DOC_BITS) | of.astype(np.uint64))
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                c, key = np.diff(np.append(first, len(key))), key[first]
                d = (key & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)
                w, v = (key >> np.uint64(bits + DOC_BITS)).astype(np.int64), (key >> np.uint64(DOC_BITS) & np.uint64((1 << bits) - 1)).astype(np.int64)
                shard = t.shard(hashes, w, v)
                for i in _by_shard(shard, t.shards):
                    out.append((int(shard[i[0]]), BIGRAMS, _packed(hashes, w[i], v[i], d[i], 2 * c[i] + train[d[i]])))
                # what the special words add; the others' counts are known to their shards
                place, special = t.find(hashes)
                base = np.bincount(of, np.where(special, np.log10(t.plus_one[place] / t.whole), 0)[follow], len(n))
                known = np.bincount(of, (special & (t.plus_one[place] > 1))[follow], len(n))
                score = -np.bincount(of, np.where(special, np.log10(t.as_context[place] + MU), 0)[before], len(n))
                facts = pa.table({"doc_id": piece.column("doc_id"), "held_out": piece.column("held_out"), "n_tokens": n + 1, "known": known.astype(np.int64), "base": base, "score": score})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, facts.schema) as writer:
                    writer.write_table(facts)
                out.append((number % t.shards, ABOUT, sink.getvalue().to_pybytes()))
                yield pa.record_batch([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([name] * len(out), pa.int64()), pa.array([x[2] for x in out], pa.binary())], ["shard", "kind", "batch", "data"])

    return run


def _summed(word: np.ndarray, context: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, context) in order with the sums of their counts."""
    order = np.lexsort((context, word))
    word, context = word[order], context[order]
    first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (context[1:] != context[:-1])])) if len(word) else np.empty(0, np.intp)
    return word[first], context[first], np.add.reduceat(count[order], first) if len(first) else count[:0]


class Trie:
    """The bigrams of a shard, reversed: words, pointers to the contexts they follow, and quantised values."""

    def __init__(self, words: np.ndarray, contexts: np.ndarray, word: np.ndarray, context: np.ndarray, value: np.ndarray) -> None:
        """Of sorted hashes, and sorted bigrams whose words and contexts are places in them; every word has a bigram."""
        start = np.searchsorted(word, np.arange(len(words) + 1))
        # half of the levels where the values are, half evenly over their range
        book = np.sort(np.concatenate([np.quantile(value, (np.arange(128) + 0.5) / 128), np.linspace(value.min(), value.max(), 128)])) if len(value) else np.zeros(256)
        right = np.clip(np.searchsorted(book, value), 1, 255)
        code = (right - (value - book[right - 1] < book[right] - value)).astype(np.uint8)
        self.width = max(len(contexts), 1)
        universe = [1 << HASH_BITS, len(word) + 1, 1 << HASH_BITS, max(len(words), 1) * self.width]
        levels = [words, start.astype(np.uint64), contexts, (word * self.width + context).astype(np.uint64)]
        held = Map([a for x, u in zip(levels, universe, strict=True) for a in Sequence.arrays(x, u)] + [code, book]).arrays
        self.words, self.pointers, self.contexts, self.bigrams = (Sequence.over(held[3 * i : 3 * i + 3], u) for i, u in enumerate(universe))
        self.code, self.book = held[12:]

    @staticmethod
    def _places(level: Sequence, h: np.ndarray) -> np.ndarray:
        """Of each hash in a level, -1 if it isn't there."""
        out = np.full(len(h), -1)
        at = level.successor(h)
        inside = np.flatnonzero(at < level.n)
        hit = inside[level.access(at[inside]) == h[inside]]
        out[hit] = at[hit]
        return out

    def find(self, words: np.ndarray, contexts: np.ndarray, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Values of bigrams of the trie, NaN for others; words and contexts are hashes, bigrams places in them."""
        out = np.full(len(word), np.nan)
        if not self.words.n:
            return out
        rank, relative = self._places(self.words, words)[word], self._places(self.contexts, contexts)[context]
        seen = np.flatnonzero((rank >= 0) & (relative >= 0))
        wanted, stop = (rank[seen] * self.width + relative[seen]).astype(np.uint64), self.pointers.access(np.arange(1, self.words.n + 1)).astype(np.int64)[rank[seen]]
        at = self.bigrams.successor(wanted)
        inside = at < stop
        hit = inside.copy()
        hit[inside] = self.bigrams.access(at[inside]) == wanted[inside]
        out[seen[hit]] = self.book[self.code[at[hit]]]
        return out


def _sums(sent):
    """The rows of each shard to sums by text: rows (batch, kind, data)."""

    def chunks(rows: list[tuple[int, pa.Buffer]]) -> Iterator[tuple[int, list[tuple[int, pa.Buffer]]]]:
        """Rows that hold about CHUNK bigrams together, with the place of the first."""
        first = n = 0
        for k, (_, data) in enumerate(rows):
            n += int(np.frombuffer(data, "<u4", 1, 8)[0])
            if n >= CHUNK or k == len(rows) - 1:
                yield first, rows[first : k + 1]
                first, n = k + 1, 0

    def opened(rows: list[tuple[int, pa.Buffer]]) -> tuple[np.ndarray, ...]:
        """Of a chunk's bigrams: the distinct words and contexts, each bigram's places in them, its text, count, and whether it trains."""
        parts = []
        for k, (_, data) in enumerate(rows):
            words, sizes, contexts, context, d, c = _unpacked(memoryview(data))
            parts.append((words, sizes, contexts, context, (d + (k << DOC_BITS)).astype(np.int32), c >> 1, (c & 1).astype(bool)))
        words, word = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        contexts, context = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        starts = np.cumsum([0, *(len(p[2]) for p in parts)])
        word = np.repeat(word, np.concatenate([p[1] for p in parts]))
        context = np.concatenate([context[a + p[3]] for a, p in zip(starts, parts, strict=False)])
        return words, contexts, word, context, *(np.concatenate([p[i] for p in parts]) for i in (4, 5, 6))

    def counted(rows: list[tuple[int, pa.Buffer]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct bigrams of training texts in order: word, context, count."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        merged = 0
        for _, some in chunks(rows):
            words, contexts, word, context, _, count, train = opened(some)
            width = max(len(contexts), 1)
            pairs, place = np.unique((word * width + context)[train], return_inverse=True)
            held.append((words[pairs // width], contexts[pairs % width], np.bincount(place, count[train], len(pairs))))
            if sum(len(x[0]) for x in held) > 1.5 * merged + 2 * CHUNK:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                merged = len(held[0][0])
        return _summed(*map(np.concatenate, zip(*held, strict=True)))

    def settle(rows: list[tuple[int, pa.Buffer]]) -> Iterator[list[tuple[int, int, bytes]]]:
        """For each chunk its batches with their texts' sums, of texts that have bigrams here."""
        t = sent.value
        w, v, seen = counted(rows)
        (words, word), (contexts, context) = (np.unique(x, return_inverse=True) for x in (w, v))
        c = np.bincount(word, seen, len(words))

        def plus_one(h: np.ndarray) -> np.ndarray:
            """c + 1 of words, all of whose bigrams are here unless their counts are known to all tasks."""
            at, special = t.find(h)
            i = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
            here = np.where(words[i] == h, c[i], 0) if len(words) else np.zeros(len(h))
            return np.where(special, t.plus_one[at], here + 1)

        trie = Trie(words, contexts, word, context, np.log10(seen + MU * plus_one(words)[word] / t.whole))
        del w, v, seen, word, context
        for _, some in chunks(rows):
            h, contexts_, word, context, doc, count, _ = opened(some)
            value, own, special = trie.find(h, contexts_, word, context), plus_one(h), t.find(h)[1]
            new = np.isnan(value)
            value[new] = np.log10(MU * own / t.whole)[word[new]]
            alone = [np.where(special, 0, x)[word] for x in (np.log10(own - 1 + MU), np.log10(own / t.whole), own > 1)]
            texts, doc = np.unique(doc, return_inverse=True)
            score, base, known = (np.bincount(doc, count * x, len(texts)) for x in (value - alone[0], alone[1], alone[2]))
            cuts = np.searchsorted(texts, np.arange(len(some) + 1) << DOC_BITS)
            inside = texts & ((1 << DOC_BITS) - 1)
            out = []
            for (name, _), a, b in zip(some, cuts[:-1], cuts[1:], strict=True):
                out.append((name, BIGRAMS, planes(inside[a:b].astype(np.int64), 2) + score[a:b].tobytes() + base[a:b].tobytes() + planes(known[a:b].astype(np.int64), 4)))
            yield out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], ["batch", "kind", "data"])

        at, rows = None, []
        for batch in batches:
            for shard, kind, name, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "batch")), batch.column("data"), strict=True):
                if kind == ABOUT:
                    yield packed([(name, kind, data.as_py())])
                    continue
                if at != shard:
                    yield from map(packed, settle(rows) if rows else ())
                    at, rows = shard, []
                rows.append((name, data.as_buffer()))
        yield from map(packed, settle(rows) if rows else ())

    return run


def _joined(tokens: int):
    """The sums of each batch of texts, put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(facts: pa.Table, total: np.ndarray) -> pa.RecordBatch:
            n = facts.num_rows
            score, base, known = total[:, :n]
            columns = [
                facts["doc_id"].combine_chunks(), facts["held_out"].combine_chunks(), facts["n_tokens"].combine_chunks(), pa.array(np.asarray(facts["known"]) + known.astype(np.int64)),
                pa.array(np.full(n, tokens)), pa.array(np.asarray(facts["base"]) + base), pa.array(np.asarray(facts["score"]) + score),
            ]
            return pa.record_batch(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        at, facts, total = None, None, None
        for batch in batches:
            for name, kind, data in zip(*(batch.column(c).to_pylist() for c in ("batch", "kind", "data")), strict=True):
                if name != at:
                    if at is not None:
                        yield finish(facts, total)
                    at, facts, total = name, None, np.zeros((3, 1 << DOC_BITS))
                if kind == ABOUT:
                    facts = pa.ipc.open_stream(data).read_all()
                else:
                    n = len(data) // SUM_BYTES
                    texts = unplaned(memoryview(data), 2, n).astype(np.int64)
                    total[:2, texts] += np.frombuffer(data, float, 2 * n, 2 * n).reshape(2, -1)
                    total[2, texts] += unplaned(memoryview(data)[18 * n :], 4, n)
        if at is not None:
            yield finish(facts, total)

    return run


def totals(train: DataFrame) -> Totals:
    counts = cut(word_counts(train))
    docs = train.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    hot = counts.where(F.col("n") > SHARD_TOKENS / 4)  # at most four a shard
    found = hot.toArrow()
    return Totals(np.asarray(found["h"], np.int64).astype(np.uint64), np.asarray(found["n"], np.int64), docs, total.n + docs, total.v + (docs > 0))


def scored(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    t = totals(docs.where(~F.col("held_out")))
    sent = docs.sparkSession.sparkContext.broadcast(t)
    rows = docs.mapInArrow(_rows(sent), "shard int, kind int, batch long, data binary")
    dealt = rows.repartition(F.col("shard")).sortWithinPartitions("shard", "kind")
    sums = dealt.mapInArrow(_sums(sent), "batch long, kind int, data binary")
    return sums.repartition(F.col("batch")).sortWithinPartitions("batch").mapInArrow(_joined(t.tokens), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
