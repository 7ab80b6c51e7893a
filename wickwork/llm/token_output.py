"""Token-ID output: texts as ids of a public tokenizer, packed into the fewest bits of its vocabulary.

Documents are dealt into ranges of doc_id and sorted there, so files, blocks in a file and documents in
a block ascend. A row of a file is a block: the ids of a few hundred documents, each in ``bits`` bits,
its first and last doc_id, and the offsets at which its documents end. read_documents finds documents by those
and unpacks them without touching the others. Spark writes the files, so a lost task is simply run again.

The tokenizer's rules never look across white space, so the distinct words of a few megabytes are encoded once
and looked up after that; a worker keeps a bounded table of words between its tasks.

Defined results: a null text is empty, and each text gets the end id. A null doc_id comes first; rows
that repeat an id stand next to each other, in the order of their texts, and are all written. No rows
give no blocks. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.llm.base import shared_folder, table

# Fixed values of word_bpe_49k.json, and the end id that the output appends.
VOCABULARY = 49408
END_ID = 1
BLOCK_DOCS = 256
BLOCK_IDS = 1 << 20
KNOWN_WORDS = 1_000_000
TOGETHER = 1000
PIECE_BYTES = 4 << 20
BLOCKS = "part int, block int, bits int, n_ids long, first_id long, last_id long, doc_ids array<bigint>, ends array<bigint>, ids binary"


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in ``bits`` bits each, the lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop (excluded) as uint32; reads only the bytes that hold them."""
    if bits in (8, 16, 32):
        wide = bits // 8
        return np.frombuffer(packed, f"<u{wide}", stop - start, start * wide).astype("<u4")
    first = start * bits // 8
    held = np.frombuffer(packed, np.uint8, (stop * bits + 7) // 8 - first, first)
    skip = start * bits - first * 8
    planes = np.unpackbits(held, bitorder="little")[skip : skip + (stop - start) * bits].reshape(-1, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


# Letters that normalising leaves as they are, and the pieces of a word in lower case.
LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff\u0430-\u044f\u4e00-\u9fa5"
PLAIN = re.compile(f"[{LETTERS}]+[!-&(-/:-@\\[-`{{-~]*")
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+")


def _gathered(values: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists that lie one after the other in values and stop at ends: those at the places ``which``, and their ends."""
    starts = np.concatenate([[0], ends[:-1]])[which]
    sizes = ends[which] - starts
    stops = np.cumsum(sizes)
    return values[np.repeat(starts - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)], stops


class Encoder:
    """Encodes texts by their distinct words; the ids of known words are kept.

    The tokenizer cuts a word into pieces, encodes each by itself and marks its last id. So the pieces of new
    ASCII words and words of common letters, which are certain, are encoded once each and a thousand together,
    as one text with spaces between them, and the words are put together from them. Any other word is encoded
    whole and alone.
    """

    _open: dict[tuple[str, int], Encoder] = {}

    def __init__(self, path: str, bits: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = None  # pieces are as normalising would leave them
        words = self.tokenizer.get_vocab()
        self.last = np.zeros(max(words.values()) + 1, bool)
        self.last[[i for word, i in words.items() if word.endswith("</w>")]] = True
        self.kind = np.dtype("<u2" if bits <= 16 else "<u4")
        self.forget()

    @classmethod
    def at(cls, path: str, bits: int) -> Encoder:
        if (path, bits) not in cls._open:
            cls._open[path, bits] = cls(path, bits)
        return cls._open[path, bits]

    def forget(self) -> None:
        #: word -> its number; the ids of the k-th word end at ends[k]; the empty one is before leading white space
        self.known: dict[bytes, int] = {b"": 0}
        self.ids, self.ends = np.empty(0, self.kind), np.zeros(1, np.int64)

    def _add(self, words: list[bytes], ids: list[np.ndarray], sizes: np.ndarray) -> None:
        at = len(self.known)
        self.known.update(zip(words, range(at, at + len(words)), strict=True))
        self.ends = np.concatenate([self.ends, len(self.ids) + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, *ids])

    def _add_alone(self, words: list[str]) -> None:
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            ids = [np.asarray(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            self._add([w.encode() for w in some], ids, np.array([len(x) for x in ids], np.int64))

    def _add_pieces(self, pieces: list[str]) -> None:
        words, found, sizes, other = [], [], [], []
        for i in range(0, len(pieces), TOGETHER):
            some = pieces[i : i + TOGETHER]
            ids = np.asarray(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                words += map(str.encode, some)
                found.append(ids)
                sizes.append(np.diff(ends, prepend=0))
            else:
                other += some
        if words:
            self._add(words, found, np.concatenate(sizes))
        self._add_alone(other)

    def _learn(self, new: list[bytes]) -> None:
        single, alone, made, parts = {}, [], [], []
        for w in new:
            text = w.decode()
            if text.isalpha() and (text.isascii() or PLAIN.fullmatch(text)):
                single[text] = None
            elif (text.isascii() and text.isprintable() and "<|" not in text) or PLAIN.fullmatch(text):
                made.append(w)
                parts.append(PIECES.findall(text))
                single.update(dict.fromkeys(parts[-1]))
            else:
                alone.append(text)
        self._add_pieces([p for p in single if p.encode() not in self.known])
        some = [k for k, w in enumerate(made) if w not in self.known]  # a word of one piece is known now
        if some:
            numbers = np.fromiter((self.known[p.encode()] for k in some for p in parts[k]), np.int64)
            ids, stops = _gathered(self.ids, self.ends, numbers)
            stops = stops[np.cumsum([len(parts[k]) for k in some]) - 1]
            self._add([made[k] for k in some], [ids], np.diff(stops, prepend=0))
        self._add_alone(alone)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's end."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        texts = texts.fill_null("")
        special = pc.match_substring(texts, "<|")
        words = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if pc.any(special).as_py():  # special strings count in their own case only
            distinct = [w if b"<|" in w else w.lower() for w in distinct]
        self._learn(list(dict.fromkeys(filterfalse(self.known.__contains__, distinct))))
        numbers = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        ids, stops = _gathered(self.ids, self.ends, numbers[coded.indices.to_numpy()])
        return ids, np.concatenate([[0], stops])[np.cumsum(words.value_lengths().to_numpy())]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about PIECE_BYTES of text, or of one text."""
    upto = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(upto // PIECE_BYTES)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def _blocks(path: str, end_id: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block = Encoder.at(path, bits), TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # doc_ids, their ids and where each ends
        docs = total = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, docs, total
            doc_ids = pa.concat_arrays([x[0] for x in held])
            before = np.cumsum([0, *(x[2][-1] for x in held)])
            ends = np.concatenate([x[2] + a for x, a in zip(held, before, strict=False)])
            packed = pack(np.concatenate([x[1] for x in held]), bits)
            span = pc.min_max(doc_ids)
            row = [[part], [block], [bits], [total], [span["min"].as_py()], [span["max"].as_py()], [doc_ids], [ends], [packed]]
            held.clear()
            block, docs, total = block + 1, 0, 0
            kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.record_batch([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], ["part", "block", "bits", "n_ids", "first_id", "last_id", "doc_ids", "ends", "ids"])

        for batch in batches:
            for piece in _pieces(batch):
                ids, stops = encoder.encode(piece.column("text"))
                ids, stops = np.insert(ids, stops, end_id), stops + np.arange(1, len(stops) + 1)
                at, begin = 0, 0
                while at < len(stops):
                    # as many texts as fit the block, one at least
                    to = min(max(int(np.searchsorted(stops, begin + BLOCK_IDS - total, "right")), at + (not docs)), at + BLOCK_DOCS - docs)
                    if to > at:
                        held.append((piece.column("doc_id").slice(at, to - at).cast(pa.int64()), ids[begin : stops[to - 1]], stops[at:to] - begin))
                        docs, total = docs + to - at, total + int(stops[to - 1]) - begin
                        at, begin = to, int(stops[to - 1])
                    if at < len(stops) or docs >= BLOCK_DOCS:
                        yield flush()
        if docs:
            yield flush()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, vocabulary: int = VOCABULARY) -> None:
    """Write the texts of docs as packed ids into a new folder."""
    dealt = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(_blocks(tokenizer, end_id, bits_for(vocabulary)), BLOCKS).write.parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in ("part", "block", "bits", "n_ids", "doc_ids", "ends", "ids")}
            ends = row["ends"].values.to_numpy()
            starts, n = np.concatenate([[0], ends[:-1]]), len(ends)
            ids = memoryview(unpack(row["ids"].as_buffer(), row["bits"].as_py(), 0, row["n_ids"].as_py())).cast("B")
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            columns = [np.full(n, row["part"].as_py(), np.int32), np.full(n, row["block"].as_py(), np.int32), row["doc_ids"].values, starts, ends, crc]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["part", "block", "doc_id", "at", "end", "crc"])


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32, part and block.

    Only sums by part (one row a file) meet in one task.
    """
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    heads = blocks.select("part", "block", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("part", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("block_start")).join(parts, "part")
    docs = blocks.mapInArrow(_documents, "part int, block int, doc_id long, at long, end long, crc long")
    met = docs.join(heads, ["part", "block"])
    start = F.col("part_start") + F.col("block_start") + F.col("at")
    return met.select("doc_id", start.alias("start"), (F.col("end") - F.col("at")).alias("n_tokens"), F.col("crc").alias("ids_crc32"), "part", "block")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and its ids, for every document of a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["ids"], row["bits"], 0, row["n_ids"]).astype("i4")
                lists = pa.ListArray.from_arrays(pa.array([0, *row["ends"]], pa.int32()), pa.array(ids))
                yield pa.record_batch([pa.array(row["doc_ids"], pa.int64()), lists], ["doc_id", "ids"])

    return spark.read.schema(BLOCKS).parquet(folder).mapInArrow(run, "doc_id long, ids array<int>")


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the wanted documents alone, as often as a folder holds them.

    Parquet skips files and row groups by the blocks' first and last doc_id; of the blocks left, only the bits
    of the wanted documents are unpacked.
    """
    wanted = sorted(set(doc_ids))
    near = F.lit(False)
    for i in range(0, len(wanted), max(1, len(wanted) // 50)):  # at most some 50 ranges for the scan
        some = wanted[i : i + max(1, len(wanted) // 50)]
        near |= (F.col("first_id") <= some[-1]) & (F.col("last_id") >= some[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bits, docs, ends, ids in zip(*(batch.column(c) for c in ("bits", "doc_ids", "ends", "ids")), strict=True):
                ends = ends.values.to_numpy()
                for k in np.flatnonzero(np.isin(docs.values.to_numpy(zero_copy_only=False), wanted)).tolist():
                    found = unpack(ids.as_buffer(), bits.as_py(), int(ends[k - 1]) if k else 0, int(ends[k])).astype("i4")
                    yield pa.record_batch([docs.values.slice(k, 1), pa.array([found], pa.list_(pa.int32()))], ["doc_id", "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(folder).where(near).select("bits", "doc_ids", "ends", "ids")
    return blocks.mapInArrow(run, "doc_id long, ids array<int>")


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write docs to a new folder among the shared ones and give the index read back from it."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, tokenizer)
    return read_index(docs.sparkSession, folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")
