"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from whole texts in one pass. A bounded sample of labelled rows (about MAX_ROWS, those
whose hash is under a threshold) trains the trees on the driver: values are put into quantile bins, and each
level of a tree is chosen from the sums of gradients by node, feature and bin. The trees are complete and
flattened into three arrays, so tasks score all rows of a batch by a few vectorised steps a level. The
model's size depends on TREES and DEPTH alone.

Labels are learned only from rows whose crc32 of the id's text, mod 3, isn't 1.

Defined results: a null text is empty and has zero statistics. Several labels for an id: the least counts;
null labels don't. Without labels of both kinds the score is the smoothed share of label 1 (0.5 with none).
A null id counts as the empty text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm.base import cut, table

FEATURES = ("log_bytes", "log_words", "word_bytes", "distinct_words", "commonest_word", "word_twice", "distinct_lines", "line_words", "capitals", "digits", "symbols", "bars", "shouts", "stops", "commas", "other_signs", "above_ascii")
MAX_ROWS = 40_000
TREES, DEPTH, BINS, RATE, SMOOTH = 40, 4, 64, 0.2, 1.0

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def statistics(text: bytes | None) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    m = max(len(words), 1)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    twice = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    signs = int(c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum())
    symbols = int(c[[35, 42, 36, 37, 38, 60, 62]].sum())
    return [
        np.log1p(n), np.log1p(len(words)), (n - int(c[32])) / m, len(seen) / m, max(seen.values(), default=0) / m, twice / m, len(set(lines)) / max(len(lines), 1), m / max(len(lines), 1),
        c[_UPPER].sum() / n, c[_DIGIT].sum() / n, symbols / n, c[124] / n, c[33] / n, c[46] / n, c[44] / n, (signs - symbols - int(c[[124, 33, 46, 44]].sum())) / n, c[128:].sum() / n,
    ]


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, x: the statistics)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [list(map(float, statistics(t))) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "held_out", "x"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, x array<double>")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


class Trees:
    """Complete trees of one depth: for each inner node a feature and a limit (greater goes right), for each leaf a value."""

    def __init__(self, base: float, feature: np.ndarray, limit: np.ndarray, leaf: np.ndarray) -> None:
        self.base, self.feature, self.limit, self.leaf = base, feature, limit, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), np.intp)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosts the log loss by second-order steps."""
    share = (y.sum() + 1) / (len(y) + 2)
    base, inner = float(np.log(share / (1 - share))), 2**DEPTH - 1
    feature, limit, leaf = np.zeros((TREES, inner), np.intp), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    if 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
        total = np.full(len(y), base)
        for t in range(TREES):
            p = 1 / (1 + np.exp(-total))
            g, h = p - y, p * (1 - p)
            node = np.zeros(len(y), np.intp)
            for level in range(DEPTH):
                first, n = 2**level - 1, 2**level
                best = np.full(n, 1e-9)
                for f, e in enumerate(edges):
                    cell = (node - first) * BINS + binned[:, f]
                    G, H = (np.bincount(cell, w, n * BINS).reshape(n, BINS).cumsum(axis=1) for w in (g, h))
                    gain = G**2 / (H + SMOOTH) + (G[:, -1:] - G) ** 2 / (H[:, -1:] - H + SMOOTH) - G[:, -1:] ** 2 / (H[:, -1:] + SMOOTH)
                    for k in range(n if len(e) else 0):
                        b = int(gain[k, : len(e)].argmax())
                        if gain[k, b] > best[k]:
                            best[k], feature[t, first + k], limit[t, first + k] = gain[k, b], f, e[b]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[t][node]] > limit[t][node])
            G, H = np.bincount(node - inner, g, inner + 1), np.bincount(node - inner, h, inner + 1)
            leaf[t] = -RATE * G / (H + SMOOTH)
            total += leaf[t][node - inner]
    return Trees(base, feature, limit, leaf)


def sampled(marked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of about MAX_ROWS rows (all, if there are fewer), in an order of their own.

    A row is taken if its hash is under the share that is wanted, so each task sends its few rows and no more.
    """
    marked = cut(marked)
    share = min(1.0, MAX_ROWS / max(1, marked.count()))
    # the limit only counts if more rows repeat id and text than the sample holds
    some = marked.where(F.shiftrightunsigned("h", 2) <= int(share * (2**62 - 1))).limit(2 * MAX_ROWS).toArrow()
    x = np.asarray(some.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES))
    order = np.lexsort((np.asarray(some.column("quality")), np.asarray(some.column("doc_id")), np.asarray(some.column("h"))))
    return x[order], np.asarray(some.column("quality"), float)[order]


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    x = cut(described(docs))
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = x.where(~F.col("held_out")).join(known, "doc_id").select(F.xxhash64("doc_id", "x").alias("h"), "doc_id", "x", "quality")
    sent = docs.sparkSession.sparkContext.broadcast(train(*sampled(marked)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = sent.value.score(np.asarray(batch.column("x").flatten()).reshape(-1, len(FEATURES)))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return x.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
