"""The pipeline's stages on a small corpus, each against what it was given."""

from __future__ import annotations

import collections
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from wickwork.llm import decontamination, mixing, near_dedup, quality_rules
from wickwork.llm.base import table


def test_stages(spark, duck, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs, rows = table(spark, SMALL, "documents"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        before, docs = docs.columns, spark.read.parquet(str(tmp_path / name))
        rows[name] = docs.collect()
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == before
    quality, near, clean, mixed, tokens = rows.values()
    assert 0 < len(clean) <= len(near) < len(quality) < table(spark, SMALL, "documents").count()
    # quality: the verdicts that SQL gives
    kept = duck.execute("with " + quality_rules.SQL_COUNTED.replace("{documents}", "documents") + "select doc_id from judged where kept").fetchall()
    assert sorted(r.doc_id for r in quality) == sorted(x[0] for x in kept)
    # mixing: as many words of each document as SQL takes of the stage's own input
    sql = mixing.SQL.replace("from documents", f"from read_parquet('{tmp_path}/decontamination/*.parquet')")
    taken = {r[0]: r[4] // r[1] for r in duck.execute(f"select doc_id, size, source_size, target, taken from ({sql})").fetchall() if r[1]}
    assert collections.Counter(r.doc_id for r in mixed) == collections.Counter(taken)
    sets = [set(near_dedup.shingles(r.text.encode(), 5).tolist()) for r in near]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert 100 * len(a & b) < 80 * len(a | b)
    items = decontamination.Items([(r.item_id, decontamination.hashed_words(r.text.encode())) for r in table(spark, SMALL, "benchmark").collect()])
    assert {r.doc_id for r in near if not items.matches(decontamination.hashed_words(r.text.encode()))} == {r.doc_id for r in clean}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean}
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for r, t in zip(sorted(mixed, key=lambda r: r.doc_id), sorted(tokens, key=lambda t: t.start), strict=True):
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        assert (t.doc_id, t.start, t.n_tokens, t.ids_crc32) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, repeated rows and ids, a very long text, columns of the operators' own names, no rows at all."""
    long = " ".join(f"word{i}" for i in range(60_000))
    plain = [" ".join(f"{a}{i}" for i in range(40)) for a in "abcdefg"]
    rows = [
        (None, None, None, None, None), (None, plain[0], None, None, 1), (None, plain[0], None, None, 1), (1, plain[1], "en", "s", 2), (1, plain[1], "en", "s", 2), (1, plain[2], "en", "s", 3), (2, "", "en", "s", 0),
        (3, "  \n", None, "s", 3), (4, long, "xx", "t", None), (5, long + " more", "xx", "t", None), (6, plain[3], None, None, 9), (-7, plain[4], "en", None, 9),
    ]
    schema = table(spark, SMALL, "documents").schema
    docs = spark.createDataFrame(rows, schema)
    for c in ("row", "copy", "part", "text_md5", "q_words", "h", "bucket", "start"):
        docs = docs.withColumn(c, F.lit(1))
    wanted, columns = {}, docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        out = stage(spark, docs, SMALL)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        wanted[name] = collections.Counter((r.doc_id, r.text) for r in docs.collect()) if k < 4 else docs.collect()
    quality, near, clean, mixed, tokens = wanted.values()
    has_words = collections.Counter((r[0], r[1]) for r in rows if r[1] and r[1].split())
    assert quality == has_words
    assert near == clean == quality - collections.Counter({(5, long + " more"): 1})
    assert set(mixed) <= set(clean) and len(tokens) == sum(mixed.values())
    assert sorted(r.start for r in tokens)[0] == 0


def test_run_is_a_registered_query(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"](spark, SMALL).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
