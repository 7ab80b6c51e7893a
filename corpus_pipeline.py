"""The corpus pipeline: documents through five operators of wickwork.llm, stage by stage.

Each stage gets what the one before it kept, as Parquet read back, and all but the last return rows with
the columns of documents. The last stage's ids can't be computed in SQL, so ORACLE_SQL is None and the
tests hold the stages against brute force.

Defined results, stage by stage: null and wordless texts fail the quality rules and go there. Rows without an id are
judged by their text, linked with nothing and kept by the later stages. Rows that repeat an id and a text are kept or
removed together by the second and third stage, and taken one by one by the mix. Rows that repeat an id with other
texts are documents of their own. A null source is a source, a null language a stratum. Very long texts pass whole
through every stage. Columns beyond those of documents pass untouched, whatever their names. An empty table stays
empty in each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wickwork.llm import decontamination, mixing, near_dedup, quality_rules, token_output
from wickwork.llm.base import removed, shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filtered(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest id stays."""
    return near_dedup.deduplicated(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; a document may go, stay or be repeated."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as packed token ids on disk, and per document its place in them."""
    return token_output.encoded(docs).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_output", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table is deleted once the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            removed(spark, before)
        before = folder
    return docs
