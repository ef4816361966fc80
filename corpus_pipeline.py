"""The corpus pipeline: each stage works on all rows that the one before kept, from Parquet to Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontamination, lines, simhash, toxicity
from ledgerloom.llm.common import table, with_row_id
from ledgerloom.session import fresh_path, remove, settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the threshold; the classifier learns from ``labels``."""
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.with_score(docs, scorer, "_toxicity").where(F.col("_toxicity") < toxicity.THRESHOLD).drop("_toxicity")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one; n_chars follows the text."""
    return lines.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of the smallest id."""
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of no benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with digests of them and of the bytes decoded from them."""
    ranks, pattern = bpe.public_bpe()
    return bpe.encode(docs, ranks, pattern, keep=("doc_id", "lang", "source"), digests=True).drop("row")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        out, path = stage(spark, docs, sf_dir), fresh_path(spark, f"pipeline-{name}")
        # Rows for the line dedup are numbered where they are written anyway.
        docs = settle(with_row_id(out, lines.ROW) if stage is drop_toxic else out, f"pipeline-{name}", path)
        for old in before:
            remove(spark, old)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)


#: A classifier, edit distances, fingerprints and tokens: not to be said in SQL. tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None
