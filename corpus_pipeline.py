"""A corpus pipeline of five stages: (spark, docs, sf_dir) -> DataFrame each.

toxicity: documents that the classifier rejects go.  lines: repeated lines go
from the texts.  near_duplicates: of documents alike in 80 % of their
five-word shingles one stays, by SimHash blocks.  mixing: texts are taken as the
mix of sources says, a document that it takes in part or twice giving a row each
time.  bpe: what is left is encoded and decoded.

In every stage a null text counts as empty, a null doc_id as the smallest, rows
that repeat are rows of their own (near_duplicates keeps one of them), columns
that a stage doesn't name are carried along, whatever their names, and an empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import bpe, lines, mixing, queries, simhash, toxicity
from voxloom.llm.common import store


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects; it learns from the labelled documents of the input tables.  A text without words stays."""
    return toxicity.keep_clean(docs, queries.toxicity_model(spark, sf_dir, F.col("doc_id").isNotNull()))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out of the texts every line that repeats, exactly or nearly, an earlier one; every document stays, one of such lines alone with an empty text."""
    return lines.without_repeated_lines(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the row of the smallest doc_id; all texts without a word are one group."""
    return simhash.keep_one_similar(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, cuts or drops texts until every source has its target of words."""
    return mixing.mixed_texts(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per text: its number of tokens and the digests of its ids and of what they decode to."""
    return bpe.encode_documents(docs, queries.tokenizer_path(queries.RANKS))


STAGES = [
    ("toxicity", toxicity_stage),
    ("lines", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: zstandard's lengths, SimHash and BPE have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
