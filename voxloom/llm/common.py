"""Shared plumbing: document keys, Arrow batches of texts, and the scratch tables of :mod:`voxloom.scratch`."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import drop, free_name, store

__all__ = ["BATCH_BYTES", "NULL_ID", "bound_batches", "drop", "free_name", "keyed", "real_id", "store", "word_spans"]

#: Bytes of text that one Arrow batch may carry to a Python worker.
BATCH_BYTES = 8 << 20
#: Stands for a null doc_id in internal keys.
NULL_ID = -(1 << 63)


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so long texts can't make a batch outgrow a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_d`` (doc_id, null as NULL_ID), ``_k`` (hash of id and text) and ``_t`` (text as bytes, null as empty).

    ``_d`` and ``_k`` together name a document; only rows that repeat both id
    and text share them, and such rows always get the same result.
    """
    bound_batches(docs.sparkSession)
    d = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(d.alias("_d"), F.xxhash64(d, t).alias("_k"), t.cast("binary").alias("_t"))


def real_id(column: str = "_d"):
    """The doc_id behind an internal id."""
    return F.when(F.col(column) != NULL_ID, F.col(column))


def word_spans(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and each word's start and end in that."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(length + 1) - 1
    return b" ".join(words), end - length, end
