"""Voice prompts: candidates of a speaker, the rolling cache, and the choice for a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import free_name

PIPELINE_RANGE, CORPUS_RANGE = (3.0, 15.0), (10.0, 25.0)
CACHE = 50


def single_source(speakers, chunks) -> Column:
    """Whether an utterance comes from one speaker and one chunk; null chunks don't count."""
    return (F.size(F.array_distinct(speakers)) == 1) & (F.size(F.array_distinct(F.array_compact(chunks))) == 1)


def candidates(df: DataFrame, limits=PIPELINE_RANGE) -> DataFrame:
    """Rows whose ``duration`` lies within limits, both included."""
    return df.where(F.col("duration").between(*limits))


def index(df: DataFrame, keys: list[str], order: str, limits=CORPUS_RANGE) -> DataFrame:
    """keys and ``paths``: the candidates' paths in order.  For large speakers prefer the flat candidates: this holds a key's paths in one row."""
    return candidates(df, limits).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "path"))), lambda x: x["path"]).alias("paths"))


def chosen(paths: Column, policy: str = "first", key: Column | None = None, seed: int = 0) -> Column:
    """One path of an array, null if it is empty: the first, or by a hash of key and seed."""
    if policy == "first":
        return F.get(paths, F.lit(0))
    return F.when(F.size(paths) > 0, F.get(paths, F.pmod(F.xxhash64(key, F.lit(seed)), F.size(paths)).cast("int")))


def select_prompts(wanted: DataFrame, flat: DataFrame, sample: list[str], order: str) -> DataFrame:
    """sample and ``prompts``: the first candidate (by path) of each wanted speaker that isn't the row's ``exclude``, in order; null if any speaker has none.

    wanted: sample columns, order, ``spk``, ``exclude``; flat: ``spk``, ``path``.
    Per speaker the two smallest paths suffice, as at most one is excluded, so
    a frequent speaker costs a partial aggregate.
    """
    first = flat.groupBy("spk").agg(F.min("path").alias("p1"))
    second = flat.join(first, "spk").where("path <> p1").groupBy("spk").agg(F.min("path").alias("p2"))
    best = first.join(second, "spk", "left")
    own = wanted.join(best, "spk", "left").withColumn("pick", F.when(~F.col("p1").eqNullSafe(F.col("exclude")), F.col("p1")).otherwise(F.col("p2")))
    got = own.groupBy(*sample).agg(F.bool_and(F.col("pick").isNotNull()).alias("all"), F.transform(F.array_sort(F.collect_list(F.struct(order, "pick"))), lambda x: x["pick"]).alias("prompts"))
    return got.select(*sample, F.when(F.col("all"), F.col("prompts")).alias("prompts"))


def rolling_cache(df: DataFrame, limits=CORPUS_RANGE, size: int = CACHE) -> DataFrame:
    """Adds ``available``: paths of the speaker's last ``size`` eligible rows up to and with this one, but its own.

    Rows: ``spk, seq, path, duration``.  The cache is made for the eligible rows
    alone, numbered within the speaker; every row joins the one of its number.
    """
    k, held = free_name(df, "_k"), free_name(df, "_held")
    fits = F.col("duration").between(*limits)
    own = df.withColumn(k, F.sum(F.when(fits, 1).otherwise(0)).over(Window.partitionBy("spk").orderBy("seq")))
    last = Window.partitionBy("spk").orderBy(k).rowsBetween(-(size - 1), 0)
    cache = own.where(fits).select("spk", k, F.collect_list("path").over(last).alias(held))
    out = own.join(cache, ["spk", k], "left")
    available = F.filter(F.coalesce(held, F.array().cast("array<string>")), lambda x: x != F.col("path"))
    return out.withColumn("available", available).select(*df.columns, "available")


def sole_source(rows: DataFrame) -> DataFrame:
    """Rows of one source speaker and one source chunk, with ``source_spk`` and ``source_chunk``."""
    own = rows.where(single_source(F.col("source_speaker_ids"), F.col("source_chunk_indices")))
    return own.withColumns({"source_spk": F.get("source_speaker_ids", F.lit(0)), "source_chunk": F.get(F.array_compact("source_chunk_indices"), F.lit(0))})


def sample_prompts(rows: DataFrame, flat: DataFrame, seed: int = 0) -> DataFrame:
    """``file, sample, voice_prompts``: for each utterance, in order, a clip of its speaker in its chunk; no row where any has none.

    rows: ``file, sample, idx`` and the lists of sources; flat: ``file, source_chunk, source_spk, path``.
    An utterance of several speakers or chunks has no prompt.  The choice is by
    a hash of the utterance: of a speaker's clips, which lie in one chunk of one file, the one with the least.
    """
    named = sole_source(rows).select("file", "sample", "idx", "source_spk", "source_chunk")
    near = named.join(flat, ["file", "source_chunk", "source_spk"])
    pick = near.groupBy("file", "sample", "idx").agg(F.min_by("path", F.struct(F.xxhash64("path", "idx", F.lit(seed)), "path")).alias("path"))
    every = rows.groupBy("file", "sample").agg(F.count("*").alias("n"))
    got = pick.groupBy("file", "sample").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "path"))), lambda x: x["path"]).alias("voice_prompts"))
    return got.join(every, ["file", "sample"]).where(F.size("voice_prompts") == F.col("n")).select("file", "sample", "voice_prompts")
