"""Samples: local speaker numbers, rendered text, spans and dataset items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_speaker, item_text, normalize_text, strip
from ..scratch import free_name


def number_speakers(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``local``: 0 for the speaker that comes first within the keys, and so on."""
    who, first = free_name(df, "_who"), free_name(df, "_first")
    out = df.withColumn(who, canonical_speaker("spk"))
    out = out.withColumn(first, F.min(order).over(Window.partitionBy(*keys, who)))
    return out.withColumn("local", F.dense_rank().over(Window.partitionBy(*keys).orderBy(first)) - 1).drop(who, first)


def render(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys and ``text``: one line ``Speaker k: ...`` per run of a speaker; blank utterances are left out but keep their speaker's number."""
    own = number_speakers(df, keys, order).withColumn("text", strip("text")).where("text <> ''")
    w = Window.partitionBy(*keys).orderBy(order)
    own = own.withColumn("run", F.sum(F.when(F.lag("local").over(w).eqNullSafe(F.col("local")), 0).otherwise(1)).over(w))
    joined = lambda c, d: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["text"]), d)
    runs = own.groupBy(*keys, "run", "local").agg(joined(F.struct(order, "text"), " ").alias("text"))
    lines = runs.select(*keys, "run", F.concat(F.lit("Speaker "), F.col("local").cast("string"), F.lit(": "), "text").alias("text"))
    return lines.groupBy(*keys).agg(joined(F.struct("run", "text"), "\n").alias("text"))


def render_lines(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys and ``text``: each utterance that isn't blank on a line of its own, normalised; numbers go to speakers with text only."""
    own = number_speakers(df.withColumn("text", normalize_text("text")).where("text <> ''"), keys, order)
    lines = own.withColumn("text", F.concat(F.lit("Speaker "), F.col("local").cast("string"), F.lit(": "), "text"))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"]), "\n").alias("text"))


def spans(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the span of their intervals: ``st``, ``en``, ``duration`` (0 at least), ``n``."""
    out = df.groupBy(*keys).agg(F.min("st").alias("st"), F.max("en").alias("en"), F.count("*").alias("n"))
    return out.withColumn("duration", F.greatest(F.lit(0.0), F.col("en") - F.col("st")))


def items(samples: DataFrame, default: str = "Speaker 0: ") -> DataFrame:
    """Dataset items ``audio, text, duration, voice_prompts`` of ``audio, text, speaker, duration, voice_prompts``; no prompts are an empty list."""
    prompts = F.coalesce(F.col("voice_prompts"), F.array().cast("array<string>"))
    return samples.select("audio", item_text("text", "speaker", default).alias("text"), "duration", prompts.alias("voice_prompts"))
