"""Filters, joins, aggregates and set operations as the pipelines use them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import free_name, store


def at_most_speakers(df: DataFrame, most: int = 4) -> DataFrame:
    return df.where(F.col("num_speakers") <= most)


def single_and_multi(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of one speaker and of several; none is in neither."""
    return df.where("num_speakers = 1"), df.where("num_speakers > 1")


def within(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Non-null values between optional bounds, both included."""
    out = df.where(F.col(column).isNotNull())
    out = out if low is None else out.where(F.col(column) >= low)
    return out if high is None else out.where(F.col(column) <= high)


def first_n(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first n rows in order; None or 0: all."""
    return df.orderBy(*order).limit(n) if n else df


def count_single_multi(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.col("num_speakers") == 1).alias("single")).withColumn("multi", F.col("total") - F.col("single"))


def duration_stats(df: DataFrame, column: str = "duration") -> DataFrame:
    """``n, total, hours, min, max, mean`` of the non-null values; no row where there is none."""
    c = F.col(column)
    out = df.where(c.isNotNull()).agg(F.count("*").alias("n"), F.sum(c).alias("total"), F.min(c).alias("min"), F.max(c).alias("max"))
    return out.where("n > 0").select("n", "total", (F.col("total") / 3600).alias("hours"), "min", "max", (F.col("total") / F.col("n")).alias("mean"))


def histogram(df: DataFrame, column: str = "duration", bins: int = 100) -> DataFrame:
    """``bin, low, high, n``: equal bins from the smallest to the largest value, the last one closed, empty ones included."""
    c = F.col(column)
    own = df.where(c.isNotNull()).select(c.cast("double").alias("x"))
    bounds = own.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where("lo is not null")
    bounds = bounds.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    place = F.least(F.floor((F.col("x") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1)).cast("int")
    counts = own.crossJoin(F.broadcast(bounds)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))  # one row of bounds
    grid = bounds.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * width).alias("low"), (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def real_time_factor(df: DataFrame) -> DataFrame:
    """Sums of the phases' times, their average per file (0 of none) and time over audio (infinite for none)."""
    out = df.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("t_load", "t_denoise", "t_enhance", "t_save", "t_total", "audio_duration")), F.count("*").alias("n_files"))
    return out.withColumns({"avg_total": F.when(F.col("n_files") == 0, 0.0).otherwise(F.col("t_total") / F.col("n_files")), "rtf": rtf(F.col("t_total"), F.col("audio_duration"))})


def rtf(time: Column, audio: Column) -> Column:
    return F.when(audio > 0, F.try_divide(time, audio)).otherwise(F.lit(float("inf")))


def sweep(spark, nfe, lambd, tau) -> DataFrame:
    """Every combination of the options, numbered in nested order; the lists are options, not data."""
    lists = spark.createDataFrame([(list(map(int, nfe)), list(map(float, lambd)), list(map(float, tau)))], "n array<int>, l array<double>, t array<double>")
    out = lists.select(F.posexplode("n").alias("i", "nfe"), "l", "t").select("i", "nfe", F.posexplode("l").alias("j", "lambd"), "t").select("i", "j", "nfe", "lambd", F.posexplode("t").alias("k", "tau"))
    return out.select(((F.col("i") * len(lambd) + F.col("j")) * len(tau) + F.col("k")).alias("combo"), "nfe", "lambd", "tau")


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """Each key with the order of its first row."""
    return df.groupBy(key).agg(F.min(order).alias(order))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """One after another by name, missing columns null, ``_src`` telling which; a frame that has such a column is an error."""
    if any("_src" in f.columns for f in frames):
        raise ValueError("a dataset already has a column _src")
    tagged = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows numbered from 0 in order: counted within ranges of it, each by a task of its own, after a row per range has told how many lie before."""
    at, where = free_name(df, "_range"), free_name(df, "_before")
    own = store(df.repartitionByRange(*order).withColumn(at, F.spark_partition_id()), "numbered")
    sizes, before = own.groupBy(at).agg(F.count("*").alias("n")).collect(), 0
    rows = []
    for r in sorted(sizes):
        rows.append((r[0], before))
        before += r.n
    starts = df.sparkSession.createDataFrame(rows, f"{at} int, {where} long")
    w = Window.partitionBy(at).orderBy(*order)
    return own.join(F.broadcast(starts), at).withColumn(name, F.col(where) + F.row_number().over(w) - 1).drop(at, where)


def head_and_more(df: DataFrame, column: str, n: int = 20) -> tuple[list[str], int]:
    """The first n values in order, and how many more there are."""
    first = [r[0] for r in df.select(column).orderBy(column).limit(n).collect()]
    return first, max(0, df.count() - n) if len(first) == n else 0


def sweep_totals(df: DataFrame) -> DataFrame:
    """``n, t_enhance, audio_duration, rtf`` over all rows of a sweep."""
    out = df.agg(F.count("*").alias("n"), F.coalesce(F.sum("t_enhance"), F.lit(0.0)).alias("t_enhance"), F.coalesce(F.sum("audio_duration"), F.lit(0.0)).alias("audio_duration"))
    return out.withColumn("rtf", rtf(F.col("t_enhance"), F.col("audio_duration")))


def merge_datasets(frames: list[DataFrame]) -> DataFrame:
    if len(frames) < 2:
        raise ValueError("merging takes at least two datasets")
    return union_all(frames)


def without(values: Column, excluded: Column) -> Column:
    """An array without the excluded values; what repeats stays repeated."""
    return F.filter(values, lambda x: ~F.array_contains(excluded, x))
