"""Waveforms as arrays of samples: JVM-side expressions for short ones, Arrow batches for real audio."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import free_name

# Frame of 20 ms, threshold of -40 dB under the peak, padding of 0.8 s, a peak under 1e-10 is silence.
FRAME_S, THRESHOLD_DB, PAD_S, SILENCE = 0.02, -40.0, 0.8, 1e-10


def clip(a: Column, seconds, rate) -> Column:
    """The first seconds; a null bound leaves all, one not over 0 is an error."""
    if seconds is None:
        return a
    if seconds <= 0:
        raise ValueError("seconds must be positive")
    return cut(a, F.lit(0), F.lit(int(seconds * rate)))


def cut(a: Column, start: Column, end: Column) -> Column:
    """Samples from start to before end, counted from 0."""
    return F.slice(a, start + 1, F.greatest(end - start, F.lit(0)))


def sample_index(seconds: Column, rate: Column, length: Column) -> Column:
    """The sample at a time, truncated, at most length."""
    return F.least((seconds * rate).cast("bigint"), length.cast("bigint"))


def downmix(channels: Column) -> Column:
    """The mean over channels, an array of equally long arrays."""
    total = F.aggregate(F.slice(channels, 2, 1 << 20), F.transform(F.get(channels, F.lit(0)), lambda x: x.cast("double")), lambda acc, c: F.zip_with(acc, c, lambda x, y: x + y))
    return F.transform(total, lambda x: x / F.size(channels))


def concatenate(df: DataFrame, keys: list[str], order: str, samples: str = "samples") -> DataFrame:
    """keys and the samples of their rows one after another."""
    return df.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, samples))), lambda x: x[samples])).alias(samples))


def trim_bounds(a: Column, frame: int, pad: int, threshold_db: float = THRESHOLD_DB) -> Column:
    """``struct<start, end>`` of what stays: from the first frame at the threshold to one frame past the last, padded.

    Frames are whole ones, one at least; the threshold is relative to the
    loudest frame.  A silent array stays whole.
    """
    n = F.size(a)
    frames = F.greatest(F.expr("1").cast("int"), F.floor(n / frame).cast("int"))
    rms = F.transform(F.sequence(F.lit(0), frames - 1), lambda i: F.sqrt(F.aggregate(F.slice(a, i * frame + 1, F.lit(frame)), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"), lambda s: s / F.least(F.lit(frame), n))))
    peak = F.array_max(rms)
    active = F.filter(F.transform(rms, lambda x, i: F.when(x >= peak * 10.0 ** (threshold_db / 20), i)), lambda i: i.isNotNull())
    start = F.greatest(F.lit(0), F.array_min(active) * frame - pad)
    end = F.least(n, (F.array_max(active) + 1) * frame + frame + pad)
    whole = (peak < SILENCE) | (n == 0) | peak.isNull()
    return F.struct(F.when(whole, 0).otherwise(start).cast("int").alias("start"), F.when(whole, n).otherwise(end).cast("int").alias("end"))


def trim_silence(df: DataFrame, samples: str, frame: int, pad: int, threshold_db: float = THRESHOLD_DB) -> DataFrame:
    """Replaces samples by what stays, and adds ``head`` and ``tail``: samples removed."""
    b = free_name(df, "_b")
    out = df.withColumn(b, trim_bounds(F.col(samples), frame, pad, threshold_db))
    start, end = F.col(b)["start"], F.col(b)["end"]
    return out.withColumns({"head": start, "tail": F.size(samples) - end, samples: cut(F.col(samples), start, end)}).drop(b)


def shift_after_trim(df: DataFrame, rate: str = "rate") -> DataFrame:
    """Moves ``st`` and ``en`` by what was trimmed; intervals that turn over go."""
    return df.withColumns({"st": F.col("st") + F.col("head") / F.col(rate), "en": F.col("en") - F.col("tail") / F.col(rate)}).where("en > st")


def trim_array(x: np.ndarray, rate: int, threshold_db: float = THRESHOLD_DB, pad_s: float = PAD_S) -> tuple[int, int]:
    """Start and end of what stays of real audio: the same rule over numpy frames."""
    frame, n = max(1, int(FRAME_S * rate)), len(x)
    if not n:
        return 0, 0
    frames = max(1, n // frame)
    own = x[: frames * frame].astype(np.float64)
    rms = np.sqrt((own.reshape(frames, -1) ** 2).mean(axis=1)) if n >= frame else np.sqrt((own**2).mean(keepdims=True))
    if rms.max() < SILENCE:
        return 0, n
    active = np.flatnonzero(rms >= rms.max() * 10 ** (threshold_db / 20))
    pad = int(pad_s * rate)
    return max(0, int(active[0]) * frame - pad), min(n, (int(active[-1]) + 2) * frame + pad)


def resample_array(x: np.ndarray, source: int, target: int, zeros: int = 16) -> np.ndarray:
    """Band-limited resampling by a windowed sinc; the same array for equal rates."""
    if source == target or not len(x):
        return x.astype(np.float32)
    ratio = target / source
    scale = min(1.0, ratio)
    n = int(round(len(x) * ratio))
    out, reach = np.empty(n, dtype=np.float32), int(np.ceil(zeros / scale))
    offsets = np.arange(-reach, reach + 1)
    padded = np.pad(x.astype(np.float64), reach + 1)
    for a in range(0, n, 1 << 14):
        at = np.arange(a, min(n, a + (1 << 14))) / ratio
        left = np.floor(at).astype(np.int64)
        d = at[:, None] - (left[:, None] + offsets)
        kernel = scale * np.sinc(scale * d) * np.where(np.abs(d) <= reach, np.cos(np.pi * d / (2 * (reach + 1))) ** 2, 0)
        out[a : a + len(at)] = (kernel * padded[left[:, None] + offsets + reach + 1]).sum(axis=1)
    return out


def resample(df: DataFrame, target: int, samples: str = "samples", rate: str = "rate") -> DataFrame:
    """Samples at the target rate, in Arrow batches."""

    names, schema = df.columns, df.schema

    def run(batches):
        for b in batches:
            new = [None if x is None else resample_array(np.asarray(x, dtype=np.float32), r, target) for x, r in zip(b.column(samples).to_pylist(), b.column(rate).to_pylist())]
            columns = dict(zip(names, b.columns))
            columns[samples] = pa.array(new, b.column(samples).type)
            columns[rate] = pa.array([target] * b.num_rows, b.column(rate).type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return df.mapInArrow(run, schema)
