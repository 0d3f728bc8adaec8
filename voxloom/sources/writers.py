"""Sinks: datasets, JSON lines, transcripts, WAV files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def push(df: DataFrame, name: str, sink) -> None:
    """Hands a dataset to a hub: ``sink(df, name)`` uploads it."""
    sink(df, name)


def save_splits(df: DataFrame, path: str) -> None:
    """A dataset per split, as partitions."""
    df.write.partitionBy("split").parquet(path)


def save_json_lines(df: DataFrame, path: str) -> None:
    """An object per row, null fields kept."""
    df.write.option("ignoreNullFields", "false").json(path)


def write_files(df: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """Writes each row's content (text or bytes) to folder/name and gives ``name, size, error``.

    The folder must be one that every executor shares; files are written under
    a temporary name and renamed, so a task that runs again does no harm.
    """

    def run(batches):
        import os
        import uuid

        import pyarrow as pa

        os.makedirs(folder, exist_ok=True)
        for b in batches:
            size, error = [], []
            for n, c in zip(*(x.to_pylist() for x in b.columns)):
                try:
                    raw = c.encode() if isinstance(c, str) else c
                    temporary = os.path.join(folder, f".{uuid.uuid4().hex}")
                    with open(temporary, "wb") as f:
                        f.write(raw)
                    os.replace(temporary, os.path.join(folder, n))
                    size.append(len(raw)), error.append(None)
                except (OSError, TypeError, AttributeError) as e:
                    size.append(None), error.append(str(e))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(error, pa.string())], ["name", "size", "error"])

    return df.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInArrow(run, "name string, size long, error string")


def save_transcripts(df: DataFrame, folder: str) -> DataFrame:
    """``<stem>.txt`` with the text and a line feed for each of ``audio, text``."""
    from ..functions.text import stem

    return write_files(df.select(F.concat(stem("audio"), F.lit(".txt")).alias("name"), F.concat("text", F.lit("\n")).alias("content")), folder, "name", "content")


def save_wavs(df: DataFrame, folder: str) -> DataFrame:
    """``name, samples, rate`` as 16-bit WAV files."""
    from pyspark.sql.types import BinaryType

    from .readers import encode_wav

    @F.pandas_udf(BinaryType())
    def encode(samples, rate):
        import pandas as pd

        return pd.Series([encode_wav(s, int(r)) for s, r in zip(samples, rate)])

    return write_files(df.select("name", encode("samples", "rate").alias("content")), folder, "name", "content")


def materialise(files: DataFrame, folder: str) -> DataFrame:
    """Brings each sound of ``name, path, bytes, samples, rate`` to folder/name: ``name, kind, size, error``.

    Bytes are written (kind ``write``), samples without bytes encoded (``encode``),
    a path alone is copied (``copy``); what has none of them is ``none``.  The
    folder and the paths must be ones that every executor sees.
    """

    def run(batches):
        import os
        import shutil
        import uuid

        import pyarrow as pa

        from .readers import encode_wav

        for b in batches:
            out = []
            for name, path, raw, samples, rate in zip(*(b.column(c).to_pylist() for c in ("name", "path", "bytes", "samples", "rate"))):
                target = os.path.join(folder, name)
                temporary = f"{target}.{uuid.uuid4().hex}"
                kind = "write" if raw is not None else "encode" if samples is not None and rate is not None else "copy" if path else "none"
                try:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    if kind == "copy":
                        shutil.copyfile(path.removeprefix("file:"), temporary)
                    elif kind != "none":
                        with open(temporary, "wb") as f:
                            f.write(raw if kind == "write" else encode_wav(samples, rate))
                    if kind != "none":
                        os.replace(temporary, target)
                    out.append((name, kind, os.path.getsize(target) if kind != "none" else None, None))
                except OSError as e:
                    out.append((name, kind, None, str(e)))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()))], ["name", "kind", "size", "error"])

    return files.select("name", "path", "bytes", "samples", "rate").mapInArrow(run, "name string, kind string, size long, error string")
