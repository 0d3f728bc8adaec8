"""Sources: audio folders, WAV content, JSON lines and saved datasets."""

from __future__ import annotations

import io
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import suffix

# File types of the builder and of batch enhancement.
AUDIO = (".wav", ".mp3")
ENHANCE = (".wav", ".mp3", ".flac", ".ogg", ".opus", ".m4a", ".aac", ".wma", ".mp4")
METADATA = "segment_id string, audio_path string, num_speakers int, transcription_text string, speakers array<struct<speaker_id:string>>, split string, duration double"


def audio_files(spark: SparkSession, folder: str, types=AUDIO) -> DataFrame:
    """``path, modificationTime, length, content`` of the folder's own files of the types, whatever their case; content is read only if used."""
    return spark.read.format("binaryFile").load(folder).where(suffix("path").isin(*types))


def json_lines(spark: SparkSession, path: str, schema: str = METADATA) -> DataFrame:
    """One record per line, in ``line_order`` the order of the file; a bad line or a missing file is an error.

    ``speakers_json`` is the text of the line's ``speakers``, whatever fields they have.
    """
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).where("trim(value) <> ''").select("value", at.alias("line_order"))
    record = F.from_json("value", schema, {"mode": "FAILFAST"})
    return lines.select(record.alias("r"), "line_order", F.get_json_object("value", "$.speakers").alias("speakers_json")).select("r.*", "speakers_json", "line_order")


def dataset(spark: SparkSession, path: str, split: str | None = None, hub=None) -> DataFrame:
    """A saved dataset, all splits or one; ``hub(spark, name)`` reads what is no path."""
    if "://" not in path and not is_local(path):
        if hub is None:
            raise ValueError(f"{path}: datasets of a hub need a reader of your own; give a path")
        out = hub(spark, path)
    else:
        out = spark.read.parquet(path)
    return out if split is None else out.where(F.col("split") == split)


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(channels, samples) between -1 and 1, and the rate, of PCM of 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(content)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    if width == 3:
        x = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        ints = (x[:, 0].astype(np.int32) << 8 | x[:, 1].astype(np.int32) << 16 | x[:, 2].astype(np.int32) << 24) >> 8
        scaled = ints / float(1 << 23)
    elif width == 1:
        scaled = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    else:
        scaled = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]) / float(1 << (8 * width - 1))
    return scaled.reshape(-1, channels).T.astype(np.float32), rate


def encode_wav(samples, rate: int) -> bytes:
    """Mono 16-bit PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.asarray(samples, dtype=np.float64), -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def decode_audio(files: DataFrame, rate: int | None = None, decoder=None) -> DataFrame:
    """``path, samples, rate, duration, error`` of mono sound, resampled if a rate is given; a file that can't be read has its error and no samples.

    PCM WAV is read here; ``decoder`` (``decode(content, suffix)``) reads all else.
    """
    from os.path import splitext

    from ..operators.waveform import resample_array

    def run(batches):
        for b in batches:
            rows = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    kind = splitext(path)[1].lower()
                    x, r = decode_wav(content) if decoder is None or kind == ".wav" else decoder.decode(content, kind)
                    mono = x.mean(axis=0)
                    seconds = len(mono) / r
                    rows.append((path, resample_array(mono, r, rate or r), rate or r, seconds, None))
                except Exception as e:  # whatever a decoder raises is the file's error
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            kinds = (pa.string(), pa.list_(pa.float32()), pa.int32(), pa.float64(), pa.string())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "samples", "rate", "duration", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, samples array<float>, rate int, duration double, error string")


#: Bytes at the start of a file that hold a WAV header, but for odd ones.
HEADER = 4096


def wav_seconds(head: bytes, length: int) -> float | None:
    """Duration by the first bytes of a WAV file of that length; null if they don't tell."""
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        return None
    at, byte_rate = 12, 0
    while at + 8 <= len(head):
        name, size = head[at : at + 4], int.from_bytes(head[at + 4 : at + 8], "little")
        if name == b"fmt ":
            byte_rate = int.from_bytes(head[at + 16 : at + 20], "little")
        elif name == b"data":
            return min(size, length - at - 8) / byte_rate if byte_rate else None
        at += 8 + size + size % 2
    return None


def probe_duration(files: DataFrame) -> DataFrame:
    """``path, duration`` by the header alone, of which only the first bytes leave the JVM; null where it can't be read."""

    def run(batches):
        for b in batches:
            out = [wav_seconds(h, n) for h, n in zip(b.column("head").to_pylist(), b.column("length").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(out, pa.float64())], ["path", "duration"])

    return files.select("path", "length", F.substring("content", 1, HEADER).alias("head")).mapInArrow(run, "path string, duration double")


def is_local(repo: str) -> bool:
    """Whether a repository name is a path: absolute, explicitly relative, or there."""
    from os.path import exists

    return repo.startswith(("/", "./", "../")) or exists(repo)
