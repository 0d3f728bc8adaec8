import json
import math
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import text
from voxloom.operators import relational, waveform
from voxloom.operators.waveform import resample_array
from voxloom.plans import builder, providers
from voxloom.sources import readers, writers
from voxloom.streaming import ingest


def tone(seconds, rate=16_000, hz=220):
    return 0.5 * np.sin(2 * math.pi * hz * np.arange(int(seconds * rate)) / rate)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("audio")
    quiet = np.zeros(16_000)
    sound = np.concatenate([quiet, tone(6), quiet, tone(4), quiet])
    (path / "a.wav").write_bytes(readers.encode_wav(sound, 16_000))
    (path / "B.WAV").write_bytes(readers.encode_wav(tone(2, 8_000), 8_000))
    (path / "bad.wav").write_bytes(b"RIFF nothing")
    (path / "note.txt").write_text("x")
    return str(path)


def test_decoding(spark, folder):
    files = readers.audio_files(spark, folder)
    assert sorted(r.path.rsplit("/", 1)[1] for r in files.select("path").collect()) == ["B.WAV", "a.wav", "bad.wav"]
    got = {r.path.rsplit("/", 1)[1]: r for r in readers.decode_audio(files, 16_000).collect()}
    assert got["bad.wav"].error and got["bad.wav"].samples is None
    assert len(got["B.WAV"].samples) == 32_000 and got["B.WAV"].duration == 2.0
    probe = {r.path.rsplit("/", 1)[1]: r.duration for r in readers.probe_duration(files).collect()}
    assert probe == {"a.wav": 13.0, "B.WAV": 2.0, "bad.wav": None}


def test_resampling_keeps_a_tone():
    x = resample_array(tone(1, 8_000).astype(np.float32), 8_000, 16_000)
    assert len(x) == 16_000 and np.abs(x[500:-500] - tone(1)[500:-500]).max() < 0.01
    assert np.array_equal(resample_array(x, 5, 5), x)


def test_build(spark, folder):
    by_speech = {r.audio.rsplit("/", 1)[-1]: r for r in builder.build_dataset(spark, folder).collect()}
    assert all(r.voice_prompts == [] and r.text.startswith("Speaker 0: ") for r in by_speech.values()) and len(by_speech) == 3
    spoken = builder.build_dataset(spark, folder, model=providers.OneSpeaker()).collect()
    assert spoken and all(r.text.startswith("Speaker 0: ") and 0 < r.duration <= 25 for r in spoken)


class Counting:
    """Models that note each call in a folder: two speakers in turn every 4 s, and a text that ends a sentence."""

    def __init__(self, folder):
        self.folder = str(folder)

    def note(self, kind, n=1):
        import os
        import uuid

        for _ in range(n):
            open(os.path.join(self.folder, f"{kind}-{uuid.uuid4().hex}"), "w").close()

    def detect(self, samples, rate):
        return [(0, len(samples))]

    def diarize(self, samples, rate):
        self.note("diarize")
        return [f"{a:.2f} {min(a + 4, len(samples) / rate):.2f} speaker_{a // 4 % 2}" for a in range(0, int(len(samples) / rate), 4)]

    def transcribe(self, batch):
        self.note("transcribe", len(batch))
        return [f"Said in {len(x) / r:.1f} s." for x, r in batch]


def test_every_model_call_is_made_once(spark, tmp_path):
    """Chunks go through the diarizer once and clips through the recogniser once; sounds and prompts that items name exist."""
    sounds, calls, out = tmp_path / "in", tmp_path / "calls", tmp_path / "out"
    for d in (sounds, calls):
        d.mkdir()
    for name in ("a", "b"):
        (sounds / f"{name}.wav").write_bytes(readers.encode_wav(tone(40), 16_000))
    model = Counting(calls)
    items = builder.build_dataset(spark, str(sounds), model, model, model, max_duration=12.0, output=str(out), chunk=30.0).collect()
    made = [p.name.split("-")[0] for p in calls.iterdir()]
    # chunks of 30 and 10 s: eight and three turns each
    assert made.count("diarize") == 4 and made.count("transcribe") == 2 * (8 + 3)
    assert len(items) == 8 and [r.audio for r in items] == sorted(r.audio for r in items)
    for r in items:
        with wave.open(r.audio) as w:
            assert w.getframerate() == 24_000 and abs(w.getnframes() / 24_000 - r.duration) < 2.1
        assert len(r.voice_prompts) == r.text.count("Said") and all(wave.open(p).getnframes() > 0 for p in r.voice_prompts)
    frame = readers.decode_audio(readers.audio_files(spark, str(sounds)), 16_000)
    samples, _ = builder.build_samples(frame, model, model, 12.0, 4, 30.0, model)
    plan = samples._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") <= 12 and plan.count("Join") <= 20


def test_files_that_cannot_be_read_are_named(spark, folder):
    audio = readers.decode_audio(readers.audio_files(spark, folder), 16_000)
    assert [(r.path.rsplit("/", 1)[1], bool(r.error)) for r in builder.unreadable(audio).collect()] == [("bad.wav", True)]

    class Decoder:
        def decode(self, content, suffix):
            return np.ones((2, 800), dtype=np.float32), 8_000

    (p,) = [x for x in (folder,)]
    files = readers.audio_files(spark, p).withColumn("path", F.regexp_replace("path", "bad.wav", "bad.mp3"))
    got = {r.path.rsplit("/", 1)[1]: r for r in readers.decode_audio(files, None, Decoder()).collect()}
    assert got["bad.mp3"].error is None and len(got["bad.mp3"].samples) == 800


def test_a_diarizer_that_fails_has_a_second_one():
    class Full:
        def diarize(self, samples, rate):
            raise MemoryError

    assert providers.WithFallback(Full(), providers.OneSpeaker()).diarize(tone(2), 16_000)


def test_denoising_happens_once_per_file(spark, folder):
    class Model:
        def denoise(self, samples, rate):
            return samples * 0 + 0.25

        def enhance(self, samples, rate, nfe=0):
            return samples * nfe, rate

    audio = readers.decode_audio(readers.audio_files(spark, folder), 16_000).where("path like '%a.wav'")
    options = relational.sweep(spark, [2, 4], [0.5], [1.0]).select("combo", "nfe")
    got = builder.enhance(audio, Model(), options=options).collect()
    assert sorted((r.combo, r.samples[0]) for r in got) == [(0, 0.5), (1, 1.0)] and len({r.t_denoise for r in got}) == 1
    totals = relational.sweep_totals(builder.enhance(audio, Model(), options=options)).first()
    assert totals.n == 2 and totals.audio_duration == 26.0


def test_corpus_speakers_keep_all_their_fields(spark, tmp_path):
    record = {"segment_id": "9", "audio_path": "x.wav", "num_speakers": 1, "transcription_text": "a", "speakers": [{"speaker_id": "s", "name": "Åse", "party": "X"}], "split": "t", "duration": 12.0}
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps({**record, "segment_id": str(i)}, ensure_ascii=False) for i in (9, 10, 8)))
    meta = readers.json_lines(spark, str(tmp_path / "m.jsonl"))
    got = builder.corpus_records(meta, limit=2).collect()
    assert sorted(r.segment_id for r in got) == ["10", "9"] and all(json.loads(r.speakers) == record["speakers"] for r in got)


def test_missing_files_are_counted(spark):
    names = spark.createDataFrame([(f"n{i:03d}",) for i in range(23)], "name string")
    text = builder.missing_report(names)
    assert text.startswith("23 required") and text.endswith("… and 3 more") and "n019" in text and "n020" not in text
    assert builder.missing_report(names.limit(0)) is None


def test_numbers_over_ranges(spark):
    df = spark.createDataFrame([(i * 7 % 50, "x", i) for i in range(200)], "a int, _range string, b int").repartition(5)
    got = relational.numbered(df, "n", "a", "b").orderBy("n").collect()
    assert [r.n for r in got] == list(range(200)) and [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in got) and got[0]._range == "x"


def test_enhance_reports_failures(spark, folder):
    class Fussy:
        def enhance(self, samples, rate, nfe=0):
            if len(samples) < 40_000:
                raise RuntimeError("too short")
            return samples, rate

    audio = readers.decode_audio(readers.audio_files(spark, folder), 16_000)
    options = relational.sweep(spark, [16, 32], [0.5], [1.0]).select("combo", "nfe")
    got = builder.enhance(audio, Fussy(), options=options).collect()
    assert sorted((r.status, r.combo) for r in got) == [("failed", 0), ("failed", 1), ("ok", 0), ("ok", 1)]
    done = audio.where("path like '%a.wav'").select("path")
    assert {r.status for r in builder.enhance(audio, Fussy(), done=done).collect()} == {"failed"}


def test_corpus(spark, tmp_path):
    lines = [
        {"segment_id": "1", "audio_path": "x.wav", "num_speakers": 1, "transcription_text": "hei. æ du", "speakers": [{"speaker_id": "s"}], "split": "train", "duration": 12.0, "other": 1},
        {"segment_id": "2", "audio_path": "y.wav", "num_speakers": 1, "transcription_text": " b", "speakers": [{"speaker_id": "s"}], "split": "train", "duration": 11.0},
        {"segment_id": "3", "audio_path": "z.wav", "num_speakers": 5, "transcription_text": "c", "speakers": [], "split": "test", "duration": None},
        {"segment_id": "4", "audio_path": "w.wav", "num_speakers": 2, "transcription_text": "d", "speakers": [], "split": "test", "duration": None},
    ]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, lines)))
    meta = readers.json_lines(spark, str(tmp_path / "m.jsonl"))
    got = {r.segment_id: r for r in builder.corpus_records(meta, spark.createDataFrame([("w.wav", 3.0)], "path string, duration double")).collect()}
    assert sorted(got) == ["1", "2", "4"] and got["1"].text == "Speaker 0: Hei. Æ du" and got["4"].duration == 3.0
    assert got["1"].voice_prompts == ["x.wav"] and got["2"].voice_prompts == ["x.wav"] and got["4"].voice_prompts == []
    writers.save_splits(builder.corpus_records(meta), str(tmp_path / "out"))
    assert readers.dataset(spark, str(tmp_path / "out"), "train").count() == 2
    writers.save_json_lines(builder.corpus_records(meta), str(tmp_path / "json"))
    assert '"duration":null' in "".join(p.read_text() for p in (tmp_path / "json").glob("part*"))
    (tmp_path / "bad.jsonl").write_text("{nope")
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl")).collect()


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("q/a.b.wav", "hi"), ("c.wav", "æ")], "audio string, text string")
    assert {r.error for r in writers.save_transcripts(df, str(tmp_path)).collect()} == {None}
    assert (tmp_path / "a.b.txt").read_text() == "hi\n" and (tmp_path / "c.txt").read_text() == "æ\n"
    clip = spark.createDataFrame([("k.wav", [0.0, 0.5, -0.5], 8000)], "name string, samples array<float>, rate int")
    writers.save_wavs(clip, str(tmp_path)).collect()
    with wave.open(str(tmp_path / "k.wav")) as w:
        assert (w.getnframes(), w.getframerate()) == (3, 8000)


def test_export_and_analysis(spark):
    a = spark.createDataFrame([("d/x.wav", "t", 4.0, ["v/p.wav", ""])], "audio string, text string, duration double, voice_prompts array<string>")
    b = spark.createDataFrame([("", "u", None, [])], a.schema)
    records, missing = builder.export_records([a, b], spark.createDataFrame([("samples/x.wav",)], "name string"))
    assert {r.audio for r in records.collect()} == {"samples/x.wav", "samples/sample_000001.wav"}
    assert {r.name for r in missing.collect()} == {"samples/sample_000001.wav", "voice_prompts/p.wav", "voice_prompts/prompt_000000_001.wav"}
    stats, bins = builder.analyse([a, b])
    assert stats.first().n == 1 and bins.count() == 100 and bins.agg({"n": "sum"}).first()[0] == 1
    assert builder.analyse([b])[0].count() == 0
    with pytest.raises(ValueError):
        relational.merge_datasets([a])


def test_text_edges(spark):
    cases = {"": "", "  hei  du. \n ja! æ?  å ": "Hei  du. Ja! Æ? Å", " x": "X"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.n for r in df.select("t", text.normalize_text("t").alias("n")).collect()} == cases
    names = spark.createDataFrame([("a/.hid",), ("a/b.tar.GZ",), ("",)], "t string")
    assert [tuple(r) for r in names.select(text.stem("t"), text.suffix("t")).collect()] == [(".hid", ""), ("b.tar", ".gz"), ("", "")]
    assert readers.is_local("./x") and not readers.is_local("org/x")


def test_stream(spark, folder, tmp_path):
    for _ in range(2):
        ingest.write_once(ingest.audio_stream(spark, folder).select("path", "length"), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_windows_of_a_stream(spark, tmp_path):
    from datetime import datetime

    rows = [(datetime(2024, 1, 1, m // 60, m % 60), float(m)) for m in (1, 30, 59, 61)]
    spark.createDataFrame(rows, "ts timestamp, v double").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, v double").json(str(tmp_path / "in"))
    ingest.duration_windows(stream, "ts", "v").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    got = {(r.n, r.total) for r in spark.table("windows").collect()}
    assert got == {(3, 90.0), (1, 61.0)}


def test_resampling_a_table(spark):
    df = spark.createDataFrame([("a", [0.0, 1.0, 0.0, -1.0] * 50, 8_000), ("b", None, 8_000)], "path string, samples array<float>, rate int")
    got = {r.path: r for r in waveform.resample(df, 16_000).collect()}
    assert len(got["a"].samples) == 400 and got["a"].rate == 16_000 and got["b"].samples is None
