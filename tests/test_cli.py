import json

import numpy as np
import pytest

from voxloom import cli
from voxloom.sources.readers import encode_wav


def test_build_merge_and_analyse(spark, tmp_path, capsys):
    audio = tmp_path / "in"
    audio.mkdir()
    (audio / "a.wav").write_bytes(encode_wav(0.5 * np.sin(np.arange(48_000) / 20), 16_000))
    for name in ("x", "y"):
        cli.main(["build", str(audio), str(tmp_path / name), "--speech-only", "--work-dir", str(tmp_path / f"work-{name}")])
    cli.main(["merge", "--output-path", str(tmp_path / "m"), str(tmp_path / "x"), str(tmp_path / "y")])
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2
    cli.main(["analyse", "--min-duration", "1", str(tmp_path / "m")])
    assert "mean" in capsys.readouterr().out
    with pytest.raises(SystemExit, match="a_001.wav"):
        (tmp_path / "j" / "samples").mkdir(parents=True)
        (tmp_path / "j" / "voice_prompts").mkdir()
        cli.main(["export", "--output-path", str(tmp_path / "j"), str(tmp_path / "m")])
    cli.main(["export", "--full", "--output-path", str(tmp_path / "j"), str(tmp_path / "m")])
    lines = [json.loads(x) for p in (tmp_path / "j" / "records").glob("part*") for x in p.read_text().splitlines()]
    assert {x["audio"] for x in lines} == {"samples/a_001.wav"}
    assert (tmp_path / "j" / "samples" / "a_001.wav").stat().st_size > 44


def test_corpus_with_models(spark, tmp_path):
    audio = tmp_path / "audio"
    audio.mkdir()
    (audio / "x.wav").write_bytes(encode_wav(0.5 * np.sin(np.arange(48_000) / 20), 16_000))
    record = {"segment_id": "1", "audio_path": "audio/x.wav", "num_speakers": 2, "transcription_text": "hei", "speakers": [{"speaker_id": "s", "name": "Åse", "party": "X"}], "split": "train", "duration": 1.0}
    (tmp_path / "m.jsonl").write_text(json.dumps(record, ensure_ascii=False))
    cli.main(["corpus", str(tmp_path / "m.jsonl"), str(tmp_path / "o"), "--audio-dir", str(audio), "--asr", "voxloom.plans.providers:LengthAsr", "--enhancer", "voxloom.plans.providers:NoEnhancement"])
    got = spark.read.parquet(str(tmp_path / "o")).collect()
    assert [(r.text.startswith("Speaker 0: ") and r.text.endswith("seconds."), r.duration, r.voice_prompts) for r in got] == [(True, 3.0, [])]
    assert json.loads(got[0].speakers) == record["speakers"]


def test_enhance_sweep(spark, tmp_path):
    audio = tmp_path / "in"
    audio.mkdir()
    (audio / "a.wav").write_bytes(encode_wav(np.zeros(800), 16_000))
    cli.main(["enhance", str(audio), str(tmp_path / "e"), "--nfe", "16,32", "--tau", "0,1"])
    assert spark.read.parquet(str(tmp_path / "e")).count() == 4
