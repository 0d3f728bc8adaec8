"""Interval operators against plain folds over random rows with ties, overlaps and gaps at the thresholds."""

import random
import re

import pytest

from voxloom.operators import prompts, samples, sequences, waveform

GRID = [0.0, 0.25, 0.5, 0.7, 1.0, 2.0, 2.5, 3.0, 15.0, 25.0, 26.0, 60.0]


def intervals(seed, n=250):
    r = random.Random(seed)
    return [(f, i, a := r.choice(GRID) + r.choice(GRID), a + r.choice(GRID + [-1.0]), r.choice(["s0", "s1", "chunk_00001_s0", "chunk_00002_s0"])) for f in range(12) for i in range(n // 12)] + [(99, 0, 1.0, 1.0, "s0")]


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return intervals(request.param)


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "file long, seq long, st double, en double, spk string").repartition(3)


def files(rows):
    for f in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == f and r[3] > r[2]), key=lambda r: (r[2], r[3], r[1]))
        if own:
            yield f, own


def who(s):
    return re.sub(r"^chunk_\d+_", "", s)


def merged(rows, cap=None):
    out = []
    for f, own in files(rows):
        done = []
        for _, _, st, en, spk in own:
            p = done[-1] if done else None
            if p and p[2] == who(spk) and st - p[1] <= 2.0 and (cap is None or max(p[1], en) - p[0] <= cap):
                p[1], p[3] = max(p[1], en), p[3] + 1
            else:
                done.append([st, en, who(spk), 1])
        out += [(f, i, *d) for i, d in enumerate(done)]
    return out


def test_merge(df, rows):
    columns = ("file", "idx", "st", "en", "spk", "n")
    for got, want in ((sequences.merge_adjacent(df), merged(rows)), (sequences.merge_adjacent_capped(df), merged(rows, 25.0))):
        assert sorted(map(tuple, got.select(*columns).collect())) == want
        assert all(len(r.source_speaker_ids) == r.n and not r.source_chunk_indices and r.chunk_index is None for r in got.collect())


def smoothed(own):
    """Rule by rule on a list that shrinks, stepping back after a removal."""
    x = [[st, en, spk] for _, _, st, en, spk in own]
    i = 0
    while i < len(x):
        st, en, _ = x[i]
        if en - st < 0.7:
            before, after = (x[i - 1] if i else None), (x[i + 1] if i + 1 < len(x) else None)
            close = before and st - before[1] <= 0.5
            if close and after and before[2] == after[2] and after[0] - en <= 0.5:
                before[1] = max(before[1], after[1])
                del x[i : i + 2]
                i = max(i - 1, 0)
                continue
            if close:
                before[1] = max(before[1], en)
                del x[i]
                i = max(i - 1, 0)
                continue
            if after and after[0] - en <= 0.5:
                after[0] = min(after[0], st)
                del x[i]
                continue
        i += 1
    return x


def test_smooth(df, rows):
    want = [(f, i, *x) for f, own in files(rows) for i, x in enumerate(smoothed(own))]
    assert sorted(map(tuple, sequences.smooth_turns(df).collect())) == want


def test_caps_tile_the_interval(df, rows):
    got = sequences.cap_durations(df, 2.5).collect()
    for f, own in files(rows):
        for _, seq, st, en, spk in own:
            p = sorted((r.piece, r.st, r.en) for r in got if r.file == f and r.seq == seq)
            assert p[0][1] == st and abs(p[-1][2] - en) < 1e-9
            assert all(abs(a[2] - b[1]) < 1e-9 for a, b in zip(p, p[1:])) and all(abs(x[2] - x[1] - 2.5) < 1e-9 for x in p[:-1])


def test_vad(df, rows):
    groups = sequences.group_vad(df.where("en > st"), 5.0, 1.0).collect()
    for f, own in files(rows):
        g = sorted((r.idx, r.st, r.en) for r in groups if r.file == f)
        assert all(e - s >= 5.0 for _, s, e in g[:-1]) and g[0][1] == own[0][2] and g[-1][2] == own[-1][3]
    chunks = sequences.vad_chunks(df, 10.0, 1.0).collect()
    assert chunks and all(0 < r.en - r.st <= 10.0 + 1e-9 for r in chunks)
    with pytest.raises(ValueError):
        sequences.vad_chunks(df, 0)


def test_packing(spark):
    r = random.Random(7)
    rows = [(f, i, 0.0, r.choice([1.0, 5.0, 10.0, 25.0, 30.0]), f"s{r.randint(0, 6)}") for f in range(10) for i in range(30)]
    df = spark.createDataFrame(rows, "file long, idx long, st double, en double, spk string")
    got = {(x.file, x.idx): x.sample for x in sequences.pack_samples(df).collect()}
    for f in range(10):
        sample, total, speakers = 0, 0.0, set()
        for _, i, st, en, spk in [x for x in rows if x[0] == f]:
            if total and (total + en - st > 25.0 or len(speakers | {spk}) > 4):
                sample, total, speakers = sample + 1, 0.0, set()
            total, speakers = total + en - st, speakers | {spk}
            assert got[f, i] == sample
    assert {x.sample for x in sequences.pack_samples(df, None, 0).collect()} == {0}


def test_sentences_and_rendering(spark):
    rows = [(1, 0, 0.0, 40.0, "chunk_00000_a", "One two three. Four five six! Seven eight?"), (1, 1, 40.0, 41.0, "b", "  "), (1, 2, 41.0, 80.0, "a", "no end " * 9), (1, 3, 80.0, 81.0, "c", "x")]
    df = spark.createDataFrame(rows, "file long, idx int, st double, en double, spk string, text string")
    got = sorted(map(tuple, sequences.split_sentences(df, 25.0).collect()))
    assert [x[6] for x in got[:3]] == ["One two three.", "Four five six!", "Seven eight?"] and got[2][4] == 40.0
    assert [x[6] for x in sorted(map(tuple, sequences.split_sentences(df, 28.0).collect()))[:2]] == ["One two three. Four five six!", "Seven eight?"]
    assert len([x for x in got if x[1] == 2]) == 1
    assert samples.render(df, ["file"], "idx").first().text == "Speaker 0: One two three. Four five six! Seven eight? " + "no end " * 8 + "no end\nSpeaker 2: x"


def test_rolling_cache_keeps_the_last_fifty(spark):
    rows = [("a", i, f"p{i:03d}", 12.0 if i % 3 else 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "spk string, seq long, path string, duration double")
    held = []
    got = {r.seq: r.available for r in prompts.rolling_cache(df).collect()}
    for _, i, p, d in rows:
        held = (held + [p])[-50:] if d == 12.0 else held
        assert got[i] == [x for x in held if x != p]


def test_trim_forms_agree(spark):
    import numpy as np

    r = np.random.default_rng(3)
    arrays = [np.zeros(100), np.concatenate([np.zeros(300), r.normal(size=200), np.zeros(250)]), r.normal(size=7), np.concatenate([r.normal(size=90) * 1e-4, r.normal(size=60)])]
    df = spark.createDataFrame([(i, a.astype(float).tolist()) for i, a in enumerate(arrays)], "i int, a array<double>")
    got = {x.i: (x.b.start, x.b.end) for x in df.select("i", waveform.trim_bounds(df.a, 20, 40).alias("b")).collect()}
    for i, a in enumerate(arrays):
        assert got[i] == waveform.trim_array(a, 1000, pad_s=0.04)


def test_empty(spark, df):
    none = df.where("false")
    for f in (sequences.merge_adjacent, sequences.merge_adjacent_capped, sequences.smooth_turns, sequences.cap_durations, sequences.group_vad, sequences.vad_chunks):
        assert f(none).count() == 0
