"""The dataset builder, the corpus builder, enhancement and export as graphs of DataFrames."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clip_name, file_name, normalize_text, stem
from ..operators import prompts, relational, samples, sequences
from ..operators.waveform import resample_array, trim_array
from ..scratch import store
from ..sources import readers, writers
from . import providers

ASR_RATE, CLIP_RATE = 16_000, 24_000


def transcribe(clips: DataFrame, asr: providers.Asr, batch: int = 8) -> DataFrame:
    """``key, text`` of ``key, samples, rate``, stripped; batches go to the model as they come."""

    def run(batches):
        for b in batches:
            rows = [(np.asarray(x or [], dtype=np.float32), r) for x, r in zip(b.column("samples").to_pylist(), b.column("rate").to_pylist())]
            texts = [t.strip() for i in range(0, len(rows), batch) for t in asr.transcribe(rows[i : i + batch])]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    return clips.select("key", "samples", "rate").mapInArrow(run, "key string, text string")


def speech(audio: DataFrame, vad: providers.Vad) -> DataFrame:
    """``file, seq, st, en`` in samples of ``path, samples, rate``."""

    def run(batches):
        for b in batches:
            rows = [(p, i, float(a), float(e)) for p, x, r in zip(*(b.column(c).to_pylist() for c in ("path", "samples", "rate"))) if x for i, (a, e) in enumerate(vad.detect(np.asarray(x, dtype=np.float32), r))]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.float64(), pa.float64()))], ["file", "seq", "st", "en"])

    return audio.where("samples is not null").select("path", "samples", "rate").mapInArrow(run, "file string, seq int, st double, en double")


def _emit(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, schema.values())], list(schema))


_CLIP = {"key": pa.string(), "name": pa.string(), "samples": pa.list_(pa.float32()), "rate": pa.int32(), "duration": pa.float64()}


def segment_audio(audio: DataFrame, vad: providers.Vad, min_duration: float = 5.0, max_duration: float | None = None, rate: int = CLIP_RATE) -> DataFrame:
    """``key, name, samples, rate, duration``: clips of grouped speech of ``path, samples, rate``, numbered from 1, at rate, no longer than max_duration."""
    from os.path import basename, splitext

    def run(batches):
        for b in batches:
            rows = []
            for path, x, r in zip(*(b.column(c).to_pylist() for c in ("path", "samples", "rate"))):
                x, first, n = np.asarray(x, dtype=np.float32), None, 1
                found = [s for s in vad.detect(x, r) if s[1] > s[0]]
                for i, (a, e) in enumerate(found):
                    first = a if first is None else first
                    if (e - first) / r >= min_duration or i == len(found) - 1:
                        clip = resample_array(x[first:e], r, rate)
                        clip = clip if max_duration is None else clip[: int(max_duration * rate)]
                        rows.append((f"{path}#{n}", f"{splitext(basename(path))[0]}_{n:03d}.wav", clip, rate, len(clip) / rate))
                        first, n = None, n + 1
            yield _emit(_CLIP, rows)

    return audio.where("samples is not null").select("path", "samples", "rate").mapInArrow(run, "key string, name string, samples array<float>, rate int, duration double")


_LINE = {"file": pa.string(), "chunk_index": pa.int32(), "chunk_start": pa.float64(), "chunk_end": pa.float64(), "line": pa.string()}


def diarize(audio: DataFrame, model: providers.Diarizer, vad: providers.Vad, chunk: float = 300.0) -> DataFrame:
    """Turns ``file, st, en, spk, chunk_index, seq`` of ``path, samples, rate``.

    Speech is packed into chunks of at most ``chunk`` seconds, each is diarized by
    itself, once, and its lines shifted.  What the model said is a table.
    """
    spoken = speech(audio, vad)
    rates = audio.select(F.col("path").alias("file"), "rate")
    seconds = spoken.join(rates, "file").select("file", "seq", (F.col("st") / F.col("rate")).alias("st"), (F.col("en") / F.col("rate")).alias("en"))
    chunks = sequences.vad_chunks(seconds, chunk, 1.0)

    def run(batches):
        for b in batches:
            rows = []
            for path, x, r, i, st, en in zip(*(b.column(c).to_pylist() for c in ("path", "samples", "rate", "idx", "st", "en"))):
                own = np.asarray(x[int(st * r) : min(len(x), int(en * r))], dtype=np.float32)
                if len(own):
                    rows += [(path, i, st, en, line) for line in model.diarize(own, r)]
            yield _emit(_LINE, rows)

    joined = audio.select("path", "samples", "rate").join(chunks.withColumnRenamed("file", "path"), "path").select("path", "samples", "rate", "idx", "st", "en")
    lines = store(joined.mapInArrow(run, "file string, chunk_index int, chunk_start double, chunk_end double, line string"), "turns")
    turns = sequences.parse_turns(lines)
    return turns.withColumn("seq", F.row_number().over(Window.partitionBy("file").orderBy("st", "en", "spk")))


_CUT = {"file": pa.string(), "idx": pa.int64(), "st": pa.float64(), "en": pa.float64(), "samples": pa.list_(pa.float32()), "rate": pa.int32()}


def cut_clips(audio: DataFrame, turns: DataFrame, trim: bool = True, rate: int | None = None) -> DataFrame:
    """turns (``file, idx, st, en`` and more) with ``samples, rate, key``: without silence at their ends, times moved; turns that turn over go."""

    def run(batches):
        for b in batches:
            rows = []
            for x, r, file, idx, st, en in zip(*(b.column(c).to_pylist() for c in ("samples", "rate", "file", "idx", "st", "en"))):
                own = np.asarray(x[int(st * r) : min(len(x), int(en * r))], dtype=np.float32)
                own, r = (own, r) if rate is None else (resample_array(own, r, rate), rate)
                a, e = trim_array(own, r) if trim else (0, len(own))
                begin, end = st + a / r, en - (len(own) - e) / r
                if end > begin and len(own):
                    rows.append((file, idx, begin, end, own[a:e], r))
            yield _emit(_CUT, rows)

    joined = turns.select("file", "idx", "st", "en").join(audio.select(F.col("path").alias("file"), "samples", "rate"), "file").select("samples", "rate", "file", "idx", "st", "en")
    cut = joined.mapInArrow(run, "file string, idx long, st double, en double, samples array<float>, rate int")
    rest = turns.select("file", F.col("idx").cast("long").alias("idx"), *(c for c in turns.columns if c not in ("file", "idx", "st", "en")))
    return rest.join(cut, ["file", "idx"]).withColumn("key", F.concat_ws("#", "file", F.col("idx").cast("string")))


def build_samples(audio: DataFrame, model: providers.Diarizer, asr: providers.Asr, max_duration: float | None = 25.0, max_speakers: int | None = 4, chunk: float = 300.0, vad: providers.Vad | None = None, seed: int = 0, folder: str = "voice_prompts") -> tuple[DataFrame, DataFrame]:
    """Samples ``file, sample, text, duration, voice_prompts, samples, rate`` and prompt clips ``name, samples, rate`` of ``path, samples, rate``.

    Diarize, smooth, merge, cut, transcribe, merge by text, split, trim again,
    pack, render.  Each stretch goes through the diarizer once and each clip
    through the recogniser once: what they say is written to a table before
    anything reads it.  Prompts of a sample are clips of its speakers in
    their chunks, each named below ``folder``; null where one has none.
    """
    cap = max_duration or float("inf")
    turns = diarize(audio, model, vad or providers.EnergyVad(), chunk)
    merged = sequences.merge_adjacent_capped(sequences.smooth_turns(turns).withColumn("seq", F.col("idx")), max_duration=cap)
    if max_duration:
        merged = sequences.cap_durations(merged, max_duration)
        merged = merged.withColumn("idx", F.row_number().over(Window.partitionBy("file").orderBy("idx", "piece")) - 1)
    clips = store(cut_clips(audio, merged, rate=CLIP_RATE), "clips")
    said = store(transcribe(clips, asr), "said")
    spoken = clips.drop("samples", "rate").join(said, "key").where("trim(text) <> ''")
    # prompts: clips of 3 to 15 s of one speaker in one chunk
    fit = prompts.candidates(spoken.withColumn("duration", F.col("en") - F.col("st")), prompts.PIPELINE_RANGE)
    name = F.concat(F.lit(f"{folder}/"), F.regexp_replace(clip_name(stem("file"), "idx", F.col("spk")), "_utt_", "_prompt_"))
    flat = prompts.sole_source(fit).select("file", "source_chunk", "source_spk", name.alias("path"), "key")
    prompt_clips = flat.join(clips.select("key", "samples", "rate"), "key").select(F.col("path").alias("name"), "samples", "rate")
    joined = sequences.merge_transcripts_capped(spoken, cap)
    split = sequences.split_sentences(joined, cap)
    order = split.withColumn("idx", F.row_number().over(Window.partitionBy("file").orderBy("idx", "piece")).cast("long"))
    # the pieces lost their silence as parts of other clips: trimmed anew
    again = cut_clips(audio, order.drop("piece", "n"), rate=CLIP_RATE)
    pieces = store(again.select("file", "idx", "st", "en", "spk", "text", "source_speaker_ids", "source_chunk_indices", "samples", "rate"), "pieces")
    packed = sequences.pack_samples(pieces.select("file", "idx", "st", "en", "spk"), max_duration, max_speakers)
    rows = packed.join(pieces.drop("st", "en", "spk"), ["file", "idx"])
    text = samples.render(rows.select("file", "sample", "idx", "spk", "text"), ["file", "sample"], "idx")
    span = samples.spans(rows.select("file", "sample", "st", "en"), ["file", "sample"])
    sound = rows.groupBy("file", "sample").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("idx", "samples"))), lambda x: x["samples"])).alias("samples"), F.first("rate").alias("rate"))
    chosen = prompts.sample_prompts(rows.select("file", "sample", "idx", "source_speaker_ids", "source_chunk_indices"), flat.drop("key"), seed)
    out = text.join(span.select("file", "sample", "duration"), ["file", "sample"]).join(sound, ["file", "sample"]).join(chosen, ["file", "sample"], "left")
    return out.select("file", "sample", "text", "duration", "voice_prompts", "samples", "rate"), prompt_clips


def unreadable(audio: DataFrame) -> DataFrame:
    """``path, error`` of the files that could not be read."""
    return audio.where("samples is null").select("path", "error")


def build_dataset(spark: SparkSession, folder: str, model: providers.Diarizer | None = None, asr: providers.Asr | None = None, vad: providers.Vad | None = None, max_duration: float = 25.0, max_speakers: int = 4, output: str | None = None, decoder: providers.Decoder | None = None, chunk: float = 300.0, prefix: str = "Speaker 0: ") -> DataFrame:
    """Dataset items ``audio, text, duration, voice_prompts`` of an audio folder.

    Clips by speech alone where there is no diarizer, or where diarization gave
    no sample.  With ``output``, a folder that every executor shares, the sound of samples
    and prompts is written there as WAV files, and items name them.  Files that
    can't be read are those of :func:`unreadable`.
    """
    asr, vad = asr or providers.LengthAsr(), vad or providers.EnergyVad()
    audio = store(readers.decode_audio(readers.audio_files(spark, folder), ASR_RATE, decoder), "audio")
    none = F.lit(None).cast("array<string>")
    root = f"{output.rstrip('/')}/" if output else ""
    found = None
    if model is not None:
        own, clips = build_samples(audio, model, asr, max_duration, max_speakers, chunk, vad)
        found = store(own, "samples")
        if found.isEmpty():
            found = None
    if found is not None:
        name = F.concat(F.lit("samples/"), F.format_string("%s_sample_%05d.wav", stem("file"), "sample"))
        sounds = found.select(name.alias("name"), "samples", "rate").unionByName(clips)
        paths = F.transform("voice_prompts", lambda p: F.concat(F.lit(root), p))
        rows = found.select(F.concat(F.lit(root), name).alias("audio"), "text", F.lit("").alias("speaker"), "duration", paths.alias("voice_prompts"))
    else:
        clips = store(segment_audio(audio, vad, max_duration=max_duration), "segments")
        name = F.concat(F.lit("segments/"), F.col("name"))
        sounds = clips.select(name.alias("name"), "samples", "rate")
        said = store(transcribe(clips, asr), "said")
        rows = clips.join(said, "key").select(F.concat(F.lit(root), name).alias("audio"), "text", F.lit("").alias("speaker"), "duration", none.alias("voice_prompts"))
    if output:
        lit = lambda kind: F.lit(None).cast(kind)
        wrote = writers.materialise(sounds.withColumns({"path": lit("string"), "bytes": lit("binary")}), output)
        failed, more = relational.head_and_more(store(wrote, "written").where("error is not null"), "name")
        if failed:
            raise OSError(f"not written: {', '.join(failed)}" + (f" and {more} more" if more else ""))
    return samples.items(rows, prefix).orderBy("audio")


def diarize_and_cut(audio: DataFrame, model: providers.Diarizer, vad: providers.Vad, chunk: float = 300.0) -> DataFrame:
    """``file, idx, st, en, spk, samples, rate, key``: merged turns of any length, cut out as they are, speakers canonical."""
    turns = sequences.smooth_turns(diarize(audio, model, vad, chunk)).withColumn("seq", F.col("idx"))
    merged = sequences.merge_adjacent(turns)
    return cut_clips(audio, merged.select("file", "idx", "st", "en", "spk"), trim=False, rate=ASR_RATE)


def corpus_records(meta: DataFrame, durations: DataFrame | None = None, limit: int | None = None, policy: str = "first", existing: DataFrame | None = None, spoken: DataFrame | None = None) -> DataFrame:
    """Corpus items of metadata: at most four speakers, text normalised, probed durations before given ones, prompts of the speaker's last clips.

    limit: the first records in the order of the file.  existing: ``path``, only
    records of one speaker whose audio is there stay.  spoken: ``segment_id, text,
    voice_prompts`` of records of several speakers, before their given text.  A
    clip of a speaker without another one prompts itself.
    """
    order = "line_order" if "line_order" in meta.columns else "segment_id"
    own = relational.first_n(relational.at_most_speakers(meta), limit, order)
    if "speakers_json" not in own.columns:
        own = own.withColumn("speakers_json", F.to_json("speakers"))
    if durations is not None:
        probed = durations.select(F.col("path").alias("audio_path"), F.col("duration").alias("_probed"))
        own = own.join(probed, "audio_path", "left").withColumn("duration", F.coalesce("_probed", "duration")).drop("_probed")
    single, multi = relational.single_and_multi(own)
    if existing is not None:
        single = single.join(existing.select(F.col("path").alias("audio_path")), "audio_path", "left_semi")
    one = single.select("*", F.get("speakers", F.lit(0))["speaker_id"].alias("spk"), F.col(order).alias("seq"), F.col("audio_path").alias("path"))
    cached = prompts.rolling_cache(one.where("spk is not null"), prompts.CORPUS_RANGE)
    pick = F.array(F.coalesce(prompts.chosen(F.col("available"), policy, F.col("segment_id")), F.col("audio_path")))
    given = samples_text("transcription_text")
    shape = lambda df, t, p: df.select("segment_id", F.col("audio_path").alias("audio"), t.alias("text"), "duration", "num_speakers", F.col("speakers_json").alias("speakers"), p.alias("voice_prompts"), "split")
    none = F.array().cast("array<string>")
    several = shape(multi, given, none)
    if spoken is not None:
        said = spoken.select("segment_id", F.col("text").alias("_text"), F.col("voice_prompts").alias("_prompts"))
        several = shape(multi.join(said, "segment_id", "left"), F.coalesce(F.nullif("_text", F.lit("")), given), F.coalesce("_prompts", none))
    return shape(cached, given, pick).unionByName(shape(one.where("spk is null"), given, none)).unionByName(several)


def samples_text(column: str):
    """A given text as one speaker's line."""
    return F.concat(F.lit("Speaker 0: "), normalize_text(column))


def corpus_spoken(meta: DataFrame, audio: DataFrame, model: providers.Diarizer, asr: providers.Asr, vad: providers.Vad, folder: str | None = None) -> DataFrame:
    """``segment_id, text, voice_prompts`` of records of several speakers: diarized, cut, transcribed in one go, a line per turn; prompts if all speakers have one.

    audio: ``path`` (as ``audio_path`` of meta), ``samples, rate``.  With ``folder`` the clips that prompts name are written there.
    """
    _, multi = relational.single_and_multi(relational.at_most_speakers(meta))
    wanted = audio.join(multi.select(F.col("audio_path").alias("path")).distinct(), "path", "left_semi")
    clips = store(diarize_and_cut(wanted, model, vad), "corpus-clips")
    said = store(transcribe(clips, asr), "corpus-said")
    rows = clips.join(said, "key").where("trim(text) <> ''").select("file", "idx", "spk", "text")
    text = samples.render_lines(rows, ["file"], "idx")
    name = F.concat(F.lit(f"{folder.rstrip('/')}/" if folder else ""), F.format_string("%s/seg_%04d.wav", stem("file"), "idx"))
    held = clips.select("file", "idx", F.concat_ws("/", "file", "spk").alias("spk"), name.alias("path"), (F.size("samples") / F.col("rate")).alias("duration"), "samples", "rate")
    flat = prompts.candidates(held, prompts.CORPUS_RANGE)
    if folder:
        sounds = flat.select(F.format_string("%s/seg_%04d.wav", stem("file"), "idx").alias("name"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("binary").alias("bytes"), "samples", "rate")
        store(writers.materialise(sounds, folder), "corpus-written")
    speakers = rows.groupBy("file", "spk").agg(F.min("idx").alias("idx")).select("file", "idx", F.concat_ws("/", "file", "spk").alias("spk"), F.lit(None).cast("string").alias("exclude"))
    chosen = prompts.select_prompts(speakers, flat.select("spk", "path"), ["file"], "idx")
    by_file = text.join(chosen, "file", "left").select(F.col("file").alias("audio_path"), "text", F.col("prompts").alias("voice_prompts"))
    return multi.select("segment_id", "audio_path").join(by_file, "audio_path").select("segment_id", "text", "voice_prompts")


def corpus_dataset(meta: DataFrame, audio: DataFrame, model: providers.Diarizer, asr: providers.Asr, vad: providers.Vad, enhancer: providers.Enhancer | None = None, limit: int | None = None, folder: str | None = None, **options) -> DataFrame:
    """The whole corpus: its audio enhanced once per file, durations probed, records of several speakers diarized and transcribed, items assembled.

    audio: ``path, samples, rate`` of decoded files, paths as in the metadata.
    A file that enhancement fails on is missing: its records of one speaker go.
    """
    order = "line_order" if "line_order" in meta.columns else "segment_id"
    own = relational.first_n(relational.at_most_speakers(meta), limit, order)
    heard = audio.join(own.select(F.col("audio_path").alias("path")).distinct(), "path", "left_semi").where("samples is not null")
    if enhancer is not None:
        settings = own.sparkSession.createDataFrame([(0, *options.values())], ["combo", *options]).withColumn("combo", F.col("combo").cast("int")) if options else None
        heard = enhance(heard, enhancer, options=settings).where("status = 'ok'")
    heard = store(heard.select("path", "samples", "rate"), "enhanced")
    durations = heard.select("path", (F.size("samples") / F.col("rate")).alias("duration"))
    return corpus_records(own, durations, existing=heard.select("path"), spoken=corpus_spoken(own, heard, model, asr, vad, folder))


_ENHANCED = {"path": pa.string(), "combo": pa.int32(), "samples": pa.list_(pa.float32()), "rate": pa.int32(), "t_denoise": pa.float64(), "t_enhance": pa.float64(), "audio_duration": pa.float64(), "status": pa.string(), "error": pa.string()}


def enhance(audio: DataFrame, model: providers.Enhancer, done: DataFrame | None = None, options: DataFrame | None = None) -> DataFrame:
    """``path, combo, samples, rate, t_denoise, t_enhance, audio_duration, status, error`` of what isn't done yet, for each row of options if given.

    A file is denoised once (where the model has ``denoise``) and then enhanced by each combination; its row
    carries the options, which are a few settings.
    """
    todo = audio.where("samples is not null")
    if done is not None:
        todo = todo.join(done.select("path").distinct(), "path", "left_anti")
    names = [c for c in options.columns if c != "combo"] if options is not None else []
    every = [r.asDict() for r in options.orderBy("combo").collect()] if options is not None else [{"combo": 0}]

    def run(batches):
        import time

        for b in batches:
            for path, x, r in zip(*(b.column(c).to_pylist() for c in ("path", "samples", "rate"))):
                x, start, failed = np.asarray(x, dtype=np.float32), time.perf_counter(), None
                seconds = len(x) / r
                try:
                    x = model.denoise(x, r) if hasattr(model, "denoise") else x
                except Exception as e:  # a file that fails is reported in its rows
                    failed = str(e)
                t_denoise, out = time.perf_counter() - start, []
                for o in every:
                    start = time.perf_counter()
                    try:
                        if failed:
                            raise RuntimeError(failed)
                        y, rate = model.enhance(x, r, **{n: o[n] for n in names})
                        out.append((path, o["combo"], y, rate, t_denoise, time.perf_counter() - start, seconds, "ok", None))
                    except Exception as e:
                        out.append((path, o["combo"], None, None, t_denoise, time.perf_counter() - start, seconds, "failed", str(e)))
                yield _emit(_ENHANCED, out)

    return todo.select("path", "samples", "rate").mapInArrow(run, "path string, combo int, samples array<float>, rate int, t_denoise double, t_enhance double, audio_duration double, status string, error string")


def analyse(frames: list[DataFrame], low: float | None = None, high: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Duration statistics and histogram over datasets."""
    own = relational.within(relational.union_all(frames), "duration", low, high)
    return relational.duration_stats(own), relational.histogram(own)


def export_records(frames: list[DataFrame], existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Records with paths relative to the export, and the files they name that existing (``name``) lacks."""
    records, files = export_files(frames)
    names = files.select("name").distinct()
    return records, names.join(existing, "name", "left_anti") if existing is not None else names


def export_files(frames: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Records as export_records, and ``name, path``: each file of the export and where its sound is now."""
    items = relational.numbered(relational.union_all(frames), "item", "_src", "audio")
    prompt = F.transform("voice_prompts", lambda p, j: F.concat(F.lit("voice_prompts/"), file_name(p, "prompt", F.col("item"), j)))
    name = F.concat(F.lit("samples/"), file_name("audio", "sample", "item"))
    records = items.select(name.alias("audio"), "text", "duration", prompt.alias("voice_prompts"))
    pairs = F.concat(F.array(F.struct(name.alias("name"), F.col("audio").alias("path"))), F.coalesce(F.arrays_zip(prompt.alias("name"), F.col("voice_prompts").alias("path")), F.array().cast("array<struct<name:string,path:string>>")))
    return records, items.select(F.explode(pairs).alias("f")).select("f.name", "f.path").dropDuplicates(["name"])


def export_sounds(files: DataFrame, folder: str) -> DataFrame:
    """Copies the files of an export (``name, path``) into folder: ``name, kind, size, error``."""
    lit = lambda kind: F.lit(None).cast(kind)
    return writers.materialise(files.withColumns({"bytes": lit("binary"), "samples": lit("array<float>"), "rate": lit("int")}), folder)


def missing_report(missing: DataFrame, n: int = 20) -> str | None:
    """What an export lacks: the first names and how many more; None if nothing."""
    first, more = relational.head_and_more(missing, "name", n)
    if not first:
        return None
    return f"{len(first) + more} required file(s) not found:" + "".join(f"\n  {x}" for x in first) + (f"\n  … and {more} more" if more else "")
