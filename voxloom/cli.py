"""Command line: ``python -m voxloom.cli build | corpus | enhance | analyse | merge | export``.

Models are named as ``module:factory``; without one the stand-ins of
``voxloom.plans.providers`` are used.
"""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.text import base_name
from .operators import relational
from .plans import builder, providers
from .sources import readers, writers


def load(name: str | None, fallback):
    """The provider that ``module:factory`` makes."""
    if not name:
        return fallback
    module, _, factory = name.partition(":")
    return getattr(import_module(module), factory)()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="voxloom")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name, *paths, **options):
        p = sub.add_parser(name)
        for path in paths:
            p.add_argument(path)
        for option, value in options.items():
            flag = "--" + option.replace("_", "-")
            if isinstance(value, bool):
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, default=value, type=type(value) if value is not None else None)
        return p

    command("build", "input_dir", "output", max_duration=25.0, max_num_speakers=4, chunk_size=300.0, speaker_prefix="Speaker 0: ", work_dir=None, diarizer=None, asr=None, vad=None, decoder=None, speech_only=False)
    command("corpus", "input_path", "output_path", limit=0, audio_dir=None, work_dir=None, diarizer=None, asr=None, vad=None, decoder=None, enhancer=None, nfe=32, lambd=0.5, tau=0.5)
    command("enhance", "input_dir", "output_dir", model=None, decoder=None, nfe="32", lambd="0.5", tau="0.5", done=None)
    for name in ("analyse", "merge", "export"):
        p = command(name, output_path=None, split=None, **({"min_duration": None, "max_duration": None} if name == "analyse" else {}))
        if name == "export":
            p.add_argument("--full", action="store_true", help="copy the sound of samples and prompts too")
        p.add_argument("datasets", nargs="+")
    return top


def numbers(spark: SparkSession, text: str, kind: str) -> list:
    from .functions.text import numbers as parse

    return spark.createDataFrame([(text,)], "t string").select(parse("t", kind).alias("x")).first().x


def report(rows, column: str, what: str) -> None:
    """The first of the rows that name a failure, and how many more."""
    first, more = relational.head_and_more(rows, column)
    if first:
        print(f"{len(first) + more} {what}:", *first, *([f"and {more} more"] if more else []), sep="\n  ")


def export(spark: SparkSession, frames: list, path: str, full: bool) -> None:
    """The records of an export as JSON lines; with full the sounds are copied first, else they must be there."""
    records, files = builder.export_files(frames)
    if full:
        report(builder.export_sounds(files, path).where("error is not null"), "name", "files could not be copied")
    else:
        there = None
        for part in ("samples", "voice_prompts"):
            own = spark.read.format("binaryFile").load(f"{path}/{part}").select(F.concat(F.lit(f"{part}/"), base_name("path")).alias("name"))
            there = own if there is None else there.unionAll(own)
        if text := builder.missing_report(files.select("name").join(there, "name", "left_anti")):
            raise SystemExit(f"Error: {text}")
    writers.save_json_lines(records, f"{path}/records")


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("voxloom").getOrCreate()
    if a.command == "build":
        model = None if a.speech_only else load(a.diarizer, providers.OneSpeaker())
        decoder = load(a.decoder, None)
        items = builder.build_dataset(spark, a.input_dir, model, load(a.asr, None), load(a.vad, None), a.max_duration, a.max_num_speakers, a.work_dir, decoder, a.chunk_size, a.speaker_prefix)
        writers.save(items, a.output)
        report(builder.unreadable(readers.decode_audio(readers.audio_files(spark, a.input_dir), None, decoder)), "path", "files could not be read")
    elif a.command == "corpus":
        meta = readers.json_lines(spark, a.input_path)
        if a.diarizer or a.asr or a.enhancer:
            sounds = readers.decode_audio(readers.audio_files(spark, a.audio_dir or a.input_path.rsplit("/", 1)[0], readers.ENHANCE), builder.ASR_RATE, load(a.decoder, None))
            # metadata names files as they lie below the folder
            named = meta.select("audio_path", base_name("audio_path").alias("base")).distinct()
            sounds = sounds.withColumn("base", base_name("path")).drop("path").join(named, "base").withColumnRenamed("audio_path", "path")
            options = {"nfe": a.nfe, "lambd": a.lambd, "tau": a.tau} if a.enhancer else {}
            items = builder.corpus_dataset(meta, sounds, load(a.diarizer, providers.OneSpeaker()), load(a.asr, providers.LengthAsr()), load(a.vad, providers.EnergyVad()), load(a.enhancer, None), a.limit or None, a.work_dir, **options)
        else:
            durations = readers.probe_duration(readers.audio_files(spark, a.audio_dir)) if a.audio_dir else None
            items = builder.corpus_records(meta, durations, a.limit or None)
        writers.save_splits(items, a.output_path)
    elif a.command == "enhance":
        options = relational.sweep(spark, numbers(spark, a.nfe, "int"), numbers(spark, a.lambd, "double"), numbers(spark, a.tau, "double"))
        audio = readers.decode_audio(readers.audio_files(spark, a.input_dir, readers.ENHANCE), None, load(a.decoder, None))
        done = spark.read.parquet(a.done) if a.done else None
        writers.save(builder.enhance(audio, load(a.model, providers.NoEnhancement()), done, options), a.output_dir)
        relational.sweep_totals(spark.read.parquet(a.output_dir)).show(truncate=False)
    else:
        frames = [readers.dataset(spark, p, a.split) for p in a.datasets]
        if a.command == "analyse":
            bound = lambda x: None if x is None else float(x)
            stats, bins = builder.analyse(frames, bound(a.min_duration), bound(a.max_duration))
            stats.show(truncate=False)
            bins.where(F.col("n") > 0).orderBy("bin").show(100, truncate=False)
        elif a.command == "merge":
            writers.save(relational.merge_datasets(frames).drop("_src"), a.output_path)
        else:
            export(spark, frames, a.output_path, a.full)


if __name__ == "__main__":
    main()
