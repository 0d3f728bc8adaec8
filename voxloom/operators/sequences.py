"""Operators over the ordered intervals of a file.

What has a closed form is a window expression.  The rest folds over each file's
rows: one exchange on the file, a sort within partitions, and a generator that
gets a file's rows one after another and holds no more than a row or two.
``file`` may be of any type that can be sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_speaker, ends_sentence, strip
from ..scratch import free_name

MIN_TURN, TURN_GAP, MERGE_GAP = 0.7, 0.5, 2.0
MAX_DURATION, MAX_SPEAKERS = 25.0, 4
VAD_RATE, VAD_MIN, VAD_CHUNK = 16_000, 5.0, 300.0
BATCH = 4096


def fold(df: DataFrame, key: str, order: list[str], step: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows that step makes of each key's rows, which it gets in order as tuples of df's columns; ``{key}`` in schema stands for the key's type."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    place, schema = df.columns.index(key), schema.replace("{key}", df.schema[key].dataType.simpleString())
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for _, own in groupby(rows, key=lambda r: r[place]):
            for x in step(own):
                out.append(x)
                if len(out) == BATCH:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def valid(df: DataFrame) -> DataFrame:
    """Intervals that end after they start."""
    return df.where("en > st")


def parse_turns(lines: DataFrame) -> DataFrame:
    """``file, chunk_index, chunk_start, chunk_end, line`` -> ``file, st, en, spk, chunk_index``: short lines go, times are shifted and cut to the chunk."""
    t = F.split(F.trim("line"), r"\s+")
    parsed = lines.where(F.size(t) >= 3).select("file", (F.col("chunk_start") + t[0].cast("double")).alias("st"), F.least(F.col("chunk_start") + t[1].cast("double"), F.col("chunk_end")).alias("en"), F.format_string("chunk_%05d_%s", "chunk_index", t[2]).alias("spk"), "chunk_index")
    return valid(parsed)


def group_vad(df: DataFrame, min_duration: float = VAD_MIN, rate: float = VAD_RATE) -> DataFrame:
    """``file, idx, st, en`` in samples: neighbours join until a group spans min_duration; the last group may be shorter."""

    def step(rows):
        n, now = 0, None
        for file, st, en, _ in rows:
            now = (file, n, now[2] if now else st, en)
            if (en - now[2]) / rate >= min_duration:
                yield now
                n, now = n + 1, None
        if now:
            yield now

    return fold(df.select("file", "st", "en", "seq"), "file", ["st", "en", "seq"], step, "file {key}, idx int, st double, en double")


def vad_chunks(df: DataFrame, size: float = VAD_CHUNK, rate: float = VAD_RATE) -> DataFrame:
    """``file, idx, st, en`` in seconds: a chunk takes intervals while it stays within size; a longer one is cut into pieces of size and a rest."""
    if size <= 0:
        raise ValueError("size must be positive")

    def step(rows):
        now, n = None, 0
        for file, st, en, _ in chain(rows, [(None, None, None, None)]):
            if st is not None:
                st, en = st / rate, en / rate
                if en <= st:
                    continue
                if now and en - now[1] <= size:
                    now = (file, now[1], max(now[2], en))
                    continue
            if now:
                name, a, b = now
                while b - a > size:
                    yield name, n, a, a + size
                    a, n = a + size, n + 1
                if b > a:
                    yield name, n, a, b
                    n += 1
            now = (file, st, en)

    return fold(df.select("file", "st", "en", "seq"), "file", ["st", "en", "seq"], step, "file {key}, idx int, st double, en double")


def smooth_turns(df: DataFrame, min_turn: float = MIN_TURN, max_gap: float = TURN_GAP) -> DataFrame:
    """``file, idx, st, en, spk`` (and ``chunk_index`` where there is one): turns without the short ones that a neighbour within max_gap can take in.

    Between turns of one speaker the short one and the next join the one
    before; else the one before takes it, else the next.  A turn before that
    is short itself has no neighbour that near, so one pass suffices.
    """

    def step(rows):
        rows = (list(r) for r in rows if r[2] > r[1])
        prev, n, now = None, 0, next(rows, None)
        while now:
            after = next(rows, None)
            st, en = now[1], now[2]
            near = prev is not None and st - prev[2] <= max_gap
            if en - st >= min_turn or not (near or (after and after[1] - en <= max_gap)):
                if prev:
                    yield prev[0], n, *prev[1:]
                    n += 1
                prev = now
            elif near and after and prev[3] == after[3] and after[1] - en <= max_gap:
                prev[2] = max(prev[2], after[2])
                after = next(rows, None)
            elif near:
                prev[2] = max(prev[2], en)
            else:
                after[1] = min(after[1], st)
            now = after
        if prev:
            yield prev[0], n, *prev[1:]

    chunk = F.col("chunk_index") if "chunk_index" in df.columns else F.lit(None)
    own = df.select("file", "st", "en", "spk", chunk.cast("int").alias("chunk_index"), "seq")
    out = fold(own.select("*"), "file", ["st", "en", "seq"], lambda rows: step(r[:5] for r in rows), "file {key}, idx int, st double, en double, spk string, chunk_index int")
    return out if "chunk_index" in df.columns else out.drop("chunk_index")


def _with_sources(df: DataFrame) -> DataFrame:
    """Valid intervals with ``who``, their canonical speaker, and ``chunk_index``, null where there is none."""
    out = valid(df).withColumn("who", canonical_speaker("spk"))
    return out if "chunk_index" in df.columns else out.withColumn("chunk_index", F.lit(None).cast("int"))


def merge_adjacent(df: DataFrame, max_gap: float = MERGE_GAP) -> DataFrame:
    """``file, idx, st, en, spk, n, chunk_index, source_speaker_ids, source_chunk_indices``: neighbours of one canonical speaker at most max_gap apart join.

    A run of one speaker breaks where a start lies more than max_gap after all
    ends of the run so far: three windows over one exchange.  ``chunk_index`` is
    the one all have in common, the lists hold the joined turns' speakers as
    they were and their chunks, in order.
    """
    w = Window.partitionBy("file").orderBy("st", "en", "seq")
    own = _with_sources(df)
    own = own.withColumn("run", F.sum(F.when(F.lag("who").over(w).eqNullSafe(F.col("who")), 0).otherwise(1)).over(w))
    r = Window.partitionBy("file", "run").orderBy("st", "en", "seq")
    own = own.withColumn("gap", F.col("st") - F.max("en").over(r.rowsBetween(Window.unboundedPreceding, -1)))
    own = own.withColumn("island", F.sum(F.when(F.col("gap") <= max_gap, 0).otherwise(1)).over(w))
    joined = F.array_sort(F.collect_list(F.struct("st", "en", "seq", "spk", "chunk_index")))
    merged = own.groupBy("file", "island").agg(F.min("st").alias("st"), F.max("en").alias("en"), F.min("who").alias("spk"), F.count("*").alias("n"), joined.alias("of"))
    chunks = F.transform("of", lambda x: x["chunk_index"])
    one = F.when((F.size(F.array_distinct(chunks)) == 1), F.get(chunks, F.lit(0)))
    return merged.select("file", (F.col("island") - 1).cast("int").alias("idx"), "st", "en", "spk", "n", one.alias("chunk_index"), F.transform("of", lambda x: x["spk"]).alias("source_speaker_ids"), F.array_compact(chunks).alias("source_chunk_indices"))


def merge_adjacent_capped(df: DataFrame, max_gap: float = MERGE_GAP, max_duration: float = MAX_DURATION) -> DataFrame:
    """As merge_adjacent, but nothing joins that would span more than max_duration."""

    def step(rows):
        now, n = None, 0
        for file, st, en, who, spk, chunk, _ in rows:
            more = [] if chunk is None else [chunk]
            if now and now[4] == who and st - now[3] <= max_gap and max(now[3], en) - now[2] <= max_duration:
                now = (file, now[1], now[2], max(now[3], en), who, now[5] + 1, chunk if now[6] == chunk else None, [*now[7], spk], now[8] + more)
                continue
            if now:
                yield now
                n += 1
            now = (file, n, st, en, who, 1, chunk, [spk], more)
        if now:
            yield now

    own = _with_sources(df).select("file", "st", "en", "who", "spk", "chunk_index", "seq")
    return fold(own, "file", ["st", "en", "seq"], step, "file {key}, idx int, st double, en double, spk string, n long, chunk_index int, source_speaker_ids array<string>, source_chunk_indices array<int>")


def cap_durations(df: DataFrame, cap: float = MAX_DURATION) -> DataFrame:
    """Each interval as pieces of cap and a rest, ``piece`` counting from 0; other columns are copied."""
    pieces = F.greatest(F.ceil((F.col("en") - F.col("st")) / cap).cast("int"), F.lit(1))
    out = valid(df).withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    at = F.col("st") + F.col("piece") * F.lit(cap)
    return out.withColumns({"en": F.least(at + F.lit(cap), F.col("en")), "st": at})


def _sources(df: DataFrame) -> DataFrame:
    """df with the lists of source speakers and chunks, empty where it has none."""
    for name, kind in (("source_speaker_ids", "array<string>"), ("source_chunk_indices", "array<int>")):
        if name not in df.columns:
            df = df.withColumn(name, F.array().cast(kind))
    return df


def merge_transcripts(df: DataFrame) -> DataFrame:
    """``file, idx, st, en, spk, text, n`` and the lists of sources: an utterance joins the one before while the speaker stays and that text hasn't ended; blank ones go.

    What a merged text ends in is what its last utterance ends in, so the joins
    follow from neighbours alone.  ``source_utterance_indices`` holds the joined
    utterances' ``idx``; their lists of speakers and chunks follow one another.
    """
    w = Window.partitionBy("file").orderBy("idx")
    own = _sources(df).withColumns({"text": strip("text"), "who": canonical_speaker("spk")}).where("text <> ''")
    joins = F.lag("who").over(w).eqNullSafe(F.col("who")) & ~ends_sentence(F.lag("text").over(w))
    own = own.withColumn("part", F.sum(F.when(joins, 0).otherwise(1)).over(w))
    of = F.array_sort(F.collect_list(F.struct("idx", "text", "source_speaker_ids", "source_chunk_indices")))
    merged = own.groupBy("file", "part").agg(F.min("st").alias("st"), F.max("en").alias("en"), F.min_by("spk", "idx").alias("spk"), F.count("*").alias("n"), of.alias("of"))
    each = lambda c: F.transform("of", lambda x: x[c])
    lists = [each("idx").alias("source_utterance_indices"), *(F.flatten(each(c)).alias(c) for c in ("source_speaker_ids", "source_chunk_indices"))]
    return merged.select("file", (F.col("part") - 1).cast("int").alias("idx"), "st", "en", "spk", F.array_join(each("text"), " ").alias("text"), "n", *lists)


def merge_transcripts_capped(df: DataFrame, max_duration: float = MAX_DURATION) -> DataFrame:
    """As merge_transcripts, but nothing joins where both durations add up to more than max_duration."""

    def step(rows):
        now, n = None, 0
        for file, idx, st, en, spk, who, text, ended, *lists in rows:
            if now and now[7] == who and not now[8] and (now[3] - now[2]) + (en - st) <= max_duration:
                more = [a + b for a, b in zip(now[9], ([idx], *lists))]
                now = (*now[:3], max(now[3], en), now[4], f"{now[5]} {text}", now[6] + 1, who, ended, more)
                continue
            if now:
                yield *now[:7], *now[9]
                n += 1
            now = (file, n, st, en, spk, text, 1, who, ended, [[idx], *lists])
        if now:
            yield *now[:7], *now[9]

    own = _sources(df).withColumn("text", strip("text")).where("text <> ''")
    own = own.select("file", F.col("idx").cast("long").alias("idx"), "st", "en", "spk", canonical_speaker("spk").alias("who"), "text", ends_sentence("text").alias("ended"), "source_speaker_ids", "source_chunk_indices")
    return fold(own, "file", ["idx"], step, "file {key}, idx int, st double, en double, spk string, text string, n long, source_utterance_indices array<long>, source_speaker_ids array<string>, source_chunk_indices array<int>")


def split_sentences(df: DataFrame, cap: float = MAX_DURATION) -> DataFrame:
    """Utterances over cap as runs of whole sentences, timed by their share of the characters; ``piece`` counts from 0, other columns are copied.

    One of a single sentence stays as it is.  A fold over each row's own
    sentences: no exchange, and nothing leaves the JVM.
    """
    from ..functions.text import sentences

    parts, length = sentences("text"), F.col("en") - F.col("st")
    total = F.aggregate(parts, F.lit(0), lambda n, p: n + F.length(p))
    piece = "struct<st:double,en:double,text:string>"
    start = F.struct(F.col("st").cast("double").alias("begin"), F.lit(0).alias("size"), F.array().cast("array<string>").alias("held"), F.array().cast(f"array<{piece}>").alias("out"))
    done = lambda a, until: F.concat(a["out"], F.array(F.struct(a["begin"].alias("st"), until.cast("double").alias("en"), F.array_join(a["held"], " ").alias("text"))))

    def step(a, p):
        full = (F.size(a["held"]) > 0) & ((a["begin"] + ((a["size"] + F.length(p)) / total) * length) - a["begin"] > cap)
        until = a["begin"] + (a["size"] / total) * length
        return F.struct(
            F.when(full, until).otherwise(a["begin"]).alias("begin"),
            F.when(full, F.length(p)).otherwise(a["size"] + F.length(p)).alias("size"),
            F.when(full, F.array(p)).otherwise(F.concat(a["held"], F.array(p))).alias("held"),
            F.when(full, done(a, until)).otherwise(a["out"]).alias("out"),
        )

    whole = F.array(F.struct(F.col("st").cast("double").alias("st"), F.col("en").cast("double").alias("en"), F.col("text").alias("text")))
    stays = (length <= cap) | (F.size(parts) <= 1) | (total == 0)
    pieces = F.when(F.coalesce(stays, F.lit(True)), whole).otherwise(F.aggregate(parts, start, step, lambda a: done(a, F.col("en"))))
    at, own = free_name(df, "_at"), free_name(df, "_own")
    out = df.select("*", F.posexplode(pieces).alias(at, own))
    out = out.withColumns({"piece": F.col(at), "st": F.col(own)["st"], "en": F.col(own)["en"], "text": F.col(own)["text"]})
    first = ("file", "idx", "piece", "st", "en", "spk", "text")
    return out.select(*first, *(c for c in df.columns if c not in first))


def pack_samples(df: DataFrame, max_duration: float | None = MAX_DURATION, max_speakers: int | None = MAX_SPEAKERS) -> DataFrame:
    """``file, idx, sample``: utterances in order fill a sample until the next would exceed its duration or its speakers; None or 0 speakers: any number."""

    def step(rows):
        sample, length, who = -1, 0.0, set()
        for file, idx, st, en, spk, _ in rows:
            long = max_duration is not None and length + (en - st) > max_duration
            many = bool(max_speakers) and max_speakers > 0 and spk not in who and len(who) + 1 > max_speakers
            if sample < 0 or long or many:
                sample, length, who = sample + 1, 0.0, set()
            length += en - st
            who.add(spk)
            yield file, idx, sample, st, en, spk

    own = valid(df).select("file", F.col("idx").cast("long").alias("idx"), "st", "en", canonical_speaker("spk").alias("spk"), F.lit(0).alias("z"))
    return fold(own, "file", ["idx"], step, "file {key}, idx long, sample int, st double, en double, spk string")
