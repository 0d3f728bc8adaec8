"""Mixing sources to target weights by Sainte-Laguë apportionment.

Seats are words.  Sources get them by highest quotients ``target / (2k + 1)``, so
each takes its target to a word, whatever its size.  The texts of a source are
laid end to end in a seeded order and cut into blocks of equal size: whole
passes over the source come first, the rest is whole blocks and a part of one
more.  The shards of the source get the blocks by the same rule as integer
quotas, and each shard fills its quota with the blocks of the smallest seeded
hashes.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, real_id, store

#: Words of a block; least words of a shard, and shards over all sources at most (shards grow beyond that).
BLOCK, SHARD_WORDS, MAX_SHARDS = 256, 1 << 16, 250_000
#: Sources that are planned on the driver; more are planned by DataFrame operations.
MAX_SOURCES = 10_000
WEIGHTS, SHARE, REPEATS, SEED = (3, 1, 2), 1.5, 2, 42


def sainte_lague(weights: list, seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by highest quotients weight / (2k + 1), none above its cap; ties go to the earlier.

    A divisor is bracketed first, so the work doesn't grow with the seats.
    """
    caps = caps or [seats] * len(weights)
    w = [Fraction(x) for x in weights]
    seats = min(seats, sum(c for c, x in zip(caps, w) if x > 0))
    if seats <= 0:
        return [0] * len(w)
    lot = lambda d: [min(c, int(x / d + Fraction(1, 2))) for x, c in zip(w, caps)]
    low, high = Fraction(0), 2 * max(w) + 1
    for _ in range(200):
        mid = (low + high) / 2
        mid = Fraction(mid).limit_denominator(1 << 80) or (low + high) / 2
        got = sum(lot(mid))
        if got > seats:
            low = mid
        else:
            high = mid
            if seats - got <= 2 * len(w):
                break
    given = lot(high)
    queue = [(-x / (2 * k + 1), i) for i, (x, k, c) in enumerate(zip(w, given, caps)) if k < c and x > 0]
    heapq.heapify(queue)
    for _ in range(seats - sum(given)):
        if not queue:
            break
        _, i = heapq.heappop(queue)
        given[i] += 1
        if given[i] < caps[i]:
            heapq.heappush(queue, (-w[i] / (2 * given[i] + 1), i))
    return given


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> list[float]:
    """Each source's words: share times all words by weight, none above repeats times its size, the excess reshared by weight until none is."""
    total = Fraction(share) * sum(sizes)
    w = [Fraction(weights[i % len(weights)]) for i in range(len(sizes))]
    out, free = [Fraction(0)] * len(sizes), set(range(len(sizes)))
    left = total
    while free:
        unit = left / sum(w[i] for i in free)
        full = {i for i in free if w[i] * unit > repeats * sizes[i]}
        if not full:
            for i in free:
                out[i] = w[i] * unit
            break
        for i in full:
            out[i] = Fraction(repeats * sizes[i])
            left -= out[i]
        free -= full
    return [float(x) for x in out]


def word_count(text):
    """Number of runs of characters other than space and U+0009 to U+000D; 0 for null."""
    parts = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    return F.coalesce(F.size(parts) - F.when(F.element_at(parts, -1) == "", 1).otherwise(0), F.lit(0)).cast("long")


_PLAN = "source string, s long, source_size long, target double, quota long"


def source_plan(sums: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, most: int = MAX_SOURCES) -> DataFrame:
    """``source``, ``s`` (its number), ``source_size``, ``target`` and ``quota`` (words to take) of each source of ``source``, ``words``."""
    listed = sums.limit(most + 1).collect()
    if len(listed) > most:
        return _many_sources(sums, weights, share, repeats)
    listed.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
    sizes = [r.words for r in listed]
    goal = targets(sizes, weights, share, repeats)
    quota = sainte_lague(goal, round(sum(goal)), [repeats * x for x in sizes])
    rows = [(r.source, i, r.words, g, q) for i, (r, g, q) in enumerate(zip(listed, goal, quota))]
    return F.broadcast(sums.sparkSession.createDataFrame(rows, _PLAN))


def _many_sources(sums: DataFrame, weights, share, repeats) -> DataFrame:
    """The same without a list of sources: numbered within ranges, targets by rounds of sums, seats by the divisor one."""
    null = F.col("source").isNull()
    parts = store(sums.withColumn("null", null).repartitionByRange("null", "source").withColumn("p", F.spark_partition_id()), "mix-number")
    before, offset = 0, []
    for r in sorted(parts.groupBy("p").agg(F.count("*").alias("n")).collect()):  # a row per partition
        offset.append((r.p, before))
        before += r.n
    own = parts.join(F.broadcast(sums.sparkSession.createDataFrame(offset, "p int, o long")), "p")
    own = own.withColumn("s", F.col("o") + F.row_number().over(Window.partitionBy("p").orderBy("null", "source")) - 1)
    own = store(own.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("s") % len(weights) + 1).cast("int"))), "mix-weight")
    unit, capped = 0.0, -1
    while True:
        full = F.col("w") * unit > repeats * F.col("words")
        got = own.agg(F.sum("words").alias("all"), F.sum(F.when(full, F.col("words")).otherwise(0)).alias("held"), F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("w"), F.count_if(full).alias("n")).first()
        if got.n == capped or not got.w:
            break
        capped, unit = got.n, (share * got["all"] - repeats * got.held) / got.w
    target = F.least(F.col("w") * unit, repeats * F.col("words").cast("double"))
    return own.select("source", "s", F.col("words").alias("source_size"), target.alias("target"), F.floor(target + 0.5).cast("long").alias("quota"))


def shard_plan(shards: list[tuple[int, int]], quota: int, block: int) -> list[tuple]:
    """(shard, begin, first block, end block, passes, blocks, part, last) of each (shard, words) of a source.

    The shard takes ``blocks`` of its blocks of full size, ``part`` words of one
    more, and ``last`` words of the source's short last block.
    """
    total = sum(n for _, n in shards)
    passes, rest = divmod(quota, total) if total else (0, 0)
    whole, part = divmod(rest, block)
    size, out, begin = total // block, [], 0
    for shard, n in sorted(shards):
        first, end = -(-begin // block), -(-(begin + n) // block)
        out.append([shard, begin, first, max(first, min(end, size)), passes, 0, 0, part if whole == size and first <= size < end else 0])
        begin += n
    held = [x[3] - x[2] for x in out]
    one_more = sainte_lague(held, whole + bool(part and whole < size), held)
    for x, q, more in zip(out, sainte_lague(held, whole, held), one_more):
        x[5], x[6] = q, part if more > q else 0
    return [tuple(x) for x in out]


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED, max_sources: int = MAX_SOURCES, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``passes``, ``ranges``, ``key``.

    Sources stand in code-point order, null last, and weigh ``weights`` in
    turn.  ``taken`` counts the words that the mix takes of a document: all of
    them ``passes`` times, and once more those in ``ranges`` (from, to; words
    counted from 0).  A source's taken words are its target to a word.  ``key`` is the document's internal key.  A null text has
    no words.  Rows that repeat share what their number is given in the order
    of the seed.  The same rows give the same result whatever their order and
    partitions; columns other than the three named are not read, whatever their
    names; an empty table gives an empty result.

    The driver gets one sum per source, if they are ``max_sources`` at most, and
    otherwise none.  A source's shards are planned by one task per source.
    """
    d = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))
    key = F.xxhash64(d, F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(d.alias("d"), key.alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"))
    rows = store(rows.withColumn("at", F.xxhash64("d", "key", F.lit(seed))), "mix")
    sums = store(rows.groupBy("source").agg(F.sum("size").alias("words")), "mix-source")
    total = sums.agg(F.sum("words")).first()[0] or 0
    width = max(shard_words, -(-total // MAX_SHARDS))
    plan = source_plan(sums, weights, share, repeats, max_sources)
    number = F.greatest(F.lit(1), F.ceil(F.col("source_size") / width)).cast("long")
    rows = rows.join(plan.withColumnRenamed("source", "of"), rows["source"].eqNullSafe(F.col("of")))
    rows = rows.select("d", "key", "at", "size", "s", "source_size", "target", "quota", F.pmod(F.shiftright("at", 8), number).cast("int").alias("shard"))

    def planned(own):
        import pandas as pd

        got = shard_plan(list(zip(own["shard"].tolist(), own["words"].tolist())), int(own["quota"].iloc[0]), block)
        return pd.DataFrame([(int(own["s"].iloc[0]), *x) for x in got], columns=["s", "shard", "begin", "b0", "b1", "passes", "blocks", "part", "last"])

    parts = rows.groupBy("s", "shard", "quota").agg(F.sum("size").alias("words"))
    quotas = store(parts.groupBy("s").applyInPandas(planned, "s long, shard int, begin long, b0 long, b1 long, passes int, blocks long, part long, last long"), "mix-quota")
    # the blocks of each shard that are taken, and how many words of each
    own = quotas.where("b1 > b0 and (blocks > 0 or part > 0)").select("s", "shard", "blocks", "part", F.explode(F.sequence(F.col("b0"), F.col("b1") - 1)).alias("block"))
    order = Window.partitionBy("s", "shard").orderBy(F.xxhash64("s", "block", F.lit(seed)), "block")
    chosen = own.withColumn("n", F.row_number().over(order)).where("n <= blocks or (n = blocks + 1 and part > 0)")
    chosen = chosen.select("s", "block", F.when(F.col("n") <= F.col("blocks"), F.lit(block)).otherwise(F.col("part")).cast("long").alias("words"))
    chosen = chosen.unionAll(quotas.where("last > 0").select("s", F.col("b1").alias("block"), F.col("last").alias("words")))
    # the line of a source: shard after shard, in each by the seeded hash
    line = Window.partitionBy("s", "shard").orderBy("at", "d", "key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(quotas.select("s", "shard", "begin", "passes"), ["s", "shard"]).withColumn("end", F.col("begin") + F.sum("size").over(line))
    placed = store(placed.withColumn("start", F.col("end") - F.col("size")).drop("quota"), "mix-line")
    bits = placed.where("size > 0").select("s", "start", "end", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(end - 1) div {block}"))).alias("block"))
    lo, hi = F.greatest(F.col("block") * block, F.col("start")) - F.col("start"), F.least(F.col("block") * block + F.col("words"), F.col("end")) - F.col("start")
    # the sides grow with the documents, which an estimate of compressed tables doesn't show: never broadcast
    pieces = bits.join(chosen.hint("merge"), ["s", "block"]).where(lo < hi).groupBy("s", "start").agg(F.array_sort(F.collect_list(F.struct(lo.alias("from"), hi.alias("to")))).alias("ranges"), F.sum(hi - lo).alias("extra"))
    out = placed.where("size > 0").join(pieces.hint("merge"), ["s", "start"], "left").unionByName(placed.where("size = 0"), allowMissingColumns=True)
    return out.select(real_id("d").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("passes") + F.coalesce("extra", F.lit(0))).alias("taken"), "passes", F.coalesce("ranges", F.array().cast("array<struct<from:bigint,to:bigint>>")).alias("ranges"), "key")


def mixed_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", n_chars: str = "n_chars", **options) -> DataFrame:
    """docs as the mix takes them, all columns kept: a row with the whole text per pass, and one more with the words in the ranges.

    That row's text is cut out of the document's from the first word of each
    range to its last; ranges are joined by a line feed.  n_chars follows the
    text where there is such a column.  A document without words is left as it
    is: it costs the mix nothing.
    """
    import re

    import pyarrow as pa

    from .common import bound_batches, free_name

    spark = docs.sparkSession
    bound_batches(spark)
    taken = store(mix(docs, text=text, doc_id=doc_id, source=source, **options), "mix-taken")
    d, k, p, r, z, n = (free_name(docs, x) for x in ("_d", "_k", "_passes", "_ranges", "_size", "_n"))
    # rows that repeat id and text are placed one after another: each takes a plan of its own
    at = lambda *order: F.row_number().over(Window.partitionBy(d, k).orderBy(*order))
    plan = taken.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias(d), F.col("key").alias(k), F.col("passes").alias(p), F.col("size").alias(z), F.col("ranges").alias(r))
    plan = plan.withColumn(n, at(p, z, r))
    own = docs.withColumn(d, F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)))
    own = own.withColumn(k, F.xxhash64(d, F.coalesce(F.col(text).cast("string"), F.lit("")))).withColumn(n, at(F.xxhash64(*(F.col(c) for c in docs.columns))))
    rows = own.join(plan, [d, k, n]).select(*docs.columns, p, z, r)
    word, names = re.compile(r"[^\x20\x09-\x0D]+"), docs.columns

    def cut(t: str, ranges) -> str:
        at = [m.span() for m in word.finditer(t)]
        return "\n".join(t[at[x["from"]][0] : at[x["to"] - 1][1]] for x in ranges)

    def run(batches):
        for batch in batches:
            index, texts = [], []
            columns = (batch.column(c).to_pylist() for c in (text, p, z, r))
            for i, (t, passes, size, ranges) in enumerate(zip(*columns)):
                for _ in range(passes if size else 1):
                    index.append(i)
                    texts.append(t)
                if ranges:
                    index.append(i)
                    texts.append(cut(t, ranges))
            out = batch.take(pa.array(index, pa.int64())).select(names)
            new = dict(zip(names, out.columns))
            new[text] = pa.array(texts, new[text].type)
            if n_chars in new:
                new[n_chars] = pa.array([old if x is None else len(x) for x, old in zip(texts, new[n_chars].to_pylist())], new[n_chars].type)
            yield pa.RecordBatch.from_arrays([new[c] for c in names], names)

    return rows.mapInArrow(run, docs.schema)
