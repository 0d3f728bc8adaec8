"""Fuzzy line deduplication by SimHash blocks.

Lines are normalised.  A line's fingerprint is a SimHash over its grams of
bytes, cut into blocks such that an edit disturbs only some of them (see
:mod:`~voxloom.llm.blocks`).  Lines that share a block are verified by Hamming
distance and edit similarity, and of each connected group the first occurrence stays.  Equal
lines of any length are one node.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import FP, Cut, buckets, class_keys, dealt, fingerprints, groups, mix, packed, unpacked
from .common import NULL_ID, drop, free_name, keyed, real_id, store

#: Least edit similarity of linked lines, in percent.
SIMILARITY = 80
#: Lines of fewer words, and of fewer characters, take part only in exact removal.
MIN_WORDS, MIN_CHARS = 1, 1
#: Lines of so many bytes have larger classes, and from the level LONG on fewer blocks of more features: of a long line a stretch that others share may well be a part.
CUT = Cut(features=3, blocks=14, least=2, alike=SIMILARITY / 100, long=160, long_features=4)
LONG, LONG_CUT = 6, replace(CUT, blocks=10, least=3)
#: Bytes of a gram, by level: the longer two unlike lines are, the more short grams they share.
GRAMS = {1: 3, 2: 3, 3: 4, 4: 5, 5: 7}
LONG_GRAM = 8
#: Bytes of a gram of the plain fingerprint.
PLAIN_GRAM = 4
#: Bytes of lines that are hashed at a time, and lines of a task that are packed at a time.
SLICE, ROWS = 1 << 18, 1 << 17
#: Parts into which the lines of a component are dealt.
SALTS = 16
#: Fixed by definition: A-Z to a-z, digits to 0, other ASCII but the line feed to a space.
_NORMAL = bytes(b if b == 10 or b > 127 else ord("0") if 48 <= b <= 57 else b | 32 if chr(b).isalpha() else 32 for b in range(256))


def split_lines(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Normalised form of every line of the texts, blank ones as empty, and the number of each text's first."""
    data = np.frombuffer(b"\n".join(texts).translate(_NORMAL), dtype=np.uint8)
    space = data == 32
    space[1:] &= space[:-1].copy()
    space[:1] = False
    lines = [x.strip(b" ") for x in data[~space].tobytes().split(b"\n")]
    return lines, np.cumsum([0, *(t.count(b"\n") + 1 for t in texts)])[:-1]


def normal_lines(text: bytes) -> list[tuple[int, bytes]]:
    """Number (from 0) and normalised form of each line that has any."""
    return [(i, x) for i, x in enumerate(split_lines([text])[0]) if x]


class _Grams:
    """The grams of lines, none of them empty, a space before and after each line."""

    def __init__(self, lines: list[bytes]):
        self.size = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines)) + 2
        self.begin = np.cumsum(self.size) - self.size
        data = np.frombuffer(b" " + b"  ".join(lines) + b" " + bytes(10), dtype=np.uint8)
        # eight bytes from each place on
        self.window = np.ndarray((int(self.size.sum()),), dtype="<u8", buffer=data, strides=(1,))

    def all(self, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams of all lines as numbers, and each one's line."""
        n = np.maximum(self.size - gram + 1, 1)
        place = np.repeat(self.begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return self.window[place] & np.uint64((1 << 8 * gram) - 1), np.repeat(np.arange(len(n)), n)

    def classed(self, low: int, high: int, gram: int, level: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Grams of lines low to before high whose class is one of so many blocks; each one's line, from low on, and class."""
        begin, size = self.begin[low:high] - self.begin[low], self.size[low:high]
        h = self.window[self.begin[low] : self.begin[low] + int(size.sum())] & np.uint64((1 << 8 * gram) - 1)
        spread = mix(h)
        at = np.flatnonzero(spread < np.uint64(blocks << 64 - level)) if blocks < 1 << level else np.arange(len(h))
        owner = np.repeat(np.arange(high - low, dtype=np.int32), size)[at].astype(np.int64)
        # a gram ends before its line does
        whole = at - begin[owner] < np.maximum(size - gram + 1, 1)[owner]
        at, owner = at[whole], owner[whole]
        return h[at], owner, (spread[at] >> np.uint64(64 - level)).view(np.int64)


def line_keys(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Line (by number) and key of every block of the lines, none of them empty."""
    order = np.argsort(np.fromiter(map(len, lines), dtype=np.int64, count=len(lines)), kind="stable")
    grams, found = _Grams([lines[i] for i in order.tolist()]), []
    own, near = CUT.level(grams.size - 2), CUT.level((grams.size - 2) / CUT.alike)
    # lines of a level and those of the level before that may be alike follow one another
    near = np.minimum(near, own + 1)
    for level in np.unique(np.append(own, near)).tolist():
        cut, low, high = CUT if level < LONG else LONG_CUT, int(np.searchsorted(near, level)), int(np.searchsorted(own, level, side="right"))
        if low < high:
            at, key = class_keys(*grams.classed(low, high, GRAMS.get(level, LONG_GRAM), level, cut.blocks), np.full(high - low, level), cut)
            found.append((order[low + at], key))
    return tuple(np.concatenate(x) for x in zip(*found))


def line_fingerprints(lines: list[bytes]) -> list[np.ndarray]:
    """Plain SimHashes of the lines' grams, in words."""
    return fingerprints(*_Grams(lines).all(PLAIN_GRAM), len(lines))


def characters(lines: list[bytes]) -> np.ndarray:
    """Characters of each line; what isn't UTF-8 counts as it is decoded."""
    data = b"\n".join(lines)
    try:
        data.decode()
    except UnicodeDecodeError:
        return np.array([len(x.decode("utf-8", "replace")) for x in lines], dtype=np.int32)
    end = np.cumsum(np.fromiter(map(len, lines), dtype=np.int64, count=len(lines)) + 1)
    # all but the bytes that go on with a character
    first = np.append(0, np.cumsum(np.frombuffer(data + b"\n", dtype=np.int8) >= -64))
    return (np.diff(first[np.append(0, end)]) - 1).astype(np.int32)


def _digests(lines: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), dtype=np.int64).reshape(-1, 2)


#: What a line is known by: the digest of its normalised form, its document and its number.
_LINE = {"h1": np.int64, "h2": np.int64, "d": np.int64, "k": np.int64, "line": np.int32}


def _heads(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of lines (columns of _LINE) the first of each digest and the others, by number; those of a document that repeats are the first's own."""
    order = np.argsort(rows[0])
    again = rows[0][order[1:]] == rows[0][order[:-1]]
    many = np.append(again, False) | np.append(False, again)
    alone, many = order[~many[: len(order)]], order[many[: len(order)]]
    many = many[np.lexsort([x[many] for x in rows[::-1]])]
    own = np.stack([x[many].astype(np.int64) for x in rows])
    begin = np.flatnonzero(np.append(True, (own[:2, 1:] != own[:2, :-1]).any(axis=0))[: len(many)])
    head = np.repeat(begin, np.diff(np.append(begin, len(many))))
    return np.append(alone, many[begin]), many[(own != own[:, head]).any(axis=0)]


def _line_rows(n: int):
    def pack(held):
        """Of equal lines the first goes on, packed by its digest; the others are in a row of their own, of bucket -1."""
        rows = [np.concatenate(x) for x in zip(*held)]
        head, other = _heads(rows)
        yield pa.RecordBatch.from_arrays(packed(rows[0][head], [x[head] for x in rows[1:]], n), ["bucket", *_LINE])
        if len(other):
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), *(pa.array([x[other].tobytes()], pa.binary()) for x in rows)], ["bucket", *_LINE])

    def run(batches):
        """The lines that aren't blank, packed."""
        held, count = [], 0
        for batch in batches:
            lines, first = split_lines(batch.column("_t").to_pylist())
            at = np.array([i for i, x in enumerate(lines) if x], dtype=np.int64)
            if len(at):
                doc, h = np.searchsorted(first, at, side="right") - 1, _digests([lines[i] for i in at.tolist()])
                held.append([h[:, 0], h[:, 1], np.asarray(batch.column("_d"))[doc], np.asarray(batch.column("_k"))[doc], (at - first[doc]).astype(np.int32)])
                count += len(at)
            if count >= ROWS:
                yield from pack(held)
                held, count = [], 0
        if held:
            yield from pack(held)

    return run


def _nodes(batches):
    """Of packed lines sorted by bucket the first of each digest, and the others as ``again``."""
    for rows in unpacked(batches, _LINE):
        head, other = _heads(rows)
        at = np.append(head, other)
        again = np.arange(len(at)) >= len(head)
        yield pa.RecordBatch.from_arrays([pa.array(rows[i][at]) for i in (0, 2, 3, 4)] + [pa.array(again)], ["node", "d", "k", "line", "again"])


def _copies(batches):
    """The lines of the rows of bucket -1."""
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("d", "k", "line"))):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, dtype=_LINE[c])) for c, x in zip(("d", "k", "line"), row)], ["d", "k", "line"])


def _block_rows(min_words: int, min_chars: int):
    def run(batches):
        """Rows of (key, size, node) of the lines, those met before in the batch left out."""

        def rows(lines):
            at, key = line_keys(lines)
            size = characters(lines)
            node = _digests(lines)[:, 0]
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(size[at]), pa.array(node[at])], ["key", "size", "node"])

        for batch in batches:
            lines, held = [], 0
            for x in dict.fromkeys(split_lines(batch.column("_t").to_pylist())[0]):
                if not x or (min_words > 1 and x.count(b" ") + 1 < min_words) or len(x) < min_chars:
                    continue
                lines.append(x)
                held += len(x)
                if held > SLICE:
                    yield rows(lines)
                    lines, held = [], 0
            if lines:
                yield rows(lines)

    return run


def _texts(batches):
    """Normalised form and fingerprint of the lines that ``wanted`` (line, node) names."""

    def rows(nodes, lines):
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([x.decode("utf-8", "replace") for x in lines], pa.string()), *map(pa.array, line_fingerprints(lines))], ["node", "content", *FP])

    last = np.empty((2, 0), dtype=np.int64)
    for batch in batches:
        # a document that repeats the one before has been done
        doc = np.concatenate([last, np.stack([np.asarray(batch.column(c)) for c in ("_d", "_k")])], axis=1)
        new = np.append([True] * (not last.size), (doc[:, 1:] != doc[:, :-1]).any(axis=0))
        batch, last = batch.filter(pa.array(new[: batch.num_rows].astype(bool))), doc[:, -1:]
        texts = batch.column("_t").to_pylist()
        own, first = b"\n".join(texts).split(b"\n"), np.cumsum([0, *(t.count(b"\n") + 1 for t in texts)])
        wanted = batch.column("wanted")
        row = np.repeat(np.arange(len(wanted)), np.asarray(wanted.value_lengths()))
        wanted = wanted.flatten()
        at, node = first[row] + np.asarray(wanted.field("line")), np.asarray(wanted.field("node"))
        lines, _ = split_lines([own[i] for i in at.tolist()])
        held = np.cumsum([len(x) for x in lines]) // SLICE
        for part in np.split(np.arange(len(at)), np.flatnonzero(held[1:] != held[:-1]) + 1) if len(at) else ():
            yield rows(node[part], lines[part[0] : part[-1] + 1])


#: Characters that must be equal for two texts to be taken up again after a difference, and how far on they are looked for.
PROBE, REACH = 12, 64


def _common(a: str, b: str, i: int, j: int) -> int:
    """Length of what a from i on and b from j on have in common."""
    low, high, step = 0, min(len(a) - i, len(b) - j), 32
    while low < high and a[i + low : i + low + step] == b[j + low : j + low + step]:
        low = min(low + step, high)
        step *= 2
    high = min(high, low + step)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[i + low : i + mid] == b[j + low : j + mid] else (low, mid - 1)
    return low


def at_most(a: str, b: str, most: int) -> int:
    """An upper bound of the edit distance, or something over most: differences skipped to where the texts go on alike."""
    i = j = cost = 0
    while True:
        n = _common(a, b, i, j)
        i, j = i + n, j + n
        if i == len(a) or j == len(b):
            return cost + max(len(a) - i, len(b) - j)
        for skip in range(min(REACH, len(b) - j - PROBE + 1)):
            found = a.find(b[j + skip : j + skip + PROBE], i, i + skip + REACH)
            if found >= 0:
                cost, i, j = cost + max(found - i, skip), found, j + skip
                break
        else:
            return cost + max(len(a) - i, len(b) - j)
        if cost > most:
            return cost


def within(a: str, b: str, most: int) -> bool:
    """Whether at most that many edits of one character lead from a to b.

    A few differences are seen by an upper bound; what that leaves open is told
    exactly by bit vectors over what lies between the common ends.
    """
    if abs(len(a) - len(b)) > most:
        return False
    if at_most(a, b, most) <= most:
        return True
    low = _common(a, b, 0, 0)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low] else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    if not a or not b:
        return max(len(a), len(b)) <= most
    if len(a) > len(b):
        a, b = b, a
    at: dict = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    m, n = len(a), len(b)
    full, up, down, get = (1 << m) - 1, (1 << m) - 1, 0, at.get
    # no column before this one can tell that too many edits are needed
    step, begin = max(CHECK, m // 8), max(0, most - (n - m))
    for done in range(begin, n + step, step):
        for c in b[0 if done == begin else done - step : done]:
            eq = get(c, 0)
            x = (((eq & up) + up) ^ up) | eq
            plus = (down | (x | up) & full ^ full) << 1 | 1
            y = eq | down
            up, down = ((up & x) << 1 | (y | plus) & full ^ full) & full, plus & y
        if done < n and begin < done and _least(up, down, m, n, done) > most:
            return False
    return n + up.bit_count() - down.bit_count() <= most


#: Columns of a comparison after which its outcome is looked for, at least.
CHECK = 32


def _least(up: int, down: int, m: int, n: int, done: int) -> int:
    """The least number of edits that a path through a column of the table of distances can need; up, down: where the column's values rise and fall."""
    size = (m + 7) // 8
    rise, fall = (np.unpackbits(np.frombuffer(x.to_bytes(size, "little"), dtype=np.uint8), bitorder="little", count=m).view(np.int8) for x in (up, down))
    column = np.append(0, np.cumsum(rise - fall, dtype=np.int64))
    return done + int((column + np.abs(m - n + done - np.arange(m + 1))).min())


def alike(similarity: int):
    return lambda a, b: within(a, b, max(len(a), len(b)) * (100 - similarity) // 100)


def similar_lines(docs: DataFrame, similarity: int = SIMILARITY, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``d``, ``k``, ``gone`` (numbers of lines) of keyed documents that lose lines."""
    schema = "bucket int, h1 binary, h2 binary, d binary, k binary, line binary"
    lines = store(docs.mapInArrow(_line_rows(buckets(docs.sparkSession)), schema), "lines")
    ordered = lines.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket").select("bucket", *_LINE)
    every = store(ordered.mapInArrow(_nodes, "node long, d long, k long, line int, again boolean"), "lines-node")
    nodes = every.where("not again").drop("again")

    def contents(wanted):
        own = wanted.join(nodes, "node").groupBy("d", "k").agg(F.collect_list(F.struct("line", "node")).alias("wanted"))
        # merged, rows that repeat both id and text follow one another
        texts = docs.join(own.hint("merge"), (docs["_d"] == own["d"]) & (docs["_k"] == own["k"])).select("_d", "_k", "_t", "wanted")
        return texts.mapInArrow(_texts, "node long, content string" + "".join(f", {f} long" for f in FP))

    rows = dealt(docs.select("_t"), _block_rows(min_words, min_chars))
    group = groups(rows, contents, alike(similarity), similarity, "lines")
    # a component of any size is dealt out by a salt
    lead = nodes.join(group, "node").withColumn("salt", F.pmod(F.xxhash64("node", "d", "k", "line"), F.lit(SALTS)).cast("int"))
    top = lead.groupBy("component").agg(F.min(F.struct("d", "k", "line")).alias("stays")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    gone = lead.join(top, ["component", "salt"]).where(F.struct("d", "k", "line") != F.col("stays")).select("d", "k", "line")
    # a line that comes after an equal one is never the first of its component
    gone = gone.unionAll(every.where("again").select("d", "k", "line"))
    gone = gone.unionAll(lines.where("bucket < 0").select("d", "k", "line").mapInArrow(_copies, "d long, k long, line int"))
    out = store(gone.groupBy("d", "k").agg(F.collect_set("line").alias("gone")), "lines-gone")
    for x in (lines, every, group):
        drop(x)
    return out


def kept_lines(text: bytes, gone) -> list[bytes]:
    gone = set(gone or ())
    lines = text.split(b"\n")
    return [x for i, x in enumerate(lines) if i not in gone] if gone else lines


def dedup_lines(docs: DataFrame, similarity: int = SIMILARITY, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, with_text: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text``.

    Lines end at line feeds.  Two lines are linked where their normalised forms
    (letters A-Z in lower case, digits as 0, other ASCII as a space, spaces
    joined) are equal, or where they share a block of their fingerprints, differ in
    at most ``blocks.BITS`` bits of 128 and their edit similarity (1 - distance / longer length, in characters) is
    ``similarity`` percent or more; lines under ``min_words`` words or ``min_chars``
    characters only where equal.  Of each connected group the occurrence
    in the smallest doc_id, then the earliest line, stays; all others go.  Kept
    lines are unchanged and joined by line feeds.  A line without a normalised
    form (blank, or punctuation alone) stays.  A null or empty text has one
    empty line, which stays.  Rows that repeat both id and text count as one
    document and get the same result.  Other columns are not read; an empty
    table gives an empty result.
    """
    source = keyed(docs, text, doc_id)
    marks = similar_lines(source, similarity, min_words, min_chars)

    def run(batches):
        for batch in batches:
            n, gone, sha, texts = [], [], [], []
            for t, g in zip(batch.column("_t").to_pylist(), batch.column("gone").to_pylist()):
                kept = b"\n".join(kept_lines(t, g))
                n.append(t.count(b"\n") + 1)
                gone.append(len(g or ()))
                sha.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode("utf-8", "replace"))
            columns, names = [batch.column("_d"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["_d", "n_lines", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    joined = source.join(marks, (source["_d"] == marks["d"]) & (source["_k"] == marks["k"]), "left").select("_d", "_t", "gone")
    out = joined.mapInArrow(run, "_d long, n_lines long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    return out.select(real_id().alias("doc_id"), *out.columns[1:])


def without_repeated_lines(docs: DataFrame, similarity: int = SIMILARITY, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, text: str = "text", doc_id: str = "doc_id", n_chars: str = "n_chars") -> DataFrame:
    """docs with the repeated lines taken out of their texts, every row and column kept; n_chars follows the text where there is such a column."""
    marks = similar_lines(keyed(docs, text, doc_id), similarity, min_words, min_chars)
    d, k, g = (free_name(docs, x) for x in ("_d", "_k", "_gone"))
    marks = marks.select(F.col("d").alias(d), F.col("k").alias(k), F.col("gone").alias(g))
    own = docs.withColumn(d, F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)))
    own = own.withColumn(k, F.xxhash64(d, F.coalesce(F.col(text).cast("string"), F.lit(""))))
    left = own.join(marks, [d, k], "left")
    parts = F.split(F.col(text), "\n", -1)
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col(g), i)), "\n")
    out = left.withColumn(text, F.when(F.col(g).isNull(), F.col(text)).otherwise(kept))
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(g).isNull(), F.col(n_chars)).otherwise(F.length(text)).cast(docs.schema[n_chars].dataType))
    return out.select(*docs.columns)
