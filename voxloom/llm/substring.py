"""Removal of passages that repeat anywhere in a corpus, by difference-cover anchors.

Anchors are windows of ``length - period + 1`` words that are hashed only where
their position modulo the period is in a difference cover.  Wherever two
windows of ``length`` words are equal, some shift brings both positions into
the cover, so both hold an equal anchor at that shift.  Anchors that repeat are
extended to the windows that contain them, and those are compared in turn by
128-bit hashes of their words.

Occurrences of a hash within a batch collapse to one row before a shuffle, and
whole documents with equal words count as one from then on, so a passage or a
document in any number of copies costs a row per batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, keyed, real_id, store, word_spans

#: Words of a window.
LENGTH = 35
#: A perfect difference set: each difference modulo PERIOD that isn't 0 occurs once.
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
_SCHEMA = "h1 long, h2 long, d long, k long, pos int, kind int"
#: What a row says of its occurrence: to be compared; its like is in the same batch; it has been found to repeat.
LONE, PAIRED, KNOWN = 0, 1, 2
#: Position of the row that stands for a document as a whole.
WHOLE = -1


def is_cover(cover, period: int) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def anchor_positions(words: int, length: int = LENGTH, period: int = PERIOD, cover=COVER) -> np.ndarray:
    """Cover positions at which an anchor of a text with so many words begins; none where no window fits."""
    last = words - (length - period + 1)
    if words < length:
        return np.empty(0, dtype=np.int64)
    at = np.arange(last + 1)
    return at[np.isin(at % period, cover)]


def window_starts(words: int, anchors: np.ndarray, length: int = LENGTH, period: int = PERIOD) -> np.ndarray:
    """Starts of the windows that contain one of the anchors at a shift under the period."""
    edge = np.zeros(words + 2, dtype=np.int64)
    np.add.at(edge, np.maximum(anchors - period + 1, 0), 1)
    np.add.at(edge, np.minimum(anchors, words - length) + 1, -1)
    return np.flatnonzero(np.cumsum(edge)[: max(0, words - length + 1)] > 0)


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)


def _combine(h: np.ndarray, doc: np.ndarray, pos: np.ndarray, ids, paired: np.ndarray | None = None):
    """One batch of rows: the first occurrence of each hash is compared later, further ones are known to repeat."""
    order = np.lexsort((pos, doc, h[:, 1], h[:, 0]))
    h, doc, pos = h[order], doc[order], pos[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]).any(axis=1)
    size = np.diff(np.append(np.flatnonzero(new), len(h)))
    kind = np.full(len(h), KNOWN, dtype=np.int32)
    kind[new] = np.where(size > 1, PAIRED, LONE)
    if paired is not None:
        kind = np.where((kind == LONE) & paired[order], PAIRED, kind)
    h[:, 0] = np.where(kind == KNOWN, np.arange(len(h)) * 0x9E3779B97F4A7C1 + h[:, 0], h[:, 0])  # spread: nothing waits for them
    d, k = ids
    return pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(d[doc]), pa.array(k[doc]), pa.array(pos.astype(np.int32)), pa.array(kind)], ["h1", "h2", "d", "k", "pos", "kind"])


def _parts(batches, limit: int = 1 << 20):
    """Batches in parts of at most that many words, but for one document."""
    for batch in batches:
        start, words = 0, 0
        sizes = [len(t) // 6 for t in batch.column("_t").to_pylist()]
        for i, n in enumerate(sizes):
            if words and words + n > limit:
                yield batch.slice(start, i - start)
                start, words = i, 0
            words += n
        yield batch.slice(start)


def _anchors(length: int, period: int, cover):
    width = length - period + 1

    def run(batches):
        for batch in _parts(batches):
            ids = [np.asarray(batch.column(c)) for c in ("_d", "_k")]
            digest, docs, at = [], [], []
            for i, t in enumerate(batch.column("_t").to_pylist()):
                words = t.split()
                if len(words) < length:
                    continue
                joined, start, end = word_spans(words)
                p = anchor_positions(len(words), length, period, cover)
                digest += [xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(start[p].tolist(), end[p + width - 1].tolist())]
                digest.append(xxhash.xxh3_128_digest(joined, 1))
                docs.append(np.full(len(p) + 1, i))
                at.append(np.append(p, WHOLE))
            if docs:
                yield _combine(_halves(digest).copy(), np.concatenate(docs), np.concatenate(at), ids)

    return run


def _windows(length: int, period: int):
    def run(batches):
        for batch in _parts(batches):
            ids = [np.asarray(batch.column(c)) for c in ("_d", "_k")]
            digest, docs, at, many = [], [], [], []
            for i, (t, anchors, twin) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_t", "anchors", "twin")))):
                words = t.split()
                joined, start, end = word_spans(words)
                p = window_starts(len(words), np.array(anchors, dtype=np.int64), length, period)
                digest += [xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(start[p].tolist(), end[p + length - 1].tolist())]
                docs.append(np.full(len(p), i))
                at.append(p)
                many.append(np.full(len(p), bool(twin)))
            if digest:
                yield _combine(_halves(digest).copy(), np.concatenate(docs), np.concatenate(at), ids, np.concatenate(many))

    return run


def _repeats(batches):
    """Over rows sorted by hash: those that repeat, and of whole documents which one speaks for its like (kind LONE) and which don't (KNOWN)."""
    held, last, twin = None, None, False

    def out(rows, repeated, first):
        kind = np.where(first & (rows[4] == WHOLE), LONE, KNOWN).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(rows[2][repeated]), pa.array(rows[3][repeated]), pa.array(rows[4][repeated]), pa.array(kind[repeated])], ["d", "k", "pos", "kind"])

    for batch in batches:
        rows = [np.asarray(batch.column(c)) for c in ("h1", "h2", "d", "k", "pos", "kind")]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        if not len(rows[0]):
            continue
        known = rows[5] == KNOWN
        same = np.zeros(len(known) + 1, dtype=bool)  # same[i]: row i is like row i - 1
        same[1:-1] = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1]) & ~known[1:] & ~known[:-1]
        same[0] = last is not None and not known[0] and last == (rows[0][0], rows[1][0])
        repeated = known | (rows[5] == PAIRED) | same[:-1] | same[1:]
        first = ~known & ~same[:-1]
        # the last row waits for its neighbour
        repeated[-1:] = False
        yield out(rows, repeated, first)
        held = [x[-1:] for x in rows]
        if len(rows[0]) > 1:
            last = None if known[-2] else (rows[0][-2], rows[1][-2])
    if held is not None:
        alike = last is not None and held[5][0] != KNOWN and last == (held[0][0], held[1][0])
        repeated = np.array([alike or held[5][0] != LONE])
        yield out(held, repeated, np.array([held[5][0] != KNOWN and not alike]))


def _repeated(rows: DataFrame) -> DataFrame:
    """``d``, ``k``, ``pos``, ``kind`` of the occurrences whose hash repeats."""
    return rows.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "kind", "d", "k", "pos").select("h1", "h2", "d", "k", "pos", "kind").mapInArrow(_repeats, "d long, k long, pos int, kind int")


def kept_words(text: bytes, starts, whole: bool, length: int = LENGTH) -> tuple[list[bytes], list[bytes]]:
    """All words of a text, and those that no repeated window covers."""
    words = text.split()
    if whole:
        return words, []
    if not starts:
        return words, words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.array(starts, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return words, [w for w, c in zip(words, covered.tolist()) if not c]


def _result(length: int, with_text: bool):
    def run(batches):
        for batch in batches:
            n, gone, sha, kept_text = [], [], [], []
            for t, starts, whole in zip(*(batch.column(c).to_pylist() for c in ("_t", "starts", "whole"))):
                words, kept = kept_words(t, starts, bool(whole), length)
                text = b" ".join(kept)
                n.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(text).hexdigest())
                kept_text.append(text.decode("utf-8", "replace"))
            columns = [batch.column("_d"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            names = ["_d", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept_text, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, period: int = PERIOD, cover=COVER, with_text: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text``.

    A word goes if a window of ``length`` words that covers it starts anywhere
    else too, in the same document or another.  Words are separated by ASCII
    white space; kept ones are joined by one space.  A null text has no words.
    Rows that repeat are documents of their own, so their windows repeat; each
    gets a row.  Other columns are not read; an empty table gives an empty
    result.
    """
    if not is_cover(cover, period) or period >= length:
        raise ValueError("cover must hold every difference modulo a period under the length")
    anchors = store(_repeated(keyed(docs, text, doc_id).mapInArrow(_anchors(length, period, cover), _SCHEMA)), "anchors")
    whole = F.col("pos") == WHOLE
    by_doc = anchors.groupBy("d", "k").agg(
        F.collect_set(F.when(~whole, F.col("pos"))).alias("anchors"),  # rows that repeat id and text share a key
        F.max(F.when(whole, 1).otherwise(0)).alias("twin"),
        F.max(F.when(whole & (F.col("kind") == LONE), 1).otherwise(0)).alias("speaks"),
    )
    by_doc = store(by_doc, "anchors-doc")
    source = keyed(docs, text, doc_id)
    on = lambda x, y: (x["_d"] == y["d"]) & (x["_k"] == y["k"])
    # of documents with equal words one row speaks, and its windows count as repeated
    searched = by_doc.where("(twin = 0 or speaks = 1) and size(anchors) > 0")
    found = source.join(searched, on(source, searched)).select("_d", "_k", "_t", "anchors", "twin").mapInArrow(_windows(length, period), _SCHEMA)
    windows = store(_repeated(found), "windows")
    starts = windows.groupBy("d", "k").agg(F.collect_set("pos").alias("starts"))
    twins = by_doc.where("twin = 1").select("d", "k", F.lit(True).alias("whole"))
    marks = store(starts.join(twins, ["d", "k"], "full").withColumnsRenamed({"d": "md", "k": "mk"}), "windows-doc")
    drop(anchors)
    drop(windows)
    final = source.join(marks, (source["_d"] == marks["md"]) & (source["_k"] == marks["mk"]), "left")
    schema = "_d long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    out = final.select("_d", "_t", "starts", "whole").mapInArrow(_result(length, with_text), schema)
    return out.select(real_id().alias("doc_id"), *out.columns[1:])
