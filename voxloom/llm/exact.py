"""Exact deduplication by Grace hash partitioning.

Records are dealt by a hash of their text.  A partition that doesn't fit in
memory goes to spill files by further bits of the hash, each file again, until
one fits an open-addressing table; the table compares complete contents, never
hashes alone.  Copies within a batch of the input collapse before the shuffle,
so a group of any size costs one record per batch.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from array import array

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, real_id, store

#: Bytes of distinct contents that one table holds before it spills.
TABLE_BYTES = 64 << 20
#: Spill files per level, and the bits that choose one.
FAN_BITS = 4
_HEAD = struct.Struct("<QqqqI")


class Table:
    """Open addressing with linear probing; a slot is free, or the number of an entry whose hash and whole content are compared."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = [-1] * slots
        self.hashes, self.contents, self.bytes = [], [], 0

    def put(self, h: int, content: bytes) -> tuple[int, bool]:
        """The entry with this content, and whether it is new."""
        mask = len(self.slots) - 1
        i = h & mask
        while (e := self.slots[i]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e, False
            i = i + 1 & mask
        self.slots[i] = e = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 100
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return e, True

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for e, h in enumerate(self.hashes):
            i = h & mask
            while self.slots[i] >= 0:
                i = i + 1 & mask
            self.slots[i] = e


def normalise(text: bytes) -> bytes:
    """A-Z lower-cased, nothing else."""
    return text.lower()


class Members:
    """Pairs of a row and its entry, beyond a bound in a file: a content in any number of copies needs no memory for them."""

    def __init__(self, folder: str, held: int = 1 << 18):
        self.path, self.file, self.part, self.held = os.path.join(folder, "members"), None, array("q"), held

    def add(self, row: int, entry: int) -> None:
        self.part.extend((row, entry))
        if len(self.part) >= 2 * self.held:
            self.file = self.file or open(self.path, "wb")
            self.part.tofile(self.file)
            self.part = array("q")

    def __iter__(self):
        if self.file:
            self.file.close()
            with open(self.path, "rb") as f:
                while raw := f.read(1 << 20):
                    own = array("q", raw)
                    yield from zip(own[::2], own[1::2])
        yield from zip(self.part[::2], self.part[1::2])


def grace(records, limit: int = TABLE_BYTES, folder: str | None = None, level: int = 0):
    """Groups records (hash, id, row, count, content) by content: yields (row, top id, top row, count) for each record.

    The first records fill a table.  Once it holds ``limit`` bytes of distinct
    contents, records whose content it has still go to it and others to spill
    files by the hash's next bits, which are read again after the table is
    done, one at a time.  A copy never adds to a table, so a file of one
    repeated content fits.  Past the hash's last bits the table just grows.  The
    spill files are a task's own and go with it: a task that runs again makes new ones.
    """
    table, top, files = Table(), [], {}
    shift = 64 - FAN_BITS * (level + 1)
    scratch = tempfile.TemporaryDirectory(dir=folder, prefix="grace-")
    members = Members(scratch.name)
    try:
        for h, i, row, n, content in records:
            if files or table.bytes >= limit and shift >= 0:
                e = _find(table, h, content)
                if e < 0:
                    f = h >> shift & (1 << FAN_BITS) - 1
                    if f not in files:
                        files[f] = open(os.path.join(scratch.name, str(f)), "wb", buffering=1 << 18)
                    files[f].write(_HEAD.pack(h, i, row, n, len(content)) + content)
                    continue
            else:
                e, new = table.put(h, content)
                if new:
                    top.append((i, row, 0))
            a, b, c = top[e]
            top[e] = (i, row, c + n) if (i, -row) > (a, -b) else (a, b, c + n)
            members.add(row, e)
        for row, e in members:
            yield (row, *top[e])
        del table, members, top
        for f in files.values():
            f.close()
        for f in sorted(files):
            path = os.path.join(scratch.name, str(f))
            yield from grace(_read(path), limit, scratch.name, level + 1)
            os.remove(path)
    finally:
        scratch.cleanup()


def _find(table: Table, h: int, content: bytes) -> int:
    mask = len(table.slots) - 1
    i = h & mask
    while (e := table.slots[i]) >= 0:
        if table.hashes[e] == h and table.contents[e] == content:
            return e
        i = i + 1 & mask
    return -1


def _read(path: str):
    with open(path, "rb", buffering=1 << 18) as f:
        while head := f.read(_HEAD.size):
            h, i, row, n, size = _HEAD.unpack(head)
            yield h, i, row, n, f.read(size)


def _local(batches):
    """Per row its number, its digest and the row that speaks for its copies in the batch; the content only on that row."""
    task, n = TaskContext.get().partitionId() << 40, 0
    for batch in batches:
        ids, texts = batch.column("_d").to_pylist(), [normalise(x) for x in batch.column("_t").to_pylist()]
        hashes = [xxhash.xxh3_64_intdigest(x) for x in texts]
        table, entry, best, size = Table(), [], [], []
        for k, (h, x) in enumerate(zip(hashes, texts)):
            e, new = table.put(h, x)
            entry.append(e)
            if new:
                best.append(k)
                size.append(0)
            elif ids[k] > ids[best[e]]:
                best[e] = k
            size[e] += 1
        speaks = [best[e] == k for k, e in enumerate(entry)]
        digest = [hashlib.sha256(x).hexdigest() for x in table.contents]
        signed = [h - (1 << 64) if h >> 63 else h for h in hashes]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_d"), pa.array(range(task + n, task + n + len(ids)), pa.int64()), pa.array([task + n + best[e] for e in entry], pa.int64()), pa.array([digest[e] for e in entry]), pa.array(signed, pa.int64()), pa.array([size[e] for e in entry], pa.int64()), pa.array([x if s else None for x, s in zip(texts, speaks)], pa.binary())],
            ["d", "row", "spoken", "sha", "h", "n", "content"],
        )
        n += len(ids)


def _global(limit: int):
    def run(batches):
        def records():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("h", "d", "row", "n", "content")))

        out = []
        for x in grace(((h & (1 << 64) - 1, d, r, n, c) for h, d, r, n, c in records()), limit):
            out.append(x)
            if len(out) == 1 << 16:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    return run


def _rows(out):
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["spoken", "keep_d", "keep_row", "size"])


def exact_groups(docs: DataFrame, limit: int = TABLE_BYTES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z.  The largest doc_id
    of a group stays; where rows repeat it, one of them does.  A null text
    counts as empty, a null doc_id is the smallest.  Other columns are not
    read; an empty table gives an empty result.
    """
    local = store(keyed(docs, text, doc_id).select("_d", "_t").mapInArrow(_local, "d long, row long, spoken long, sha string, h long, n long, content binary"), "exact")
    speakers = local.where("content is not null").select("h", "d", "row", "n", "content")
    groups = speakers.repartition("h").mapInArrow(_global(limit), "spoken long, keep_d long, keep_row long, size long")
    out = local.select("d", "row", "spoken", "sha").join(groups, "spoken")
    return out.select(real_id("d").alias("doc_id"), real_id("keep_d").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))
