"""Wide SimHash fingerprints whose blocks an edit can't all touch, and groups of what is alike by them.

A thing is a set of hashed features.  Its fingerprint is cut into blocks of 64
bits, and each block is the SimHash of a class of the features alone: the
feature's hash says which class.  An edit disturbs only the blocks of the
features that it touches, so things that differ in fewer features than there
are blocks must share a block (pigeonhole), and those that differ in more do
so with a chance that falls slowly.  Things that meet in equal blocks are verified by
the Hamming distance of a plain SimHash of all their features, and then exactly.

The number of classes doubles with the features, so that a block stands for
about as many features in a short thing as in a long one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, store
from .graph import components

#: Nodes of a key that one task compares with one another, about.
TILE = 512
#: Buckets into which keys are dealt, at least; rows of a task that are packed at a time, and rows that are sorted together.
BUCKETS, PACK, HELD = 4096, 1 << 17, 1 << 17
#: Pairs of rows of groups that are looked at together, about, if not a group's own.
PAIRS = 1 << 21
#: Words of a plain fingerprint, and bits in which those of alike things may differ.
WORDS, BITS = 2, 40
FP = tuple(f"f{i}" for i in range(WORDS))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: The lowest bit of each byte.
_LOW = np.uint64(0x0101010101010101)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that leaves no pattern of its argument."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def mix(h: np.ndarray) -> np.ndarray:
    """Features spread so that the highest bits say the class."""
    return h * _MIX[0]


@dataclass(frozen=True)
class Cut:
    """How fingerprints are cut: features of a class (about), blocks that a thing has at most, features that a block needs.

    ``alike``: least ratio of the numbers of features of two things that are to meet.
    ``long``: from so many features on a class has ``long_features``, as long things need not share short stretches to be alike.
    """

    features: float = 4
    blocks: int = 16
    least: int = 1
    alike: float = 0.8
    long: float = float("inf")
    long_features: float = 4

    def level(self, count: np.ndarray) -> np.ndarray:
        """How often the classes of things with so many features are doubled."""
        of = np.where(count < self.long, self.features, self.long_features)
        return np.maximum(np.floor(np.log2(np.maximum(count, 1) / of) + 1e-9), 1).astype(np.int64)


def levels(count: np.ndarray, cut: Cut) -> list[tuple[np.ndarray, np.ndarray]]:
    """Things (by number) and levels: once their own, and the next where a thing of that level may be alike."""
    own = cut.level(count)
    near = np.flatnonzero(cut.level(count / cut.alike) > own)
    return [(np.arange(len(count)), own), (near, own[near] + 1)]


def majority(h: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    """SimHashes of n slots, none of them empty: bit i is set where over half of the slot's hashes have it; h: hashes, slot: that of each, in order."""
    if not n:
        return np.empty(0, dtype=np.uint64)
    begin = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
    votes = np.diff(np.append(begin, len(slot)))
    # eight counters of a byte each: number i has bits i, i + 8, ...
    def sums(starts):
        return [np.add.reduceat((h >> np.uint64(i)) & _LOW, starts) for i in range(8)]

    if votes.max() < 128:
        # a counter's highest bit is set where over half are
        short = (127 - votes // 2).astype(np.uint64) * _LOW
        return sum(((x + short) >> np.uint64(7) & _LOW) << np.uint64(i) for i, x in enumerate(sums(begin)))
    # more than a counter holds: a slot is counted in parts
    parts = (votes + 254) // 255
    first = np.cumsum(parts) - parts
    ones = np.stack(sums(np.repeat(begin - 255 * first, parts) + 255 * np.arange(int(parts.sum()))), axis=1)
    ones = np.add.reduceat(ones.view(np.uint8).reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 64), first, axis=0, dtype=np.uint32)
    return np.packbits(2 * ones > votes[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def distinct(h: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each slot's distinct features, as 40-bit hashes, and their slots (under 2^24, in order): repeats of a frequent feature would outvote all others."""
    both = (slot.astype(np.uint64) << np.uint64(40)) | (h * _MIX[1] >> np.uint64(24))
    both.sort()
    if len(both):
        new = np.ones(len(both), dtype=bool)
        new[1:] = both[1:] != both[:-1]
        both = both[new]
    return both & np.uint64((1 << 40) - 1), (both >> np.uint64(40)).view(np.int64)


def fingerprints(h: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """The plain SimHash of all distinct features of each of n things, in WORDS words of 64 bits."""
    h, owner = distinct(h, owner)
    return [majority(mixed(h + np.uint64(i + 1 << 40)), owner, n).view(np.int64) for i in range(WORDS)]


def block_keys(h: np.ndarray, owner: np.ndarray, level: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """Owner and key (uint64) of every block.  h: features of 64 bits; owner: their thing, from 0 on; level: of each thing.

    A key holds the level, the class and the SimHash of its distinct features.
    """
    shift = (64 - level).astype(np.uint64)
    kind = (mix(h) >> shift[owner]).view(np.int64)
    at = np.flatnonzero(kind < cut.blocks)
    return class_keys(h[at], owner[at], kind[at], level, cut)


def class_keys(h: np.ndarray, owner: np.ndarray, kind: np.ndarray, level: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """The same of the features whose class (``kind``) is a block."""
    own, slot = distinct(h, owner * cut.blocks + kind)
    taken = np.flatnonzero(np.bincount(slot, minlength=len(level) * cut.blocks) >= cut.least)
    number = np.full(len(level) * cut.blocks, -1)
    number[taken] = np.arange(len(taken))
    slot = number[slot]
    bits = majority(mixed(own[slot >= 0]), slot[slot >= 0], len(taken))
    who = taken // cut.blocks
    place = (level[who] * 1024 + taken % cut.blocks).astype(np.uint64)
    return who, mixed(bits ^ mixed(place))


def _met(percent: int):
    """Over rows sorted by (key, size, node): those of keys with several nodes, each with the node before it if that is of like size."""

    def found(rows, begin, end):
        """Rows begin to before end; those outside are only looked at."""
        same = np.zeros(len(rows[0]) + 1, dtype=bool)  # same[i]: row i has the key of row i - 1
        same[1:-1] = rows[0][1:] == rows[0][:-1]
        pick = np.flatnonzero((same[:-1] | same[1:])[begin:end]) + begin
        at = np.maximum(pick - 1, 0)
        near = same[pick] & (rows[1][at].astype(np.int64) * 100 >= rows[1][pick].astype(np.int64) * percent)
        return pa.RecordBatch.from_arrays([pa.array(rows[0][pick]), pa.array(rows[1][pick]), pa.array(rows[2][pick]), pa.array(rows[2][at], mask=~near)], ["key", "size", "node", "before"])

    def run(batches):
        held, seen = [np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)], 0
        for batch in batches:
            rows = [np.concatenate([h, np.asarray(batch.column(c))]) for h, c in zip(held, ("key", "size", "node"))]
            new = np.ones(len(rows[0]), dtype=bool)
            new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[2][1:] != rows[2][:-1])
            rows = [x[new] for x in rows]
            if len(rows[0]) - 1 > seen:
                yield found(rows, seen, len(rows[0]) - 1)
            # the last row waits for its neighbour, the one before it is its context
            held, seen = [x[-2:] for x in rows], min(1, max(0, len(rows[0]) - 1))
        if len(held[0]) > seen:
            yield found(held, seen, len(held[0]))

    return run


def buckets(spark: SparkSession) -> int:
    """Ranges of hashes into which rows are dealt: sixteen or more for each shuffle partition, so that a task holds but a part of its rows."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return parts * max(16, -(-BUCKETS // parts))


def packed(key: np.ndarray, columns: list[np.ndarray], n: int) -> list[pa.Array]:
    """Rows as one for each bucket of their keys, which are hashes: its number, then its keys and the columns' values as bytes."""
    order = np.argsort(key)
    bucket = ((key[order] >> 32) + (1 << 31)) * n >> 32
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(key))

    def column(values):
        offsets = (np.append(0, ends) * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])

    return [pa.array(bucket[ends - 1].astype(np.int32)), *(column(x[order]) for x in (key, *columns))]


def unpacked(batches, kinds: dict):
    """The columns (kinds: name to dtype) of packed rows sorted by bucket; whole buckets are taken up together until they have HELD rows."""

    def of(held):
        return [np.frombuffer(b"".join(x), dtype=t) for x, t in zip(zip(*held), kinds.values())]

    held, n, last = [], 0, None
    for batch in batches:
        for bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", *kinds))):
            if bucket != last and n >= HELD:
                yield of(held)
                held, n = [], 0
            last = bucket
            held.append(row)
            n += len(row[0]) // 8
    if held:
        yield of(held)


def _packing(keys: Callable, n: int):
    """The rows of (key, size, node) that keys makes, packed when they are PACK or so."""

    def pack(held):
        key, size, node = (np.concatenate(x) for x in zip(*held))
        return pa.RecordBatch.from_arrays(packed(key, [size, node], n), ["bucket", "keys", "sizes", "nodes"])

    def run(batches):
        held, rows = [], 0
        for batch in keys(batches):
            if batch.num_rows:
                held.append([np.asarray(batch.column(c)) for c in ("key", "size", "node")])
                rows += batch.num_rows
            if rows >= PACK:
                yield pack(held)
                held, rows = [], 0
        if held:
            yield pack(held)

    return run


def dealt(source: DataFrame, keys: Callable) -> DataFrame:
    """Rows of (key, size, node) that keys makes of source's Arrow batches, packed by buckets: many times fewer rows to deal out and to sort."""
    return source.mapInArrow(_packing(keys, buckets(source.sparkSession)), "bucket int, keys binary, sizes binary, nodes binary")


def _met_packed(percent: int):
    """``_met`` over packed rows sorted by bucket, less the nodes of which no other of the key is of like size."""
    met = _met(percent)

    def run(batches):
        for key, size, node in unpacked(batches, {"keys": np.int64, "sizes": np.int32, "nodes": np.int64}):
            order = np.argsort(key)
            again = key[order[1:]] == key[order[:-1]]
            # most keys have one row
            at = order[np.append(again, False) | np.append(False, again)]
            at = at[np.lexsort((node[at], size[at], key[at]))]
            rows = [x[at] for x in (key, size, node)]
            new = np.append(True, (rows[0][1:] != rows[0][:-1]) | (rows[2][1:] != rows[2][:-1]))[: len(at)]
            key, size, node = (x[new] for x in rows)
            # a node may be alike to one of its key only if it is of like size to its neighbour
            near = (key[1:] == key[:-1]) & (size[:-1].astype(np.int64) * 100 >= size[1:].astype(np.int64) * percent)
            at = np.flatnonzero(np.append(near, False) | np.append(False, near)) if len(key) else []
            yield from met([pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (key, size, node)], ["key", "size", "node"])])

    return run


def verify_by(alike: Callable):
    """Of pairs ``a``, ``b``, ``ca``, ``cb`` those whose contents are alike, a batch at a time in Python."""

    def run(batches):
        for batch in batches:
            keep = list(map(alike, batch.column("ca").to_pylist(), batch.column("cb").to_pylist()))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return lambda pairs: pairs.select("a", "b", "ca", "cb").mapInArrow(run, "a long, b long")


def _apart(alike: Callable, bits: int, percent: int):
    """Over rows sorted by (key, i, j, size, node): verified links, as pairs of labels, that connect what a group holds of different ones.

    Every pair of different labels whose sizes and fingerprints are near is compared until
    it is connected.  In a group of two tiles (i < j) only pairs across them are.  Where a key is one
    tile, neighbours of different labels have been compared before, in vain.
    """
    names = ("key", "i", "j", "label", "tile", "tiles", "size", "content", *FP)

    def near(ends, label, tile, tiles, size, across, f):
        """Pairs of rows of a group, in order."""
        found, live, d = [np.empty((2, 0), dtype=np.int64)], np.arange(len(label)), 0
        while len(live := live[live + (d := d + 1) < ends[live]]):
            x = live[(d > 1) | (tiles[live] > 1)]
            x = x[(label[x] != label[x + d]) & (~across[x] | (tile[x] != tile[x + d]))]
            y = x + d
            x = x[(np.minimum(size[x], size[y]) * 100 >= np.maximum(size[x], size[y]) * percent) & (np.bitwise_count(f[x] ^ f[y]).sum(axis=1) <= bits)]
            found.append(np.stack([x, x + d]))
        pairs = np.concatenate(found, axis=1)
        return pairs[:, np.lexsort((pairs[1], pairs[0]))]

    def run(batches):
        held, parent = None, {}

        def root(x):
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        def links(table, cuts):
            label, tile, tiles, size, i, j = (table.column(c).to_numpy() for c in ("label", "tile", "tiles", "size", "i", "j"))
            f = np.stack([table.column(c).to_numpy() for c in FP], axis=1).view(np.uint64)
            contents, out = table.column("content").combine_chunks(), []
            contents = contents.chunk(0) if isinstance(contents, pa.ChunkedArray) and contents.num_chunks else contents
            each = np.diff(cuts)
            ends, size = np.repeat(cuts[1:], each), size.astype(np.int64)
            # groups of so many pairs are gone through at a time
            most = np.cumsum(each * each) // PAIRS
            for a, b in zip(first := [0, *(np.flatnonzero(most[1:] != most[:-1]) + 1).tolist()], [*first[1:], len(each)]):
                own = slice(cuts[a], cuts[b])
                for x, y in (near(ends[own] - cuts[a], label[own], tile[own], tiles[own], size[own], i[own] != j[own], f[own]) + cuts[a]).T.tolist():
                    p, q = label[x].item(), label[y].item()
                    # a content leaves the batch only if its fingerprint is near another
                    if root(p) != root(q) and alike(contents[x].as_py(), contents[y].as_py()):
                        parent[root(p)] = root(q)
                        out.append((p, q))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch.select(names)])
            held = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            ids = np.stack([held.column(c).to_numpy() for c in names[:3]])
            cuts = np.append(0, np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1)
            if len(cuts) > 1:
                yield from links(held.slice(0, cuts[-1]), cuts)
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from links(held, np.array([0, held.num_rows]))

    return run


def groups(rows: DataFrame, contents: Callable, alike: Callable, percent: int, label: str, verify: Callable | None = None, bits: int = BITS, tile: int = TILE) -> DataFrame:
    """``node``, ``component`` (smallest node reachable over verified links) of each node that has a link.

    rows: ``key`` (a hash), ``size`` (int), ``node``, which may repeat, or what ``dealt`` makes of such rows; two nodes are compared where they share a
    key and the smaller size is at least percent of the larger.  contents:
    nodes (``node``) -> ``node``, ``content`` and FP (plain SimHash); a node may come more than once.  A link is one whose fingerprints
    differ in at most ``bits`` bits and whose contents are ``alike``; verify is the
    same over a table of pairs ``a``, ``b``, ``ca``, ``cb``.

    First each node is compared with the one before it in each key, which
    connects most of what is alike and makes no node meet more than two others a
    key.  Keys of three or more nodes that still hold different components are then gone
    through for exact links between these; one with more than ``tile`` nodes is dealt out in
    pairs of tiles to as many tasks, so none holds more than two tiles.  Links
    inside a key are never listed beyond those that connect.
    """
    rows = rows if "bucket" in rows.columns else dealt(rows.select("key", "size", "node"), iter)
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "keys", "sizes", "nodes")
    met = store(ordered.mapInArrow(_met_packed(percent), "key long, size int, node long, before long"), f"{label}-met")
    pairs = met.where("before is not null").select(F.least("before", "node").alias("a"), F.greatest("before", "node").alias("b")).distinct()
    held = store(contents(met.select("node").distinct()).select("node", "content", *FP), f"{label}-content")
    fps = [held.select(F.col("node").alias(x), *(F.col(f).alias(f + x) for f in FP)) for x in "ab"]
    apart_by = sum((F.bit_count(F.col(f + "a").bitwiseXOR(F.col(f + "b"))) for f in FP), F.lit(0))
    near = store(pairs.join(fps[0], "a").join(fps[1], "b").where(apart_by <= bits).select("a", "b"), f"{label}-near")
    ca, cb = (held.select(F.col("node").alias(x), F.col("content").alias(f"c{x}")) for x in "ab")
    first = store((verify or verify_by(alike))(near.join(ca, "a").join(cb, "b")).select("a", "b"), f"{label}-edges1")
    drop(near)
    joined = store(components(first, f"{label}1"), f"{label}-cc1")
    marked = met.join(joined, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("label"))
    marked = store(marked, f"{label}-marked")
    apart = marked.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.count("*").alias("n")).where("n > 2 and l0 <> l1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rest = marked.join(apart.select("key", tiles.alias("tiles")), "key").withColumn("tile", F.pmod(F.xxhash64("node", F.lit(5)), F.col("tiles")).cast("int"))
    rest = rest.select("key", "node", "size", "label", "tile", "tiles", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    rest = rest.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "node", "size", "label", "tile", "tiles").join(held, "node")
    # the work is in the comparing, not in the bytes: no merging of small partitions
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = rest.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "size", "node").select("key", "i", "j", "label", "tile", "tiles", "size", "content", *FP)
    second = store(rest.mapInArrow(_apart(alike, bits, percent), "a long, b long"), f"{label}-edges2")
    # components of components: those that the second round joined
    over = components(second, f"{label}2").select(F.col("node").alias("of"), F.col("component").alias("top"))
    known = joined.join(over, joined["component"] == over["of"], "left").select("node", F.coalesce("top", "component").alias("component"))
    alone = over.join(joined.select(F.col("node").alias("of")), "of", "left_anti").select(F.col("of").alias("node"), F.col("top").alias("component"))
    out = store(known.unionAll(alone), f"{label}-cc2")
    for x in (met, held, first, joined, marked, second):
        drop(x)
    return out
