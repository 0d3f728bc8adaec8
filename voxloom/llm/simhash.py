"""SimHash near-duplicate documents by pigeonhole blocks.

A fingerprint has 64 bits.  Cut into ``n_blocks`` blocks, two fingerprints
that differ in at most ``distance`` bits agree in ``n_blocks - distance`` whole
blocks, so every such pair meets under the key of some combination of that many
blocks.  Keys with one fingerprint are dropped by a partial aggregate, pairs
are verified by Hamming distance, in pairs of tiles where a key has many
fingerprints.  One with more than ``bucket_limit`` is cut finer, exactly: what is left of its bits is dealt into
``distance + 1`` parts, one of which any close pair leaves untouched.

64 bits tell apart only copies that are almost equal.  The general rule, sets of
word shingles with a Jaccard similarity of 80 % or more, has a wider fingerprint
whose blocks are SimHashes of classes of shingles (:mod:`~voxloom.llm.blocks`);
documents that share a block are verified by Hamming distance and by the exact
similarity of the sets.
"""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks
from .blocks import Cut, block_keys, groups, levels
from .common import NULL_ID, drop, free_name, keyed, real_id, store, word_spans
from .graph import components

SEED = 42
#: Fingerprints of a key from which on it is cut finer, and how often; fingerprints of a tile, of which a task holds two.
BUCKET_LIMIT, REFINEMENTS, DENSE_TILE = 1 << 14, 2, 2048
#: Fingerprints up to which all distances are told at once.
MATRIX = 256
#: Hashes that are counted at a time.
SLICE = 1 << 18
#: The general rule: words of a shingle, least Jaccard similarity in percent, how fingerprints are cut, documents that a task compares, hashes that are cut into blocks at a time.
SHINGLE, SIMILARITY = 5, 80
CUT = Cut(features=4, blocks=16, least=1, alike=SIMILARITY / 100)
TILE, BATCH_HASHES = 128, 1 << 16


def fingerprint(hashes, slice_size: int = SLICE) -> int:
    """Bit i is set where more than half of the hashes (uint64 arrays, one after another) have it."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for h in hashes:
        ones += np.unpackbits(np.ascontiguousarray(h).view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]) if n else 0


def document_fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the XXH64 (seed 42) of word shingles of the text, A-Z lower-cased, repeats included.

    Words are separated by ASCII white space.  Fewer words than a shingle: the
    whole sequence is hashed.  No word: zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, start, end = word_spans(words)
    last = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest

    def slices():
        for i in range(0, last, SLICE):
            j = min(i + SLICE, last)
            yield np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start[i:j].tolist(), end[i + shingle - 1 : j + shingle - 1].tolist())), dtype=np.uint64, count=j - i)

    return fingerprint(slices())


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            fp = np.fromiter((document_fingerprint(x, shingle) for x in batch.column("_t").to_pylist()), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("_d"), batch.column("_k"), pa.array(fp.view(np.int64))], ["d", "k", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``d``, ``k`` (the document's key, see :func:`~voxloom.llm.common.keyed`) and ``fp`` for each row."""
    return keyed(docs, text, doc_id).mapInArrow(_fingerprints(shingle), "d long, k long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(distance: int, n_blocks: int, bits: int = 64) -> list[int]:
    """One mask for each combination of blocks that a close pair may agree in."""
    cut = [bits * i // n_blocks for i in range(n_blocks + 1)]
    block = [((1 << cut[i + 1]) - (1 << cut[i])) for i in range(n_blocks)]
    return [sum(c) for c in combinations(block, n_blocks - distance)]


def refinements(distance: int, level: int, bits: int = 64) -> list[int]:
    """Masks of ``distance + 1`` parts that cover all bits, dealt anew at each level."""
    order = list(range(bits))
    random.Random(level).shuffle(order)
    return [sum(1 << b for b in order[i :: distance + 1]) for i in range(distance + 1)]


def _links(distance: int):
    """Over rows sorted by (mask, key, i, j): as many verified links inside each group as connect what is close in it."""
    place = ("mask", "key", "i", "j")

    def of(fp: np.ndarray):
        n = len(fp)
        close = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance if n <= MATRIX else None
        parent = np.full(n, -1)
        for root in range(n):  # a walk from each fingerprint that nothing has reached
            if parent[root] >= 0:
                continue
            parent[root], todo = root, [root]
            while todo:
                u = todo.pop()
                near = close[u] if close is not None else np.bitwise_count(fp ^ fp[u]) <= distance
                found = np.flatnonzero(near & (parent < 0))
                parent[found] = u
                todo += found.tolist()
        i = np.flatnonzero(parent != np.arange(n))
        return fp[i], fp[parent[i]]

    def run(batches):
        held = None
        for batch in batches:
            part = [np.asarray(batch.column(c)) for c in (*place, "fp")]
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
            edge = np.flatnonzero(np.any([np.diff(x) != 0 for x in part[:4]], axis=0)) + 1
            if not len(edge):
                held = part
                continue
            held = [x[edge[-1] :] for x in part]
            yield from emit(part[4], [0, *edge.tolist()])
        if held is not None and len(held[0]):
            yield from emit(held[4], [0, len(held[4])])

    def emit(fp, cuts):
        found = [of(fp[i:j].view(np.uint64)) for i, j in zip(cuts, cuts[1:]) if j - i > 1]
        found = [x for x in found if len(x[0])]
        if found:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def close_links(fps: DataFrame, distance: int, n_blocks: int, bucket_limit: int = BUCKET_LIMIT, label: str = "fp", dense_tile: int = DENSE_TILE) -> DataFrame:
    """Links ``a``, ``b`` between fingerprints (distinct ``fp``) that differ in at most ``distance`` bits, by pigeonhole blocks.

    Within each key only as many links as connect its fingerprints, which keeps
    their number in proportion to the fingerprints.  A crowded key is cut finer
    REFINEMENTS times; what is crowded still, as a dense cloud of close
    fingerprints is, goes in pairs of tiles to as many tasks.
    """
    far = lambda a, b: F.bit_count(a.bitwiseXOR(b)) > distance
    masks = [F.lit(_signed(m)).cast("long") for m in block_masks(distance, n_blocks)]
    rows = fps.select("fp", F.explode(F.array(*masks)).alias("mask"))
    found = []
    for level in range(REFINEMENTS + 1):
        keys = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        size = store(keys.groupBy("mask", "key").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1"), f"{label}-keys{level}")
        found.append(size.where("n = 2").where(~far(F.col("lo"), F.col("hi"))).select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        sizes = {r.big: r.c for r in size.where("n > 2").groupBy((F.col("n") > bucket_limit).alias("big")).agg(F.count("*").alias("c")).collect()}
        if not sizes:
            break
        more = store(keys.join(size.where("n > 2").select("mask", "key", "n"), ["mask", "key"]), f"{label}-big{level}")
        last = level == REFINEMENTS
        few = more if last else more.where(F.col("n") <= bucket_limit)
        tiles = F.ceil(F.col("n") / dense_tile).cast("int")
        tile = F.pmod(F.xxhash64("fp", F.lit(level)), tiles).cast("int")
        few = few.select("mask", "key", "fp", tile.alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
        few = few.select("mask", "key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "fp")
        few = few.repartition("mask", "key", "i", "j").sortWithinPartitions("mask", "key", "i", "j", "fp")
        found.append(few.mapInArrow(_links(distance), "a long, b long"))
        if True not in sizes or last:
            break
        parts = [F.col("mask").bitwiseOR(F.lit(_signed(m)).cast("long")) for m in refinements(distance, level)]
        rows = more.where(F.col("n") > bucket_limit).select("fp", F.explode(F.array(*parts)).alias("mask")).distinct()
    out = found[0]
    for x in found[1:]:
        out = out.unionAll(x)
    return out


def classes(docs: DataFrame, distance: int, n_blocks: int, shingle: int, bucket_limit: int, text: str, doc_id: str) -> DataFrame:
    """``d``, ``k``, ``fp``, ``component`` (smallest ``fp`` reachable) and ``low`` (smallest ``d`` reachable) for each row."""
    rows = store(fingerprints(docs, shingle, text, doc_id), "simhash")
    first = store(rows.groupBy("fp").agg(F.min("d").alias("first")), "simhash-fp")
    links = close_links(first.select("fp"), distance, n_blocks, bucket_limit, "simhash")
    node = store(components(links, "simhash"), "simhash-cc")
    low = node.join(first, node.node == first.fp).groupBy("component").agg(F.min("first").alias("low"))
    joined = node.join(low, "component").select(F.col("node").alias("fp"), "component", "low")
    label = first.join(joined, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), F.coalesce("low", "first").alias("low"))
    return rows.join(label, "fp")


def near_duplicates(docs: DataFrame, distance: int = 2, n_blocks: int = 4, shingle: int = 3, bucket_limit: int = BUCKET_LIMIT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents are linked where their fingerprints differ in at most
    ``distance`` bits; ``component_id`` is the smallest doc_id reachable.
    Equal fingerprints collapse before the search, so a group of copies of any
    size is one row in it.  A null text counts as empty, and all texts without
    a word (fingerprint zero) are linked.  A null doc_id sorts below all others
    and is given back as null.  Rows that repeat a doc_id each get a row.  An
    empty table gives an empty result.  Columns other than the two named are
    not read.

    At a scale where 32-bit keys crowd, raise ``n_blocks`` (5 gives ten keys of
    38 bits for 2 bits' distance); the result is the same.
    """
    found = classes(docs, distance, n_blocks, shingle, bucket_limit, text, doc_id)
    return found.select(real_id("d").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), real_id("low").alias("component_id"))


def shingle_set(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than a shingle are one."""
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    joined, start, end = word_spans(words)
    digest = xxhash.xxh64_intdigest
    spans = zip(start[: len(start) - shingle + 1].tolist(), end[shingle - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(words) - shingle + 1))


def set_keys(sets: list[np.ndarray], cut: Cut = CUT) -> tuple[np.ndarray, np.ndarray]:
    """Set (by number) and key of every block of the sets, none of them empty."""
    size = np.array([len(x) for x in sets])
    flat, begin, found = np.concatenate(sets), np.cumsum(size) - size, []
    for which, level in levels(size, cut):
        n = size[which]
        place = np.repeat(begin[which] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        at, key = block_keys(flat[place], np.repeat(np.arange(len(which)), n), level, cut)
        found.append((which[at], key))
    return tuple(np.concatenate(x) for x in zip(*found))


def _document(text: bytes) -> tuple[int, list[bytes]]:
    words = text.lower().split()
    return xxhash.xxh64_intdigest(b" ".join(words), SEED), words


def _nodes(batches):
    for batch in batches:
        node = np.fromiter((_document(t)[0] for t in batch.column("_t").to_pylist()), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("_d"), batch.column("_k"), pa.array(node.view(np.int64))], ["d", "k", "node"])


def _block_rows(shingle: int):
    def rows(nodes, sets):
        at, key = set_keys(sets)
        size = np.array([len(x) for x in sets], dtype=np.int32)
        node = np.array(nodes, dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(size[at]), pa.array(node[at])], ["key", "size", "node"])

    def run(batches):
        for batch in batches:
            seen, nodes, sets, held = set(), [], [], 0
            for t in batch.column("_t").to_pylist():
                node, words = _document(t)
                if node in seen:
                    continue
                seen.add(node), nodes.append(node), sets.append(shingle_set(words, shingle))
                held += len(sets[-1])
                if held > BATCH_HASHES:
                    yield rows(nodes, sets)
                    nodes, sets, held = [], [], 0
            if nodes:
                yield rows(nodes, sets)

    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            for node, t in zip(batch.column("node").to_pylist(), batch.column("_t").to_pylist()):
                own = shingle_set(t.lower().split(), shingle)
                fp = blocks.fingerprints(own, np.zeros(len(own), dtype=np.int64), 1)
                yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([own.tobytes()], pa.binary()), *map(pa.array, fp)], ["node", "content", *blocks.FP])

    return run


def alike(percent: int):
    def run(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    return run


def near_copies(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``d``, ``k`` and ``component`` for each row by the general rule: near copies share a component, which is a node and no doc_id."""
    source = keyed(docs, text, doc_id)
    rows = store(source.mapInArrow(_nodes, "d long, k long, node long"), "similar")

    def contents(wanted):
        at = rows.groupBy("node").agg(F.min(F.struct("d", "k")).alias("at")).join(wanted, "node").select("node", F.col("at.d").alias("d"), F.col("at.k").alias("k"))
        found = source.join(at, (source["_d"] == at["d"]) & (source["_k"] == at["k"])).select("node", "_t")
        return found.mapInArrow(_sets(shingle), "node long, content binary" + "".join(f", {f} long" for f in blocks.FP)).dropDuplicates(["node"])

    keys = blocks.dealt(source, _block_rows(shingle))
    group = groups(keys, contents, alike(similarity), similarity, "similar", tile=TILE)
    return rows.join(group, "node", "left").select("d", "k", F.coalesce("component", "node").alias("component"))


def rows_kept(docs: DataFrame, found: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of docs for each ``component`` of found (``d``, ``k``, ``component``): that of the least ``d``, then ``k``, then of the other columns' hash."""
    keep = found.groupBy("component").agg(F.min(F.struct("d", "k")).alias("at"))
    d, k, n, x, y = (free_name(docs, c) for c in ("_d", "_k", "_n", "_keep_d", "_keep_k"))
    keep = keep.select(F.col("at.d").alias(x), F.col("at.k").alias(y))
    own = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))
    own = docs.withColumns({d: own, k: F.xxhash64(own, F.coalesce(F.col(text).cast("string"), F.lit("")))})
    kept = own.join(keep, (own[d] == keep[x]) & (own[k] == keep[y]), "left_semi")
    one = kept.withColumn(n, F.row_number().over(Window.partitionBy(d, k).orderBy(F.xxhash64(*(F.col(c) for c in docs.columns)))))
    return one.where(F.col(n) == 1).select(*docs.columns)


def keep_one(docs: DataFrame, distance: int = 2, n_blocks: int = 4, shingle: int = 3, bucket_limit: int = BUCKET_LIMIT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without near copies by 64-bit fingerprints, all columns kept: the row of each component's smallest doc_id stays.

    Where rows of one component repeat that doc_id, one of them stays.
    """
    return rows_kept(docs, classes(docs, distance, n_blocks, shingle, bucket_limit, text, doc_id), text, doc_id)


def keep_one_similar(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without near copies by the general rule, all columns kept: of each connected group the row of the smallest doc_id stays.

    Two documents are linked where the sets of their ``shingle``-word shingles
    (words lower-cased A-Z, separated by ASCII white space) have a Jaccard
    similarity of ``similarity`` percent or more; all texts without a word are linked.
    Verified links are right but for collisions of 64-bit hashes; a pair may be
    missed where it shares no block.  A null text counts as empty.  A null doc_id sorts below all
    others; where rows of a group repeat the smallest doc_id, one of them stays.
    An empty table gives an empty result.
    """
    return rows_kept(docs, near_copies(docs, shingle, similarity, text, doc_id), text, doc_id)
