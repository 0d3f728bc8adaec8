import random

import numpy as np
import pyarrow as pa

from voxloom.llm import blocks, lines
from voxloom.llm.common import keyed

from .test_lines import edit_distance


def batches(columns, names, size):
    """The columns (with types) as record batches of so many rows."""
    n = len(columns[0][0])
    return [pa.RecordBatch.from_arrays([pa.array(x[i : i + size], t) for x, t in columns], names) for i in range(0, n, size)]


def test_blocks_are_dealt_in_few_rows(spark, docs):
    """Blocks leave a task as a row a bucket at most, not as a row each: most of the query's CPU time went into dealing out and sorting these."""
    source = keyed(docs.coalesce(1))
    rows = blocks.dealt(source.select("_t"), lines._block_rows(1, 1)).collect()
    assert len(rows) <= blocks.buckets(spark)
    each = [len(r.keys) // 8 for r in rows]
    assert [len(r.nodes) // 8 for r in rows] == [len(r.sizes) // 4 for r in rows] == each and sum(each) > 1000
    assert len({r.bucket for r in rows}) == len(rows)


def test_keys_of_a_line_do_not_depend_on_its_batch():
    """Alone, first or last in its batch a line has the same blocks and fingerprint."""
    r = random.Random(9)
    texts = [b" ".join(bytes(r.choice(b"abcdefgh") for _ in range(r.randint(1, 8))) for _ in range(n)) for n in (1, 1, 2, 3, 5, 9, 20, 40, 90, 200) * 3] + [b"a"]
    at, keys = lines.line_keys(texts)
    prints = list(zip(*lines.line_fingerprints(texts)))
    for i, t in enumerate(texts):
        assert sorted(lines.line_keys([t])[1].tolist()) == sorted(keys[at == i].tolist())
        assert list(zip(*lines.line_fingerprints([t]))) == [prints[i]]


def test_packed_rows_meet_as_plain_ones(monkeypatch):
    """Whatever the batches: the rows of plain sorted ones but for those without a neighbour of like size."""
    monkeypatch.setattr(blocks, "PACK", 40)
    monkeypatch.setattr(blocks, "HELD", 30)
    r = random.Random(4)
    hashes, sizes = [r.randrange(-(1 << 63), 1 << 63) for _ in range(60)], [r.choice((50, 80, 90, 100, 200)) for _ in range(40)]
    rows = [(r.choice(hashes), sizes[n := r.randrange(40)], n) for _ in range(400)]
    names, types = ("key", "size", "node"), (pa.int64(), pa.int32(), pa.int64())
    plain = batches(list(zip(zip(*sorted(set(rows))), types)), names, 1000)
    found = [tuple(x.values()) for b in blocks._met(80)(plain) for x in b.to_pylist()]
    linked = {(k, n) for k, _, n, before in found if before is not None} | {(k, before) for k, _, n, before in found if before is not None}
    want = sorted((x for x in found if (x[0], x[2]) in linked), key=repr)
    assert 0 < len(want) < len(found)
    for size in (1, 7, 400):
        out = [x for b in blocks._packing(iter, 16)(batches(list(zip(zip(*rows), types)), names, size)) for x in b.to_pylist()]
        out.sort(key=lambda x: x["bucket"])
        columns = [([x[c] for x in out], t) for c, t in (("bucket", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("nodes", pa.binary()))]
        got = [tuple(x.values()) for b in blocks._met_packed(80)(batches(columns, ["bucket", "keys", "sizes", "nodes"], 5)) for x in b.to_pylist()]
        assert sorted(got, key=repr) == want


def test_first_of_equal_lines():
    """The least document and number of each digest goes on; rows of a document that repeats are no copies."""
    r = random.Random(7)
    for n in (0, 1, 2, 300):
        rows = [(r.randrange(-9, 60), r.randrange(2), r.randrange(-3, 4), r.randrange(2), r.randrange(3)) for _ in range(n)]
        columns = [np.array([x[i] for x in rows], dtype=t) for i, t in enumerate(lines._LINE.values())]
        head, other = lines._heads(columns)
        least = {}
        for x in rows:
            least[x[:2]] = min(x, least.get(x[:2], x))
        assert sorted(rows[i] for i in head) == sorted(least.values())
        assert sorted(rows[i] for i in other) == sorted(x for x in rows if x != least[x[:2]])


def test_long_texts_within_few_edits():
    """Comparisons that are given up early are those of too many edits."""
    r = random.Random(10)
    for _ in range(120):
        a = "".join(r.choice("abcdefg ß") for _ in range(r.randint(60, 200)))
        b = list(a)
        for _ in range(r.randint(0, 50)):
            i = r.randint(0, len(b))
            b[i : i + r.randint(0, 4)] = "".join(r.choice("abcdefg ß") for _ in range(r.randint(0, 4)))
        b = "".join(b)
        d = edit_distance(a, b)
        assert all(lines.within(a, b, k) == (d <= k) for k in {0, 10, 20, 40, max(0, d - 1), d, d + 1})
