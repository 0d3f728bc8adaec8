import hashlib
import random
from collections import Counter

import pytest

from voxloom.llm import queries, substring

from .conftest import order


def brute(rows, length=35):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[s : s + length]) for _, w in words for s in range(len(w) - length + 1))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - length + 1):
            if count[tuple(w[s : s + length])] > 1:
                gone.update(range(s, s + length))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_matches_brute_force(docs, rows, empty, spark, sf, sf_rows):
    assert order(substring.remove_repeats(docs).collect()) == order(brute([r[:2] for r in rows]))
    assert order(queries.op4_substring(spark, sf).collect()) == order(brute(sf_rows))
    out = substring.remove_repeats(empty)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and out.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_short_windows_over_few_words(spark, seed):
    """Overlaps, runs of one word and repeats within a text, with windows of nine words and a cover modulo seven."""
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice("ab") if r.random() < 0.8 else r.choice("cdefgh") for _ in range(r.randint(0, 90)))) for i in range(60)]
    rows += [(100, "x " * 40), (101, "x " * 9), (102, rows[3][1]), (103, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring.remove_repeats(df, length=9, period=7, cover=(1, 2, 4), with_text=True)
    assert order(got.drop("kept_text").collect()) == order(brute(rows, 9))
    assert all(hashlib.sha256(x.kept_text.encode()).hexdigest() == x.kept_sha256 for x in got.collect())


def test_cover():
    assert substring.is_cover(substring.COVER, substring.PERIOD)
    assert not substring.is_cover((0, 1), 7)
    for i in range(substring.PERIOD):
        for j in range(substring.PERIOD):
            assert any((i + d) % substring.PERIOD in substring.COVER and (j + d) % substring.PERIOD in substring.COVER for d in range(substring.PERIOD))


def test_batches_are_joined_across_borders():
    """The last row of a batch waits for the first of the next."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(1)
    keys = sorted(r.randint(0, 60) for _ in range(120))
    n = len(keys)
    table = pa.table({"h1": keys, "h2": [0] * n, "d": list(range(n)), "k": [0] * n, "pos": pa.array([5] * n, pa.int32()), "kind": pa.array([substring.LONE] * n, pa.int32())})
    count = Counter(keys)
    want = [i for i, k in enumerate(keys) if count[k] > 1]
    for size in (1, 2, 3, 7, 200):
        got = [d for b in substring._repeats(table.to_batches(max_chunksize=size)) for d in np.asarray(b.column("d")).tolist()]
        assert got == want
