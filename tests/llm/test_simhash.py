import random

import numpy as np
import xxhash

from voxloom.llm import graph, simhash
from voxloom.llm.graph import components

from .conftest import order


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    h = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(nodes, linked):
    """Smallest reachable node by repeated relaxation."""
    low = dict.fromkeys(nodes)
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and low[a] != low[b]:
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
    return low


def brute(rows):
    fps = [(-(1 << 63) if i is None else i, brute_fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in fps})
    group = classes(distinct, lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for i, f in fps:
        low[group[f]] = min(i, low.get(group[f], i))
    real = lambda i: None if i == -(1 << 63) else i
    return [(real(i), f"{f:016x}", real(low[group[f]])) for i, f in fps]


def test_matches_brute_force_on_awkward_rows(docs, rows):
    assert order(simhash.near_duplicates(docs).collect()) == order(brute([r[:2] for r in rows]))


def test_matches_brute_force_on_documents(spark, sf, sf_rows):
    from voxloom.llm.queries import op1_simhash

    assert order(op1_simhash(spark, sf).collect()) == order(brute(sf_rows))


def test_small_buckets_find_every_link(spark):
    """A crowded neighbourhood goes through the finer keys and still yields the components of all close pairs."""
    r = random.Random(3)
    center = [r.getrandbits(64) for _ in range(4)]
    fps = sorted({c ^ sum(1 << b for b in r.sample(range(20), r.randint(0, 5))) for c in center for _ in range(120)} | {r.getrandbits(64) for _ in range(50)})
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for distance, blocks in ((2, 4), (3, 5)):
        links = simhash.close_links(df, distance, blocks, bucket_limit=4).collect()
        full = {(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in links}
        assert all((a ^ b).bit_count() <= distance for a, b in full)
        both = full | {(b, a) for a, b in full}
        assert classes(fps, lambda a, b: (a, b) in both) == classes(fps, lambda a, b: (a ^ b).bit_count() <= distance)
        tiled = simhash.close_links(df, distance, blocks, bucket_limit=4, dense_tile=30).collect()
        both = {x for a, b in tiled for x in ((int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))), (int(np.int64(b).view(np.uint64)), int(np.int64(a).view(np.uint64))))}
        assert classes(fps, lambda a, b: (a, b) in both) == classes(fps, lambda a, b: (a ^ b).bit_count() <= distance)


def test_a_dense_cloud_of_fingerprints(spark):
    """20,000 fingerprints within a few bits of one: one component, by links in proportion to them."""
    r = random.Random(5)
    center = r.getrandbits(63)
    fps = {center}
    while len(fps) < 20_000:
        fps.add(center ^ sum(1 << b for b in r.sample(range(40), r.randint(1, 4))))
    links = simhash.close_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, 4).distinct().collect()
    assert len(links) <= 60 * len(fps)
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    assert len({root(f) for f in fps}) == 1


def test_slices_of_a_long_text(monkeypatch):
    text = b" ".join(str(i % 977).encode() for i in range(5000))
    whole = simhash.document_fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 97)
    assert simhash.document_fingerprint(text) == whole == brute_fingerprint(text.decode())


def test_empty_table_and_columns(empty):
    out = simhash.near_duplicates(empty)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_keep_one(docs, rows, empty):
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    # a component is known by its fingerprints, not by its smallest doc_id, which unrelated ones may share
    own = [(i, brute_fingerprint(t), t) for i, t, *_ in rows]
    group = classes(sorted({f for _, f, _ in own}), lambda a, b: (a ^ b).bit_count() <= 2)
    value, want = lambda i: -(1 << 63) if i is None else i, {}
    for i, f, t in own:
        want.setdefault(group[f], []).append((i, t))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(want)
    for members in want.values():
        first = min(value(i) for i, _ in members)
        assert any(x in got for x in members if value(x[0]) == first)
    assert simhash.keep_one(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(0, 300).selectExpr("id as a", "id + 1 as b")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == dict.fromkeys(range(301), 0)


def test_a_small_graph_takes_no_rounds(spark, monkeypatch):
    """Where the links are few no round is gone through; both ways give the same components."""
    r = random.Random(3)
    links = [(r.randrange(-400, 400), r.randrange(-400, 400)) for _ in range(450)] + [(7, 7), (1000, 1000), (-(1 << 63), 2000), (3000, 2000)]
    links += [(5000, 5001 + i) for i in range(300)] + [(6000 + i, 6001 + i) for i in range(50, 0, -1)]
    edges = spark.createDataFrame(r.sample(links, len(links)) + links[:20], "a long, b long").repartition(7)
    rounds, large_star = [], graph._large_star
    monkeypatch.setattr(graph, "_large_star", lambda e: rounds.append(1) or large_star(e))
    few = sorted(map(tuple, components(edges).collect()))
    assert not rounds
    monkeypatch.setattr(graph, "SETTLED", len(links) // 2)
    assert sorted(map(tuple, components(edges).collect())) == few and rounds
    least = {x: x for e in links if e[0] != e[1] for x in e}
    for _ in least:
        for x, y in links:
            if x != y:
                least[x] = least[y] = min(least[x], least[y])
    assert few == sorted(least.items())
    assert components(edges.limit(0)).count() == 0


def test_rounds_of_a_long_chain(spark, monkeypatch):
    monkeypatch.setattr(graph, "SETTLED", 10)
    test_components_of_a_long_chain(spark)
