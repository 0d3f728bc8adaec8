import re
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm import mixing, queries

from .conftest import order

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_seats(weights, seats, caps):
    given_ = [0] * len(weights)
    for _ in range(seats):
        best = max((i for i in range(len(weights)) if given_[i] < caps[i] and weights[i] > 0), key=lambda i: (Fraction(weights[i], 2 * given_[i] + 1), -i), default=None)
        if best is None:
            break
        given_[best] += 1
    return given_


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8), st.integers(0, 60), st.data())
@settings(max_examples=200, deadline=None)
def test_seats_go_by_highest_quotients(weights, seats, data):
    caps = [data.draw(st.integers(0, 30)) for _ in weights]
    assert mixing.sainte_lague(weights, seats, caps) == plain_seats(weights, seats, caps)


@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=12))
@settings(max_examples=100, deadline=None)
def test_targets(sizes):
    goal = mixing.targets(sizes)
    assert all(g <= 2 * s + 1e-6 for g, s in zip(goal, sizes))
    assert abs(sum(goal) - 1.5 * sum(sizes)) < 1e-3 * (1 + sum(sizes)) ** 0.5
    free = {round(g / mixing.WEIGHTS[i % 3], 3) for i, (g, s) in enumerate(zip(goal, sizes)) if g < 2 * s - 1e-6}
    assert len(free) <= 1


def check(out, rows):
    key = lambda s: (s is None, (s or "").encode("utf-32-be"))
    sizes = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    sources = sorted({s for *_, s in sizes}, key=key)
    total = {s: sum(n for _, n, x in sizes if x == s) for s in sources}
    goal = dict(zip(sources, mixing.targets([total[s] for s in sources])))
    assert order((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in out) == order((i, n, total[s], round(goal[s], 6)) for i, n, s in sizes)
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    by_goal = {}
    for r in out:
        by_goal.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    for (size, target), taken in by_goal.items():
        same = sum(1 for s in sources if (total[s], round(goal[s], 6)) == (size, target))
        assert abs(sum(taken) - same * target) <= same


def test_mix(docs, rows, empty, spark, sf):
    given_ = [(r[0], r[1], r[3]) for r in rows]
    out = mixing.mix(docs, block=16, shard_words=700)
    check(out.collect(), given_)
    assert order(out.drop("ranges").collect()) == order(mixing.mix(docs.repartition(7), block=16, shard_words=700).drop("ranges").collect())
    for r in out.collect():
        assert r.taken == r.size * r.passes + sum(x["to"] - x["from"] for x in r.ranges)
    d = spark.read.parquet(f"{sf}/documents.parquet")
    check(queries.op9_mixing(spark, sf).collect(), [(r.doc_id, r.text, r.source) for r in d.collect()])
    assert mixing.mix(empty).count() == 0


def test_mixed_texts(docs, rows, empty):
    out = mixing.mixed_texts(docs, block=16, shard_words=700)
    assert out.schema == docs.schema
    got = out.collect()
    taken = mixing.mix(docs, block=16, shard_words=700).collect()
    assert sum(len(WORD.findall(r.text or "")) for r in got) == sum(r.taken for r in taken)
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    assert sum(1 for r in got if not WORD.findall(r.text or "")) == sum(1 for r in taken if r.size == 0)
    assert mixing.mixed_texts(empty).count() == 0


@given(st.lists(st.integers(0, 300), min_size=1, max_size=12), st.integers(1, 64), st.data())
@settings(max_examples=200, deadline=None)
def test_shards_take_the_quota_to_a_word(words, block, data):
    total = sum(words)
    quota = data.draw(st.integers(0, 2 * total))
    got = mixing.shard_plan(list(enumerate(words)), quota, block)
    short = total % block
    assert sum(x[5] * block + x[6] + x[7] for x in got) + sum(words) * got[0][4] == quota
    assert all(x[5] + bool(x[6]) <= x[3] - x[2] and 0 <= x[6] < block for x in got)
    assert sum(x[3] - x[2] for x in got) == total // block and all(x[7] <= short and (not x[7] or x[3] == total // block) for x in got)


def taken_of(spark, sizes, **options):
    """Rows of documents of these sizes, a source each, and what the mix takes of each."""
    texts = [(i, "w " * n, f"s{i:06d}") for i, n in enumerate(sizes)]
    return sorted(mixing.mix(spark.createDataFrame(texts, "doc_id long, text string, source string"), **options).collect(), key=lambda r: r.doc_id)


def test_sources_of_any_size_meet_their_targets(spark):
    """From a source of a word to one of a hundred thousand: taken is the target to a word."""
    for sizes in ([10, 10, 10], [40, 5000, 5000], [100, 100_000, 100_000], [1, 0, 100_000, 3, 700]):
        got = taken_of(spark, sizes)
        assert all(abs(r.taken - r.target) <= 1 and r.taken <= 2 * r.size for r in got)
        assert [round(r.target, 6) for r in got] == [round(x, 6) for x in mixing.targets(sizes)]


def test_more_sources_than_the_driver_lists(spark):
    """Planned by DataFrame operations, the same targets and the words to one."""
    sizes = [(i * i) % 97 for i in range(60)]
    a, b = taken_of(spark, sizes), taken_of(spark, sizes, max_sources=20)
    assert [(r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in a] == [(r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in b]
    assert all(abs(r.taken - r.target) <= 1 and r.taken <= 2 * r.size for r in b)


def test_blocks_by_brute_force(spark):
    """The taken words are those of the blocks with the smallest seeded hashes in each shard."""
    docs = [(i, " ".join(f"d{i}w{j}" for j in range(7 + 5 * i % 23)), "ab"[i % 2]) for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(frame, block=8, shard_words=120).collect()}
    hashed = lambda *x: spark.sql(f"SELECT xxhash64({', '.join(map(str, x))}) AS h").first().h
    at = {i: k for i, k in frame.selectExpr("doc_id", "xxhash64(doc_id, xxhash64(doc_id, text), 42) AS h").collect()}
    for s, source in enumerate("ab"):
        own = [(i, len(t.split())) for i, t, x in docs if x == source]
        total = sum(n for _, n in own)
        shards = -(-total // 120)
        line = sorted(own, key=lambda x: ((at[x[0]] >> 8) % shards, at[x[0]]))
        words = {k: sum(n for i, n in own if (at[i] >> 8) % shards == k) for k in {(at[i] >> 8) % shards for i, _ in own}}
        quota = round(sum(r.taken for i, r in got.items() if (i % 2) == s))
        taken = [0] * total
        for shard, begin, b0, b1, passes, blocks, part, last in mixing.shard_plan(sorted(words.items()), quota, 8):
            ranked = sorted(range(b0, b1), key=lambda b: hashed(f"CAST({s} AS BIGINT)", f"CAST({b} AS BIGINT)", 42))
            spans = [(b, 8) for b in ranked[:blocks]] + [(b, part) for b in ranked[blocks : blocks + 1]] + [(b1, last)] * bool(last)
            for b, n in spans:
                for p in range(b * 8, b * 8 + n):
                    taken[p] += 1
        place = 0
        for i, n in line:
            assert got[i].taken == n * passes + sum(taken[place : place + n])
            place += n
