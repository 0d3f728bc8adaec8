import random

import corpus_pipeline
from voxloom.llm import simhash

from .conftest import order
from .test_simhash import classes


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(rows):
    """The least (id, text) of each connected group of texts."""
    sets = [shingles(t) for _, t in rows]
    near = lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    low = classes(range(len(rows)), near)
    groups = {}
    for i, g in low.items():
        groups.setdefault(g, []).append(rows[i])
    return groups.values()


def edited(r, words, n):
    words = list(words)
    for i in r.sample(range(len(words)), n):
        words[i] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def test_keep_one_matches_brute_force(docs, rows, empty):
    kept = simhash.keep_one_similar(docs)
    assert kept.schema == docs.schema
    got = [(r.doc_id, r.text) for r in kept.collect()]
    groups = brute([r[:2] for r in rows])
    assert len(got) == len(groups)
    for own in groups:
        first = min(-(1 << 63) if i is None else i for i, _ in own)
        assert any(x in got for x in own if (-(1 << 63) if x[0] is None else x[0]) == first)
    assert simhash.keep_one_similar(empty).count() == 0


def test_stage_finds_edited_copies_and_leaves_others(spark):
    """Copies with single words replaced: all of 80 % similarity or more go, those clearly below stay."""
    r = random.Random(9)
    rows, like = [], 0
    for i in range(150):
        base = [f"w{r.randrange(5000)}" for _ in range(r.randint(60, 900))]
        copy = edited(r, base, max(1, int(len(base) * r.choice((0.005, 0.01, 0.02, 0.05)))))
        a, b = shingles(" ".join(base)), shingles(copy)
        like += 100 * len(a & b) >= 80 * len(a | b)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, copy)]
    out = corpus_pipeline.near_duplicates_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), None)
    assert like > 60 and out.count() == len(rows) - like


def test_a_large_group_of_near_copies(spark):
    """Members alike through others only are one group."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words)) for i in range(1)]
    for i in range(1, 60):
        words = list(words)
        words[3 * i] = f"x{i}"
        rows.append((i, " ".join(words)))
    r.shuffle(rows)
    assert [x.doc_id for x in simhash.keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [0]


def test_unlike_texts_of_one_id_each_stay(spark):
    rows = [(None, "a b c d e f"), (None, "g h i j k l"), (None, "m n o p q r"), (1, "one two three four five six"), (1, "red blue green grey black white"), (2, "one two three four five six"), (3, "red blue green grey black white")]
    out = simhash.keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert order(x[:2] for x in out.collect()) == order(rows[:5])


def test_pairs_of_80_percent_share_a_block(sf_rows):
    """Of pairs of texts of sf0.001 and edited copies of all of them, those of 80 % similarity or more share a block."""
    r = random.Random(7)
    texts = [t for _, t in sf_rows if t and len(t.split()) >= 12]
    hit = total = 0
    for t in texts:
        words = t.split()
        copy = edited(r, words, max(1, round(len(words) * r.choice((0.004, 0.01, 0.02)))))
        sets = [simhash.shingle_set(x.encode().lower().split()) for x in (t, copy)]
        both = len(set(sets[0].tolist()) & set(sets[1].tolist()))
        if both >= 0.8 * (len(sets[0]) + len(sets[1]) - both):
            at, keys = simhash.set_keys(sets)
            total += 1
            hit += bool(set(keys[at == 0].tolist()) & set(keys[at == 1].tolist()))
    assert hit >= 0.97 * total > 60
