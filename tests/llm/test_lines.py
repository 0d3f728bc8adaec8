import hashlib
import random
import re

import numpy as np

from voxloom.llm import lines, queries

from .conftest import order
from .test_simhash import classes


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def normal(line):
    out = "".join(c if ord(c) > 127 else "0" if c.isdigit() else c.lower() if c.isalpha() else " " for c in line)
    return re.sub(r"[ \t-\r]+", " ", out).strip(" ")


def whole(texts):
    """Plain fingerprints as numbers."""
    return [(int(a) % (1 << 64)) << 64 | int(b) % (1 << 64) for a, b in zip(*lines.line_fingerprints(texts))]


def brute(rows):
    """Links of all pairs of different normalised lines that share a block, then one occurrence for each class."""
    docs = sorted({(-(1 << 63) if i is None else i, t or "") for i, t in rows}, key=repr)
    places = {}
    for i, t in docs:
        for n, line in enumerate(t.split("\n")):
            if s := normal(line):
                places.setdefault(s, []).append((i, n, t))
    distinct = sorted(places)
    blocks = [set() for _ in distinct]
    for i, k in zip(*lines.line_keys([s.encode() for s in distinct])):
        blocks[i].add(int(k))
    fps = whole([s.encode() for s in distinct])
    own = dict(zip(distinct, zip(blocks, fps)))

    def linked(a, b):
        most = max(len(a), len(b)) * 20 // 100
        return bool(own[a][0] & own[b][0]) and (own[a][1] ^ own[b][1]).bit_count() <= 40 and abs(len(a) - len(b)) <= most and edit_distance(a, b) <= most

    low = classes(distinct, linked)
    groups = {}
    for s in distinct:
        groups.setdefault(low[s], []).extend(places[s])
    return groups


def check(got, rows):
    groups = brute(rows)
    by_doc = {}
    for own in groups.values():
        first = min(own, key=lambda x: (x[0], x[1]))
        for i, n, t in own:
            if (i, n, t) != first:
                by_doc.setdefault((i, t), set()).add(n)
    want = []
    for i, t in rows:
        key = (-(1 << 63) if i is None else i, t or "")
        gone = by_doc.get(key, set())
        kept = "\n".join(x for n, x in enumerate(key[1].split("\n")) if n not in gone)
        want.append((i, key[1].count("\n") + 1, len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert order(got) == order(want)


def test_matches_brute_force(spark, empty):
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcdefgß") for _ in range(r.randint(2, 8))) for _ in range(80)]
    base = [[r.choice(vocabulary) for _ in range(r.choice((4, 6, 30, 80)))] for _ in range(25)]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "x" * 3000)]
    for i in range(4, 60):
        own = []
        for _ in range(r.randint(1, 5)):
            words = list(r.choice(base))
            for _ in range(r.choice((0, 0, 1, 2))):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            line = " ".join(words)
            own.append(r.choice((line, line.upper(), line.replace(" ", "  ") + "!!", line + " 7")))
        rows.append((i, "\n".join(own)))
    rows += [rows[10], (None, rows[11][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = lines.dedup_lines(df, with_text=True)
    check([x[:4] for x in got.collect()], rows)
    assert all(hashlib.sha256(x.kept_text.encode()).hexdigest() == x.kept_sha256 for x in got.collect())
    assert lines.dedup_lines(empty).count() == 0


def test_documents_keep_one_line_of_each_group(spark, sf, sf_rows):
    """Every line that stays is unlike every other by its normalised form, and each removed one has its like."""
    kept = lines.dedup_lines(spark.read.parquet(f"{sf}/documents.parquet"), with_text=True).collect()
    seen = [s for k in kept for x in k.kept_text.split("\n") if (s := normal(x))]
    assert len(seen) == len(set(seen))
    assert sum(k.n_removed for k in kept) > 0
    assert {k.doc_id for k in queries.op3_lines(spark, sf).collect()} == {i for i, _ in sf_rows}


def test_recall_against_all_pairs(sf_rows, capsys):
    """Of all pairs of lines of 80 % edit similarity or more, at least nine in ten share a block, whatever their length from 20 characters on."""
    distinct = sorted({s for _, t in sf_rows for x in (t or "").split("\n") if (s := normal(x))}, key=len)
    blocks = [set() for _ in distinct]
    for i, k in zip(*lines.line_keys([s.encode() for s in distinct])):
        blocks[i].add(int(k))
    fps = whole([s.encode() for s in distinct])
    size, found, total = np.array([len(s) for s in distinct]), {}, {}
    for i, a in enumerate(distinct):
        end = int(np.searchsorted(size, len(a) / 0.8 + 1e-9, side="right"))
        own = [i, *range(i + 1, end)]
        for x, y in (p for p in _paired([distinct[j] for j in own]) if p[0] == 0) if len(own) > 1 else ():
            b = distinct[own[y]]
            if lines.within(a, b, len(b) * 20 // 100):
                bin = next(low for low in (500, 200, 80, 40, 20, 0) if len(b) >= low)
                total[bin] = total.get(bin, 0) + 1
                found[bin] = found.get(bin, 0) + bool(blocks[i] & blocks[own[y]] and (fps[i] ^ fps[own[y]]).bit_count() <= 40)
    with capsys.disabled():
        print("\npairs of 80 % edit similarity found, by characters of the longer line:", {f"{b}+": f"{found[b]}/{total[b]}" for b in sorted(total)})
    assert sum(found[b] for b in total if b >= 20) >= 0.9 * sum(total[b] for b in total if b >= 20) > 0


def _paired(texts):
    """Positions 0 and y of texts that have letters enough in common."""
    from collections import Counter

    first = Counter(texts[0])
    for y, t in enumerate(texts[1:], 1):
        if abs(len(t) - len(texts[0])) <= 0.2 * len(t) and (Counter(t) - first).total() <= 0.2 * len(t):
            yield 0, y


def test_edits_of_one_to_two_words(sf_rows):
    """Lines of the documents with one or two words replaced, of 80 % edit similarity or more."""
    r = random.Random(3)
    distinct = sorted({s for _, t in sf_rows for x in (t or "").split("\n") if (s := normal(x)) and 5 <= s.count(" ") + 1 <= 200})
    words = sorted({w for s in distinct for w in s.split(" ")})
    for n in (1, 2):
        hit = total = 0
        for s in r.sample(distinct, 600):
            w = s.split(" ")
            for i in r.sample(range(len(w)), n):
                w[i] = r.choice(words)
            e = " ".join(w)
            if e != s and lines.within(s, e, max(len(s), len(e)) * 20 // 100):
                at, keys = lines.line_keys([s.encode(), e.encode()])
                x, y = whole([s.encode(), e.encode()])
                total += 1
                hit += bool(set(keys[at == 0].tolist()) & set(keys[at == 1].tolist())) and (x ^ y).bit_count() <= 40
        assert hit >= 0.95 * total > 0


def test_within_is_the_edit_distance():
    r = random.Random(8)
    for _ in range(400):
        a = "".join(r.choice("abcß") for _ in range(r.randint(0, 30)))
        b = list(a)
        for _ in range(r.randint(0, 8)):
            i = r.randint(0, len(b))
            b[i : i + r.randint(0, 1)] = r.choice(("", "x", "a"))
        b = "".join(b) if r.random() < 0.8 else "".join(r.choice("abcß") for _ in range(r.randint(0, 30)))
        d = edit_distance(a, b)
        assert all(lines.within(a, b, k) == (d <= k) for k in range(0, 32))


def test_pipeline_form(docs, rows, empty):
    out = lines.without_repeated_lines(docs)
    assert out.schema == docs.schema and out.count() == len(rows)
    want = {(x.doc_id, x.kept_sha256) for x in lines.dedup_lines(docs).collect()}
    got = {(x.doc_id, hashlib.sha256((x.text or "").encode()).hexdigest()) for x in out.collect()}
    assert got == want
    assert lines.without_repeated_lines(empty).count() == 0


def test_hot_blocks_of_unlike_lines_and_chains(spark):
    """A passage that many unlike lines hold, a chain of lines alike through others only, and one line a third of all."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 9)))
    passage = " ".join(word() for _ in range(25))
    hot = [passage + " " + " ".join(word() for _ in range(22)) for _ in range(150)]
    chain, own = [], [word() for _ in range(40)]
    for i in range(30):
        own[i] = word()
        chain.append(" ".join(own))
    common = " ".join(word() for _ in range(9))
    rows = [(i, x) for i, x in enumerate(hot + chain + [common] * 90)]
    r.shuffle(rows)
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    gone = {x.doc_id for x in got.collect() if x.n_removed}
    assert gone == {*range(151, 180), *range(181, 270)}


def test_tiles_of_a_large_key(spark, monkeypatch):
    """A key dealt out in tiles gives the same groups."""
    from voxloom.llm import blocks

    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 9)))
    text = {n: " ".join(word() for _ in range(12)) for n in range(40)}
    text.update({n + 40: text[n].replace(" ", " q", 2) for n in range(0, 40, 2)})
    rows = spark.createDataFrame([(7, 100, n) for n in text], "key long, size int, node long")
    content = spark.createDataFrame([(n, t, 0, 0) for n, t in text.items()], "node long, content string, f0 long, f1 long")
    args = (lambda w: content.join(w, "node"), lambda a, b: edit_distance(a, b) <= 10, 80, "tiles")
    want = order(blocks.groups(rows, *args).collect())
    assert len(want) == 40 and order(blocks.groups(rows, *args, tile=5).collect()) == want


def test_met_rows_whatever_the_batches():
    """Rows of keys with several nodes, each with the one before it if of like size; the same however the rows are cut into batches."""
    import pyarrow as pa

    from voxloom.llm.blocks import _met

    r = random.Random(1)
    rows = sorted((r.randrange(25), r.choice((80, 90, 100, 200)), r.randrange(6)) for _ in range(120))
    rows = [x for x in rows if not any(y[0] == x[0] and y[2] == x[2] and y < x for y in rows)] + []
    rows = sorted(rows + rows[::3])
    unique = sorted(set(rows))
    want = []
    for i, (k, s, n) in enumerate(unique):
        prev = unique[i - 1] if i and unique[i - 1][0] == k else None
        after = i + 1 < len(unique) and unique[i + 1][0] == k
        if prev or after:
            want.append((k, s, n, prev[2] if prev and prev[1] * 100 >= s * 80 else None))
    for size in (1, 2, 3, 7, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + size]), (pa.int64(), pa.int32(), pa.int64()))], ["key", "size", "node"]) for i in range(0, len(rows), size)]
        got = [tuple(x.values()) for b in _met(80)(batches) for x in b.to_pylist()]
        assert got == want


def test_block_keys_are_simhashes():
    from voxloom.llm import blocks

    features = [int(x) for x in np.random.default_rng(0).integers(0, 1 << 62, 700)] * 2
    h = np.array(features, dtype=np.uint64)
    cut = blocks.Cut(features=4, blocks=2, least=1)
    at, keys = blocks.block_keys(h, np.zeros(len(h), dtype=np.int64), np.array([1]), cut)
    want = []
    for c in (0, 1):
        own = {f * int(blocks._MIX[1]) % (1 << 64) >> 24 for f in features if f * int(blocks._MIX[0]) % (1 << 64) >> 63 == c}
        votes = blocks.mixed(np.array(sorted(own), dtype=np.uint64))
        bits = sum(1 << b for b in range(64) if 2 * sum(int(v) >> b & 1 for v in votes) > len(own))
        want.append(int(blocks.mixed(np.array([bits], dtype=np.uint64) ^ blocks.mixed(np.array([1024 + c], dtype=np.uint64)))[0]))
    assert len(h) > 2 * 255 and at.tolist() == [0, 0] and keys.tolist() == want
