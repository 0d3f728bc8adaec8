import hashlib
import random
from collections import Counter

import pytest

from voxloom.llm import exact, queries, quality

from .conftest import order


def brute_measures(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().split()]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, rows, empty, spark, sf, sf_rows):
    def want(i, t):
        n, chars, symbols, dup, rep = m = brute_measures(t)
        return (i, *m, n < 10 or 100 * rep > 20 * n)

    for got, source in ((quality.ledger(docs), [r[:2] for r in rows]), (quality.ledger(spark.read.parquet(f"{sf}/documents.parquet")), sf_rows)):
        base = quality.mask(quality.BASE)
        assert order((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.failed & base != 0) for r in got.collect()) == order(want(*x) for x in source)
    out = queries.op5_quality(spark, sf).collect()
    assert all(not r.kept for r in out if r.base_failed) and any(r.kept for r in out)
    assert quality.ledger(empty).count() == 0


def test_policies_and_ablations(docs):
    rows = quality.ledger(docs).collect()
    kept = quality.apply_policy(quality.ledger(docs), "v2").collect()
    mask = quality.mask(quality.POLICIES["v2"])
    assert all(r.kept == (r.failed & mask == 0) for r in kept)
    for r in quality.ablations(quality.ledger(docs)).collect():
        own, bit = quality.mask(quality.POLICIES[r.version]), quality.mask([r["rule"]])
        assert r.n_failed == sum(x.failed & bit != 0 for x in rows)
        assert r.n_only == sum(x.failed & own == bit for x in rows)


def brute_copies(rows):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for t, ids in groups.items():
        top = max(ids, key=lambda i: -(1 << 63) if i is None else i)
        kept = False
        for i in ids:
            out.append((i, top, len(ids), i == top and not kept, hashlib.sha256(t.encode()).hexdigest()))
            kept = kept or i == top
    return out


@pytest.mark.parametrize("limit", [exact.TABLE_BYTES, 600])
def test_exact(docs, rows, empty, spark, sf, sf_rows, limit):
    assert order(exact.exact_groups(docs, limit).collect()) == order(brute_copies(r[:2] for r in rows))
    assert order(exact.exact_groups(spark.read.parquet(f"{sf}/documents.parquet"), limit).collect()) == order(brute_copies(sf_rows))
    assert exact.exact_groups(empty, limit).count() == 0


def test_spilling_compares_contents(tmp_path):
    """Records of one hash and different contents stay apart, at every depth; the files go."""
    r = random.Random(4)
    records = [(r.choice((0, 7 << 60, (1 << 64) - 1, r.getrandbits(64))), r.randint(0, 99), n, 1, bytes([r.randint(97, 103)] * r.randint(0, 5))) for n in range(3000)]
    got = {x[0]: x[1:] for x in exact.grace(iter(records), limit=250, folder=str(tmp_path))}
    groups = {}
    for h, i, n, c, content in records:
        groups.setdefault((h, content), []).append((i, -n))
    assert len(got) == len(records)
    for h, i, n, c, content in records:
        own = groups[h, content]
        top = max(own)
        assert got[n] == (top[0], -top[1], len(own))
    assert not list(tmp_path.iterdir())


def test_members_beyond_memory(tmp_path):
    members = exact.Members(str(tmp_path), held=10)
    pairs = [(i * 3, i) for i in range(57)]
    for p in pairs:
        members.add(*p)
    assert len(members.part) < 20 and list(members) == pairs


def test_quality_by_sql(spark, sf):
    """The SQL of op5 and op4 over the tables gives the queries' rows."""
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    for name in ("op5_quality", "op4_substring"):
        got = queries.queries()[name](spark, sf)
        want = con.sql(queries.oracle_sql()[name])
        columns = sorted(got.columns)
        assert sorted(want.columns) == columns
        assert order(got.select(*columns).collect()) == order(want.project(", ".join(columns)).fetchall())
