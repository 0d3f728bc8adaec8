import hashlib
import random

from voxloom.llm import lines, queries

from .conftest import order
from .test_lines import edit_distance, normal


def typo(r, line):
    i = r.choice([i for i, c in enumerate(line) if c != " "])
    return line[:i] + ("q" if line[i] != "q" else "z") + line[i + 1 :]


def test_query_finds_small_edits_of_short_and_long_lines(spark, tmp_path):
    """One letter changed in lines of 5 to 80 words: the second occurrence goes."""
    r = random.Random(6)
    rows, n = [], 0
    for words in (5, 8, 12, 20, 40, 80):
        for _ in range(40):
            line = " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 9))) for _ in range(words))
            rows += [(n, line), (n + 1, typo(r, line))]
            n += 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    gone = {x.doc_id: x.n_removed for x in queries.op3_lines(spark, str(tmp_path)).collect()}
    assert sum(gone[i] for i in range(0, n, 2)) == 0
    assert sum(gone[i] for i in range(1, n, 2)) >= 0.97 * n / 2


def test_every_removed_line_is_linked_and_forms_agree(spark, docs, rows, empty):
    """Removed lines have a verified like, nothing but repeats goes, and the pipeline's form gives the same texts."""
    got = lines.dedup_lines(docs, with_text=True).collect()
    assert len(got) == len(rows)
    every = {s for _, t, *_ in rows for x in (t or "").split("\n") if (s := normal(x))}
    kept = [s for k in got for x in k.kept_text.split("\n") if (s := normal(x))]
    for s in every - set(kept):
        assert any(s != x and edit_distance(s, x) <= max(len(s), len(x)) * 20 // 100 for x in every if abs(len(s) - len(x)) <= 0.2 * max(len(s), len(x)))
    out = lines.without_repeated_lines(docs)
    assert out.schema == docs.schema
    assert order((x.doc_id, hashlib.sha256((x.text or "").encode()).hexdigest()) for x in out.collect()) == order((x.doc_id, x.kept_sha256) for x in got)
    assert lines.dedup_lines(empty).count() == 0
