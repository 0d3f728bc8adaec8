"""A small fixture with the awkward cases, and part of the driver's documents."""

import os
import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, _k string, kind string"


def awkward():
    """Nulls, empty and long texts, copies, near copies, repeated rows, shared passages and columns with clashing names."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéßñ") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, line, base = say(60), say(14), say(300)
    texts = [None, "", "   \n\t ", "a", "A b", "one two three", "!!! ### $$$ 123", "日本語の文章 です", "x" * 5000, passage, say(40) + " " + passage + " " + say(50), passage + "\n" + say(20)]
    for i in range(12):
        words = base.split(" ")
        words[i * 7] = "changed"
        texts.append(" ".join(words))
    texts += [base, base, base.upper(), base.title(), say(4000) + "\n" + line, "\n".join([line] * 4), line.replace(" ", "  ").upper() + ".", say(12) + "\n" + line + "\n\n" + say(9), "\x1c odd \x85 space here", "tab\tand\x0bvertical\x0cform\rreturn"]
    texts += [say(r.randint(1, 120)) for _ in range(60)]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["b", "a", None, "é", "\U0001f600", "￿"]), len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, base, None, None, 3, "", "", ""), (None, None, None, None, None, None, None, None), (30, say(30), "en", "a", 1, "", "", "")]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return awkward()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf(spark):
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path


@pytest.fixture(scope="session")
def sf_rows(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def order(rows):
    return sorted(map(tuple, rows), key=repr)
