"""Quality rules as a ledger of bits.

Every rule is evaluated once per document; the ledger keeps its measurements
and one bit per failed rule.  A policy is a version and a mask of rules, so
applying one, comparing two and asking what a rule costs are bit operations
over the ledger, without another look at the texts.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, real_id

SYMBOLS = b"#*$%&|<>"
#: Words of a window that counts as repeated if found twice.
WINDOW = 5
#: Rules in the order of their bits, as conditions on the measurements under which a document fails.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "long_words": "word_chars > 12 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "many_words": "n_words > 100000",
    "no_letters": "n_letter_words < n_words div 2",
}
BASE = ("few_words", "repeated_words")
#: Versions of policies: the rules that each applies.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "many_symbols", "repeated_lines"),
    "v3": (*BASE, "many_symbols", "repeated_lines", "long_words", "short_words", "no_letters"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words")


def measure(text: bytes) -> tuple[int, ...]:
    """MEASURES of one text: words are separated by ASCII white space, word_chars counts code points."""
    words = text.split()
    chars = sum(map(len, words)) if text.isascii() else len(b"".join(words).decode("utf-8", "replace"))
    symbols = sum(map(text.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS)))))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if len(words) > WINDOW:
        grams = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(grams)) < len(grams):
            count = Counter(grams)
            starts = np.fromiter((count[g] > 1 for g in grams), dtype=np.int64, count=len(grams))
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            edge[: len(grams)] += starts
            edge[WINDOW : WINDOW + len(grams)] -= starts
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    letters = sum(map(str.isalpha, (w[:1] for w in map(bytes.decode, words, ["utf-8"] * len(words), ["replace"] * len(words))))) if not text.isascii() else sum(w[:1].isalpha() for w in words)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), letters


def ledger(docs: DataFrame, rules: dict[str, str] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, MEASURES and ``failed`` (long, bit i: rule i of rules).

    A null text has no words and measures 0 throughout.  A duplicate line is
    one with a word that equals an earlier line of its text.  Rows that repeat
    each get a row; other columns are not read; an empty table gives an empty
    result.
    """

    def run(batches):
        for batch in batches:
            rows = [measure(x) for x in batch.column("_t").to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([batch.column("_d"), *(pa.array(x, pa.int64()) for x in columns)], ["_d", *MEASURES])

    rows = keyed(docs, text, doc_id).select("_d", "_t").mapInArrow(run, "_d long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " | ".join(f"if({rule}, {1 << i}L, 0L)" for i, rule in enumerate(rules.values()))
    return rows.select(real_id().alias("doc_id"), *MEASURES, F.expr(bits).alias("failed"))


def mask(names, rules: dict[str, str] = RULES) -> int:
    """The bits of the named rules."""
    order = list(rules)
    return sum(1 << order.index(n) for n in names)


def apply_policy(rows: DataFrame, version: str, policies: dict = POLICIES, rules: dict[str, str] = RULES, name: str = "kept") -> DataFrame:
    """Adds whether a document passes every rule of a policy."""
    return rows.withColumn(name, F.col("failed").bitwiseAND(F.lit(mask(policies[version], rules)).cast("long")) == 0)


def ablations(rows: DataFrame, policies: dict = POLICIES, rules: dict[str, str] = RULES) -> DataFrame:
    """``version``, ``rule``, ``n_failed``, ``n_only``: documents that fail the rule, and that only this rule of the policy rejects.

    The ledger is first counted by its bits, of which there are few patterns.
    """
    patterns = rows.groupBy("failed").agg(F.count("*").alias("n"))
    out = []
    for version, names in policies.items():
        own = F.col("failed").bitwiseAND(F.lit(mask(names, rules)).cast("long"))
        for n in names:
            bit = F.lit(mask([n], rules)).cast("long")
            out.append(F.struct(F.lit(version).alias("version"), F.lit(n).alias("rule"), F.when(own.bitwiseAND(bit) != 0, F.col("n")).otherwise(0).alias("f"), F.when(own == bit, F.col("n")).otherwise(0).alias("o")))
    each = patterns.select(F.explode(F.array(*out)).alias("x")).select("x.*")
    return each.groupBy("version", "rule").agg(F.sum("f").alias("n_failed"), F.sum("o").alias("n_only"))
