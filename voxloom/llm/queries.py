"""The subpackage's queries for the driver: ``(spark, sf_dir) -> DataFrame`` each, and SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, langid, lines, mixing, quality, simhash, substring, tokencount, toxicity

RANKS, COUNTED = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int):
    """crc32 of doc_id as text, modulo folds."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(RANKS))


def op3_lines(spark, sf_dir):
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op4_substring(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), "v2", name="policy_kept")
    base = F.col("failed").bitwiseAND(F.lit(quality.mask(quality.BASE)).cast("long")) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & F.col("policy_kept")).alias("kept"), "failed")


def op6_exact(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def toxicity_model(spark, sf_dir, where):
    """Fitted on labelled rows that meet where."""
    return toxicity.fit(*toxicity.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), where))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.score(docs, toxicity_model(spark, sf_dir, fold(5) != 0))
    return rows.select("doc_id", F.coalesce(fold(5) == 0, F.lit(True)).alias("held_out"), "score", "predicted")


def op8_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = langid.predict(docs, langid.fit(langid.labelled_sample(docs, fold(4) != 2)))
    return rows.select("doc_id", F.coalesce(fold(4) == 2, F.lit(True)).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op9_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_tokens(spark, sf_dir):
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(COUNTED))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (op1_simhash, op2_bpe, op3_lines, op4_substring, op5_quality, op6_exact, op7_toxicity, op8_langid, op9_mixing, op10_tokens, pipeline)}


#: Every group of equal texts, lower-casing A-Z alone: DuckDB's lower() changes other letters too, so the letters are named.
EXACT_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""


WORD = r"[^\x20\x09-\x0D]+"

#: Windows of 35 words by their text; a word goes if a window that starts twice or more covers it.
SUBSTRING_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
x AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: sha256(array_to_string(w[i:i+34], ' ')))) AS h FROM d WHERE len(w) >= 35),
t AS (SELECT r, i FROM x QUALIFY count(*) OVER (PARTITION BY h) > 1),
g AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM t),
l AS (SELECT r, list(p) AS gone FROM g GROUP BY r),
k AS (SELECT doc_id, w, CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]) END AS kept FROM d LEFT JOIN l USING (r))
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(kept))::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""

#: The measures, every rule's bit, and the verdict of the base and of policy v2.
QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM documents),
x AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM d WHERE len(w) >= 5),
t AS (SELECT r, i FROM x QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
p AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS q FROM t) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '^\p{{L}}')))::BIGINT AS n_letter_words
  FROM d LEFT JOIN p USING (r)),
f AS (SELECT *, {' + '.join(f"CASE WHEN {rule.replace(' div ', ' // ')} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(quality.RULES.values()))} AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {quality.mask(quality.BASE)} <> 0 AS base_failed, failed & {quality.mask(quality.POLICIES["v2"])} = 0 AS kept, failed::BIGINT AS failed FROM f
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_substring": SUBSTRING_SQL, "op5_quality": QUALITY_SQL, "op6_exact": EXACT_SQL}
