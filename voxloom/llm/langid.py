"""Language identification by compression.

Each language has a zstandard raw-content dictionary of its own text.  A text is
cut into pieces, each is compressed with every dictionary, and the language
whose total is smallest wins; where the margin to the next is narrow the
prediction is marked as rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, real_id

UNKNOWN = "und"
#: Documents per language in a fit at most, and the longest of them in characters.
SAMPLE, SAMPLE_CHARS = 128, 20_000
#: Bytes of a dictionary, which whole texts fill, and of a piece that is compressed by itself.
DICTIONARY_BYTES, PIECE_BYTES = 48 << 10, 4096
#: Share of the best length by which the second must exceed it.
MIN_MARGIN = 0.02
#: Bytes of margin per piece that multiply the odds by e.
TEMPERATURE = 4.0


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numerals such as ½ or Ⅷ aren't."""
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """Dictionary contents by language."""

    contents: dict[str, bytes]

    def compressors(self):
        import zstandard as z

        out = []
        for content in self.contents.values():
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            p = z.ZstdCompressionParameters(window_log=17, chain_log=16, hash_log=15, search_log=5, min_match=3, target_length=64, strategy=z.STRATEGY_BTLAZY2, write_content_size=0, write_dict_id=0)
            d.precompute_compress(compression_params=p)
            out.append(z.ZstdCompressor(dict_data=d, compression_params=p).compress)
        return out


def fit(samples: dict[str, list[bytes]]) -> Model:
    """A dictionary per language: its texts in the given order, whole ones while they fit into DICTIONARY_BYTES; the first is cut if it alone doesn't."""
    contents = {}
    for lang in sorted(samples):
        held = b""
        for t in samples[lang]:
            own = t.decode("utf-8", "replace").lower().encode()
            if not own.strip():
                continue
            if not held:
                held = own[:DICTIONARY_BYTES]
            elif len(held) + 1 + len(own) <= DICTIONARY_BYTES:
                held += b"\n" + own
        contents[lang] = held or b" " * 8
    return Model(contents)


def labelled_sample(docs: DataFrame, where, seed: int = 23) -> dict[str, list[bytes]]:
    """Texts of at most SAMPLE documents of each non-null lang, those of the smallest hashes; where: a condition on ``doc_id``.

    The number of languages is taken to be that of a list of languages, so the
    whole sample is bounded.  Only rows with a hash under a bound, by which a few
    times SAMPLE of each language pass, are ranked: no task gets all rows of one.
    Other columns are not read, whatever their names.
    """
    own = docs.where(where & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    rows = own.select("lang", "doc_id", "text", F.xxhash64("doc_id", F.lit(seed)).alias("h"))
    share = F.least(F.lit(1.0), F.lit(4.0 * SAMPLE) / F.greatest(F.lit(1), F.col("n")))
    bound = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.05).alias("n")).select(F.col("lang").alias("of"), F.when(share < 1, (share * 2.0**64 - 2.0**63).cast("long")).otherwise(F.lit((1 << 63) - 1)).alias("most"))
    few = rows.join(F.broadcast(bound), (rows["lang"] == bound["of"]) & (rows["h"] <= bound["most"]))  # a row per language
    once = few.groupBy("lang", "doc_id", "h").agg(F.min("text").alias("text"))  # a repeated id gives one text
    first = once.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("n") <= SAMPLE)
    out: dict[str, list[bytes]] = {}
    for r in sorted(first.select("lang", "h", F.col("text").cast("binary").alias("text")).collect(), key=lambda r: (r.h, bytes(r.text))):
        out.setdefault(r.lang, []).append(bytes(r.text))
    return {k: list(dict.fromkeys(v)) for k, v in out.items()}


def pieces(text: bytes, size: int = PIECE_BYTES) -> list[bytes]:
    """The text in parts of about equal size, none over size."""
    n = -(-len(text) // size)
    return [text[len(text) * i // n : len(text) * (i + 1) // n] for i in range(n)]


def predict(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred``, ``score``, ``margin``, ``rejected``.

    ``lang_pred`` is the language of the shortest total, ties to the first in
    code-point order; ``und`` with score 0 for a null text or one without a
    letter (or if nothing was learned).  ``score`` is the share of the best in
    odds that fall with the mean length of a piece.  ``rejected``: the margin
    is under MIN_MARGIN of the best length, or the text is ``und``.  Rows that
    repeat each get a row; other columns are not read, whatever their names; an
    empty table gives an empty result.
    """

    def run(batches):
        compress, names = model.compressors(), list(model.contents)
        for batch in batches:
            lang, value, margin = [], [], []
            for raw in batch.column("_t").to_pylist():
                text = raw.decode("utf-8", "replace")
                if not names or not has_letter(text):
                    lang.append(UNKNOWN), value.append(0.0), margin.append(0.0)
                    continue
                parts = pieces(text.lower().encode())
                total = np.array([sum(len(c(p)) for p in parts) for c in compress], dtype=float)
                best = int(total.argmin())
                odds = np.exp(-(total - total[best]) / len(parts) / TEMPERATURE)
                rest = np.delete(total, best)
                lang.append(names[best])
                value.append(float(1 / odds.sum()))
                margin.append(float((rest.min() - total[best]) / total[best]) if len(rest) else 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("_d"), pa.array(lang, pa.string()), pa.array(value, pa.float64()), pa.array(margin, pa.float64())], ["_d", "lang_pred", "score", "margin"])

    rows = keyed(docs, text, doc_id).select("_d", "_t").mapInArrow(run, "_d long, lang_pred string, score double, margin double")
    return rows.select(real_id().alias("doc_id"), "lang_pred", "score", "margin", ((F.col("margin") < MIN_MARGIN) | (F.col("lang_pred") == UNKNOWN)).alias("rejected"))
