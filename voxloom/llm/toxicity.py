"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic
text.  Both hold the ordinary words' beginnings; the toxic one ends in the
segments that set toxic documents apart, the ordinary one in filler of the same
size, so that a window without any such segment compresses alike with both.  A
window is a word between fixed marks; a document is judged by its two largest
savings (bytes by which the toxic dictionary is shorter), through thresholds
calibrated on labelled documents that trained no dictionary.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Cache
from .common import keyed, real_id

#: Labelled rows of each class that a fit takes at most, and the longest text among them in characters.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 2400, 4000, 20_000
#: Share of the sample that trains the dictionaries; the rest calibrates.
TRAIN_SHARE = 0.5
#: Beginnings of words, in bytes, that can become segments.
SEGMENT = range(4, 13)
ORDINARY_SEGMENTS = 1500
#: Contexts that a toxic segment needs, at least and as a share of the toxic texts, and how much likelier it must be there.
MIN_CONTEXTS, MIN_SHARE, MIN_RATIO = 5, 0.01, 20
#: Bytes that frame a window, and bytes after it that always compress.
MARK, TAIL = bytes(range(1, 7)), bytes(range(128, 192))
#: Savings above this count alike.
TOP = 8


def _contexts(texts: list[bytes]) -> tuple[Counter, int]:
    """In how many contexts (word before, word) each beginning occurs: copies of a text add nothing."""
    seen = {p for t in texts for w in (t.lower().split(),) for p in zip([b"", *w], w)}
    count = Counter(w[:k] for _, w in seen for k in SEGMENT if len(w) >= k)
    return count, max(1, len(seen))


def toxic_segments(toxic: list[bytes], ordinary: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Segments that set toxic texts apart, and the ordinary ones, each with the most frequent first."""
    ct, nt = _contexts(toxic)
    co, no = _contexts(ordinary)
    least = max(MIN_CONTEXTS, MIN_SHARE * len(toxic))
    chosen: list[bytes] = []
    for g in sorted((g for g, n in ct.items() if n >= least and n / nt >= MIN_RATIO * (co[g] + 1) / no), key=lambda g: (-ct[g], len(g), g)):
        if any(g.startswith(k) or k.startswith(g) for k in chosen):
            continue
        while (longer := max((g + bytes([b]) for b in range(256)), key=lambda x: ct[x])) and ct[longer] >= 0.9 * ct[g]:
            g = longer
        chosen.append(g)
    plain = sorted((g for g in co if g not in chosen), key=lambda g: (-co[g], g))[:ORDINARY_SEGMENTS]
    return chosen, plain


@dataclass
class Model:
    """Contents of the two dictionaries, and the log odds of each pair of savings."""

    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def compressors(self):
        import zstandard as z

        made = []
        for content in (self.ordinary, self.toxic):
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            p = z.ZstdCompressionParameters(window_log=16, chain_log=14, hash_log=13, search_log=6, min_match=4, target_length=64, strategy=z.STRATEGY_LAZY2, write_content_size=0, write_dict_id=0)
            d.precompute_compress(compression_params=p)
            made.append(z.ZstdCompressor(dict_data=d, compression_params=p).compress)
        return made

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-features @ np.array(self.weights)))


class Savings:
    """Savings of words, those met before looked up."""

    def __init__(self, model: Model):
        self.ordinary, self.toxic = model.compressors()
        self.cache = Cache(400_000)

    def _fresh(self, words: list[bytes]) -> list[int]:
        frames = [MARK + w + MARK + TAIL for w in words]
        return [len(self.ordinary(f)) - len(self.toxic(f)) for f in frames]

    def top_two(self, text: bytes) -> tuple[int, int]:
        """The largest and second largest saving among the words of a text, 0 at least."""
        words = set(text.lower().split())
        get = self.cache.new.get
        known = [x for w in words if (x := get(w)) is not None]
        if len(known) < len(words):
            fresh = words.difference(self.cache.new)
            known += self.cache.fill(fresh, self._fresh).values()
        known += (0, 0)
        first = max(known)
        known.remove(first)
        return max(first, 0), max(0, max(known))


def _features(pairs: np.ndarray) -> np.ndarray:
    """Each saving as steps up to TOP, and a constant."""
    steps = np.arange(1, TOP + 1)
    return np.hstack([np.ones((len(pairs), 1)), pairs[:, :1] >= steps, pairs[:, 1:] >= steps]).astype(float)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 60) -> np.ndarray:
    """Newton's method with a ridge on all weights but the constant's."""
    w, r = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    r[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(r), x.T @ (y - p) - r * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    """Dictionaries from the first part of each class, thresholds from the rest.

    With a class missing the model gives every text the other class.
    """
    if not toxic or not ordinary:
        return Model(MARK, MARK, [20.0 if toxic else -20.0] + [0.0] * (2 * TOP))
    a, b = (max(1, int(len(x) * TRAIN_SHARE)) for x in (toxic, ordinary))
    segments, plain = toxic_segments(toxic[:a], ordinary[:b])
    base = TAIL + b"".join(MARK + g for g in reversed(plain)) + MARK
    own = b"".join(MARK + g for g in reversed(segments)) + MARK
    model = Model(base + b"\x07" * (len(own) - len(MARK)) + MARK, base + own, [])
    rest = [(t, 1) for t in toxic[a:] or toxic] + [(t, 0) for t in ordinary[b:] or ordinary]
    savings = Savings(model)
    x = _features(np.array([savings.top_two(t) for t, _ in rest]))
    model.weights = _logistic(x, np.array([y for _, y in rest], dtype=float)).tolist()
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, where, seed: int = 17) -> tuple[list[bytes], list[bytes]]:
    """Texts of at most SAMPLE_TOXIC toxic and SAMPLE_ORDINARY ordinary labelled rows, those of the smallest hashes.

    where: a condition on ``doc_id`` that the rows must meet.  Texts over
    SAMPLE_CHARS characters don't enter a sample.
    """
    rows = labels.where(where & F.col("toxic").isin(0, 1)).select("doc_id", "toxic", F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("h"))
    take = [rows.where(F.col("toxic") == t).orderBy("h", "doc_id").limit(n) for t, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))]
    few = F.broadcast(take[0].unionAll(take[1]))
    got = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text").join(few, "doc_id").groupBy("doc_id", "toxic", "h").agg(F.min("text").cast("binary").alias("text")).collect()  # a repeated id gives one text
    got.sort(key=lambda r: (r.h, bytes(r.text)))
    seen: dict = {1: {}, 0: {}}
    for r in got:
        seen[r.toxic].setdefault(bytes(r.text))
    return list(seen[1]), list(seen[0])


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``saving``, ``second_saving``, ``score``, ``predicted``.

    A null or empty text has no window and gets the score of none.  Rows that
    repeat each get a row; other columns are not read; an empty table gives an
    empty result.
    """

    def run(batches):
        savings = Savings(model)
        for batch in batches:
            pairs = np.array([savings.top_two(t) for t in batch.column("_t").to_pylist()], dtype=np.int64).reshape(-1, 2)
            p = model.probability(_features(pairs))
            yield pa.RecordBatch.from_arrays([batch.column("_d"), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(p)], ["_d", "saving", "second_saving", "score"])

    rows = keyed(docs, text, doc_id).select("_d", "_t").mapInArrow(run, "_d long, saving long, second_saving long, score double")
    return rows.select(real_id().alias("doc_id"), "saving", "second_saving", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of docs that the model doesn't reject, all columns kept."""

    def clean(batches):
        savings = Savings(model)
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            pairs = np.array([savings.top_two(t or b"") for t in texts], dtype=np.int64).reshape(-1, 2)
            yield batch.filter(pa.array(model.probability(_features(pairs)) < 0.5))

    from .common import bound_batches

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(clean, docs.schema)
