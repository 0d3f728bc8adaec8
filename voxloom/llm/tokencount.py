"""Token counts of texts of any length by overlap resynchronisation.

A huge text is encoded in chunks that overlap.  Two neighbours are spliced at a
place that both have as a token boundary and that is proven stable: the text
there has a space between two characters that are not white space, and the
tokenizer's pre-tokens (and its special strings) have a space only at their
start or in runs of white space, so every encoding of any stretch around it
breaks there.  For the byte-level pattern places between letters and numbers, and
before punctuation beyond ASCII, are proven as well.  Where an overlap has no
such place it doubles, and then the chunk does.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Cache, odd
from .common import keyed, real_id

#: Longest text that is encoded in one go, in characters, and the step between chunks.
CHUNK_CHARS = 1 << 15
#: First overlap of two chunks.
OVERLAP_CHARS = 256
#: Stable places that both neighbours must have as boundaries before the splice is taken.
PROOFS = 4
#: A space between two characters that aren't white space.
STABLE = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?= [^\s\x1c-\x1f\x85])")
#: Further places for the byte-level pattern, which never joins a letter with a number, nor with punctuation after it but the apostrophe's: texts without spaces have these.
BETWEEN_KINDS = r"(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})|(?<=\p{L})(?=[\p{P}--[\x00-\x7f]])"


def chunked_count(text: str, offsets, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, stable: re.Pattern = STABLE) -> int:
    """Number of tokens of text; offsets(part) gives (start, end) in characters of each token of a part.

    The left chunk's tokens count up to the splice, the right chunk's from it
    on.  The overlap doubles while it holds no splice; where it has taken in
    the rest of the text, the rest is encoded whole.
    """
    total, begin = 0, 0
    while begin < len(text):
        end, width = min(begin + chunk, len(text)), overlap
        left = offsets(text[begin:end])
        if end == len(text):
            return total + len(left)
        while True:
            right_end = min(end + width, len(text))
            if right_end == len(text) and width > len(text) - end:
                return total + len(offsets(text[begin:]))
            lap = max(begin, end - width)
            right = offsets(text[lap:right_end])
            ours, theirs = {begin + a for a, _ in left}, {lap + a for a, _ in right}
            # not at the chunks' own ends, which either has for lack of context
            places = [m.start() for m in stable.finditer(text, lap + 1, end - 1)]
            common = [p for p in places if p in ours and p in theirs and p > begin]
            if len(common) >= min(PROOFS, max(1, len(places))):
                cut = common[-1]
                total += sum(begin + a < cut for a, _ in left)
                begin = cut
                break
            width *= 2
            if width > end - begin:  # the overlap is the whole chunk: widen the chunk itself
                end = min(end + end - begin, len(text))
                left = offsets(text[begin:end])
                if end == len(text):
                    return total + len(left)
    return total


class Json:
    """Counts by a tokenizers file."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.words = Cache(600_000)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.stable, own = STABLE, regex.compile(f"{STABLE.pattern}|{BETWEEN_KINDS}", regex.V1)
        cut = file.get("pre_tokenizer") or {}
        if cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not any(own.search(x["content"]) for x in file.get("added_tokens") or ()):
            self.stable = own

    def offsets(self, text: str):
        return self.model.encode(text, add_special_tokens=False).offsets

    def _batch(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def short(self, text: str) -> int:
        """Of a text in one go: stretches between stable places are encoded by themselves, those met before are looked up."""
        words = text.split(" ")
        if words[0][-1:].isspace() or any(map(odd, set(words[1:]).difference(self.words.new))):
            return self._batch([text])[0]
        got = list(map(self.words.new.get, words[1:]))
        if None in got:
            own = self.words.fill({w for w, x in zip(words[1:], got) if x is None}, lambda ws: self._batch([" " + w for w in ws]))
            got = [own[w] if x is None else x for w, x in zip(words[1:], got)]
        return sum(got) + (self._batch(words[:1])[0] if words[0] else 0)


class Pieces:
    """Counts by a sentencepiece file, whose pieces may join across spaces: no stretch but a whole text is known to be stable, so none is cached."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def short(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    offsets = stable = None


_LOADED: dict = {}


def counter(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _LOADED:
        _LOADED[path] = (Pieces if path.endswith(".model") else Json)(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    path: a tokenizers file of a byte-level BPE (.json) or a sentencepiece file
    (.model).  Nothing is added, cut or padded; a special string inside a text
    is what the library makes of it.  A null or empty text has 0 bytes and
    tokens.  Rows that repeat each get a row; other columns are not read; an
    empty table gives an empty result.
    """

    def run(batches):
        model = counter(path)
        for batch in batches:
            size, tokens = [], []
            for raw in batch.column("_t").to_pylist():
                t = raw.decode("utf-8", "replace")
                size.append(len(raw))
                huge = len(t) > chunk and model.offsets is not None
                tokens.append(chunked_count(t, model.offsets, chunk, overlap, model.stable) if huge else model.short(t))
            yield pa.RecordBatch.from_arrays([batch.column("_d"), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())], ["_d", "n_bytes", "n_tokens"])

    out = keyed(docs, text, doc_id).select("_d", "_t").mapInArrow(run, "_d long, n_bytes long, n_tokens long")
    return out.select(real_id().alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
