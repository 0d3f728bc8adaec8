"""Byte-level BPE through a sentencepiece model that is serialised from the ranks.

Every byte is mapped to a printable character of its own, every token becomes a
piece of such characters with the score ``-rank``, and the normaliser is the
identity; sentencepiece's BPE then merges exactly as the ranks order.  Text is
cut by the tokenizer's pattern and each match is encoded by itself.  Decoding
maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keyed, real_id

#: Pieces that stand before the vocabulary in the model: only the unknown piece.
OFFSET = 1
#: Entries of one generation of a worker's cache; there are two generations.
CACHE = 300_000
#: Pieces of text longer than this many characters are not cached.
CACHED_CHARS = 64
#: Pieces that are encoded at a time.
SLICE = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Token and rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else from U+0100 on in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One protocol-buffer field: int or bool as varint, float as 32 bits, the rest by length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model: piece id = position in rank order + OFFSET, score = -rank."""
    char = byte_characters()
    piece = [_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece.append(_field(1, _field(1, "".join(char[b] for b in token)) + _field(2, float(-rank)) + _field(3, 1)))
    # trainer: BPE, no begin, end or padding piece; normaliser: identity without any change of spaces
    trainer = _field(3, 2) + _field(4, len(piece)) + _field(40, 0) + b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    normaliser = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(piece) + _field(2, trainer) + _field(3, normaliser)


#: Places before a space that stands between two other characters.
CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?= [^\s\x1c-\x1f\x85])")


def odd(word: str) -> bool:
    """Whether a part after a space is empty or has white space at an end, so that the spaces beside it may not begin a match."""
    return not word or word[0].isspace() or word[-1].isspace()


class Cache:
    """What short strings are encoded to, bounded: a full generation replaces the one before."""

    def __init__(self, limit: int):
        self.new, self.old, self.limit = {}, {}, limit

    def fill(self, keys: set[str], make) -> dict:
        """Values of keys; make gets a list of those that aren't held."""
        new, old = self.new, self.old
        own = {k: x for k in keys if (x := new.get(k) or old.get(k)) is not None}
        fresh = [k for k in keys if k not in own]
        own.update(zip(fresh, make(fresh)) if fresh else ())
        new.update((k, x) for k, x in own.items() if len(k) <= CACHED_CHARS)
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return own


class ByteBPE:
    """Encoder and decoder over one rank file, with a bounded cache of encoded pieces."""

    def __init__(self, path: str, pattern: str, cache: int = CACHE):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.by_piece = [None] * OFFSET + sorted(ranks.values())
        self.token = {r: t for t, r in ranks.items()}
        self.number = {r: str(r) for r in ranks.values()}
        self.char = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(ranks))
        self.pieces, self.matches = Cache(cache), Cache(cache)

    def _merge(self, matches: list[str]) -> list[list[int]]:
        """Ids of each match.  A match that is a token is that token, as the rank library has it."""
        raw = [m.encode() for m in matches]
        out = [[r] if (r := self.ranks.get(b)) is not None else None for b in raw]
        todo = [i for i, x in enumerate(out) if x is None]
        if todo:
            mapped = [raw[i].decode("latin-1").translate(self.char) for i in todo]
            by_piece = self.by_piece
            for i, ids in zip(todo, self.model.encode(mapped, out_type=int, num_threads=1)):
                out[i] = [by_piece[x] for x in ids]
        return out

    def _encode_matches(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece, a piece being a run of whole matches."""
        found = list(map(self.pattern.findall, pieces))
        ids = self.matches.fill({m for x in found for m in x}, self._merge)
        return [ids[x[0]] if len(x) == 1 else [i for m in x for i in ids[m]] for x in found]

    def encode(self, text: str):
        """Yields lists of ids, which in a row are the text's ids."""
        words = text.split(" ")
        # a space between two other characters always begins a match: a match has a space only at its start or in a run of white space
        if words[0][-1:].isspace() or any(map(odd, set(words[1:]).difference(self.pieces.new))):
            pieces = iter(CUT.split(text))
            while part := list(islice(pieces, SLICE)):
                yield [i for x in self._encode_matches(part) for i in x]
            return
        yield [i for x in self._encode_matches(words[:1]) for i in x]
        for i in range(1, len(words), SLICE):
            part = words[i : i + SLICE]
            got = list(map(self.pieces.new.get, part))
            if None in got:
                own = self.pieces.fill({w for w, x in zip(part, got) if x is None}, lambda ws: self._encode_matches([" " + w for w in ws]))
                got = [own[w] if x is None else x for w, x in zip(part, got)]
            yield list(chain.from_iterable(got))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_LOADED: dict = {}


def load(path: str, pattern: str) -> ByteBPE:
    """The worker's encoder for a rank file."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBPE(path, pattern)
    return _LOADED[path, pattern]


def round_trip(path: str, pattern: str | None = None, with_ids: bool = False):
    """A function over Arrow batches of ``_d``, ``_t``: ids, their number and digest, and the digest of what they decode to."""

    def run(batches):
        import public_tokenizers

        bpe = load(path, pattern or public_tokenizers.PATTERN)
        for batch in batches:
            count, digest, decoded, all_ids = [], [], [], []
            for raw in batch.column("_t").to_pylist():
                a, b, n, own = hashlib.sha256(), hashlib.sha256(), 0, []
                for ids in bpe.encode(raw.decode("utf-8", "replace")):
                    if ids:
                        a.update(("," * bool(n) + ",".join(map(bpe.number.__getitem__, ids))).encode())
                        b.update(bpe.decode(ids))
                        n += len(ids)
                        if with_ids:
                            own += ids
                count.append(n)
                digest.append(a.hexdigest())
                decoded.append(b.hexdigest())
                all_ids.append(own)
            columns = [batch.column("_d"), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())]
            names = ["_d", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str | None = None, with_ids: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``.

    A null or empty text has no ids; the digests are then those of no bytes.
    Rows that repeat each get a row; other columns are not read; an empty table
    gives an empty result.  Texts are streamed in slices, so a very long one
    needs no more than its own characters.
    """
    schema = "_d long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    out = keyed(docs, text, doc_id).select("_d", "_t").mapInArrow(round_trip(path, pattern, with_ids), schema)
    return out.select(real_id().alias("doc_id"), *out.columns[1:])


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``text`` of a column of ids; null ids decode to an empty text, bytes that aren't UTF-8 to U+FFFD."""
    from pyspark.sql import functions as F

    def run(batches):
        token = {r: t for t, r in read_ranks(path).items()}
        for batch in batches:
            text = [b"".join(token[i] for i in x or ()).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")
