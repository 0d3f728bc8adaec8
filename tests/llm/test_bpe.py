import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm import bpe, queries, tokencount

from .conftest import order

PATH = queries.tokenizer_path(queries.RANKS)
ENCODER = bpe.ByteBPE(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENCODER.ranks, special_tokens={})


def ids(text):
    return [i for x in ENCODER.encode(text) for i in x]


def row(i, text):
    own = LIBRARY.encode_ordinary(text or "")
    return i, len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x1c\x85 　ab'sé1²,.日"), st.characters(exclude_categories=["Cs"])), max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_librarys(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids(text)) == text.encode()


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "don't 'll", "<|endoftext|> x", "x" * 20000, " " * 3000, "a b " * 40000, "\n \n a"])
def test_edges(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


def test_every_token_round_trips():
    assert all(ENCODER.decode([r]) == t for t, r in ENCODER.ranks.items())
    assert ENCODER.decode(range(len(ENCODER.ranks))) == b"".join(t for t, _ in sorted(ENCODER.ranks.items(), key=lambda x: x[1]))


def test_documents(docs, rows, empty, spark, sf, sf_rows):
    assert order(bpe.encode_documents(docs, PATH).collect()) == order(row(*r[:2]) for r in rows)
    assert order(queries.op2_bpe(spark, sf).collect()) == order(row(*r) for r in sf_rows)
    assert bpe.encode_documents(empty, PATH).count() == 0


def test_decoding_operator(docs, rows):
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH, with_ids=True), PATH)
    assert order(back.collect()) == order((i, t or "") for i, t, *_ in rows)


def test_cache_is_bounded():
    cache = bpe.Cache(10)
    for i in range(100):
        assert cache.fill({f"w{i}"}, lambda ws: [w.upper() for w in ws]) == {f"w{i}": f"W{i}"}
    assert len(cache.new) + len(cache.old) <= 24


JSON = tokencount.Json(queries.tokenizer_path(queries.COUNTED))


def whole(text):
    return len(JSON.model.encode(text, add_special_tokens=False).ids)


@given(st.text(alphabet=st.sampled_from(" \n\tab'é1,.日"), max_size=400), st.integers(8, 60), st.integers(1, 20))
@settings(max_examples=300, deadline=None)
def test_resynchronised_counts(text, chunk, overlap):
    assert tokencount.chunked_count(text, JSON.offsets, chunk, overlap) == whole(text) == JSON.short(text)


@given(st.text(alphabet=st.sampled_from(" \n'sab12½é。，’日本<|>endoftext"), max_size=400), st.integers(8, 60), st.integers(1, 20))
@settings(max_examples=300, deadline=None)
def test_resynchronised_counts_between_kinds(text, chunk, overlap):
    assert JSON.stable is not tokencount.STABLE
    assert tokencount.chunked_count(text, JSON.offsets, chunk, overlap, JSON.stable) == whole(text)


@pytest.mark.parametrize("text", ["日本語の文章。" * 9000, "Zm9vYmFy0aGk5" * 4000, "x" * 40_000, "a1<|endoftext|>2b" * 3000])
def test_texts_without_spaces_cost_in_proportion(text):
    """Characters that are encoded stay within a few times the text, where it has stable places and where it has none."""
    cost = []

    def offsets(part):
        cost.append(len(part))
        return JSON.offsets(part)

    assert tokencount.chunked_count(text, offsets, 1024, 64, JSON.stable) == whole(text)
    assert sum(cost) <= 6 * len(text)


@pytest.mark.parametrize("text", ["ab<|endoftext|>cd " * 300, "word " * 3000, "x" * 9000, " " * 500 + "a b c" * 900, "日本語" * 2000])
def test_resynchronised_counts_of_long_texts(text):
    assert tokencount.chunked_count(text, JSON.offsets, 256, 16) == whole(text) == JSON.short(text)


def test_counts(docs, rows, empty, spark, sf, sf_rows):
    want = lambda rs: order((i, len((t or "").encode()), n := whole(t or ""), n > 1024) for i, t in rs)
    path = queries.tokenizer_path(queries.COUNTED)
    assert order(tokencount.count_tokens(docs, path, chunk=300, overlap=16).collect()) == want(r[:2] for r in rows)
    assert order(queries.op10_tokens(spark, sf).collect()) == want(sf_rows)
    assert tokencount.count_tokens(empty, path).count() == 0


def test_counts_by_sentencepiece(docs, rows):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in tokencount.count_tokens(docs, path).collect()}
    assert all(got[i, len((t or "").encode())] == len(model.encode(t or "")) for i, t, *_ in rows)
