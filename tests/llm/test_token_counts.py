import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import token_counts
from millrace.llm.queries import tokenizer_path
from millrace.llm.token_counts import count_batch, count_tokens, op6_token_counts

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n▁é😀<s>\t", max_size=120))
def test_parts_add_up_to_the_whole(text):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PATH)
    before, token_counts.PART_BYTES = token_counts.PART_BYTES, 5
    try:
        model, lines = token_counts._model(PATH)
        parts = list(token_counts.split_safely(text, lines, 5))
        assert sum(len(model.encode(p)) - extra for p, extra in parts) == len(whole.encode(text))
    finally:
        token_counts.PART_BYTES = before


def test_long_texts(model):
    texts = ["word " * 40_000, "x" * 200_000, "line\n" * 50_000, " " * 100_000, ""]
    assert count_batch(texts, PATH) == [len(model.encode(t)) for t in texts]


def test_edges(sp, docs, no_docs, model):
    rows = count_tokens(docs.withColumnRenamed("n_chars", "n_tokens"), PATH).collect()
    assert len(rows) == 12
    for r in rows:
        assert r["n_tokens_"] == len(model.encode(r.text or "")) and r.n_bytes == len((r.text or "").encode())
        assert r.over_limit == (r["n_tokens_"] > 4096)
    assert op6_token_counts(sp, no_docs, PATH).collect() == []


def test_corpus(sp, sample, model):
    documents = sample("documents")
    want = {r.doc_id: len(model.encode(r.text)) for r in documents.collect()}
    assert {r.doc_id: r.n_tokens for r in op6_token_counts(sp, documents, PATH).collect()} == want
