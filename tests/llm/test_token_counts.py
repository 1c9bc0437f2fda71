import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from doclake.llm.token_counts import TokenCounter, count_tokens, load_merges

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = TokenCounter(*load_merges(PATH))


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdlrve\x1c\x85　a<|>")), max_size=60))
def test_like_the_library(text):
    assert COUNTER.count(text) == library(text)


def test_special_strings_and_runs():
    for text in ("<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", " " * 70 + "x", "ab" * 5000, "I'LL i'll 'S"):
        assert COUNTER.count(text) == library(text)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: (len((r.text or "").encode()), library(r.text)) for r in docs.collect()}
    rows = count_tokens(docs, PATH).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_odd_rows(odd_docs, no_docs):
    got = sorted((r.n_bytes, r.n_tokens) for r in count_tokens(odd_docs, PATH).collect())
    assert got == sorted((len((r.text or "").encode()), library(r.text)) for r in odd_docs.collect())
    assert count_tokens(no_docs, PATH).count() == 0
