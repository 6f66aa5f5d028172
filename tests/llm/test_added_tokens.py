"""Strings of added tokens in texts become those tokens, as the library alone has it."""

from __future__ import annotations

import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scdstar.llm import tokencounts, tokenfiles
from scdstar.llm.encoder import Encoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALONE = {p: Tokenizer.from_file(str(p)) for p in (BYTES, WORDS)}
ENCODERS = {p: Encoder(open(p, encoding="utf-8").read()) for p in (BYTES, WORDS)}
END = "<|endoftext|>"
TEXT = st.lists(st.sampled_from([END, "<|startoftext|>", "<|", "|>", " ", " a", "b.", "\n", "é🙂", "endoftext"]), max_size=12).map("".join)


def alone(path: str, text: str):
    return ALONE[path].encode(text, add_special_tokens=False)


def test_the_string_is_one_token():
    assert ENCODERS[BYTES].encode([f"a {END} b"])[0].tolist() == [64, 220, 50256, 275]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_ids_and_spans_are_the_librarys(texts):
    for path, encode in ENCODERS.items():
        found = encode.encode(texts)
        assert [x.tolist() for x in found] == [alone(path, t).ids for t in texts]
        for text, ids in zip(texts, found):
            first, last = tokencounts.spans(text, encode, ids)
            assert list(zip(first.tolist(), last.tolist())) == alone(path, text).offsets


@pytest.mark.parametrize("text", [END, f"one {END} two", f"a{END}{END}\nb"])
def test_files_and_counts_of_texts_with_the_string(spark, tmp_path, text):
    docs = spark.createDataFrame([(1, text), (2, "plain text.")], "doc_id bigint, text string")
    tokenfiles.write_tokens(docs, BYTES, f"{tmp_path}/a", 2)
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in tokenfiles.read_tokens(spark, f"{tmp_path}/a").collect()}
    for i, t in ((1, text), (2, "plain text.")):
        ids = [*alone(BYTES, t).ids, 2]
        assert found[i] == (len(ids), zlib.crc32(b"".join(k.to_bytes(4, "little") for k in ids)))
    counted = tokencounts.token_counts(docs, BYTES, "start").filter("doc_id = 1").collect()
    assert sum(r.units for r in counted) == tokencounts.UNITS * len(alone(BYTES, text).ids)
