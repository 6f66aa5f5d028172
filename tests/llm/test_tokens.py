from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scdstar.llm import rans, tokencounts, tokenfiles
from scdstar.llm.encoder import Encoder

from awkward import awkward, docs, none  # noqa: F401

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ENCODERS = {p: Encoder(open(p, encoding="utf-8").read()) for p in (BYTES, WORDS)}
TEXT = st.text(st.sampled_from(list("ab'.,!* \n\t\r 1é日🙂<|")) | st.characters(exclude_categories=["Cs"]), max_size=40)


def whole(path: str, text: str | None) -> list[int]:
    return ENCODERS[path].library.encode_batch_fast([text or ""], add_special_tokens=False)[0].ids


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_cached_units_encode_as_whole_texts(texts):
    for path, encode in ENCODERS.items():
        assert [x.tolist() for x in encode.encode(texts)] == [whole(path, t) for t in texts]


def test_words_at_line_breaks_are_encoded_once(monkeypatch):
    encode = Encoder(open(BYTES, encoding="utf-8").read())
    encode.encode(["one.\nTwo, one"])
    text, asked = "one, one.\nTwo.\nTwo, one", []
    monkeypatch.setattr(encode, "_whole", asked.append)
    assert encode.encode([text])[0].tolist() == whole(BYTES, text) and not asked


def test_every_low_character_starts_and_ends_pieces_as_in_whole_texts():
    texts = [t.replace("x", chr(k)) for k in range(0x260) for t in ("x", "axb", "a x1xx x", "'sx 'x'llx", "x  x\n\nx \n")]
    found = ENCODERS[BYTES].encode(texts)
    assert [x.tolist() for x in found] == [whole(BYTES, t) for t in texts]


def test_a_small_cache_starts_anew_without_harm(monkeypatch):
    monkeypatch.setattr("scdstar.llm.encoder.KEPT", 5)
    encode = Encoder(open(BYTES, encoding="utf-8").read())
    texts = [t for _, t in awkward() if t and len(t) < 5000]
    for _ in range(2):
        for k in range(0, len(texts), 3):
            part = texts[k : k + 3]
            assert [x.tolist() for x in encode.encode(part)] == [whole(BYTES, t) for t in part]


@given(st.lists(st.integers(0, 50), max_size=3000), st.integers(1, 8))
def test_blocks_decode_to_what_was_coded(ids, copies):
    ids = np.array(ids * copies, np.uint32)
    table = rans.Table(rans.quantized(np.bincount(ids, minlength=60)))
    block = rans.encode(ids, table, [3, None], [len(ids), 0])
    docs, sizes, back = rans.decode(block, table)
    assert docs == [3, None] and sizes.tolist() == [len(ids), 0] and back.tolist() == ids.tolist()


def test_segments_decode_alone_and_damage_is_noticed():
    ids = np.random.default_rng(1).zipf(1.4, 400_000).clip(1, 999).astype(np.uint32)
    table = rans.Table(rans.quantized(np.bincount(ids, minlength=1000)))
    block = rans.encode(ids, table, [1], [len(ids)])
    assert len(block) * 8 < len(ids) * 8  # well under a byte an id
    per = rans.STEPS * rans.LANES
    for k in range(-(-len(ids) // per)):
        found = rans.decode(block, table, range(k, k + 1))[2]
        assert found.tolist() == ids[k * per : (k + 1) * per].tolist()
    for at in (4, 60, len(block) - 3):
        with pytest.raises(ValueError):
            rans.decode(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :], table)


def test_files_of_awkward_rows(spark, docs, none, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK", 700)  # many blocks, and texts longer than one
    tokenfiles.write_tokens(docs, BYTES, f"{tmp_path}/a", 2)
    found = sorted(tokenfiles.read_tokens(spark, f"{tmp_path}/a").collect(), key=lambda r: r.start)
    expected, at = Counter(), 0
    for i, t in awkward():
        ids = np.array([*whole(BYTES, t), 2], "<u4")
        expected[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == expected
    for r in found:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    tokenfiles.write_tokens(none, BYTES, f"{tmp_path}/b", 2)
    assert tokenfiles.read_tokens(spark, f"{tmp_path}/b").count() == 0


@settings(max_examples=300, deadline=None)
@given(TEXT, st.sampled_from(tokencounts.RULES))
def test_spans_and_rules(text, rule):
    for path, encode in ENCODERS.items():
        ids = encode.encode([text])[0] if encode.byte_level else None
        first, last = tokencounts.spans(text, encode, ids)
        offsets = encode.library.encode_batch([text], add_special_tokens=False)[0].offsets
        assert list(zip(first.tolist(), last.tolist())) == offsets
        line = [text[:k].count("\n") for k in range(len(text))]
        expected = [0] * (text.count("\n") + 1)
        for a, b in offsets:
            counted = Counter(line[a:b])
            if b <= a:
                return  # a token without text, which normalization can make
            if rule == "start":
                expected[line[a]] += tokencounts.UNITS
            elif rule == "most":
                expected[min(counted, key=lambda s: (-counted[s], s))] += tokencounts.UNITS
            else:
                shares = {s: n * tokencounts.UNITS // (b - a) for s, n in counted.items()}
                shares[min(shares)] += tokencounts.UNITS - sum(shares.values())
                for s, n in shares.items():
                    expected[s] += n
        assert tokencounts.allocate(first, last, tokencounts.lines(text), rule).tolist() == expected


def test_counts_add_up_for_awkward_rows_and_given_sections(spark, docs, none):
    for path in (BYTES, WORDS):
        for rule in tokencounts.RULES:
            found = tokencounts.token_counts(docs, path, rule).collect()
            assert len(found) == sum((t or "").count("\n") + 1 for _, t in awkward())
            assert sum(r.units for r in found) == tokencounts.UNITS * sum(
                len(whole(path, t)) for _, t in awkward()
            )
    text = "head line\nbody text here\ntail"
    rows = spark.createDataFrame(
        [(1, text, [("body", 10, 24), ("title", 0, 9)]), (2, text, []), (3, None, [("x", 0, 5)]), (4, text, None)],
        "doc_id bigint, text string, sections array<struct<name: string, start: bigint, end: bigint>>",
    )
    found = tokencounts.token_counts(rows, BYTES, "start").collect()
    one = {(r.section, r.name): r.units // tokencounts.UNITS for r in found if r.doc_id == 1 and r.section >= 0}
    assert one == {(1, "title"): len(whole(BYTES, "head line")), (0, "body"): len(whole(BYTES, "body text here"))}
    assert sum(r.units for r in found if r.doc_id == 2) == tokencounts.UNITS * len(whole(BYTES, text))
    assert tokencounts.token_counts(none, BYTES).count() == 0
