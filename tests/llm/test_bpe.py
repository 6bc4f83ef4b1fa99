import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from evidora.llm import bpe, queries

PATH = P.path("byte_bpe_multi_50k.tiktoken")
PIECES = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "''", " ", "  ", "\n", "\t ", " ", "　", "a", "It", "é", "日本", "1", "²", "12", "#", "$$", "…", "́", "😀", "'S", "\r\n", "\x1c", "\x00", "\U000136e7", "\U00010d50", "\u1c89"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_file(PATH))


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(PIECES), st.characters(exclude_categories=["Cs", "Cn"])), max_size=20).map("".join), max_size=5))
def test_boundaries_are_the_patterns(texts):
    for text, (parts, offsets) in zip(texts, bpe.pieces(texts, bpe.classes()), strict=True):
        want = [(m.start(), m[0]) for m in regex.finditer(P.PATTERN, text)]
        assert list(zip(offsets.tolist(), parts, strict=True)) == want


def test_every_code_point_after_a_letter_a_number_and_a_mark(codec, library):
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for before in ("a", " a", "7", "#", " "):
        texts = ["".join(before + c + "a1# " for c in every[i : i + 4096]) for i in range(0, len(every), 4096)]
        for text, got in zip(texts, codec.encode(texts), strict=True):
            assert got.ids == library.encode_ordinary(text)


def test_like_the_library(codec, library):
    rng = random.Random(3)
    texts = ["", "aaaa" * 500, "#" * 3000, " " * 700, "'s" * 90, " \U000136e7a"] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 400))) for _ in range(400)]
    letters = [chr(c) for c in [*range(0x20, 0xD800), *range(0xE000, 0x20000)]]
    texts += ["".join(rng.choice(letters if rng.random() < 0.5 else PIECES) for _ in range(rng.randint(1, 9))) for _ in range(60_000)]
    for text, got in zip(texts, codec.encode(texts), strict=True):
        assert got.ids == library.encode_ordinary(text)
        assert codec.decode(got.ids) == text.encode() == b"".join(codec.slices(got, 7))


def test_stretches_are_decoded_by_their_offsets(spark, codec):
    text = "It's 12 naïve 日本語 tests, and  more\n"
    (got,) = codec.encode([text])
    for a in range(len(text)):
        for b in range(a, len(text) + 1):
            inside = [int(o) for o in got.offsets if a <= o < b]
            after = [int(o) for o in got.offsets if o >= b] + [len(text)]
            assert codec.between(got, a, b).decode() == (text[inside[0] : after[0]] if inside else "")
    encoded = bpe.encode(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), PATH)
    assert {r.doc_id: bytes(r.data).decode() for r in bpe.decode(encoded, PATH, 4, 9).collect()} == {1: " 12 naïve", 2: ""}


def test_query(spark, rows, sf_dir, library):
    got = {r.doc_id: r for r in queries.op5_byte_bpe(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256, got[doc_id].decoded_sha256) == want


def test_encode_decode_and_odd_inputs(spark, rows, docs, odd, empty):
    encoded = bpe.encode(docs, PATH)
    back = {r.doc_id: bytes(r.data).decode() for r in bpe.decode(encoded, PATH).collect()}
    assert back == {r[0]: r[1] or "" for r in rows}
    assert bpe.round_trip(empty, PATH).count() == 0
    assert bpe.round_trip(odd, PATH).count() == 2 * docs.count()
