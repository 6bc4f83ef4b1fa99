import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from evidora.llm import packing, queries

PATH = P.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Best-fit decreasing, piece by piece."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms[rooms.index(min(fits))] -= x
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 50, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))] + [rng.randint(1, capacity)] * rng.randint(0, 100)
    histogram = defaultdict(int)
    for x in lengths:
        histogram[x] += 1
    bins, ranks = defaultdict(list), defaultdict(set)
    for s in packing.plan(histogram, capacity):
        for k in range(s.bins * s.each):
            bins[s.bin + k // s.each].append((s.offset + k % s.each * s.length, s.length))
            ranks[s.length].add(s.first + k)
    assert {k: len(v) for k, v in ranks.items()} == dict(histogram)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(x for _, x in b) for b in bins.values()) == one_by_one(lengths, capacity)


def check(got, rows):
    library = Tokenizer.from_file(PATH)
    pieces, bins = defaultdict(dict), defaultdict(list)
    for r in got:
        pieces[r.doc_id][r.piece] = r
        bins[r.sequence_id].append((r.offset, r.length))
    for doc_id, text, *_ in rows:
        ids = np.asarray([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = [pieces[doc_id][k] for k in range(len(pieces[doc_id]))]
        assert len(own) == -(-len(ids) // 4096) and [r.start for r in own] == list(range(0, len(ids), 4096))
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert all(r.length == 4096 for r in own[:-1]) and sum(r.length for r in own) == len(ids)
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(x for _, x in parts[:k]) for k in range(len(parts))] and sum(x for _, x in parts) <= 4096
    assert len(bins) == len(one_by_one([r.length for r in got], 4096))


def test_query(spark, rows, sf_dir):
    check(queries.op4_best_fit_packing(spark, sf_dir).collect(), rows)


def test_texts_that_a_cache_of_parts_could_spoil(spark):
    texts = ["don't stop\tnow", "<|endoftext|>x <|startoftext|> y", "é ́a ΑΣ ΣΑΣ. İstanbul ǅ", " \n\r\x0b\x1c a", "word" * 3000, "İ" * 40, "ΟΔΟΣ\nΟΔΟΣ ΟΔΟΣ", "  two  spaces ", "J\u030c \u01f0 J\u030cx.", "<|ENDOFTEXT|> <|EndOfText|>.", "Word, WORD. word: don't. DON'T! x'S. 's, É. É, Straße; STRASSE"]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check(packing.pack(frame, open(PATH).read()).collect(), rows)


def fuzzed(rng):
    """Random strings of letters that change under normalisation, marks, digits, white space and special tokens."""
    odd = ["\u0130", "\u0130stanbul", "\u0958", "\u0340", "\u1e9e", "\u212a", "\u0345", "\u03a3", "\u1f80", "\u1100", "\u1161", "\u11a8", "\u0f73", "\u2126", "\ufb01", "\u0149", "\u10a0", "\u13a0", "\U00010d50", "\U000136e7", "\u0301", "\u0307", "\u093c", "\u200d"]
    plain = [*"abzABZ09", "don't", "'S", "'ll", "x", "<|endoftext|>", "<|", "|>", "\t", "\r\n", "\u3000", "\u00a0"]
    pools = [odd, plain, list(".,;:!?"), [" ", "\n"]]
    def one(_):
        return rng.choice(rng.choice(pools)) if rng.random() < 0.9 else chr(rng.choice([rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x20000)]))
    return "".join(map(one, range(rng.randint(1, 9))))


def test_marks_after_letters_that_change():
    encode, library = packing.Encoder(open(PATH).read()), Tokenizer.from_file(PATH)
    assert encode.apart
    rng = random.Random(23)
    every = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if c.isalpha()][::3]
    texts = ["\u0130,", "\u0130stanbul\u0130.", "\u0958!"] + [c + rng.choice(".,;:!?") for c in every] + [fuzzed(rng) for _ in range(60_000)]
    bad = [t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True) if encode(t) != np.asarray(e.ids, "<u4").tobytes()]
    assert not bad, bad[:20]


def test_another_definition_goes_to_the_library_whole():
    import json

    other = json.loads(open(PATH).read())
    other["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    other = json.dumps(other)
    encode, library = packing.Encoder(other), Tokenizer.from_str(other)
    assert not encode.apart
    for text in ["a b", " x.", "\u0130, no", "two\n lines."]:
        assert encode(text) == np.asarray(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_odd_inputs(odd, docs, empty):
    definition = open(PATH).read()
    assert packing.pack(empty, definition).count() == 0
    once, twice = packing.pack(docs, definition).collect(), packing.pack(odd, definition).collect()
    assert len(twice) == 2 * len(once) == len({(r.sequence_id, r.offset) for r in twice})


def test_hot_length_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 7)
    rows = [(i, "same text" if i % 3 else f"text {i} " * (i % 40)) for i in range(300)]
    check(packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), open(PATH).read()).collect(), rows)


def test_a_worker_gives_memory_back_when_another_operator_begins(monkeypatch):
    from evidora.llm import common

    done = []
    monkeypatch.setattr(common, "_holder", ("", lambda: None))
    monkeypatch.setattr(common, "release", lambda: done.append("released"))
    common.hold("a", lambda: done.append("cleared"))
    common.hold("a", lambda: done.append("cleared"))
    assert done == []
    common.hold("b")
    assert done == ["cleared", "released"]
    assert list(common.spared(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3] and done[2:] == ["released"]
