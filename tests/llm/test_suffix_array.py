import random

import numpy as np
import pytest

from evidora.llm import suffix_array as sa


def texts(rng):
    yield []
    for alphabet in (1, 2, 3, 20, 256):
        for n in (1, 2, 3, 10, 200, 1500):
            yield [rng.randrange(alphabet) for _ in range(n)]
    part = [rng.randrange(4) for _ in range(60)]
    yield part * 12
    yield [0] * 500
    yield list(range(200)) * 3


@pytest.mark.parametrize("induce", ["bucket", "entry"])
def test_order_and_prefixes(monkeypatch, induce):
    both = sa._induce_by_bucket if induce == "bucket" else sa._induce_by_entry
    monkeypatch.setattr(sa, "_induce_by_bucket", both)
    monkeypatch.setattr(sa, "_induce_by_entry", both)
    for text in texts(random.Random(4)):
        s = np.asarray([*(x + 1 for x in text), 0], np.int16)
        order = sa.suffix_array(s, 258)
        whole = s.tolist()
        assert order.tolist() == sorted(range(len(s)), key=lambda i: whole[i:])
        shared = sa.common_prefixes(s, order)
        for k in range(1, len(s)):
            a, b = whole[order[k - 1] :], whole[order[k] :]
            assert shared[order[k]] == next(i for i in range(len(s)) if a[i] != b[i])


def test_repeats():
    rng = random.Random(6)
    shared = bytes(rng.randrange(256) for _ in range(40))
    contexts = [bytes(rng.randrange(97, 99) for _ in range(rng.randint(0, 60))) for _ in range(40)] + [b"x" + shared + b"y", shared[3:], b"a" * 50]
    got = sa.repeats(contexts, 10)
    often: dict = {}
    for c in contexts:
        for i in range(len(c) - 9):
            often[c[i : i + 10]] = often.get(c[i : i + 10], 0) + 1
    assert [g.tolist() for g in got] == [[often[c[i : i + 10]] > 1 for i in range(len(c) - 9)] for c in contexts]
