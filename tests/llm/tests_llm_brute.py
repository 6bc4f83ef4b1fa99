"""Plain versions of the pipeline's stages."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_kept(text):
    """The rules alone: no host of the fixture fails."""
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(words) >= 50 and 100 * len(hit) <= 50 * len(words)


def jaccard_components(texts, shingle, similarity):
    def grams(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set()

    sets = {i: grams(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if (len(x & y) >= similarity * len(x | y)) if x | y else True:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def without_repeats(texts, length):
    data = {i: (t or "").encode() for i, t in texts.items()}
    seen = Counter(t[k : k + length] for t in data.values() for k in range(len(t) - length + 1))
    out = {}
    for i, t in data.items():
        cover = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                cover[k : k + length] = b"\x01" * length
        out[i] = None if texts[i] is None else bytes(b for b, c in zip(t, cover, strict=True) if not c).decode(errors="ignore")
    return out
