"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

A batch of texts becomes one array of code points with a separator after each text. A table turns code points into
classes (letter, number, white space, other); white space and apostrophes are told apart by what follows them. Each
class is a function from scanner state to scanner state, and functions compose associatively: the batch is cut into
rows, the functions of all rows are composed column by column at once, the rows' results are chained, and a second
pass gives the state before every character. State and class say where a token begins. No regular expression is used.

The slices between beginnings go through a cache of merged pieces; a miss is merged by a heap of ranked pairs, so a
piece of any length takes n log n steps. Offsets (the code points where the pieces begin, and the ids before each) are
kept for decoding: any stretch of a text is decoded by itself, and a long text is decoded slice by slice.

The classes are those of the tiktoken library, whose Unicode tables may be newer than Python's: on the driver the
library is asked once which code points its pattern classes hold, and the table (a byte for each code point) is broadcast.

Defined cases: a null text counts as empty and has no tokens; repeated rows are encoded alike; texts of any length are
encoded whole; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import hold, values

#: Classes of characters. SPACE is a U+0020 that the next token takes in; LONE is other white space before a token;
#: RUN is white space before white space or the end; QUOTE2 and QUOTE3 are apostrophes before a contraction's letters.
LETTER, NUMBER, OTHER, SPACE, LONE, RUN, QUOTE2, QUOTE3, END = range(9)
#: States: START (the next character begins a token), in a LETTER, NUMBER or OTHER token, after a SPACE, in a RUN, and
#: one or two letters of a contraction to come.
_START, _LETTERS, _NUMBERS, _OTHERS, _TAKEN, _BLANKS, _LAST1, _LAST2 = range(8)
_SEPARATOR = 0xD800  # a lone surrogate: no text has one
_CHUNK = 64

#: The contractions of the public pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, begins a token) by class and state."""
    move, begins = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for kind, own in ((LETTER, _LETTERS), (NUMBER, _NUMBERS), (OTHER, _OTHERS)):
        move[kind] = own
        begins[kind, [own, _TAKEN]] = False
    move[LETTER, _LAST1], move[LETTER, _LAST2] = _START, _LAST1
    begins[LETTER, [_LAST1, _LAST2]] = False
    for kind, own in ((QUOTE2, _LAST1), (QUOTE3, _LAST2)):
        move[kind] = own
        move[kind, [_OTHERS, _TAKEN]] = _OTHERS
        begins[kind, [_OTHERS, _TAKEN]] = False
    move[SPACE], move[LONE], move[RUN], move[END] = _TAKEN, _START, _BLANKS, _START
    begins[RUN, _BLANKS] = False
    return move, begins


_MOVE, _BEGINS = _machine()


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, as the library has it; RUN stands for white space here."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}
    kind = np.full(0x110000, OTHER, np.uint8)
    for pattern, own in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", RUN)):
        found = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        kind[np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)] = own
    kind[_SEPARATOR] = END
    return kind


def _classes(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    kind = table[codes]
    after = np.append(kind[1:], np.uint8(END))
    blank, stands = kind == RUN, (after != RUN) & (after != END)
    kind[blank & stands] = LONE
    kind[blank & stands & (codes == 0x20)] = SPACE
    quotes = np.flatnonzero(codes == 0x27)
    if len(quotes):
        tail = np.append(codes, np.full(2, _SEPARATOR, codes.dtype))
        one, two = tail[quotes + 1], tail[quotes + 2]
        for text in CONTRACTIONS:
            hit = one == ord(text[1])
            if len(text) == 3:
                hit &= two == ord(text[2])
            kind[quotes[hit]] = QUOTE2 if len(text) == 2 else QUOTE3
    return kind


def boundaries(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The places where a token or a separator begins, by a scan of composed transition functions."""
    kind, n = _classes(codes, table), len(codes)
    rows = -(-n // _CHUNK)
    grid = np.full(rows * _CHUNK, END, np.uint8)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(rows, _CHUNK).T)
    flat = _MOVE.ravel()
    # compose the functions of each row, for all rows at once: whole[r, s] is the state after row r from state s
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in grid:
        whole = flat[(column[:, None].astype(np.intp) << 3) + whole]
    # chain the rows: doubling would do as well, but a row's function mostly is constant, which ends a chain
    entry = np.zeros(rows, np.uint8)
    constant = (whole == whole[:, :1]).all(1)
    entry[1:] = whole[:-1, 0]
    for r in np.flatnonzero(~constant[:-1]) + 1:
        entry[r] = whole[r - 1, entry[r - 1]]
    # second pass: the state before each character
    out, state = np.empty(grid.shape, bool), entry
    starts = _BEGINS.ravel()
    for j, column in enumerate(grid):
        at = (column.astype(np.intp) << 3) + state
        out[j] = starts[at]
        state = flat[at]
    return np.flatnonzero(out.T.ravel()[:n])


def pieces(texts: list[str], table: np.ndarray) -> Iterator[tuple[list[str], np.ndarray]]:
    """For each text its pre-tokens and the code points where they begin; ``table``: the classes."""
    joined = "".join(x + "\ud800" for x in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    places = boundaries(codes, table)
    ends = np.flatnonzero(codes[places] == _SEPARATOR)  # places that are separators
    first, base = 0, 0
    for text, last in zip(texts, ends.tolist(), strict=True):
        own = places[first : last + 1] - base
        edges = own.tolist()
        yield [text[a:b] for a, b in zip(edges, edges[1:], strict=False)], own[:-1]
        first, base = last + 1, base + len(text) + 1


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of ``piece``: the pair of the lowest rank is merged first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    n = len(piece)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    stop = list(range(1, n + 1))  # where the part that begins here stops
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or stop[j] != end:
            continue  # one of the two has been merged meanwhile
        alive[j], stop[i], after[i] = False, end, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i : stop[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop[after[i]]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[k:end])) is not None:
            heapq.heappush(heap, (r, k, end))
    return tuple(ranks[piece[i : stop[i]]] for i in range(n) if alive[i])


class Cache(dict):
    """Merged pieces by text; forgotten all at once beyond ``most`` entries, long pieces never kept."""

    def __init__(self, ranks: dict[bytes, int], most: int = 400_000):
        super().__init__()
        self.ranks, self.most = ranks, most

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = merge(piece.encode(), self.ranks)
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(2)
def _vocabulary(data: bytes) -> tuple[Cache, list[bytes], list[str]]:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    parts = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        parts[i] = piece
    return Cache(ranks), parts, [str(i) for i in range(len(parts))]


class Encoded(NamedTuple):
    """The ids of a text, and for each pre-token the code point where it begins and the number of ids before it."""

    ids: list[int]
    offsets: np.ndarray
    firsts: np.ndarray


class Codec:
    """Encodes and decodes with the ranks in ``data``, the content of a tiktoken vocabulary file, and the classes in ``table``."""

    def __init__(self, data: bytes, table: np.ndarray | None = None):
        self._cache, self._parts, self._numbers = _vocabulary(data)
        self._table = classes() if table is None else table

    def encode(self, texts: Iterable[str]) -> Iterator[Encoded]:
        """For each text its ids and offsets."""
        get = self._cache.__getitem__
        for parts, offsets in pieces(list(texts), self._table):
            found = list(map(get, parts))
            firsts = np.cumsum(np.fromiter(chain((0,), map(len, found)), np.int64, len(found) + 1))[:-1]
            yield Encoded(list(chain.from_iterable(found)), offsets, firsts)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self._parts.__getitem__, ids))

    def between(self, text: Encoded, start: int, end: int) -> bytes:
        """The decoded bytes of the pre-tokens that begin at the code points from ``start`` to ``end``, exclusive."""
        first, last = np.searchsorted(text.offsets, (start, end))
        stop = text.firsts[last] if last < len(text.firsts) else len(text.ids)
        return self.decode(text.ids[text.firsts[first] : stop]) if first < last else b""

    def slices(self, text: Encoded, step: int = 1 << 16) -> Iterator[bytes]:
        """The decoded bytes, slice by slice of about ``step`` code points, so that a long text is not held again."""
        for start in range(0, int(text.offsets[-1]) + 1 if len(text.offsets) else 0, step):
            yield self.between(text, start, start + step)

    def written(self, ids: Iterable[int]) -> str:
        return ",".join(map(self._numbers.__getitem__, ids))


def _groups(texts: Iterable[str | None], most: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters, so that a batch's arrays stay small."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _shared(frame: DataFrame, vocabulary: str):
    """The vocabulary file and the classes, read on the driver, as a broadcast variable: of the file's size and 1.1 MB."""
    return frame.sparkSession.sparkContext.broadcast((read_file(vocabulary), classes()))


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 for every row; one pass, no shuffle."""
    shared = _shared(docs, vocabulary)

    def run(batches):
        import pyarrow as pa

        hold("bpe", _vocabulary.cache_clear)
        codec = Codec(*shared.value)
        for batch in batches:
            n, ids_sha, back_sha = [], [], []
            for group in _groups(values(batch.column(1))):
                for encoded in codec.encode(group):
                    n.append(len(encoded.ids))
                    ids_sha.append(hashlib.sha256(codec.written(encoded.ids).encode()).hexdigest())
                    back = hashlib.sha256()
                    for part in codec.slices(encoded):
                        back.update(part)
                    back_sha.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """doc_id, ids (array of int), offsets (where the pre-tokens begin, in code points) and firsts (ids before each) for every row."""
    shared = _shared(docs, vocabulary)

    def run(batches):
        import pyarrow as pa

        hold("bpe", _vocabulary.cache_clear)
        codec = Codec(*shared.value)
        for batch in batches:
            rows = [x for group in _groups(values(batch.column(1))) for x in codec.encode(group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.ids for r in rows], pa.list_(pa.int32())), pa.array([r.offsets for r in rows], pa.list_(pa.int64())),
                                              pa.array([r.firsts for r in rows], pa.list_(pa.int64()))], ["doc_id", "ids", "offsets", "firsts"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>, firsts array<long>")


def decode(encoded: DataFrame, vocabulary: str, start: int = 0, end: int | None = None) -> DataFrame:
    """doc_id and the decoded bytes (``data``) of rows of ``encode``.

    Given ``start`` or ``end`` (code points), only the pre-tokens that begin between them are decoded, by the offsets.
    Null ids or offsets decode to no bytes.
    """
    shared = _shared(encoded, vocabulary)
    stop = 1 << 62 if end is None else end

    def run(batches):
        import pyarrow as pa

        hold("bpe", _vocabulary.cache_clear)
        codec = Codec(*shared.value)
        for batch in batches:
            rows = zip(*(values(batch.column(k)) for k in (1, 2, 3)), strict=True)
            data = [codec.between(Encoded(ids, np.asarray(o, np.int64), np.asarray(f, np.int64)), start, stop) if ids and o and f else b"" for ids, o, f in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select(F.col("doc_id").cast("long"), "ids", "offsets", "firsts").mapInArrow(run, "doc_id long, data binary")
