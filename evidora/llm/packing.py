"""Best-fit decreasing packing of tokenised documents into sequences of a fixed length.

Only documents longer than a sequence are cut. The pieces then have at most ``capacity`` different lengths, so all that
best-fit decreasing looks at is the histogram of lengths: it is summed over the whole corpus and its ``capacity`` rows
at most go to the driver. There the pieces of one length are placed together, longest first: a segment tree over the
remaining capacities finds the tightest open bins in logarithmic time, and the pieces of the length that best-fit
decreasing would put there one by one go into them in one step. The result is its packing, written as steps (length,
first rank, bins, pieces a bin, first bin, offset). A step list has at most some ten thousand entries whatever
the size of the corpus, and is broadcast.

Executors rank the pieces of each length and look up bin and offset. The rank is taken inside small groups, whose
offsets are summed up by length, so a length that a third of all pieces has is not gathered in one task.

Where the definition has the normaliser and the splitter below, tokens of a text are those of its parts between single
spaces and line breaks, since no pre-token and no normalisation reaches across white space; parts are cached, so the
tokenizer library sees each part once a worker. Texts of any other definition go to the library whole.

Defined cases: a null text counts as empty and is one piece with the end token alone; repeated rows (equal doc_id and
text too) are packed as rows of their own; a null doc_id is kept; texts of any length are packed whole; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidora.llm.common import cut, hold, values

#: Production parameters.
CAPACITY = 4096
END_ID = 1
#: Pieces of one length that a ranking task takes, on average.
GROUP_PIECES = 4096
#: Parts of texts that a generation of a worker's cache holds.
PARTS = 600_000


#: The normaliser and the splitter for which texts may be taken apart.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_MARKS = ".,;:!?"


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, by the tokenizers library with a cache of parts.

    The cache has two generations of at most ``most`` parts each: a full one becomes the old one, and a part found there
    comes back. A part that ends in a lone mark is put together from the two where the library itself splits the mark
    off the character before it, and a part is looked up in lower case where the library's own normalisation would do
    no more than that. ``apart`` is False for definitions with another normaliser, splitter or post-processor.
    """

    def __init__(self, definition: str, most: int = PARTS):
        from tokenizers import Tokenizer

        rules = json.loads(definition)
        added = all(" " not in t["content"] and "\n" not in t["content"] and t["content"][:2] == "<|" and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in rules["added_tokens"])
        plain = not (rules["truncation"] or rules["padding"] or rules["post_processor"])
        self.apart = added and plain and rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == SPLITTER
        self._library, self._new, self._old, self._most = Tokenizer.from_str(definition), {"": b""}, {}, most
        self._splits: dict[str, bool] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, part: str, low: str) -> bool:
        normal = unicodedata.is_normalized
        return "<|" not in part and "\u03a3" not in part and normal("NFC", part) and normal("NFC", low)

    def _split_off(self, before: str) -> bool:
        """Whether the library begins a new pre-token at a mark that follows the letter ``before``."""
        known = self._splits.get(before)
        if known is None:
            pieces = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(before + "."))
            known = self._splits[before] = before.isalpha() and [p for p, _ in pieces][-1:] == ["."]
        return known

    def _part(self, part: str) -> bytes:
        ids = self._new.get(part)
        if ids is not None:
            return ids
        ids = self._old.get(part)
        if ids is None:
            if len(part) > 1 and part[-1] in _MARKS and self._split_off(part[-2]):
                ids = self._part(part[:-1]) + self._part(part[-1])
            elif (low := part.lower()) != part and self._plain(part, low):
                ids = self._part(low)
            else:
                ids = self._whole(part)
        if len(part) <= 64:
            if len(self._new) >= self._most:
                self._old, self._new = self._new, {}
            self._new[part] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if not self.apart:
            return self._whole(text)
        out, get = [], self._new.get
        for part in text.replace("\n", " ").split(" "):
            ids = get(part)
            if ids is None:
                ids = self._part(part)
                get = self._new.get
            out.append(ids)
        return b"".join(out)


@lru_cache(2)
def _encoder(definition: str, most: int) -> Encoder:
    return Encoder(definition, most)


def cut_pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", parts: int = PARTS) -> DataFrame:
    """doc_id, row (its number), piece, start, length and ids_crc32: every document's ids, cut only where it is too long."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # the size of the vocabulary file
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa

        hold("packing", _encoder.cache_clear)
        encode = _encoder(shared.value, parts)
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            for doc, body in zip(values(batch.column(0)), values(batch.column(1)), strict=True):
                ids = encode(body or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Tightest:
    """A segment tree over the remaining capacities 0 to ``capacity`` that have open bins."""

    def __init__(self, capacity: int):
        self._base = 1 << capacity.bit_length()
        self._any = bytearray(2 * self._base)

    def set(self, room: int, there: bool) -> None:
        i = self._base + room
        self._any[i] = there
        while i > 1:
            i >>= 1
            there = self._any[2 * i] or self._any[2 * i + 1]
            if self._any[i] == there:
                break
            self._any[i] = there

    def at_least(self, room: int) -> int | None:
        """The smallest capacity of ``room`` or more that has an open bin."""
        i = self._base + room
        if self._any[i]:
            return room
        while i > 1:  # climb until a right neighbour has one
            if not i & 1 and self._any[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return None
        while i < self._base:
            i = 2 * i if self._any[2 * i] else 2 * i + 1
        return i - self._base


@dataclass(frozen=True)
class Step:
    """Pieces of ``length`` and ranks from ``first`` on go to ``bins`` bins from ``bin`` on: ``each`` a bin, from ``offset`` on."""

    length: int
    first: int
    bins: int
    each: int
    bin: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Iterator[Step]:
    """Best-fit decreasing over a histogram of lengths from 1 to ``capacity``.

    A bin that is the tightest stays the tightest while another piece of the length fits, so it takes all that fit.
    """
    tree, open_bins, bins = Tightest(capacity), {}, 0  # open_bins: remaining capacity -> ranges (first bin, count)
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.at_least(length)
            each = min(left, (capacity if room is None else room) // length)
            if room is None:
                room, at, there = capacity, bins, left // each
                bins += there
            else:
                at, there = open_bins[room].pop()
            used = min(there, left // each)
            if used < there:
                open_bins[room].append((at + used, there - used))
            if room < capacity and not open_bins[room]:
                tree.set(room, False)
            yield Step(length, rank, used, each, at, capacity - room)
            if rest := room - each * length:
                open_bins.setdefault(rest, []).append((at, used))
                tree.set(rest, True)
            left, rank = left - used * each, rank + used * each


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", parts: int = PARTS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset for every piece of every row; ``parts`` bounds a worker's cache, not the result."""
    pieces = cut(cut_pieces(docs, definition, capacity, end_id, text, parts))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # ``capacity`` rows at most
    # ranks: a length is dealt to as many groups as its pieces need; the constant below has a number for each length
    groups = F.split(F.lit(",".join(str(-(-histogram.get(n, 0) // GROUP_PIECES) or 1) for n in range(capacity + 1))), ",").cast("array<int>")
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(groups, F.col("length").cast("int"))))
    counts = grouped.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    steps = list(plan(histogram, capacity))
    spark = docs.sparkSession
    table = {}
    for s in steps:
        table.setdefault(s.length, []).append((s.first, s.bin, s.offset, s.each))
    shared = spark.sparkContext.broadcast({k: np.asarray(v, np.int64) for k, v in table.items()})
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("length", "_group", F.coalesce(before, F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = grouped.withColumn("_inner", inner).join(offsets, ["length", "_group"]).withColumn("_rank", F.col("_before") + F.col("_inner") - 1)

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(own):
                    known = shared.value[int(length[own[0]])]
                    at = np.searchsorted(known[:, 0], rank[own], "right") - 1
                    nth, each = rank[own] - known[at, 0], known[at, 3]
                    sequence[own] = known[at, 1] + nth // each
                    offset[own] = known[at, 2] + nth % each * length[own]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "_rank"]
    return ranked.select(*columns).mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
