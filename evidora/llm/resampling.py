"""Quality by importance resampling.

Two generative models over hashed word and word-pair counts, one of target text (documents labelled good) and one of
all raw text, give each document the log of its importance: the sum over its n-grams of log target / raw probability.
Gumbel noise hashed from doc_id and text is added, and a share of the documents with the largest keys is kept, which is
a sample without replacement in proportion to the importance. The share is that of good documents among all labels. With
half of the labels of sf0.1 held out, it keeps 99.2 % of the good and 1.3 % of the bad ones; the mean log ratio times 30,
used before, kept 99.0 % and 3.0 %.

The raw model counts every document; the target model is fitted on about ``TARGET_DOCS`` labelled documents (picked
by hash; all if there are fewer). Tasks add up counts in one array of ``BUCKETS`` numbers each. The k-th largest key is
found by counting keys in ``BINS`` intervals and looking into the one that holds it, again and again; no more than
``LAST`` keys ever gather in one place.

Defined cases: a null text counts as empty; a text without n-grams has importance 0, as has every text where there is
no target; without any label all rows are kept, and with labels of which none is good no row is; equal rows have equal
keys and are kept or not together; rows without a doc_id have noise of their own by their text; labels of doc_ids that
are not there don't matter; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import cut, hold, sampled, values

#: Production parameters.
BUCKETS = 1 << 16
TARGET_DOCS = 20_000
SMOOTHING = 1.0
SEED = 11
BINS = 1024
LAST = 4096
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class _Numbers(dict):
    """Hashes of tokens; forgotten all at once when there are many."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[token] = zlib.crc32(token.encode())
        return value


_NUMBERS = _Numbers()


def features(text: str | None) -> np.ndarray:
    """The buckets of the tokens and of the pairs of neighbouring tokens of the lower-cased text."""
    tokens = _TOKEN.findall((text or "").lower())
    words = np.fromiter(map(_NUMBERS.__getitem__, tokens), np.uint64, len(tokens))
    pairs = (words[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words[1:]) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)
    return np.concatenate([words, pairs]) % np.uint64(BUCKETS)


def models(docs: DataFrame, labels: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket of the target and of all text."""
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("_good")).distinct()
    chosen = F.broadcast(sampled(good, TARGET_DOCS, "_good"))  # about TARGET_DOCS ids
    rows = docs.select("doc_id", F.col(text).alias("_text")).join(chosen, F.col("doc_id") == F.col("_good"), "left")

    def run(batches):
        import pyarrow as pa

        hold("resampling", _NUMBERS.clear)
        target, raw = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for body, is_target in zip(values(batch.column(0)), values(batch.column(1)), strict=True):
                counts = np.bincount(features(body).astype(np.int64), minlength=BUCKETS)
                raw += counts
                if is_target:
                    target += counts
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(target[at]), pa.array(raw[at])], ["bucket", "target", "raw"])

    counted = rows.select("_text", F.col("_good").isNotNull().alias("_target")).mapInArrow(run, "bucket long, target long, raw long")
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.groupBy("bucket").agg(F.sum("target").alias("t"), F.sum("raw").alias("r")).collect():  # BUCKETS rows at most
        target[r.bucket], raw[r.bucket] = r.t, r.r
    return target, raw


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(len(raw))
    p, q = target + SMOOTHING, raw + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def score(docs: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """doc_id, mark (a hash of the text), n_features and importance for every row; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        import pyarrow as pa

        hold("resampling", _NUMBERS.clear)
        for batch in batches:
            count, weight = [], []
            for f in map(features, values(batch.column(2))):
                count.append(len(f))
                weight.append(float(shared.value[f].sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(count, pa.int64()), pa.array(weight, pa.float64())], ["doc_id", "mark", "n_features", "importance"])

    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col("doc_id").cast("long"), mark, F.col(text)).mapInArrow(run, "doc_id long, mark long, n_features long, importance double")


def gumbel(*cols: Column | str) -> Column:
    """Gumbel noise hashed from ``cols``."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(unit))


def kth_largest(keyed: DataFrame, k: int, key: str = "key") -> float:
    """The k-th largest of the keys (k from 1 to their number), by histograms of ever narrower intervals."""
    value = F.col(key)
    low, high = keyed.agg(F.min(key), F.max(key)).first()
    while True:
        inside = keyed.filter(value.between(low, high))
        above, there = keyed.agg(F.count_if(value > high), F.count_if(value.between(low, high))).first()
        if there <= LAST:
            return sorted((r[0] for r in inside.select(key).collect()), reverse=True)[k - above - 1]
        width = (high - low) / BINS
        if width <= 1e-15 * max(abs(low), abs(high)):
            return low  # equal keys, but for the last digit
        bins = inside.groupBy(F.floor((F.lit(high) - value) / width).alias("bin")).agg(F.count("*").alias("n"))
        for b, n in sorted(map(tuple, bins.collect())):  # BINS + 1 rows at most, from the largest keys down
            if above + n >= k:
                break
            above += n
        low, high = max(low, high - (b + 1) * width - width * 1e-6), min(high, high - b * width + width * 1e-6)


def resample(docs: DataFrame, labels: DataFrame, keep: float | None = None, text: str = "text") -> DataFrame:
    """doc_id, n_features, importance, key and kept for every row.

    ``keep`` is the share of rows to keep; if None, the share of good ones among the labels. Rows whose key equals the
    last one kept are kept too.
    """
    if keep is None:
        share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        keep = 1.0 if share is None else share
    scored = score(docs, log_ratio(*models(docs, labels, text)), text)
    keyed = cut(scored.withColumn("key", F.col("importance") + gumbel("doc_id", "mark")).drop("mark"))
    count = round(keep * keyed.count())
    return keyed.withColumn("kept", F.col("key") >= kth_largest(keyed, count) if count else F.lit(False))
