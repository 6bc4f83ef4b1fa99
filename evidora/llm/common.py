"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidora.shared import written

#: Characters that separate words, for use inside a Java or Python character class.
SPACE = r"\x20\x09-\x0D"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder (``evidora.shared.folder``) and read back from there."""
    return written(df)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def before(entries: Column, add: Callable[[Column, Column], Column] = lambda a, x: a + x, block: int = 128) -> Column:
    """For each entry of an array of non-negative numbers the sum (or other ``add`` from 0) of the entries before it.

    Sums of blocks, then within blocks: for n entries some n block / 2 + (n / block)^2 / 2 steps, and nothing is evaluated twice.
    """
    def summed(values: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(values) / block).cast("int"))
        wholes = F.transform(blocks, lambda b: F.aggregate(F.slice(values, b * block + 1, F.lit(block)), F.lit(0), add))
        bases = let(wholes, lambda w: F.transform(w, lambda _, b: F.aggregate(F.slice(w, F.lit(1), b), F.lit(0), add)))
        return let(bases, lambda base: F.transform(values, lambda _, i: F.aggregate(F.slice(values, i - i % block + 1, i % block), F.get(base, F.floor(i / block).cast("int")), add)))

    return let(entries, summed)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of ``text`` in order; a null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(parts, lambda w: w != "")


def values(column, step: int = 256) -> Iterator:
    """The Python values of an Arrow column, ``step`` at a time, so that a batch of long texts is not held twice."""
    for k in range(0, len(column), step):
        yield from column.slice(k, step).to_pylist()


#: Bits of a key filter for each key, at most in all, and those that one task sets.
FILTER_BITS, FILTER_MOST, FILTER_CHUNK = 16, 1 << 28, 1 << 20


def key_filter(wanted: DataFrame, key: str) -> Callable[[Column | str], Column] | None:
    """A test of a column against the column ``key`` (long, evenly spread) of ``wanted``: true for all that are there, and for few others.

    Rows that fail it need not be shuffled to meet ``wanted``. It holds a broadcast bit set, sized by a count; None where
    that would be more than ``FILTER_MOST`` bits, and joins have to do without.
    """
    keys = cut(wanted.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct())
    bits, step = max(FILTER_CHUNK, 1 << (FILTER_BITS * keys.count()).bit_length()), FILTER_CHUNK
    if bits > FILTER_MOST:
        return None

    def chunk(table):
        import numpy as np
        import pyarrow as pa

        slots = table.column("key").to_numpy() & (bits - 1)
        own = np.zeros(step, bool)
        own[slots & (step - 1)] = True
        return pa.table({"chunk": pa.array([int(slots[0]) // step], pa.int64()), "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    chunks = keys.groupBy(F.floor(F.col("key").bitwiseAND(F.lit(bits - 1)) / step).alias("at")).applyInArrow(chunk, "chunk long, bits binary")
    table = bytearray(bits // 8)
    for at, own in zip(*(c.to_pylist() for c in chunks.toArrow().columns), strict=True):  # FILTER_MOST / 8 bytes at most
        table[at * step // 8 : (at + 1) * step // 8] = own
    shared = wanted.sparkSession.sparkContext.broadcast(bytes(table))

    @F.pandas_udf("boolean")
    def there(keys):
        import numpy as np
        import pandas as pd

        slots = keys.fillna(0).to_numpy(np.int64) & (bits - 1)
        return pd.Series((np.frombuffer(shared.value, np.uint8)[slots >> 3] >> (slots & 7) & 1).astype(bool))

    return there


_holder: tuple[str, Callable[[], None]] = ("", lambda: None)


def hold(owner: str, clear: Callable[[], None] = lambda: None) -> None:
    """A Python worker keeps the caches of one operator: those of the one before are cleared, and their memory given back, when another begins."""
    global _holder
    if _holder[0] not in ("", owner):
        _holder[1]()
        release()
    _holder = (owner, clear)


def release() -> None:
    """Gives free memory back to the system, which the allocators of a Python worker keep otherwise."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def spared(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` (for ``mapInArrow``) that gives free memory back at the end of its task: workers wait idle, beside those of the next stage."""
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return inner


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sampled(df: DataFrame, count: int, *keys: str) -> DataFrame:
    """About ``count`` rows of ``df``, all if there are no more, chosen by a hash of ``keys``: a filter, so no task gathers them."""
    total = df.count()
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(0), *keys), 11) / float(1 << 53)
    return df if total <= count else df.filter(unit < count / total)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
