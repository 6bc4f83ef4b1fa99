"""First arrivals of a stream by keyed state: rows too new for their source are delayed, never dropped.

A source may still bring rows of its newest ``LAG`` seconds, so a key whose row is that new is held in state and sent when a
timer of processing time says that it has come of age. Rows that are late go out at once. A key that has gone out is kept for
``KEEP`` seconds and its later versions are dropped; after that Spark removes it (its time to live), so state is bounded by the keys of that
time, and a later version meets the table's own anti-join.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from evidora.operators.store import KEY, append
from evidora.operators.windows import LAG
from evidora.schemas import DOCUMENT

#: Seconds for which a key that has gone out is remembered.
KEEP = 7 * 86_400
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _First(StatefulProcessor):
    def __init__(self, names: list[str], schema: str, lag_s: int, keep_s: int):
        self._names, self._schema, self._lag, self._keep = names, schema, lag_s * 1000, keep_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getValueState("held", self._schema)
        self._sent = handle.getValueState("sent", "sent boolean", self._keep)

    @staticmethod
    def _order(row: Row) -> tuple:
        return row["_at"] is not None, row["_at"] or 0, row["body"] is not None, row["body"] or ""

    def _row(self, values) -> Row:
        return Row(**dict(zip(self._names, values)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = min(rows, key=self._order)
        if self._sent.exists() or self._held.exists():
            return
        values = tuple(first[n] for n in self._names)
        due = 0 if first["_at"] is None else first["_at"] // 1000 + self._lag
        if due <= timerValues.getCurrentProcessingTimeInMs():
            self._sent.update((True,))
            yield self._row(values)
        else:
            self._held.update(values)
            self._handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._held.exists():
            row = self._held.get()
            self._held.clear()
            self._sent.update((True,))
            yield self._row(row)

    def close(self) -> None:
        """Nothing is open."""


def first_arrivals(documents: DataFrame, lag_s: int = LAG, keep_s: int = KEEP) -> DataFrame:
    """The stream ``documents`` with one row a key, none before it is ``lag_s`` seconds old.

    Of versions in one batch the first by time and body wins (nulls first), else the first to arrive. A row without a time is of age;
    rows without a whole key are left out, as normalisation has rejected and counted them. State needs RocksDB, which is set
    for the session.
    """
    documents.sparkSession.conf.set(_PROVIDER, _ROCKS)
    names = DOCUMENT.names
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DOCUMENT.fields)
    whole = documents.select(*names, F.unix_micros("created_at").alias("_at")).filter(F.col("source").isNotNull() & F.col("source_id").isNotNull())
    return whole.groupBy(*KEY).transformWithState(_First(names, schema, lag_s, keep_s), schema, "Append", "ProcessingTime")


def ingest_firsts(documents: DataFrame, table: str, checkpoint: str, name: str, every: str = "10 seconds", lag_s: int = LAG, keep_s: int = KEEP) -> StreamingQuery:
    """Runs until it is stopped and appends first arrivals; a batch that is replayed inserts nothing twice."""

    def insert(batch: DataFrame, _: int) -> None:
        batch.persist()  # read twice by the append; made again from the state of the batch where it is lost
        try:
            append(batch, table, ["source", "source_id", "created_at", "body"], datetime.datetime.now(datetime.timezone.utc))
        finally:
            batch.unpersist()

    sink = first_arrivals(documents, lag_s, keep_s).writeStream.outputMode("append").foreachBatch(insert)
    return sink.option("checkpointLocation", checkpoint).queryName(name).trigger(processingTime=every).start()
