"""Incremental ingest as a stream: captured documents in, idempotent appends out, the checkpoint as cursor."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from evidora.operators.store import append
from evidora.schemas import DOCUMENT

DOCUMENTS = "source string, source_id string, url string, author_handle string, title string, body string, created_at timestamp, engagement string, raw string"


class PagedStream(DataSource):
    """Format ``evidora_pages``: option ``pages`` is a JSON list of pages, each a list of [source, source_id, body].

    The offset is the number of the next page. It only grows, and a page read again gives the same rows.
    """

    @classmethod
    def name(cls) -> str:
        return "evidora_pages"

    def schema(self) -> str:
        return "page long, pos long, source string, source_id string, body string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Pages(json.loads(self.options.get("pages", "[]")), int(self.options.get("pagesPerBatch", "1")))


class _Pages(SimpleDataSourceStreamReader):
    def __init__(self, pages: list, step: int):
        self._pages, self._step = pages, step

    def initialOffset(self) -> dict:
        return {"page": 0}

    def _rows(self, start: int, end: int):
        return iter([(k, p, *row) for k in range(start, end) for p, row in enumerate(self._pages[k])])

    def read(self, start: dict):
        end = min(len(self._pages), start["page"] + self._step)
        return self._rows(start["page"], end), {"page": end}

    def readBetweenOffsets(self, start: dict, end: dict):
        return self._rows(start["page"], end["page"])


def captured(spark: SparkSession, folder: str, per_batch: int = 1) -> DataFrame:
    """A stream over JSON documents that land as files in ``folder``."""
    return spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", per_batch).json(folder)


def ingest_stream(documents: DataFrame, table: str, checkpoint: str, name: str, ingested_at: str) -> StreamingQuery:
    """Appends what is there and ends. ``name`` is one a source, so a second query of the source can't run beside it in
    this session; ``lease.Lease`` keeps other processes out.

    A batch that is replayed after a failure inserts nothing twice: its keys are there already.
    """

    def insert(batch: DataFrame, _: int) -> None:
        append(batch.select(*DOCUMENT.names), table, ["source", "source_id", "created_at", "body"], ingested_at)

    return documents.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).queryName(name).trigger(availableNow=True).start()
