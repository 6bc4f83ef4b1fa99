"""The documents table as a Spark data source that takes filters: a scan of a source or a time reads part of the files.

Format ``evidora_store`` with option ``version`` reads a snapshot of a table with a commit log. Filters on ``source`` and
``created_at`` are held against the statistics in the manifests, and only files that may have such rows become partitions; Spark
still applies every filter itself. Manifests and files are opened by Arrow, so the path has to be on a file system that
Arrow knows; ``operators.commits.Log.snapshot`` does the same through Spark's own reader. The session has to allow filters
for Python sources (``spark.sql.python.filterPushdown.enabled``).

As a stream it gives every commit once: the offset is the number of a commit, a batch has all commits since the last one, and
each of their files is a task of its own. A commit whose files are not in place yet waits. Batches have no limit, as a
Python source is asked for its latest offset before it is told where the stream stands.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from evidora.operators.commits import fold, manifest_name, touches
from evidora.schemas import TABLES


class StoredDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "evidora_store"

    def schema(self):
        return TABLES["documents"]

    def reader(self, schema) -> DataSourceReader:
        return _Stored(self.options["path"], int(self.options.get("version", "0")), schema)


    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Commits(self.options["path"], schema.names)


class _Table:
    """What both readers do: list the commits that are in place, and read a file."""

    def __init__(self, path: str, names: list[str]):
        self._path, self._names = path, names

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self._path) if "://" in self._path else (fs.LocalFileSystem(), self._path.removeprefix("file:"))

    def _newest(self) -> int:
        from pyarrow import fs

        files, base = self._fs()
        return max((int(i.base_name[:20]) for i in files.get_file_info(fs.FileSelector(f"{base}/_log")) if i.base_name.endswith(".done")), default=0)

    def _entry(self, version: int) -> dict:
        files, base = self._fs()
        with files.open_input_stream(f"{base}/{manifest_name(version)}") as stream:
            return json.loads(stream.read())

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        files, base = self._fs()
        with files.open_input_file(f"{base}/{partition.value}") as stream:
            for batch in pq.ParquetFile(stream).iter_batches(columns=self._names):
                columns = [batch.column(n) for n in self._names]
                yield pa.RecordBatch.from_arrays([c.cast(pa.timestamp("us", "UTC")) if pa.types.is_timestamp(c.type) else c for c in columns], self._names)


class _Commits(_Table, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": self._newest()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition(f["name"]) for v in range(start["version"] + 1, end["version"] + 1) for f in self._entry(v)["added"]]

    def commit(self, end: dict) -> None:
        """Nothing is kept for a batch that is done."""


class _Stored(_Table, DataSourceReader):
    def __init__(self, path: str, version: int, schema):
        super().__init__(path, schema.names)
        self._version = version
        self._sources: set[str] | None = None
        self._since: int | None = None
        self._until: int | None = None

    def pushFilters(self, filters: list) -> Iterable:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("source",):
                own = set(f.value) if isinstance(f, In) else {f.value}
                self._sources = own if self._sources is None else self._sources & own
            elif isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == ("created_at",):
                at = _micros(f.value)
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self._since = at if self._since is None else max(at, self._since)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self._until = at if self._until is None else min(at, self._until)
            yield f  # files are left out by it, rows are not

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f["name"]) for f in fold(self._entry, self._version or self._newest()) if touches(f, self._sources, self._since, self._until)]


def _micros(at: datetime) -> int:
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return int(at.timestamp()) * 1_000_000 + at.microsecond
