"""Captured searches as a partitioned stream, whose offset never claims a second that has not been read whole.

A client searches outside of tasks and records each read in a folder (``record``): files of hits, then a numbered entry with the read's
query, bounds, whether it was capped, and the earliest second at which an item could not be had. Format ``evidora_searches`` (option
``path``) streams them. The offset is the number of the last entry and each query's mark, the second up to which it is covered:

* an uncapped read covers its whole window;
* a capped one may have been cut inside its newest second, so it covers up to the second newest one, or nothing;
* a transient failure holds the mark before its second;
* a read that begins beyond the mark would leave a hole, so it covers nothing.

A batch has the hits between the old and new marks, a task for each file. Hits beyond a mark come with the next read, which
begins there (``marks``). ``readsPerBatch`` limits a batch; as Spark does not tell a Python source where the stream stands when it
asks for the latest offset, the position is then kept in the file of option ``progress`` (one for each query that runs).
It is written when a batch is planned, and a batch whose offset is logged is always planned before the next offset is asked for,
so after a restart the file stands where Spark's own log does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from evidora.errors import EvidenceError
from evidora.operators.commits import Files


class SearchLogError(EvidenceError):
    code = "SEARCH_LOG"


def _entry_name(number: int) -> str:
    return f"_reads/{number:020d}.json"


def record(spark: SparkSession, path: str, query: str, since: int, until: int, pages: list[list[dict]], capped: bool = False, failed_at: int | None = None) -> int:
    """Records one read (hits: ``hit_id``, ``at`` in whole seconds, ``payload``) of ``query`` over (since, until]; returns its number.

    Files come first and the entry last, in one step, so a stream never sees half a read. One page is one file.
    """
    files, listed = Files(spark, path), []
    for page in filter(None, pages):
        name = f"hits-{uuid.uuid4().hex}.json"
        files.create_once(name, "\n".join(json.dumps(h) for h in page))
        listed.append({"name": name, "oldest": min(h["at"] for h in page), "newest": max(h["at"] for h in page)})
    newest = sorted({h["at"] for page in pages for h in page}, reverse=True)[:2]
    entry = {"query": query, "since": since, "until": until, "capped": capped, "failed_at": failed_at, "newest": newest, "files": listed}
    number = max((int(n[:20]) for n in files.names("_reads") if n[:20].isdigit()), default=0)
    while True:
        number += 1
        if files.create_once(_entry_name(number), json.dumps(entry)):
            return number


def advanced(marks: dict[str, int], entry: dict) -> tuple[int, int]:
    """(old, new) mark of the entry's query. The new one is never below the old one."""
    old = marks.get(entry["query"], entry["since"])
    if entry["since"] > old:
        return old, old
    new = entry["until"]
    if entry["capped"]:
        new = entry["newest"][1] if len(entry["newest"]) > 1 else entry["since"]
    if entry["failed_at"] is not None:
        new = min(new, entry["failed_at"] - 1)
    return old, max(old, new)


def marks(spark: SparkSession, path: str) -> dict[str, int]:
    """Where the next read of each query has to begin."""
    files, found = Files(spark, path), {}
    for name in sorted(n for n in files.names("_reads") if n[:20].isdigit()):
        entry = json.loads(files.read(f"_reads/{name}"))
        found[entry["query"]] = advanced(found, entry)[1]
    return found


class CapturedSearches(DataSource):
    @classmethod
    def name(cls) -> str:
        return "evidora_searches"

    def schema(self) -> str:
        return "query string, hit_id string, at long, payload string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        limit = int(self.options.get("readsPerBatch", "0"))
        if limit and "progress" not in self.options:
            raise SearchLogError("readsPerBatch needs the option progress")
        return _Searches(self.options["path"], limit, self.options.get("progress"))


class _Searches(DataSourceStreamReader):
    def __init__(self, path: str, limit: int, progress: str | None):
        self._path, self._limit, self._progress = path, limit, progress

    @staticmethod
    def _at(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))

    def _loaded(self, path: str) -> dict:
        files, name = self._at(path)
        with files.open_input_stream(name) as stream:
            return json.loads(stream.read())

    def _entry(self, number: int) -> dict:
        return self._loaded(f"{self._path}/{_entry_name(number)}")

    def _newest(self) -> int:
        from pyarrow import fs

        files, base = self._at(self._path)
        found = files.get_file_info(fs.FileSelector(f"{base}/_reads", allow_not_found=True))
        return max((int(i.base_name[:20]) for i in found if i.base_name[:20].isdigit()), default=0)

    def _position(self) -> dict:
        from pyarrow import fs

        if self._progress:
            files, name = self._at(self._progress)
            if files.get_file_info(name).type == fs.FileType.File:
                return self._loaded(self._progress)
        return self.initialOffset()

    def initialOffset(self) -> dict:
        return {"read": 0, "marks": {}}

    def latestOffset(self) -> dict:
        start, newest = self._position(), self._newest()
        end = min(newest, start["read"] + self._limit) if self._limit else newest
        held = dict(start["marks"])
        for number in range(start["read"] + 1, end + 1):
            entry = self._entry(number)
            held[entry["query"]] = advanced(held, entry)[1]
        return {"read": end, "marks": held}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["read"] < start["read"]:
            raise SearchLogError("the progress file is behind the stream's own log")
        held, tasks = dict(start["marks"]), []
        for number in range(start["read"] + 1, end["read"] + 1):
            entry = self._entry(number)
            old, new = advanced(held, entry)
            held[entry["query"]] = new
            tasks += [InputPartition((entry["query"], f["name"], old, new)) for f in entry["files"] if f["oldest"] <= new and f["newest"] > old]
        if self._progress:
            files, name = self._at(self._progress)
            made = f"{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(made) as stream:
                stream.write(json.dumps(end).encode())
            files.move(made, name)
        return tasks

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import io

        query, name, old, new = partition.value
        files, path = self._at(f"{self._path}/{name}")
        with files.open_input_stream(path) as stream, io.TextIOWrapper(stream, "utf-8") as lines:
            for line in lines:
                hit = json.loads(line)
                if old < hit["at"] <= new:
                    yield query, hit["hit_id"], hit["at"], hit.get("payload")

    def commit(self, end: dict) -> None:
        """Captured reads stay where they are."""
