"""A commit log for append-only tables: whole commits, optimistic writers, snapshots by number, files pruned before they are read.

Beside its data files a table at ``path`` has ``_log``, with one numbered manifest a commit. A manifest is made whole and then
given its name in one step that only one writer can do, so of two that want the same number one wins and the other looks
again at what is new. A manifest names its files with the rows of each, and by source the least and greatest key and time; every
``FULL``-th one names all files of the table, so a snapshot reads few of them. For each file there is also a Bloom filter of
its keys (``BITS`` bits a key, in a Parquet table beside the manifests), which keeps files out of an anti-join.

Spark writes data files to a staging folder first, which plain readers don't see, with its own commit of tasks. After the
manifest they are moved to their place; whoever next looks at the log ends the moves of a writer that has died. What was
never committed is invisible, and ``vacuum`` deletes it. ``spark.read.parquet(path)`` works, and sees committed rows only;
``snapshot`` sees whole commits only.

The driver holds the list of files, as Spark's own file index does, and at most ``BLOOM_KEYS`` hashed keys of a page.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evidora.errors import EvidenceError

FULL = 16
BITS, HASHES = 32, 12
#: Keys of a page up to which files are tested before a join; larger loads join with all files whose bounds fit.
BLOOM_KEYS = 200_000


class ConflictError(EvidenceError):
    code = "COMMIT_CONFLICT"


class Files:
    """The few file operations that a log and a lease need, on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._jvm, self.folder = spark, spark._jvm, folder
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self.path(folder).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def at(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def local(self) -> bool:
        return self._fs.getUri().getScheme() == "file"

    def create_once(self, name: str, text: str) -> bool:
        """Makes the file ``name`` with ``text`` in one step; false if it is there already.

        A link on a local disk, else a rename that doesn't replace, which HDFS does in one step.
        """
        target = self.path(self.at(name))
        temp = self.path(f"{target.getParent().toString()}/.{uuid.uuid4().hex}.tmp")
        if self.local():
            there, made = (p.toUri().getPath() for p in (target, temp))
            os.makedirs(os.path.dirname(there), exist_ok=True)
            with open(made, "w") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(made, there)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(made)
        stream = self._fs.create(temp, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        plain = self._spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(temp, target, plain)
            return True
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            self._fs.delete(temp, False)
            return False

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(self.at(name)))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str = "") -> dict[str, float]:
        """The names in a folder and the seconds at which they were changed; none if it isn't there."""
        try:
            return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._fs.listStatus(self.path(self.at(folder)))}
        except Exception as error:
            if "FileNotFound" not in str(error):
                raise
            return {}

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(self.at(name)))

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(self.at(name)), True)

    def touch(self, name: str) -> None:
        self._fs.setTimes(self.path(self.at(name)), int(1000 * time.time()), -1)

    def move(self, name: str, to: str) -> None:
        """Moves a file whose name is unique; it may have been moved by another meanwhile."""
        try:
            done = self._fs.rename(self.path(self.at(name)), self.path(self.at(to)))
        except Exception:
            if not self.exists(to):
                raise
            return
        if not done and not self.exists(to):
            raise OSError(f"{name} could not be moved to {to}")


def manifest_name(version: int) -> str:
    return f"_log/{version:020d}.json"


def fold(load: Callable[[int], dict], version: int) -> list[dict]:
    """The files of a version, from its manifest back to the last one that names all."""
    files: list[dict] = []
    while version:
        entry = load(version)
        if "all" in entry:
            return entry["all"] + files
        files = entry["added"] + files
        version -= 1
    return files


def touches(file: dict, sources: Iterable[str] | None = None, since: int | None = None, until: int | None = None) -> bool:
    """Whether a file may hold rows of ``sources`` with a time from ``since`` to ``until`` (microseconds); one without statistics may."""
    if "sources" not in file:
        return True
    own = [s for name, s in file["sources"].items() if sources is None or name in set(sources)]
    return any((since is None or s["last"] >= since) and (until is None or s["first"] <= until) for s in own)


class Log:
    """The commit log of the table at ``path``, whose rows have ``schema``; ``key`` names the two columns of its key."""

    def __init__(self, spark: SparkSession, path: str, key: tuple[str, str] = ("source", "source_id"), time_column: str = "created_at", schema: StructType | None = None):
        if schema is not None:
            self._schema = schema  # one that has gained columns since files were written
        self.spark, self.path, self._key, self._time = spark, path, key, time_column
        self.files = Files(spark, path)
        self._known: dict[int, dict] = {}

    @property
    def schema(self) -> StructType:
        if not hasattr(self, "_schema"):
            self._schema = self.spark.read.parquet(self.path).schema
        return self._schema

    def entry(self, version: int) -> dict:
        if version not in self._known:
            self._known[version] = json.loads(self.files.read(manifest_name(version)))
        return self._known[version]

    def latest(self) -> int:
        """The number of the last commit, with its files and those before it in place. A table without a log gets one that names what is there."""
        names = self.files.names("_log")
        versions = sorted(int(n[:20]) for n in names if n.endswith(".json") and n[:20].isdigit())
        if not versions:
            filters = f"_log/filters-{uuid.uuid4().hex}"
            there = self._described(self.spark.read.schema(self.schema).parquet(self.path), filters)
            if not self._publish(1, {"added": there, "all": there, "staging": None}):
                self.files.delete(filters)
            return self.latest()
        for version in reversed(versions):
            if f"{version:020d}.done" in names:
                break
            self._place(version)
        return versions[-1]

    def _publish(self, version: int, entry: dict) -> bool:
        return self.files.create_once(manifest_name(version), json.dumps(entry))

    def _place(self, version: int) -> None:
        """Moves the files of a commit to where readers look; any number may do so at once."""
        entry = self.entry(version)
        if entry["staging"]:
            for file in entry["added"]:
                if not self.files.exists(file["name"]):
                    self.files.move(f"{entry['staging']}/{file['name']}", file["name"])
            self.files.delete(entry["staging"])
        self.files.create_once(f"_log/{version:020d}.done", "")

    def commit(self, version: int, added: list[dict], staging: str) -> bool:
        """Makes ``version`` of its predecessor and the files of ``staging``; false if another has made it."""
        entry = {"added": added, "staging": staging}
        if version % FULL == 0:
            entry["all"] = fold(self.entry, version - 1) + added
        if not self._publish(version, entry):
            return False
        self._place(version)
        return True

    def listed(self, version: int | None = None) -> list[dict]:
        """The files of a version, the latest unless given; a version that isn't there is an error."""
        last = self.latest()
        if version is not None and not 1 <= version <= last:
            raise ConflictError("no such version", version=version, latest=last)
        return fold(self.entry, version or last)

    def over(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f['name']}" for f in files])

    def snapshot(self, version: int | None = None, sources: list[str] | None = None, since=None, until=None) -> DataFrame:
        """The rows of a version; with bounds (datetimes, both included) those within, of the files that may have any."""
        micros = lambda t: None if t is None else int(t.timestamp() * 1_000_000)
        rows = self.over([f for f in self.listed(version) if touches(f, sources, micros(since), micros(until))])
        if sources is not None:
            rows = rows.filter(F.col(self._key[0]).isin(list(sources)))
        if since is not None:
            rows = rows.filter(F.col(self._time) >= F.lit(since))
        return rows if until is None else rows.filter(F.col(self._time) <= F.lit(until))

    def stage(self, rows: DataFrame) -> tuple[str, list[dict]]:
        """Writes ``rows`` to a staging folder: its name, and its files with statistics and filters."""
        staging = f"_staging-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(self.files.at(staging))
        return staging, self._described(self.spark.read.schema(self.schema).parquet(self.files.at(staging)), f"_log/filters-{staging}")

    def _described(self, held: DataFrame, filters: str) -> list[dict]:
        """The files of ``held`` that have rows, with statistics; their filters are written to ``filters``."""
        source, ident = self._key
        named = held.select(F.col("_metadata.file_name").alias("file"), F.col(source).alias("source"), F.col(ident).alias("ident"), F.unix_micros(self._time).alias("at"), _hashed(source, ident).alias("h"))
        found: dict[str, dict] = {}
        stats = named.groupBy("file", "source").agg(F.count("*"), F.min("ident"), F.max("ident"), F.min("at"), F.max("at"))
        for name, of, rows_, low, high, first, last in stats.collect():  # a row a file and source
            file = found.setdefault(name, {"name": name, "rows": 0, "sources": {}, "filters": filters})
            file["rows"] += rows_
            file["sources"][of] = {"low": low, "high": high, "first": first, "last": last}
        if found:
            named.select("file", "h").groupBy("file").applyInArrow(_filter, "file string, bits binary").write.parquet(self.files.at(filters))
        return sorted(found.values(), key=lambda f: f["name"])

    def drop(self, staging: str) -> None:
        """Forgets a staging folder that was not committed."""
        self.files.delete(staging)
        self.files.delete(f"_log/filters-{staging}")

    def may_hold(self, files: list[dict], offered: DataFrame) -> list[dict]:
        """Those of ``files`` that may hold a key of ``offered``: by the bounds of each source, then by their filters.

        A file that holds a key is never left out; one that holds none stays by chance, about once in a million keys.
        """
        source, ident = self._key
        keys = offered.select(F.col(source).alias("source"), F.col(ident).alias("ident"))
        ends = {r.source: (r.low, r.high, r.n) for r in keys.groupBy("source").agg(F.min("ident").alias("low"), F.max("ident").alias("high"), F.count("*").alias("n")).collect()}  # a row a source

        def near(file: dict) -> bool:
            return "sources" not in file or any(of in ends and s["low"] <= ends[of][1] and s["high"] >= ends[of][0] for of, s in file["sources"].items())

        files = [f for f in files if near(f)]
        tested = [f for f in files if "filters" in f]
        if not tested or sum(n for *_, n in ends.values()) > BLOOM_KEYS:
            return files
        hashes = self.spark.sparkContext.broadcast(keys.select(_hashed("source", "ident").alias("h")).distinct().toArrow().column("h").to_numpy())
        wanted = {f["name"] for f in tested}

        def test(batches):
            import pyarrow as pa

            for batch in batches:
                names, bits = batch.column("file").to_pylist(), batch.column("bits")
                kept = [n for k, n in enumerate(names) if n in wanted and _any_in(bits[k].as_buffer(), hashes.value)]
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], ["file"])

        tables = sorted({f["filters"] for f in tested})
        filters = self.spark.read.schema("file string, bits binary").parquet(*[self.files.at(t) for t in tables])
        hit = {r.file for r in filters.mapInArrow(test, "file string").collect()}  # names of files
        return [f for f in files if "filters" not in f or f["name"] in hit]

    def append(self, offered: DataFrame, missing: Callable[[DataFrame, DataFrame], DataFrame], wait_s: float = 600.0) -> int:
        """Commits ``missing(offered, stored)``, the rows of ``offered`` that the stored ones lack; returns how many.

        A writer that loses its number to another takes out what the other has brought meanwhile and tries again, until
        ``wait_s`` seconds are over.
        """
        end, base = time.monotonic() + wait_s, self.latest()
        staging, files = self.stage(missing(offered, self.over(self.may_hold(self.listed(base), offered))))
        while files:
            if self.commit(base + 1, files, staging):
                return sum(f["rows"] for f in files)
            if time.monotonic() > end:
                self.drop(staging)
                raise ConflictError("other writers were faster", path=self.path)
            last = self.latest()
            new = [f for v in range(base + 1, last + 1) for f in self.entry(v)["added"]]
            held = self.spark.read.schema(self.schema).parquet(self.files.at(staging))
            met, base = self.may_hold(new, held), last
            if met:
                old = staging
                staging, files = self.stage(held.join(self.over(met).select(*self._key), list(self._key), "left_anti"))
                self.drop(old)
        self.drop(staging)
        return 0

    def vacuum(self, older_s: float = 7 * 86_400) -> int:
        """Deletes staging folders that no commit names and that are older than ``older_s`` seconds; returns how many."""
        self.latest()
        dead = [n for n, at in self.files.names().items() if n.startswith("_staging-") and time.time() - at > older_s]
        for name in dead:
            self.drop(name)
        return len(dead)


def _hashed(source: str, ident: str):
    return F.xxhash64(source, ident)


def _place_of(hashes, k: int, bits: int):
    """The bit of each hash for the ``k``-th of its tests."""
    import numpy as np

    h = hashes.astype(np.uint64)
    low, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return ((low + np.uint64(k) * step) % np.uint64(bits)).astype(np.int64)


def _filter(rows):
    """A Bloom filter of the hashes of one file."""
    import numpy as np
    import pyarrow as pa

    hashes = rows.column("h").to_numpy()
    bits = max(64, BITS * len(hashes))
    own = np.zeros(bits, bool)
    for k in range(HASHES):
        own[_place_of(hashes, k, bits)] = True
    return pa.table({"file": rows.column("file")[:1].cast(pa.string()), "bits": pa.array([len(own).to_bytes(8, "little") + np.packbits(own, bitorder="little").tobytes()], pa.binary())})


def _any_in(buffer, hashes) -> bool:
    import numpy as np

    bits = int.from_bytes(bytes(buffer[:8]), "little")
    table = np.frombuffer(buffer, np.uint8)[8:]
    left = hashes
    for k in range(HASHES):
        places = _place_of(left, k, bits)
        left = left[(table[places >> 3] >> (places & 7) & 1).astype(bool)]
    return len(left) > 0
