"""Exclusive leases held by files, so that they hold across processes: one run a source.

A lease is a row of numbered terms, each a file that only one caller can create (``commits.Files.create_once``). The owner of
the highest term holds the lease until that term is ended or has not been renewed in time; whoever finds it so tries to
create the next term. So a lease that another has taken over meanwhile can't be taken from them, and the number of the term is
a fence: work done under it is void once a higher one is there.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import SparkSession

from evidora.errors import EvidenceError
from evidora.operators.commits import Files
from evidora.operators.policy import JOB


class LeaseHeldError(EvidenceError):
    code = "LEASE_HELD"


class Lease:
    """A lease on ``name`` in ``folder``; as a context manager it waits ``wait_s`` for it and is renewed until the end.

    ``seconds`` without a renewal end it. ``term`` is its number while it is held.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str, seconds: float = JOB["lease_s"], beat_s: float = JOB["heartbeat_s"], wait_s: float = 0.0):
        self._files, self._name, self._seconds, self._beat_s, self._wait_s = Files(spark, folder), name, seconds, beat_s, wait_s
        self.owner, self.term = uuid.uuid4().hex, 0
        self._ended = threading.Event()

    def _file(self, term: int, end: str = "") -> str:
        return f"_{self._name}.{term:012d}{end}.lease"

    def _terms(self) -> tuple[int, bool, float, list[str]]:
        """The highest term, whether it was ended, when it was renewed, and the files of terms before it."""
        own = {n: at for n, at in self._files.names().items() if n.startswith(f"_{self._name}.") and n.endswith(".lease")}
        terms = [int(n.split(".")[1]) for n in own if not n.endswith(".end.lease")]
        last = max(terms, default=0)
        old = [n for n in own if int(n.split(".")[1]) < last]
        return last, self._file(last, ".end") in own, own.get(self._file(last), 0.0), old

    def acquire(self) -> bool:
        """Takes the lease if it is free or has expired."""
        last, ended, renewed, old = self._terms()
        if last and not ended and time.time() - renewed <= self._seconds:
            return False
        if not self._files.create_once(self._file(last + 1), self.owner):
            return False
        self.term = last + 1
        for name in old:
            self._files.delete(name)
        return True

    def held(self) -> bool:
        """Whether this owner holds it still."""
        last, ended, *_ = self._terms()
        return bool(self.term) and last == self.term and not ended

    def beat(self) -> bool:
        """Renews the lease; false if it is another's by now, whose term stays as it is."""
        if not self.held():
            return False
        self._files.touch(self._file(self.term))
        return True

    def release(self) -> None:
        if self.held():
            self._files.create_once(self._file(self.term, ".end"), self.owner)
        self.term = 0

    def __enter__(self) -> Lease:
        stop = time.monotonic() + self._wait_s
        while not self.acquire():
            if time.monotonic() >= stop:
                raise LeaseHeldError("another owner holds the lease", name=self._name)
            time.sleep(min(0.2, self._wait_s))

        def renew():
            while not self._ended.wait(self._beat_s) and self.beat():
                pass

        self._ended.clear()
        threading.Thread(target=renew, daemon=True).start()
        return self

    def __exit__(self, *_) -> None:
        self._ended.set()
        self.release()
