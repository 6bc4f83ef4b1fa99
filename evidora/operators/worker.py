"""A worker that runs the jobs of scheduled ticks: one run a source at a time, retries, dead letters, and an orderly end."""

from __future__ import annotations

import logging
import signal
import threading
import time
from collections.abc import Callable

from evidora.operators.lease import Lease, LeaseHeldError
from evidora.operators.policy import JOB


class Worker:
    """``lease`` gives the lease of a source, ``run`` does its job, ``dead`` is told of a job that failed to the end.

    A tick that comes while the source's lease is held, here or in another process, is dropped and logged. A job that
    raises is tried again after 60 s, 120 s and so on, 900 s at most. Once stopped, the worker ends what it is doing and
    takes no tick; a wait for another try ends at once.
    """

    def __init__(self, lease: Callable[[str], Lease], run: Callable[[str], None], dead: Callable[[str, Exception], None], retries: int = JOB["retries"], backoff_s: float = JOB["backoff_s"], most_s: float = JOB["backoff_max_s"]):
        self._lease, self._run, self._dead, self._retries, self._backoff, self._most = lease, run, dead, retries, backoff_s, most_s
        self._stopped, self._log = threading.Event(), logging.getLogger(__name__)

    def tick(self, source: str) -> str:
        """done, dropped, dead-letter or stopped."""
        if self._stopped.is_set():
            return "stopped"
        try:
            with self._lease(source):
                return self._tried(source)
        except LeaseHeldError:
            self._log.warning("tick dropped: a run of %s goes on", source)
            return "dropped"

    def _tried(self, source: str) -> str:
        for attempt in range(1, self._retries + 2):
            try:
                self._run(source)
                return "done"
            except Exception as error:
                self._log.exception("attempt %d of %s failed", attempt, source)
                if attempt > self._retries:
                    self._dead(source, error)
                    return "dead-letter"
            if self._paused(min(self._backoff * 2 ** (attempt - 1), self._most)):
                return "stopped"
        raise AssertionError("unreachable")

    def _paused(self, seconds: float) -> bool:
        """Waits; true as soon as the worker is stopped. In slices, as a signal that another thread gets wakes no wait."""
        end = time.monotonic() + seconds
        while (left := end - time.monotonic()) > 0:
            if self._stopped.wait(min(left, 0.5)):
                return True
        return self.stopped

    def stop(self) -> None:
        self._stopped.set()

    @property
    def stopped(self) -> bool:
        return self._stopped.is_set()

    def on_signals(self) -> None:
        """The first SIGINT or SIGTERM stops the worker; later ones are ignored, so that what goes on can end."""
        def handle(number, _):
            if not self.stopped:
                self._log.info("signal %d: stopping", number)
                self.stop()

        for number in (signal.SIGINT, signal.SIGTERM):
            signal.signal(number, handle)
