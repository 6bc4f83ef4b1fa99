import os
import signal
import threading
import time
from contextlib import contextmanager
from pathlib import Path

import evidora
from evidora.operators.lease import LeaseHeldError
from evidora.operators.worker import Worker
from evidora.rules import violations


def leases(held):
    @contextmanager
    def lease(source):
        if source in held:
            raise LeaseHeldError("held")
        held.add(source)
        try:
            yield
        finally:
            held.discard(source)
    return lease


def test_ticks_retries_and_dead_letters():
    held, calls, dead = {"reddit"}, [], []

    def run(source):
        calls.append(source)
        if source == "appstore" or calls.count(source) < 3:
            raise OSError(source)

    worker = Worker(leases(held), run, lambda s, e: dead.append((s, str(e))), backoff_s=0.001)
    assert worker.tick("hackernews") == "done" and calls == ["hackernews"] * 3
    assert worker.tick("reddit") == "dropped" and "reddit" not in calls
    assert worker.tick("appstore") == "dead-letter" and calls.count("appstore") == 4 and dead == [("appstore", "appstore")]
    assert held == {"reddit"}


def test_a_signal_ends_the_worker_in_order():
    def run(_):
        raise OSError

    worker = Worker(leases(set()), run, lambda *_: None, backoff_s=60)
    before = {n: signal.getsignal(n) for n in (signal.SIGINT, signal.SIGTERM)}
    worker.on_signals()
    try:
        def send():
            time.sleep(0.3)
            os.kill(os.getpid(), signal.SIGTERM)
            os.kill(os.getpid(), signal.SIGINT)  # ignored

        threading.Thread(target=send).start()
        began = time.monotonic()
        assert worker.tick("hackernews") == "stopped" and time.monotonic() - began < 10  # the wait for another try ends
        time.sleep(0.3)
        assert worker.stopped and worker.tick("hackernews") == "stopped"
    finally:
        for n, handler in before.items():
            signal.signal(n, handler)


def test_static_rules(tmp_path):
    assert violations(Path(evidora.__file__).parent) == []
    (tmp_path / "operators").mkdir()
    (tmp_path / "operators" / "bad.py").write_text("import os, urllib.request\nfrom evidora.llm import bpe\nfrom evidora.plans import catalog\nprint(os.environ)\nraise RuntimeError('x')\n")
    assert len(violations(tmp_path)) == 6
