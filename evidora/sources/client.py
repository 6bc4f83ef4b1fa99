"""One request with its policy: wait at the host's bucket, send, classify, wait, again. Transport, clock and sleep are given."""

from __future__ import annotations

import email.utils
from collections.abc import Callable
from urllib.parse import urlsplit

from evidora.errors import NetworkError, RateLimitError, TimeoutError_, UpstreamError
from evidora.functions.columns import HOST_LIMITS, RETRY


class Bucket:
    """A steadily refilled bucket that may be drawn below nothing; the debt is the wait."""

    def __init__(self, capacity: float, interval_ms: float):
        self._capacity, self._rate, self._level, self._at = capacity, capacity / interval_ms, capacity, None

    def wait_ms(self, now_ms: float) -> float:
        if self._at is not None and now_ms > self._at:
            self._level = min(self._capacity, self._level + (now_ms - self._at) * self._rate)
        self._at = now_ms if self._at is None else max(self._at, now_ms)
        self._level -= 1
        return max(0.0, -self._level / self._rate)


def retry_after_ms(header: str | None, now_ms: float, most: float = RETRY["max_ms"]) -> float | None:
    if header is None:
        return None
    text = header.strip()
    if text.isascii() and text.isdigit():
        return min(int(text) * 1000, most)
    try:
        at = email.utils.parsedate_to_datetime(text).timestamp() * 1000
    except (TypeError, ValueError):
        return None
    return min(max(at - now_ms, 0), most)


class Client:
    """``send(url, headers)`` returns (status, headers, body); it raises TimeoutError, or OSError for other failures."""

    def __init__(self, send: Callable, clock_ms: Callable[[], float], sleep_ms: Callable[[float], None], uniform: Callable[[], float], limits: dict = HOST_LIMITS, attempts: int = RETRY["attempts"]):
        self._send, self._clock, self._sleep, self._uniform, self._attempts = send, clock_ms, sleep_ms, uniform, attempts
        self._buckets = {host: Bucket(*limit) for host, limit in limits.items()}

    def request(self, url: str, headers: dict | None = None) -> tuple[int, dict, object]:
        """The answer, unless its status is worth a retry and none is left."""
        host = urlsplit(url).hostname
        for attempt in range(1, self._attempts + 1):
            if (bucket := self._buckets.get(host)) and (wait := bucket.wait_ms(self._clock())) > 0:
                self._sleep(wait)
            problem: Exception | None = None
            try:
                status, answered, body = self._send(url, headers or {})
            except TimeoutError as error:
                problem, status, answered = TimeoutError_("the request timed out", url=url), None, {}
                problem.__cause__ = error
            except OSError as error:
                problem, status, answered = NetworkError("the request failed", url=url), None, {}
                problem.__cause__ = error
            if problem is None and not (status == 429 or 500 <= status <= 599):
                return status, answered, body
            if attempt == self._attempts:
                break
            told = retry_after_ms(answered.get("retry-after"), self._clock())
            self._sleep(told if told is not None else self._uniform() * min(RETRY["base_ms"] * 2 ** (attempt - 1), RETRY["max_ms"]))
        if problem is not None:
            raise problem
        raise (RateLimitError if status == 429 else UpstreamError)("no usable answer", url=url, status=status)


def headroom(headers: dict) -> dict[str, float] | None:
    """What the rate-limit headers say; None if none of them can be read."""
    found = {}
    for key, name in (("remaining", "x-ratelimit-remaining"), ("used", "x-ratelimit-used"), ("reset_seconds", "x-ratelimit-reset")):
        try:
            value = float(headers[name])
        except (KeyError, ValueError, TypeError):
            continue
        if value == value and abs(value) != float("inf"):
            found[key] = value
    return found or None


def apply_schedules(scheduler, wanted: dict[str, str], zone: str) -> None:
    """All schedules or none: what was there is put back if one can't be set. ``scheduler`` has all(), set(), remove()."""
    before = scheduler.all()
    try:
        for name, cron in wanted.items():
            scheduler.set(name, cron, zone)
        for name in before.keys() - wanted.keys():
            scheduler.remove(name)
    except Exception:
        for name in scheduler.all().keys() - before.keys():
            scheduler.remove(name)
        for name, (cron, old_zone) in before.items():
            scheduler.set(name, cron, old_zone)
        raise
