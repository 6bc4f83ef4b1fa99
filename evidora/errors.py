"""Errors with a code and a context, and their projection to a row."""

from __future__ import annotations

from pyspark.sql import types as T


class EvidenceError(Exception):
    """Base of all errors raised here. ``context`` is data for the log; the cause is the chained exception."""

    code = "EVIDENCE"

    def __init__(self, message: str, *, code: str | None = None, **context):
        super().__init__(message)
        self.code, self.context = code or self.code, context


class ConfigError(EvidenceError):
    code = "CONFIG"


class NetworkError(EvidenceError):
    code = "NETWORK"


class TimeoutError_(EvidenceError):
    code = "TIMEOUT"


class RateLimitError(EvidenceError):
    code = "RATE_LIMIT"


class UpstreamError(EvidenceError):
    code = "UPSTREAM"


class BudgetExceededError(EvidenceError):
    code = "BUDGET_EXCEEDED"


RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "kind", "name", "code", "message")] + [T.StructField("context", T.MapType(T.StringType(), T.StringType()))])


def record(source: str | None, kind: str, error: object) -> dict:
    """The row of an error: own errors with code and context, others without, anything else as an unknown value. Never a stack."""
    if isinstance(error, EvidenceError):
        return {"source": source, "kind": kind, "name": type(error).__name__.rstrip("_"), "code": error.code, "message": str(error),
                "context": {k: str(v) for k, v in error.context.items()}}
    if isinstance(error, BaseException):
        return {"source": source, "kind": kind, "name": type(error).__name__, "code": None, "message": str(error), "context": {}}
    return {"source": source, "kind": kind, "name": "UnknownThrownValue", "code": None, "message": str(error), "context": {}}


def causes(error: BaseException) -> list[str]:
    """The messages of an error and of what caused it, outermost first."""
    out: list[str] = []
    seen: set[int] = set()
    while error is not None and id(error) not in seen:
        seen.add(id(error))
        out.append(f"{type(error).__name__}: {error}")
        error = error.__cause__ or error.__context__
    return out
