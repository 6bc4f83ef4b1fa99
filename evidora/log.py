"""Log records as JSON lines, correlated with the run in which they were written."""

from __future__ import annotations

import contextlib
import contextvars
import datetime
import json

from evidora.errors import EvidenceError, causes

_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("run", default=None)


@contextlib.contextmanager
def run(run_id: str, spark=None):
    """Records and Spark jobs inside belong to the run."""
    token = _RUN.set(run_id)
    if spark is not None:
        spark.sparkContext.setJobGroup(run_id, f"run {run_id}")
    try:
        yield run_id
    finally:
        _RUN.reset(token)


def current_run() -> str | None:
    return _RUN.get()


def _plain(value: object) -> object:
    if isinstance(value, BaseException):
        out = {"name": type(value).__name__, "message": str(value), "causes": causes(value)[1:]}
        return {**out, "code": value.code, "context": {k: str(v) for k, v in value.context.items()}} if isinstance(value, EvidenceError) else out
    return value if isinstance(value, (str, int, float, bool, type(None))) else str(value)


def line(level: str, msg: str, /, **fields) -> str:
    """One record. The fields can't take the place of ts, level, msg and run_id; outside a run there is no run_id."""
    fixed = {"ts": datetime.datetime.now(datetime.UTC).isoformat(timespec="milliseconds"), "level": level, "msg": msg}
    if _RUN.get() is not None:
        fixed["run_id"] = _RUN.get()
    kept = {k: _plain(v) for k, v in fields.items() if k not in {"ts", "level", "msg", "run_id"}}
    return json.dumps({**kept, **fixed}, ensure_ascii=False)
