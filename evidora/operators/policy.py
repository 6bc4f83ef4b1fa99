"""Request policy as data: token buckets per host, retries, and how a scheduled job goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidora.functions.columns import HOST_LIMITS, RETRY, backoff_ms, retry_after_ms, retryable

#: Schedules by source, job retries, backoff (seconds), lease, heartbeat, days a dead letter is kept.
SCHEDULES = {"hackernews": "*/15 * * * *", "appstore": "17 * * * *", "reddit": "37 * * * *"}
JOB = {"retries": 3, "backoff_s": 60, "backoff_max_s": 900, "lease_s": 3600, "heartbeat_s": 60, "dead_letter_days": 30}


def bucket_delays(requests: DataFrame, capacity: float, interval_ms: float, key: str = "host", at: str = "at_ms", tie: str = "id") -> DataFrame:
    """``requests`` with ``delay_ms``: how long each must wait at a bucket that refills steadily and may be drawn below nothing.

    A bucket's level is a running sum cut at the capacity, which has a closed form: with s the sum of all steps so far
    (refill less the draws), the level before a draw is capacity + s less the largest s that overflowed. So two window
    functions by host do; no state is kept by hand.
    """
    order = Window.partitionBy(key).orderBy(at, tie)
    rate = capacity / interval_ms
    first = F.first(at).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    refilled = (F.col(at) - first) * rate
    drawn = F.row_number().over(order) - 1
    free = refilled - drawn  # the level before the draw if nothing overflowed, less the capacity
    over = F.greatest(F.lit(0.0), F.max("_free").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    level = F.lit(float(capacity)) + F.col("_free") - over - 1
    return requests.withColumn("_free", free).withColumn("delay_ms", F.when(level < 0, -level / rate).otherwise(0.0)).drop("_free")


def limited(requests: DataFrame, limits: dict[str, tuple[float, float]] = HOST_LIMITS) -> DataFrame:
    """Delays for hosts that have a limit; others never wait."""
    out = requests.filter(~F.col("host").isin(*limits)).withColumn("delay_ms", F.lit(0.0))
    for host, (capacity, interval) in limits.items():
        out = out.unionByName(bucket_delays(requests.filter(F.col("host") == host), capacity, interval))
    return out


def attempts(responses: DataFrame, most: int = RETRY["attempts"]) -> DataFrame:
    """For each attempt (request, attempt, status, retry_after, at_ms): what follows, and the delay before jitter.

    return, retry, or at the last attempt rate-limited (429) or upstream-error (a server error). A readable
    Retry-After replaces the computed delay and has no jitter.
    """
    again, last = retryable(F.col("status")), F.col("attempt") >= most
    told = retry_after_ms(F.col("retry_after"), F.col("at_ms"))
    action = F.when(~again, "return").when(~last, "retry").when(F.col("status") == 429, "rate-limited").otherwise("upstream-error")
    return responses.select("*", action.alias("action")).withColumn("delay_ms", F.when(F.col("action") == "retry", F.coalesce(told, backoff_ms(F.col("attempt"))))).withColumn(
        "jittered", F.col("action").eqNullSafe("retry") & told.isNull())


def job_backoff_s(attempt):
    """Seconds before a job is tried again."""
    return F.least(F.lit(JOB["backoff_s"]) * F.pow(F.lit(2.0), attempt - 1), F.lit(JOB["backoff_max_s"])).cast("long")


def dropped_ticks(ticks: DataFrame, key: str = "source", at: str = "at", until: str = "until") -> DataFrame:
    """``ticks`` with ``dropped``: a tick that comes while an accepted run of its source still goes on.

    A run that was dropped doesn't hold the lock, so acceptance is decided in order within each source. Ticks are the
    scheduler's own rows, some ninety a source and day.
    """
    def decide(frame):
        frame = frame.sort_values(at)
        dropped, free = [], None
        for start, end in zip(frame[at], frame[until], strict=True):
            taken = free is not None and start < free
            dropped.append(taken)
            free = free if taken else end
        return frame.assign(dropped=dropped)

    return ticks.groupBy(key).applyInPandas(decide, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ticks.schema.fields) + ", dropped boolean")


def kept_letters(letters: DataFrame, now, days: int = JOB["dead_letter_days"], at: str = "at") -> DataFrame:
    """Dead letters that are not older than ``days`` days."""
    return letters.filter(F.col(at) >= now - F.expr(f"INTERVAL {days * 24} HOURS"))
