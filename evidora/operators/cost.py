"""Cost of external calls: usage per call, rolling spend, the budget guard, and results joined to their requests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidora.errors import BudgetExceededError, ConfigError
from evidora.functions.columns import cost_usd, within_budget

#: The ceiling in dollars, the window in days, and dollars a million tokens (input, output) by route.
CEILING, DAYS, WARN = 70, 30, 0.8
DISPATCH = 100_000
RATES = {"batch": ("0.5", "2.5"), "single": ("3.0", "15.0")}


def allowed(route: str, rates: dict = RATES) -> tuple[str, str]:
    """The rates of a route; names must match exactly."""
    if route not in rates:
        raise ConfigError("no rate is known for this model", model=route)
    return rates[route]


def priced(usage: DataFrame, route: str, rates: dict = RATES) -> DataFrame:
    """``usage`` with ``cost`` in full precision; columns input_tokens, output_tokens, cache_write, cache_read."""
    i, o = (F.lit(x) for x in allowed(route, rates))
    return usage.withColumn("cost", cost_usd(F.col("input_tokens"), F.col("output_tokens"), F.col("cache_write"), F.col("cache_read"), i, o))


def recorded(calls: DataFrame, run: str = "run_id") -> DataFrame:
    """Sums by run of calls that are each rounded to four places once: the sum of the rounded is kept, not the rounded sum."""
    return calls.groupBy(run).agg(F.sum("input_tokens").cast("long").alias("input_tokens"), F.sum("output_tokens").cast("long").alias("output_tokens"),
                                  F.sum(F.round("cost", 4).cast("decimal(20,4)")).alias("cost_usd"))


def trailing_spend(runs: DataFrame, now: Column, days: int = DAYS, at: str = "started_at") -> DataFrame:
    """Spend of the runs that started after now - days, all stages, without an upper bound; 0 for none."""
    cutoff = now - F.expr(f"INTERVAL {days * 24} HOURS")
    return runs.filter(F.col(at) > cutoff).agg(F.coalesce(F.sum("cost_usd"), F.lit(0)).cast("decimal(20,4)").alias("spend"))


def budget(trailing: Column, pending: Column, ceiling: Column, warn: float = WARN) -> Column:
    """ok, warning or exceeded."""
    projected = trailing + pending
    return F.when(~within_budget(trailing, pending, ceiling), "exceeded").when(projected >= ceiling * F.lit(str(warn)).cast("decimal(3,2)"), "warning").otherwise("ok")


def pending_cost(requests: DataFrame, route: str, rates: dict = RATES) -> DataFrame:
    """The estimate before a dispatch: all input at the plain rate, output at the most that may come."""
    i, o = (F.lit(x) for x in allowed(route, rates))
    none = F.lit(0)
    sums = requests.agg(F.coalesce(F.sum("estimated_tokens"), none).alias("i"), F.coalesce(F.sum("max_tokens"), none).alias("o"))
    return sums.select(cost_usd(F.col("i"), F.col("o"), none, none, i, o).alias("pending"))


def results(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """A row for each request in request order: its last answer, or expired where none came.

    ``requests``: ordinal, custom_id; ``answers``: custom_id, arrival, type, input_tokens, output_tokens.
    """
    last = F.row_number().over(Window.partitionBy("custom_id").orderBy(F.desc("arrival")))
    final = answers.withColumn("_rank", last).filter("_rank = 1").drop("_rank", "arrival")
    joined = requests.join(final, "custom_id", "left")
    ok = F.col("type") == "succeeded"
    usage = [F.when(ok, F.col(c)).otherwise(0).cast("long").alias(c) for c in ("input_tokens", "output_tokens")]
    return joined.select("ordinal", "custom_id", F.coalesce("type", F.lit("expired")).alias("type"), F.when(F.col("type").isNull(), "missing_result").alias("error"), *usage)


@dataclass
class Client:
    """An external model, given by the caller. ``submit`` takes requests and returns answers; ``count`` estimates tokens."""

    submit: object
    count: object


def extract(requests: DataFrame, client: Client, route: str, spent, record_usage, ceiling: float = CEILING, rates: dict = RATES):
    """Dispatches requests once from the driver, after the budget guard; returns ``results``, or None for no requests.

    Executors never call out: a task that is tried again would be billed twice. ``requests``: ordinal, custom_id,
    prompt, max_tokens; a dispatch has ``DISPATCH`` of them at most, more are an error.
    """
    rows = requests.orderBy("ordinal").limit(DISPATCH + 1).collect()
    if len(rows) > DISPATCH:
        raise ConfigError("too many requests for one dispatch", most=DISPATCH)
    i, o = (float(x) for x in allowed(route, rates))
    if not rows:
        return None
    pending = sum(client.count(r.prompt) * i + r.max_tokens * o for r in rows) / 1e6
    trailing = spent()
    if not trailing + pending <= ceiling:
        raise BudgetExceededError("the dispatch would exceed the budget", trailing=trailing, pending=pending, ceiling=ceiling)
    answers = requests.sparkSession.createDataFrame(client.submit(rows), "custom_id string, arrival long, type string, input_tokens long, output_tokens long")
    found = results(requests.select("ordinal", "custom_id"), answers)
    used = found.agg(F.sum("input_tokens"), F.sum("output_tokens")).first()
    if used[0] + used[1] > 0:
        record_usage(used[0], used[1], round((used[0] * i + used[1] * o) / 1e6, 4))
    return found


def history(runs: DataFrame, at: str = "started_at", days: int = DAYS) -> DataFrame:
    """By day and stage: runs, cost, and the spend of the ``days`` days that end with it. The window runs over days, of which there are few."""
    daily = runs.groupBy(F.date_trunc("day", at).alias("day"), "stage").agg(F.count("*").alias("runs"), F.sum("cost_usd").alias("cost"))
    spend = daily.groupBy("day").agg(F.sum("cost").alias("cost_of_day"))
    rolled = spend.withColumn("spend_30d", F.sum("cost_of_day").over(Window.orderBy(F.unix_seconds(F.col("day").cast("timestamp"))).rangeBetween(-(days - 1) * 86400, 0)))
    return daily.join(rolled.select("day", "spend_30d"), "day")


def stage_metrics(runs: DataFrame) -> DataFrame:
    """Per stage: runs, seconds, rows in and out, errors, their rate, and cost. ``runs``: stage, seconds, rows_in, rows_out, errors, cost_usd."""
    sums = runs.groupBy("stage").agg(F.count("*").alias("runs"), F.sum("seconds").alias("seconds"), F.max("seconds").alias("longest"), F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"),
                                     F.sum("errors").alias("errors"), F.sum("cost_usd").alias("cost_usd"))
    return sums.withColumn("error_rate", F.round(F.try_divide("errors", "rows_in"), 6))


def projection(runs: DataFrame, ceiling: Column, at: str = "started_at", days: int = DAYS, warn: float = WARN) -> DataFrame:
    """Per day the spend of the ``days`` days that end with it, the same at the day's own rate, and the verdict on the latter."""
    daily = history(runs, at, days).groupBy("day").agg(F.sum("cost").alias("cost_of_day"), F.max("spend_30d").alias("spend"))
    projected = F.col("cost_of_day") * days
    verdict = F.when(projected > ceiling, "over").when(projected >= ceiling * F.lit(str(warn)).cast("decimal(3,2)"), "near").otherwise("under")
    return daily.select("day", "spend", projected.alias("projected"), verdict.alias("verdict"))
