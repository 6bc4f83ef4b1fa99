"""Scalar functions over columns: strict JSON fields, normalisation, addresses, cost, retry policy, settings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Retry policy, price multipliers, and the host limited by default (requests, milliseconds).
RETRY = {"attempts": 5, "base_ms": 250, "max_ms": 30_000}
CACHE_WRITE, CACHE_READ = "1.25", "0.1"
HOST_LIMITS = {"oauth.reddit.com": (100, 60_000)}


_NUMBER = "^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"


def field(value: Column, path: str) -> Column:
    """The JSON value at ``path`` as a variant; null where it is not there."""
    return F.variant_get(value, path, "variant")


def kind_of(value: Column, path: str) -> Column:
    """STRING, NUMBER, BOOLEAN, OBJECT, ARRAY or VOID (a JSON null); null where the field is not there."""
    family = lambda name: (F.when(name.rlike(_NUMBER), "NUMBER").when(name.startswith("OBJECT"), "OBJECT")
                           .when(name.startswith("ARRAY"), "ARRAY").otherwise(name))
    return F.transform(F.array(F.schema_of_variant(field(value, path))), family)[0]  # the schema is looked up once


def string_at(value: Column, path: str) -> Column:
    """The string at ``path``; null for any other type. No coercion."""
    return F.when(F.schema_of_variant(field(value, path)) == "STRING", F.try_variant_get(value, path, "string"))


def number_at(value: Column, path: str) -> Column:
    return F.when(F.schema_of_variant(field(value, path)).rlike(_NUMBER), F.try_variant_get(value, path, "double"))


def is_optional(value: Column, path: str, kind: str) -> Column:
    """Whether the field is not there or has this type; a JSON null has not."""
    return F.coalesce(kind_of(value, path) == kind, F.lit(True))


def without(raw: Column, *keys: str) -> Column:
    """The JSON object ``raw`` (a string) without some of its keys."""
    return F.to_json(F.map_filter(F.from_json(raw, "map<string,variant>"), lambda k, _: ~k.isin(*keys)))


def prefixed_author(author: Column) -> Column:
    """u/name; null for no name, an empty one and that of a deleted account."""
    return F.when(author.isNull() | author.isin("", "[deleted]"), None).otherwise(F.concat(F.lit("u/"), author))


def blank_to_null(text: Column) -> Column:
    """Null where only white space is there; otherwise the text untrimmed."""
    return F.when(F.regexp_replace(text, r"^\s+|\s+$", "") == "", None).otherwise(text)


def pair_key(app: Column, territory: Column) -> Column:
    return F.concat_ws(":", app, territory)


def pair_label(app: Column, territory: Column) -> Column:
    return F.format_string("%s (%s)", app, territory)


def feed_url(app: Column, territory: Column, page: Column) -> Column:
    """The address of one page of a review feed; the first has no page part."""
    part = F.when(page == 1, "").otherwise(F.concat(F.lit("/page="), page.cast("string")))
    return F.concat(F.lit("https://itunes.apple.com/"), territory, F.lit("/rss/customerreviews"), part, F.lit("/id="), app, F.lit("/sortby=mostrecent/json"))


def reviews_url(app: Column, territory: Column) -> Column:
    return F.concat(F.lit("https://apps.apple.com/"), territory, F.lit("/app/id"), app, F.lit("?see-all=reviews"))


def iso_ms(time: Column) -> Column:
    """Fixed-width ISO-8601 with milliseconds, so that the order of the texts is that of the times."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def from_seconds(seconds: Column) -> Column:
    """Epoch seconds, possibly fractional, cut to milliseconds."""
    return F.timestamp_millis(F.floor(seconds * 1000).cast("long"))


def list_setting(value: Column) -> Column:
    """A comma-separated setting as trimmed, non-empty entries; null if none is left."""
    parts = F.filter(F.transform(F.split(value, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts)


def cron_like(value: Column) -> Column:
    """Five fields of the characters that schedules use."""
    fields = F.split(F.trim(value), r"\s+")
    return (F.size(fields) == 5) & F.forall(fields, lambda x: x.rlike(r"^[0-9A-Za-z*/,\-?#]+$"))


def integer_within(value: Column, least: int, most: int | None = None) -> Column:
    """Whether a setting is written as an integer and lies within the bounds."""
    number = F.when(F.trim(value).rlike(r"^-?\d{1,18}$"), F.trim(value).cast("long"))
    fits = number >= least
    return F.coalesce(fits & (number <= most) if most is not None else fits, F.lit(False))


def postgres_url(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^postgres(ql)?://[^/\s]+"), F.lit(False))


def retryable(status: Column) -> Column:
    """429 and the server errors."""
    return (status == 429) | status.between(500, 599)


def backoff_ms(attempt: Column, base_ms: int = RETRY["base_ms"], max_ms: int = RETRY["max_ms"]) -> Column:
    """The computed delay after the n-th failed attempt, without jitter; a uniform value times it is the delay."""
    return F.least(F.lit(base_ms) * F.pow(F.lit(2.0), attempt - 1), F.lit(max_ms)).cast("long")


def retry_after_ms(header: Column, now_ms: Column, max_ms: int = RETRY["max_ms"]) -> Column:
    """A Retry-After header: seconds, or a date in GMT; clamped to [0, max_ms], null if unreadable."""
    text = F.trim(header)
    digits = F.when(text.rlike(r"^\d+$"), F.when(F.length(text) > 12, F.lit(max_ms)).otherwise(F.least(text.try_cast("long") * 1000, F.lit(max_ms))))
    date = F.unix_millis(F.try_to_timestamp(F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z]{3},\s*", ""), r"\s*GMT$", ""), F.lit("d MMM yyyy HH:mm:ss")))
    return F.coalesce(digits.cast("long"), F.when(date.isNotNull(), F.least(F.greatest(date - now_ms, F.lit(0)), F.lit(max_ms))).cast("long"))


def cost_usd(input_tokens: Column, output_tokens: Column, cache_write: Column, cache_read: Column, input_rate: Column, output_rate: Column) -> Column:
    """Cost in full precision (decimal); rates are dollars a million tokens."""
    million = F.lit("0.000001").cast("decimal(7,6)")
    tokens = lambda x: F.coalesce(x, F.lit(0)).cast("decimal(18,0)")
    rate = lambda x: x.cast("decimal(8,4)")
    write, read = F.lit(CACHE_WRITE).cast("decimal(3,2)"), F.lit(CACHE_READ).cast("decimal(2,1)")
    weighted = (tokens(input_tokens).cast("decimal(20,2)") + tokens(cache_write) * write + tokens(cache_read) * read).cast("decimal(22,2)")
    return (weighted * rate(input_rate) * million + tokens(output_tokens) * rate(output_rate) * million).cast("decimal(38,12)")


def total_input_tokens(input_tokens: Column, cache_write: Column, cache_read: Column) -> Column:
    return input_tokens + F.coalesce(cache_write, F.lit(0)) + F.coalesce(cache_read, F.lit(0))


def within_budget(trailing: Column, pending: Column, ceiling: Column) -> Column:
    """Equality passes."""
    return trailing + pending <= ceiling


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; null where one has no direction."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
