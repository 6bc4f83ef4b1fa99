"""Settings from named texts: every problem is reported at once, and secrets never show."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

from evidora.errors import ConfigError

#: Name -> (default, least, most) of the whole-number settings.
INTEGERS = {
    "BUDGET_CEILING_USD": (70, 1, None), "MAX_PAGES_PER_RUN": (25, 1, None), "JOB_RETRY_LIMIT": (3, 0, None), "JOB_BACKOFF_SECONDS": (60, 1, None), "JOB_BACKOFF_MAX_SECONDS": (900, 1, None),
    "JOB_EXPIRE_SECONDS": (3600, 1, None), "JOB_HEARTBEAT_SECONDS": (60, 10, None), "REDDIT_POSTS_PER_PAGE": (25, 1, 100),
}
SCHEDULES = {"CRON_HACKERNEWS": "*/15 * * * *", "CRON_APPSTORE": "17 * * * *", "CRON_REDDIT": "37 * * * *"}
SECRETS = ("DATABASE_URL", "LLM_API_KEY", "REDDIT_CLIENT_SECRET")
LISTS = ("HN_QUERIES", "APPSTORE_APP_IDS", "APPSTORE_TERRITORIES", "REDDIT_SUBREDDITS")


class Secret(str):
    """A text that prints as a mark."""

    def __repr__(self) -> str:
        return "'[redacted]'"

    __str__ = __repr__


@dataclass(frozen=True)
class Config:
    numbers: dict[str, int]
    schedules: dict[str, str]
    time_zone: str
    lists: dict[str, tuple[str, ...] | None]
    secrets: dict[str, Secret] = field(repr=False)
    reddit_client_id: str | None = None
    reddit_user_agent: str | None = None

    @property
    def listing_credentials(self) -> bool:
        return bool(self.reddit_client_id and self.secrets.get("REDDIT_CLIENT_SECRET") and self.reddit_user_agent)

    def redacted(self) -> dict:
        return {**self.numbers, **self.schedules, "TZ": self.time_zone, **self.lists, **{k: "[redacted]" for k in self.secrets}}


def is_cron(value: str) -> bool:
    parts = value.split()
    return len(parts) == 5 and all(re.fullmatch(r"[0-9A-Za-z*/,\-?#]+", p) for p in parts)


def is_time_zone(value: str) -> bool:
    try:
        ZoneInfo(value)
    except (KeyError, ValueError, OSError):
        return False
    return True


def parse_list(value: str | None) -> tuple[str, ...] | None:
    parts = tuple(p.strip() for p in (value or "").split(",") if p.strip())
    return parts or None


def load(env: dict[str, str | None]) -> Config:
    """The settings in ``env``; raises one ConfigError that names every problem."""
    problems: list[str] = []
    numbers: dict[str, int] = {}
    for name, (default, least, most) in INTEGERS.items():
        raw = (env.get(name) or "").strip()
        if not raw:
            numbers[name] = default
        elif not re.fullmatch(r"-?\d+", raw):
            problems.append(f"{name} is not an integer")
        elif int(raw) < least or most is not None and int(raw) > most:
            problems.append(f"{name} is out of bounds")
        else:
            numbers[name] = int(raw)
    schedules = {k: (env.get(k) or "").strip() or v for k, v in SCHEDULES.items()}
    problems += [f"{k} is not a schedule of five fields" for k, v in schedules.items() if not is_cron(v)]
    zone = (env.get("SCHEDULE_TZ") or "UTC").strip()
    if not is_time_zone(zone):
        problems.append("SCHEDULE_TZ is not a time zone")
    url = env.get("DATABASE_URL")
    if not url:
        problems.append("DATABASE_URL is missing")
    elif not re.match(r"postgres(ql)?://[^/\s]+", url):
        problems.append("DATABASE_URL is not a database address")
    if problems:
        raise ConfigError("settings are wrong: " + "; ".join(problems), problems=problems)
    return Config(numbers, schedules, zone, {k: parse_list(env.get(k)) for k in LISTS}, {k: Secret(env[k]) for k in SECRETS if env.get(k)}, env.get("REDDIT_CLIENT_ID"), env.get("REDDIT_USER_AGENT"))


def warnings(config: Config) -> list[str]:
    """Settings that can have no effect."""
    if config.lists["REDDIT_SUBREDDITS"] and not config.listing_credentials:
        return ["communities are set, but the credentials of their source are not"]
    return []
