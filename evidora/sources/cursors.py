"""Cursors as texts: per-pair marks of feeds, and positions in a round of listings."""

from __future__ import annotations

import json
import logging

from evidora.errors import ConfigError

LISTINGS = ("new", "top")


def read_marks(cursor: str | None) -> dict[str, str]:
    """Marks by pair; an unreadable cursor starts anew with a warning, entries that are not texts are left out."""
    if cursor is None:
        return {}
    try:
        state = json.loads(cursor)
    except ValueError:
        state = None
    if not isinstance(state, dict):
        logging.getLogger(__name__).warning("unreadable feed cursor; starting anew")
        return {}
    return {k: v for k, v in state.items() if isinstance(v, str)}


def write_marks(marks: dict[str, str]) -> str:
    return json.dumps(marks, separators=(",", ":"))


def round_pairs(communities: list[str]) -> list[tuple[str, str]]:
    return [(c, listing) for c in communities for listing in LISTINGS]


def read_position(cursor: str | None, communities: list[str]) -> tuple[int, str | None]:
    """(number of the pair, position in it). Names, not numbers, are stored, so a new order is safe; an unknown name starts anew."""
    if cursor is None:
        return 0, None
    try:
        state = json.loads(cursor)
    except ValueError as error:
        raise ConfigError("unreadable listing cursor", cursor=cursor) from error
    after = state.get("after") if isinstance(state, dict) else 0
    if not isinstance(state, dict) or not isinstance(state.get("subreddit"), str) or state.get("listing") not in LISTINGS or not (after is None or isinstance(after, str)):
        raise ConfigError("unreadable listing cursor", cursor=cursor)
    pair = (state["subreddit"], state["listing"])
    known = round_pairs(communities)
    return (known.index(pair), after) if pair in known else (0, None)


def next_position(communities: list[str], at: int, given: str | None, after: str | None, failed: bool) -> str | None:
    """The cursor after a page: the same place after a failure, the rest of the pair, the next pair, or none after the last."""
    known = round_pairs(communities)
    if failed:
        pair, place = known[at], given
    elif after is not None:
        pair, place = known[at], after
    elif at + 1 < len(known):
        pair, place = known[at + 1], None
    else:
        return None
    return json.dumps({"subreddit": pair[0], "listing": pair[1], "after": place}, separators=(",", ":"))


def read_backfill(cursor: str | None, communities: list[str]) -> tuple[int, str | None]:
    """(number of the community, position in it) of a backfill, whose cursor has no listing; one that has is another's, and an error."""
    if cursor is None:
        return 0, None
    try:
        state = json.loads(cursor)
    except ValueError as error:
        raise ConfigError("unreadable backfill cursor", cursor=cursor) from error
    good = isinstance(state, dict) and isinstance(state.get("subreddit"), str) and "listing" not in state and "after" in state
    if not good or not (state["after"] is None or isinstance(state["after"], str)):
        raise ConfigError("unreadable backfill cursor", cursor=cursor)
    if state["subreddit"] not in communities:
        logging.getLogger(__name__).warning("backfill cursor of an unknown community; starting the range anew")
        return 0, None
    return communities.index(state["subreddit"]), state["after"]


def next_backfill(communities: list[str], at: int, after: str | None) -> str | None:
    """The cursor after a page of a backfill: the rest of the community, the next one, or none after the last."""
    if after is None:
        at += 1
    return json.dumps({"subreddit": communities[at], "after": after}, separators=(",", ":")) if at < len(communities) else None
