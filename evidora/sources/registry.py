"""Sources by name, and those that are left out with the reason."""

from __future__ import annotations

from typing import Protocol

from evidora.errors import ConfigError
from evidora.operators.runs import Page
from evidora.schemas import SOURCES


class Source(Protocol):
    def incremental(self, cursor: str | None) -> Page: ...
    def backfill(self, span: tuple, cursor: str | None) -> Page: ...
    def health(self) -> tuple[bool, str]: ...


class Registry:
    def __init__(self, adapters: dict[str, Source], skipped: dict[str, str] | None = None):
        skipped = skipped or {}
        for name in [*adapters, *skipped]:
            if name not in SOURCES:
                raise ConfigError("unknown source", source=name)
        if both := adapters.keys() & skipped.keys():
            raise ConfigError("a source is both registered and skipped", source=min(both))
        self._adapters, self._skipped = dict(adapters), dict(skipped)

    @classmethod
    def of(cls, pairs: list[tuple[str, Source]], skipped: dict[str, str] | None = None) -> Registry:
        """From a list, in which a source may not come twice."""
        names = [n for n, _ in pairs]
        if len(set(names)) < len(names):
            raise ConfigError("a source is registered twice", sources=names)
        return cls(dict(pairs), skipped)

    def get(self, name: str) -> Source:
        if name not in self._adapters:
            raise ConfigError("no such source is registered", source=name)
        return self._adapters[name]

    def sources(self) -> list[str]:
        return [s for s in SOURCES if s in self._adapters]

    def skipped(self) -> dict[str, str]:
        return dict(self._skipped)

    def only(self, name: str) -> Registry:
        """This registry with one source; the others are skipped."""
        others = {s: f"run is restricted to {name}" for s in self._adapters if s != name}
        return Registry({name: self.get(name)}, {**others, **{s: r for s, r in self._skipped.items() if s != name}})


class PagedSource:
    """A source over a list of pages; its cursor is the number of the next page, so a replay gives the same pages."""

    def __init__(self, pages: list[Page | list[dict]], healthy: bool = True, detail: str = "ok"):
        self._pages = [p if isinstance(p, Page) else Page(p) for p in pages]
        self._health = healthy, detail

    def incremental(self, cursor: str | None) -> Page:
        if cursor is not None and not cursor.isdigit():
            raise ConfigError("unreadable cursor", cursor=cursor)
        at = int(cursor or 0)
        if at >= len(self._pages):
            return Page([])
        page = self._pages[at]
        following = page.cursor if page.cursor is not None else str(at + 1) if at + 1 < len(self._pages) else None
        return Page(page.documents, following, page.truncated, page.error)

    def backfill(self, span: tuple, cursor: str | None) -> Page:
        """Documents with created_at in the span, both ends included."""
        page = self.incremental(cursor)
        return Page([d for d in page.documents if span[0] <= d["created_at"] <= span[1]], page.cursor, page.truncated, page.error)

    def health(self) -> tuple[bool, str]:
        return self._health


def production(captures: dict[str, Source], credentials: bool) -> Registry:
    """The registry of a deployment: the listing source needs credentials and is skipped without them."""
    if credentials:
        return Registry(captures)
    return Registry({k: v for k, v in captures.items() if k != "reddit"}, {"reddit": "credentials are not configured"})
