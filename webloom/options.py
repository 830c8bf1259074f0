"""Option objects, validated eagerly on the driver before any plan is built.
Per-row problems are data (an ``error`` column), never exceptions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import ClassVar

# Output formats, error codes and default limits of the engine.
FORMATS = ("markdown", "json", "html", "text")
ERROR_CODES = ("INVALID_URL", "NETWORK_ERROR", "CLOUD_FEATURE", "UNKNOWN")
DEFAULT_AGENT = "webloom"
ROBOTS_TTL_SECONDS = 600
DEFAULT_DELAY_MS = 1000


class WebloomError(ValueError):
    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


def _refuse(opts: dict, names) -> None:
    for n in names:
        if opts.get(n):
            raise WebloomError("CLOUD_FEATURE", f'"{n}" is not available in this engine')


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise WebloomError("UNKNOWN", f"unknown format {fmt!r}")
    return fmt


def _check_patterns(pats) -> tuple[str, ...]:
    out = tuple(pats or ())
    for p in out:
        re.compile(p)  # patterns use Java regexp syntax; reject obviously broken ones early
    return out


@dataclass(frozen=True)
class ScrapeOptions:
    format: str = "markdown"
    pii_filter: bool = False

    def __post_init__(self):
        check_format(self.format)

    @classmethod
    def of(cls, **kw) -> "ScrapeOptions":
        _refuse(kw, ("js_rendering", "screenshot", "wait_for"))
        return cls(**{k: v for k, v in kw.items() if v is not None
                      and k not in ("js_rendering", "screenshot", "wait_for")})


@dataclass(frozen=True)
class CrawlOptions:
    depth: int = 3
    max_pages: int = 500
    format: str = "markdown"
    respect_robots: bool = True
    crawl_delay_ms: int = DEFAULT_DELAY_MS
    same_domain: bool = True
    exclude: tuple[str, ...] = field(default_factory=tuple)
    include: tuple[str, ...] = field(default_factory=tuple)
    user_agent: str = DEFAULT_AGENT
    pii_filter: bool = False
    scan_tos: bool = False
    canonicalize: bool = False

    def __post_init__(self):
        if not 1 <= self.depth <= 10:
            raise WebloomError("UNKNOWN", "depth must be between 1 and 10")
        if self.max_pages < 1:
            raise WebloomError("UNKNOWN", "max_pages must be at least 1")
        if self.crawl_delay_ms < 0:
            raise WebloomError("UNKNOWN", "crawl_delay_ms must be >= 0")
        check_format(self.format)
        object.__setattr__(self, "exclude", _check_patterns(self.exclude))
        object.__setattr__(self, "include", _check_patterns(self.include))

    @classmethod
    def of(cls, **kw) -> "CrawlOptions":
        _refuse(kw, ("js_rendering", "webhook"))
        return cls(**{k: v for k, v in kw.items() if v is not None
                      and k not in ("js_rendering", "webhook")})


@dataclass(frozen=True)
class MapOptions:
    depth: int = 2
    include_external: bool = False

    def __post_init__(self):
        if not 1 <= self.depth <= 5:
            raise WebloomError("UNKNOWN", "depth must be between 1 and 5")


@dataclass(frozen=True)
class SearchOptions:
    MOST: ClassVar[int] = 50
    limit: int = 10
    scrape_content: bool = False
    format: str = "markdown"
    site: str | None = None
    after: str | None = None
    before: str | None = None

    def __post_init__(self):
        if not 1 <= self.limit <= self.MOST:
            raise WebloomError("UNKNOWN", f"limit must be between 1 and {self.MOST}")
        check_format(self.format)

    @classmethod
    def of(cls, **kw) -> "SearchOptions":
        _refuse(kw, ("include_images", "include_news"))
        return cls(**{k: v for k, v in kw.items() if v is not None
                      and k not in ("include_images", "include_news")})
