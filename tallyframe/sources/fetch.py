"""A batch source for manifests over HTTP, and what renders pages. Both need more than this environment offers."""

from __future__ import annotations

import time
from typing import Protocol

from pyspark.sql.datasource import DataSource, DataSourceReader


def waits(retries: int, base: float = 1.0, cap: float = 60.0) -> list[float]:
    """Seconds before each retry."""
    return [min(cap, base * 2**k) for k in range(retries)]


class _Reader(DataSourceReader):
    def __init__(self, url: str, retries: int):
        self.url, self.retries = url, retries

    def read(self, partition):
        import json
        from urllib.request import urlopen

        for wait in [*waits(self.retries), None]:
            try:
                with urlopen(f"{self.url}?t={time.time_ns()}", timeout=30) as answer:
                    body = answer.read().decode("utf-8-sig")
                json.loads(body)
                yield (self.url.rsplit("/", 1)[-1], body)
                return
            except (OSError, ValueError):
                if wait is None:
                    raise
                time.sleep(wait)


class ManifestSource(DataSource):
    """``spark.read.format("manifest").option("url", ...)``: one row of ``file, text``, valid JSON only."""

    @classmethod
    def name(cls):
        return "manifest"

    def schema(self):
        return "file string, text string"

    def reader(self, schema):
        return _Reader(self.options["url"], int(self.options.get("retries", 5)))


class Renderer(Protocol):
    """Turns a PDF's bytes into grey pages; none is installed here."""

    def pages(self, content: bytes, dpi: int = 200) -> list: ...


class Engine(Protocol):
    """Reads a number from a crop; none is installed here."""

    def number(self, crop) -> str: ...


ENGINES: dict[str, type] = {}


def engine(name: str) -> Engine:
    if name not in ENGINES:
        raise LookupError(f"no reading engine called {name!r} is registered; add one to ENGINES")
    return ENGINES[name]()
