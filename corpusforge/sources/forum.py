"""A forum of papers and their notes as a Python data source.

`spark.read.format("forum")` reads pages of an API in parallel: each partition asks for its own
range of a year, or for its own ids, so nothing passes through the driver. The client is named as "module:factory"; its
methods are `count(year)`, `papers(year, start, stop)`, which yields plain dicts, and `paper(id)`, which gives one or None. The default
is an offline client that makes stub papers. `fetched` chooses between ids, a scan and the stub.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "paper_id string, title string, abstract string, venue string, year int, authors array<string>, pos bigint"
# Seconds between two requests, tries after a refusal, seconds to wait where it does not say how long.
INTERVAL, TRIES, FALLBACK_WAIT = 22.0, 3, 60.0


class RateLimited(Exception):
    """A request refused for its rate; `reset` is the time (epoch seconds) from which it is allowed again, if known."""

    def __init__(self, message: str = "", reset: float | None = None):
        super().__init__(message)
        self.reset = reset


class Throttle:
    """Calls at least `interval` apart; a refused one is tried again when its limit is reset."""

    def __init__(self, interval: float = INTERVAL, tries: int = TRIES, fallback: float = FALLBACK_WAIT, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.tries, self.fallback, self.clock, self.sleep, self.free = interval, tries, fallback, clock, sleep, float("-inf")

    def call(self, ask: Callable, *args, **kw):
        for left in range(self.tries, -1, -1):
            wait = self.free - self.clock()
            if wait > 0:
                self.sleep(wait)
            self.free = self.clock() + self.interval
            try:
                return ask(*args, **kw)
            except RateLimited as refused:
                if not left:
                    raise
                self.free = max(self.free, refused.reset if refused.reset is not None else self.clock() + self.fallback)


def first_nonempty(listings: Sequence[tuple[str, Callable[[], list]]]) -> tuple[list, str]:
    """The first listing with rows and its name; one that fails counts as empty; of none the last name."""
    name = ""
    for name, listing in listings:
        try:
            rows = list(listing())
        except Exception:  # noqa: BLE001
            continue
        if rows:
            return rows, name
    return [], name


class StubClient:
    """Ten stub papers a year."""

    def count(self, year: int) -> int:
        return 10

    def papers(self, year: int, start: int, stop: int) -> Iterator[dict]:
        for i in range(start, stop):
            yield {"paper_id": f"paper_{year}_{i}", "title": f"Stub paper {i} of {year}", "abstract": "", "venue": "Stub", "year": year, "authors": []}

    def paper(self, paper_id: str) -> dict | None:
        kind, _, rest = paper_id.partition("_")
        year, _, i = rest.partition("_")
        return next(self.papers(int(year), int(i), int(i) + 1)) if kind == "paper" and year.isdigit() and i.isdigit() and int(i) < 10 else None


class _Page(InputPartition):
    def __init__(self, year: int, start: int, stop: int, first: int, ids: tuple[str, ...] = ()):
        self.year, self.start, self.stop, self.first, self.ids = year, start, stop, first, ids


class ForumReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.years = sorted((int(y) for y in options.get("years", "2024").split(",")), reverse=True)
        self.page, self.limit = int(options.get("page", "5")), int(options.get("limit", "0"))
        self.ids = list(dict.fromkeys(x.strip() for x in options.get("ids", "").split(",") if x.strip()))

    def _client(self):
        module, _, factory = self.options.get("client", f"{__name__}:StubClient").partition(":")
        return getattr(importlib.import_module(module), factory)()

    def partitions(self) -> list[InputPartition]:
        """Pages of the ids, or of the years, newest first, no more than the limit needs."""
        if self.ids:
            return [_Page(0, 0, 0, i, tuple(self.ids[i : i + self.page])) for i in range(0, len(self.ids), self.page)]
        client, pages, pos = self._client(), [], 0
        for year in self.years:
            n = client.count(year)
            for start in range(0, n, self.page):
                if self.limit and pos >= self.limit:
                    return pages
                stop = min(n, start + self.page)
                pages.append(_Page(year, start, stop, pos))
                pos += stop - start
        return pages

    def read(self, partition: _Page) -> Iterator[tuple]:
        client = self._client()
        found = (client.paper(i) for i in partition.ids) if partition.ids else client.papers(partition.year, partition.start, partition.stop)
        for i, p in enumerate(found):
            pos = partition.first + i
            if p is None or self.limit and not partition.ids and pos >= self.limit:
                continue
            yield p["paper_id"], p.get("title"), p.get("abstract"), p.get("venue"), p.get("year"), list(p.get("authors") or []), pos


class ForumSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "forum"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ForumReader:
        return ForumReader(self.options)


def fetched(spark: SparkSession, years: Sequence[int], ids: Sequence[str] | None = None, limit: int | None = None, client: str | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Papers by id (looked up one by one, never filtered), else those of a scan that `keep` keeps, the first `limit` of them in order; stub papers without a client."""
    spark.dataSource.register(ForumSource)
    read = spark.read.format("forum").option("years", ",".join(map(str, years)))
    read = read.option("client", client) if client else read
    if ids:
        return read.option("ids", ",".join(ids)).load().dropDuplicates(["paper_id"])
    if client is None or keep is None:
        return (read.option("limit", str(limit)) if limit else read).load()
    kept = keep(read.load())  # the limit counts kept papers, so it can't be left to the scan
    return kept.orderBy(F.col("pos")).limit(limit) if limit else kept
