"""Paged services as Spark data sources: listings that go on by opaque cursors, and archives that go on by time.

`paged_listing`, batch and stream: pages are JSON documents as a listing service returns them, `data.children[].data`
and a cursor `data.after` that names the next page. They lie below `path` as `<cursor>.json`, or come from a service
(`http://...`) that takes the cursor as `after`. Several listings, named by their first cursors, are read side by side.
Reading one stops at a missing page, a body that isn't JSON, an empty page, no cursor, or `limit` items.

`paged_archive`, batch: a service that returns rows newest first between two times. Bounds of created_utc in a query
become the service's parameters, so pages outside them are never asked for; windows of time are read side by side.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from threadloom.functions import lookups as L

FIELDS = "id string, title string, permalink string, url string, author string, selftext string, score double, num_comments double, created_utc double, stickied boolean, removed_by_category string"
COMMENT_FIELDS = "id string, post_id string, parent_id string, author string, body string, score double, created_utc double, depth double"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
#: Pages of a listing that a stream's task reads unless the option says otherwise.
PAGES_PER_TASK = 50
#: Rows of an archive's page; most posts of a window and most comments of a thread; seconds of a request.
PAGE, MOST_POSTS, MOST_COMMENTS, TIMEOUT = 100, 50_000, 5_000, 30
#: A second that fills a page is asked for again in pages twice as long, up to so many rows.
LONGEST_PAGE = 1_600
_NUMBERS = {"score", "num_comments", "created_utc"}


def _number(x) -> float | None:
    return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None


def _row(item: dict) -> tuple:
    return tuple(_number(item.get(n)) if n in _NUMBERS else item.get(n) for n in NAMES)


# --- listings ---------------------------------------------------------------------------------------------------------


def file_page(path: str) -> Callable[[str], str | None]:
    """Fetches a page by its cursor; none where it isn't there."""
    from pyarrow import fs

    def fetch(cursor: str) -> str | None:
        system, top = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        name = f"{top}/{cursor}.json"
        if system.get_file_info(name).type != fs.FileType.File:
            return None
        with system.open_input_stream(name) as f:
            return f.read().decode()

    return fetch


def http_page(url: str) -> Callable[[str], str | None]:
    """Fetches a page of a service; none where it is refused."""

    def fetch(cursor: str) -> str | None:
        try:
            with urlopen(f"{url}?{urlencode({'after': cursor, 'limit': PAGE})}", timeout=TIMEOUT) as r:
                return r.read().decode()
        except (HTTPError, URLError):
            return None

    return fetch


def fetcher(path: str) -> Callable[[str], str | None]:
    return http_page(path) if path.startswith("http") else file_page(path)


def pages(fetch: Callable[[str], str | None], cursor: str) -> Iterator[tuple[list[dict], str | None]]:
    """(items, next cursor) from a cursor on."""
    at: str | None = cursor
    while at:
        body = fetch(at)
        try:
            data = json.loads(body).get("data") or {} if body else {}
        except ValueError:
            return
        items = [c["data"] for c in data.get("children") or [] if c.get("data")]
        if not items:
            return
        at = data.get("after")
        yield items, at


class PagedListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


class _Reader(DataSourceReader):
    """One partition a first cursor: option `cursors` (comma-separated) reads several listings side by side."""

    def __init__(self, options):
        self.path, self.limit = options["path"], int(options.get("limit", 0))
        self.cursors = options.get("cursors", "first").split(",")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(c) for c in self.cursors]

    def read(self, partition) -> Iterator[tuple]:
        left = self.limit or None
        for items, _ in pages(fetcher(self.path), partition.value):
            for item in items if left is None else items[:left]:
                yield _row(item)
            left = left if left is None else left - len(items)
            if left is not None and left <= 0:
                return


@dataclass
class Stretch(InputPartition):
    """What a task reads of a listing: from an item of one page up to an item of another."""

    cursor: str
    seen: int
    to_cursor: str
    to_seen: int


class _Stream(DataSourceStreamReader):
    """Offsets are a cursor a listing, and how many of its page's items were read: a last page may grow, and may name a
    next one later. The driver walks from cursor to cursor and keeps nothing of a page but, now and then, its cursor, so
    that several tasks read what is new of a listing. A query that is started again walks from the first page, since
    Spark doesn't say where the checkpoint was; its tasks begin there.
    """

    def __init__(self, options):
        self.path, self.per_task = options["path"], int(options.get("pagesPerTask", PAGES_PER_TASK))
        self.listings = options.get("cursors", "first").split(",")
        self.at = self.initialOffset()
        self.walked: dict[str, list[str]] = {}

    def initialOffset(self) -> dict:
        return {c: {"cursor": c, "seen": 0} for c in self.listings}

    def latestOffset(self) -> dict:
        self.at = {c: self._walk(c, at["cursor"], at["seen"]) for c, at in self.at.items()}
        return self.at

    def _walk(self, listing: str, cursor: str, seen: int) -> dict:
        """To the end of what is there. Cursors of every so many pages are kept, from the last walk that moved."""
        marks, n = [cursor], 0
        for items, after in pages(fetcher(self.path), cursor):
            cursor, seen = (after, 0) if after else (cursor, max(seen, len(items)))
            n += 1
            if after and n % self.per_task == 0:
                marks.append(cursor)
        if n > 1 or listing not in self.walked:
            self.walked[listing] = marks
        return {"cursor": cursor, "seen": seen}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """A listing that the checkpoint doesn't know yet begins at its first page."""
        first, out = self.initialOffset(), []
        for listing, to in end.items():
            at = start.get(listing) or first.get(listing)
            if at is None or at == to:
                continue
            marks = self.walked.get(listing, [])
            known = marks[marks.index(at["cursor"]) + 1 :] if at["cursor"] in marks else []
            stops = [(c, 0) for c in known if (c, 0) != (to["cursor"], to["seen"])] + [(to["cursor"], to["seen"])]
            begin = (at["cursor"], at["seen"])
            for stop in stops:
                out.append(Stretch(*begin, *stop))
                begin = stop
        return out

    def read(self, partition: Stretch) -> Iterator[tuple]:
        cursor, seen = partition.cursor, partition.seen
        while (cursor, seen) != (partition.to_cursor, partition.to_seen):
            found = next(pages(fetcher(self.path), cursor), None)
            if found is None:
                return
            items, after = found
            if cursor == partition.to_cursor:
                yield from map(_row, items[seen : partition.to_seen])
                return
            yield from map(_row, items[seen:])
            cursor, seen = after, 0


# --- archives ---------------------------------------------------------------------------------------------------------


def ask(url: str, params: dict, delay: float) -> list[dict]:
    """The rows of one request, newest first; none if it fails for good. A service that is busy (429) is asked once more
    after a while, one that refuses the parameters (422) without the order."""
    for attempt in range(2):
        try:
            with urlopen(f"{url}?{urlencode(params)}", timeout=TIMEOUT) as r:
                found = json.loads(r.read().decode()).get("data") or []
            # without the order asked for, it may come in any
            return sorted((x for x in found if isinstance(x, dict)), key=lambda x: -(_number(x.get("created_utc")) or 0))
        except HTTPError as e:
            if attempt or e.code not in (422, 429):
                return []
            params = {k: v for k, v in params.items() if e.code == 429 or not k.startswith("sort")}
            time.sleep(delay)
        except (URLError, ValueError):
            return []
    return []


def by_time(request: Callable[[dict], list[dict]], after: float | None, before: float | None, most: int) -> Iterator[dict]:
    """Rows with after <= created_utc < before, newest first, each id once, at most `most`.

    A page ends at its oldest second, which the next one asks for again: rows of one second may lie on two pages. Ids of
    that second tell them apart. If a whole page is of one second, and known, it is asked for in longer ones.
    """
    size, seen, n = PAGE, set(), 0
    while n < most and (after is None or before is None or after < before):
        rows = request({"limit": size, **({} if before is None else {"before": math.ceil(before)}), **({} if after is None else {"after": math.floor(after)})})
        fresh = [r for r in rows if str(r.get("id") or "") not in seen]
        for r in fresh:
            at = _number(r.get("created_utc")) or 0.0
            if (after is None or at >= after) and (before is None or at < before) and n < most:
                n += 1
                yield r
        if len(rows) < size:
            return
        oldest = math.floor(_number(rows[-1].get("created_utc")) or 0)
        if after is not None and oldest < after:
            return
        if fresh:
            before, size = oldest + 1, PAGE
        elif size < LONGEST_PAGE:
            size *= 2
            continue
        else:  # more rows in a second than any page takes
            before, size = oldest, PAGE
        seen = {str(r["id"]) for r in rows if r.get("id") and math.floor(_number(r.get("created_utc")) or 0) == oldest}


class PagedArchive(DataSource):
    """Options: path (the service), kind (posts, or comments of the threads in `threads`, comma-separated), windows (how
    many are read side by side if both ends are bounded), limit (newest rows; one window then), query, delay (seconds
    before a request is made again). Each window gives at most 50,000 posts, each thread 5,000 comments."""

    @classmethod
    def name(cls) -> str:
        return "paged_archive"

    def schema(self) -> str:
        return COMMENT_FIELDS if self.options.get("kind") == "comments" else FIELDS

    def reader(self, schema) -> DataSourceReader:
        return _Archive(self.options)


@dataclass
class Window(InputPartition):
    after: float | None
    before: float | None
    thread: str | None = None


class _Archive(DataSourceReader):
    def __init__(self, options):
        self.url, self.kind = options["path"], options.get("kind", "posts")
        self.threads = [t for t in options.get("threads", "").split(",") if t]
        self.windows, self.limit, self.delay = int(options.get("windows", 8)), int(options.get("limit", 0)), float(options.get("delay", 2.0))
        self.query = options.get("query")
        self.after: float | None = None
        self.before: float | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of created_utc are kept to exactly; Spark looks after all other filters."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) != ("created_utc",) or _number(value) is None:
                yield f
            elif isinstance(f, (GreaterThanOrEqual, GreaterThan, EqualTo)) or isinstance(f, (LessThan, LessThanOrEqual)):
                up = math.nextafter(value, math.inf)
                if isinstance(f, (GreaterThanOrEqual, GreaterThan, EqualTo)):
                    least = up if isinstance(f, GreaterThan) else value
                    self.after = least if self.after is None else max(self.after, least)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    end = value if isinstance(f, LessThan) else up
                    self.before = end if self.before is None else min(self.before, end)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.kind == "comments":
            return [Window(self.after, self.before, t) for t in self.threads]
        if self.after is None or self.before is None or self.limit or self.windows < 2:
            return [Window(self.after, self.before)]
        if self.before <= self.after:
            return [Window(self.after, self.after)]  # Spark takes no list without a partition
        step = (self.before - self.after) / self.windows
        cuts = [self.after, *dict.fromkeys(c for i in range(1, self.windows) if self.after < (c := math.floor(self.after + i * step)) < self.before), self.before]
        return [Window(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]

    def read(self, partition: Window) -> Iterator[tuple]:
        if partition.thread is None:
            base = {"query": self.query} if self.query else {"sort": "desc", "sort_type": "created_utc"}
            for item in by_time(lambda p: ask(f"{self.url}/posts", base | p, self.delay), partition.after, partition.before, min(self.limit or MOST_POSTS, MOST_POSTS)):
                yield _row(item)
            return
        base = {"link_id": partition.thread, "sort": "desc"}
        for c in by_time(lambda p: ask(f"{self.url}/comments", base | p, self.delay), partition.after, partition.before, min(self.limit or MOST_COMMENTS, MOST_COMMENTS)):
            if (c.get("body") or "") not in L.DELETED:
                parent = c.get("parent_id") or f"t3_{partition.thread}"
                yield c.get("id"), partition.thread, parent, c.get("author"), c["body"], _number(c.get("score")), _number(c.get("created_utc")), 0.0 if str(parent).startswith("t3_") else 1.0


def register(spark) -> None:
    """Makes both sources known, and lets filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedListing)
    spark.dataSource.register(PagedArchive)
