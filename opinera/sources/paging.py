"""Paged remote sources: when to ask again, how a walk through pages resumes, and pages as a Spark data source.

How a page is asked for is a parameter, a function that tests and clusters supply; nothing here opens a connection.
"""

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from opinera.sources.files import append_jsonl, write_json


@dataclass(frozen=True)
class Response:
    status: int
    body: dict = field(default_factory=dict)
    retry_after: str | None = None


@dataclass(frozen=True)
class Retry:
    """Which answers end a walk at once, which are asked again, and after how long."""

    attempts: int = 5
    exponential: bool = True
    pause: float = 2.0
    fatal: tuple[int, ...] = (403,)
    again: tuple[int, ...] = (429,)

    def wait(self, attempt: int, retry_after: str | None = None) -> float:
        """Seconds after the attempt (from 1): what the server says, else 2, 4, 8 ..., or always the same."""
        if retry_after and retry_after.isdigit():
            return float(retry_after)
        return float(2**attempt) if self.exponential else self.pause


#: A crawler gives up when it is refused; a check of single items asks again.
CRAWLER = Retry()
CHECKER = Retry(fatal=(), again=(403, 429))


class Refused(RuntimeError):
    """The source doesn't answer, or doesn't want to."""


def ask(get: Callable[[], Response], retry: Retry = CRAWLER, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The body of the first good answer."""
    for attempt in range(1, retry.attempts + 1):
        found = get()
        if 200 <= found.status < 300:
            return found.body
        if found.status in retry.fatal or not (found.status in retry.again or found.status >= 500):
            raise Refused(f"status {found.status}")
        if attempt < retry.attempts:
            sleep(retry.wait(attempt, found.retry_after))
    raise Refused(f"no good answer in {retry.attempts} attempts")


def walk(fetch: Callable[[str], dict], cursor: str = "*", most_pages: int | None = None) -> Iterator[tuple[int, str, dict]]:
    """number, cursor and body of pages, until one is empty, a cursor comes again, or most_pages. A body has rows and cursor."""
    seen, number = set(), 0
    while cursor not in seen and (most_pages is None or number < most_pages):
        seen.add(cursor)
        body = fetch(cursor)
        number += 1
        if not body.get("rows"):
            return
        yield number, cursor, body
        cursor = body.get("cursor") or cursor


def archive_page(root: str | Path, item: int, number: int, cursor: str, body: dict) -> Path:
    """One JSON file a page, as it came."""
    path = Path(root) / str(item) / f"page_{number:05d}.json"
    write_json(path, {"item": item, "page": number, "cursor": cursor, "body": body})
    return path


def wanted(row: dict, seen: set[str]) -> bool:
    """English, with an id that is new."""
    key = str(row.get("recommendationid") or "").strip()
    return bool(key) and row.get("language") == "english" and key not in seen


def crawl(fetch: Callable[[str], dict], item: int, target: int, out: str | Path, state: str | Path, archive: str | Path | None = None) -> int:
    """Appends up to target new rows of an item to a JSONL file, and where it got to to a state file; a second run goes on there."""
    out, state = Path(out), Path(state)
    out.parent.mkdir(parents=True, exist_ok=True)
    seen = {json.loads(line)["review"]["recommendationid"] for line in out.read_text().splitlines() if line.strip()} if out.exists() else set()
    before = json.loads(state.read_text()) if state.exists() else {"cursor": "*", "page": 0, "done": False}
    if before["done"] or len(seen) >= target:
        return len(seen)
    for number, cursor, body in walk(fetch, before["cursor"]):
        page = before["page"] + number
        if archive:
            archive_page(archive, item, page, cursor, body)
        fresh = []
        for row in body["rows"]:
            if len(seen) < target and wanted(row, seen):
                seen.add(str(row["recommendationid"]).strip())
                fresh.append({"appid": item, "page_number": page, "request_cursor": cursor, "review": row})
        append_jsonl(out, fresh)
        write_json(state, {"cursor": body.get("cursor") or cursor, "page": page, "done": len(seen) >= target})
        if len(seen) >= target:
            break
    return len(seen)


@dataclass
class _Item(InputPartition):
    item: str

    def __init__(self, item: str):
        super().__init__(item)
        self.item = item


class _Pages(DataSourceReader):
    def __init__(self, fetch: Callable[[str, str], dict], items: list[str], most: int):
        self.fetch, self.items, self.most = fetch, items, most

    def partitions(self):
        return [_Item(i) for i in self.items]

    def read(self, partition):
        for number, cursor, body in walk(lambda c: self.fetch(partition.item, c), most_pages=self.most):
            for row in body["rows"]:
                yield int(partition.item), number, cursor, json.dumps(row)


def register_pages(spark: SparkSession, name: str, fetch: Callable[[str, str], dict]) -> None:
    """spark.read.format(name) with options items ('1,2,3') and pages (most a walk): a task an item, a row a row of a page.

    Rows come as JSON text, to be read by the schema that the reader wants.
    """

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "item int, page int, cursor string, value string"

        def reader(self, schema):
            items = [i for i in self.options.get("items", "").split(",") if i]
            return _Pages(fetch, items, int(self.options.get("pages", "3")))

    spark.dataSource.register(Pages)


@dataclass(frozen=True)
class Feasibility:
    rows: int
    status: str
    pages: int

    @property
    def feasible(self) -> bool:
        return self.status == "TARGET_REACHED"


def probe(fetch: Callable[[str], dict], target: int, idle_pages: int = 3) -> Feasibility:
    """Whether a walk gets to target new rows: it ends there, at the end, or after pages in a row without anything new."""
    if target < 1:
        raise ValueError("a probe wants at least one row")
    seen: set[str] = set()
    pages = idle = 0
    for pages, _, body in walk(fetch):  # noqa: B007
        before = len(seen)
        for row in body["rows"]:
            if wanted(row, seen):
                seen.add(str(row["recommendationid"]).strip())
        if len(seen) >= target:
            return Feasibility(target, "TARGET_REACHED", pages)
        idle = 0 if len(seen) > before else idle + 1
        if idle >= idle_pages:
            return Feasibility(len(seen), "EXHAUSTED_STAGNANT", pages)
    return Feasibility(len(seen), "EXHAUSTED", pages)


def player_count(get: Callable[[], Response], retry: Retry = Retry(attempts=3, fatal=()), sleep: Callable[[float], None] = time.sleep) -> int:
    """The number of players that a good answer has; an answer that says it failed, or has no such number, is asked for again."""
    for attempt in range(1, retry.attempts + 1):
        body = ask(get, retry, sleep).get("response")
        count = body.get("player_count") if isinstance(body, dict) and body.get("result") == 1 else None
        if isinstance(count, int) and not isinstance(count, bool) and count >= 0:
            return count
        if attempt < retry.attempts:
            sleep(min(30.0, retry.wait(attempt)))
    raise Refused("no player count in the answer")
