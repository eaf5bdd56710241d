"""A paged mail service as a Python data source (SC1-SC3): pages are fetched with retries, a
lower bound on the time of receipt is pushed down to the request."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition

#: How often a request is tried, and the first pause between tries in seconds.
TRIES, PAUSE = 5, 0.5


def fetch(url: str, token: str | None = None) -> dict:
    """A page of the service, or the file of a recorded page (file:...); 429 and 5xx are tried again."""
    if url.startswith("file:"):
        with open(url.removeprefix("file:").removeprefix("//").split("?")[0], encoding="utf-8") as f:
            return json.load(f)
    for k in range(TRIES):
        try:
            with urlopen(Request(url, headers={"Authorization": f"Bearer {token}"} if token else {}), timeout=60) as answer:
                return json.load(answer)
        except OSError as e:
            code = getattr(e, "code", 503)
            if k == TRIES - 1 or code != 429 and code < 500:
                raise
            wait = getattr(e, "headers", None)
            time.sleep(float((wait and wait.get("Retry-After")) or PAUSE * 2**k))
    raise AssertionError("unreachable")


def pages(url: str, get: Callable[[str], dict] = fetch) -> Iterator[dict]:
    """The messages of all pages, following the links to the next one."""
    while url:
        page = get(url)
        yield from page.get("value", [])
        url = page.get("@odata.nextLink")


class MailboxSource(DataSource):
    """spark.read.format("mailbox").option("urls", "...,...").load(): one partition per mailbox."""

    @classmethod
    def name(cls) -> str:
        return "mailbox"

    def schema(self) -> str:
        return "id string, receivedDateTime string, message string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options.get("urls", "").split(",") if u]
        self.token = options.get("token") or os.environ.get("MAILBOX_TOKEN")
        self.since: str | None = None
        self.id: str | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, GreaterThanOrEqual) and f.attribute == ("receivedDateTime",):
                self.since = max(self.since or f.value, f.value)
            elif isinstance(f, EqualTo) and f.attribute == ("id",):
                self.id = f.value
            yield f  # also checked by Spark, as a service may answer with more

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        asked = {"$orderby": "receivedDateTime"} | ({"$filter": f"receivedDateTime ge {self.since}"} if self.since else {})
        url = partition.value if partition.value.startswith("file:") else f"{partition.value}?{urlencode(asked)}"
        for m in pages(url, lambda u: fetch(u, self.token)):
            if (self.since is None or (m.get("receivedDateTime") or "") >= self.since) and self.id in (None, m.get("id")):
                yield m.get("id"), m.get("receivedDateTime"), json.dumps(m)
