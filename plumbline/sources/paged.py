"""A keyset-paged source as a Python data source, for batches and for streams.

``spark.dataSource.register(PagedSource)``, then ``spark.readStream.format("paged")`` with the options

    transport   "package.module:function": (after, before, size) -> items (JSON objects) with after < time < before,
                in order of time, at most ``size``; it is called inside tasks, with retries
    now         the same kind of name: () -> the latest time there is
    time        the item's time, "created_utc" by default; whole seconds
    id          the item's key, "id" by default
    after       where to begin; a stream goes on from its checkpoint
    shards      how many ranges of time are read at once
    ranges      for batches: JSON pairs [after, before] that alone are read, e.g. the gaps of an earlier run

The offset is the latest time read. Rows are (id, time, payload); a page that ends within a
second is followed by one that begins with that second again, so ties past a page's edge
aren't lost; each key of that second comes once.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from plumbline.operators.queues import exponential, retried

Transport = Callable[[int, int, int], list[dict]]


def pages(fetch: Transport, after: int, before: int, size: int = 100, time: str = "created_utc", key: str = "id") -> Iterator[dict]:
    """All items with after < time < before; a short page is the last."""
    seen: set = set()  # keys of the second that the last page ended in
    while True:
        page = retried(lambda: fetch(after, before, size), 6, exponential)
        fresh = [x for x in page if x[key] not in seen]
        yield from fresh
        if len(page) < size:
            return
        last = int(page[-1][time])
        if last - 1 == after:
            if not fresh:  # a second with more items than a page: ask for more of it
                size *= 2
            seen |= {x[key] for x in page if int(x[time]) == last}
        else:
            seen = {x[key] for x in page if int(x[time]) == last}
        after = last - 1


def _named(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class _Range(InputPartition):
    def __init__(self, after: int, before: int):
        self.after, self.before = after, before


class _Reader:
    def __init__(self, options: dict):
        self.transport, self.clock = options["transport"], options.get("now", "")
        self.given = json.loads(options["ranges"]) if "ranges" in options else None
        self.time, self.key = options.get("time", "created_utc"), options.get("id", "id")
        self.begin, self.shards, self.size = int(options.get("after", 0)), int(options.get("shards", 1)), int(options.get("size", 100))

    def ranges(self, after: int, upto: int) -> list[_Range]:
        """after < time <= upto, in shards."""
        step = max(1, -(-(upto - after) // self.shards))
        return [_Range(a, min(a + step, upto) + 1) for a in range(after, upto, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        for x in pages(_named(self.transport), partition.after, partition.before, self.size, self.time, self.key):
            yield str(x[self.key]), int(x[self.time]), json.dumps(x, ensure_ascii=False)


class _Batch(_Reader, DataSourceReader):
    def partitions(self) -> list[_Range]:
        if self.given is not None:
            return [_Range(int(a), int(b)) for a, b in self.given]
        return self.ranges(self.begin, int(_named(self.clock)()))


class _Stream(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"after": self.begin}

    def latestOffset(self) -> dict:
        return {"after": max(self.begin, int(_named(self.clock)()))}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        return self.ranges(start["after"], end["after"])

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    """Items of a paged service, newest time as offset."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id string, time long, payload string"

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)
