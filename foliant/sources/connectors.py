"""Calls to services by way of a given transport; nothing here opens a connection of its own."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Statuses worth another try, and a service's limits.
RETRY = frozenset([408, 409, 425, 429, *range(500, 600)])
MAX_PAGES, MAX_BYTES = 100, 50 * 1024 * 1024

#: request -> (status, headers, body)
Transport = Callable[[dict], tuple[int, dict, str]]


def page_ranges(n_pages: int, most: int = MAX_PAGES) -> list[tuple[int, int]]:
    """First and last page, from 1, of the requests that cover a document."""
    return [(a, min(a + most - 1, n_pages)) for a in range(1, n_pages + 1, most)]


def call(send: Transport, request: dict, attempts: int = 4, wait: float = 1.0,
        sleep: Callable[[float], None] = time.sleep) -> tuple[int, str, int]:
    """(status, body, attempts made): tries again on the statuses of RETRY, doubling the wait or as Retry-After says."""
    for k in range(1, attempts + 1):
        status, headers, body = send(request)
        if status not in RETRY or k == attempts:
            return status, body, k
        after = {h.lower(): v for h, v in headers.items()}.get("retry-after", "")
        sleep(float(after) if after.replace(".", "", 1).isdigit() else wait * 2 ** (k - 1))
    raise AssertionError


def paced(items: Iterable, per_minute: float, clock: Callable[[], float] = time.monotonic,
        sleep: Callable[[float], None] = time.sleep) -> Iterator:
    """items, no faster than so many a minute."""
    due = clock()
    for x in items:
        now = clock()
        if now < due:
            sleep(due - now)
        due = max(now, due) + 60 / per_minute
        yield x


def fetch(requests: DataFrame, key: str, payload: str, transport: Callable[[], Transport], attempts: int = 4,
        per_minute: float = 90, lanes: int = 1) -> DataFrame:
    """(key, status, body, attempts) of each request row; transport() makes a lane's transport.

    Requests are dealt over `lanes` partitions, each with its share of the rate, so that all of them together keep to
    per_minute.  Failures are rows too (status -1, or -2 for a payload above MAX_BYTES, which is not sent), so that a
    later run can take up what is left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = transport()
        wait = paced(iter(int, 1), per_minute / lanes)  # one clock for all batches
        for b in batches:
            out = []
            for k, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if len((p or "").encode()) > MAX_BYTES:
                    out.append((k, -2, f"payload above {MAX_BYTES} bytes", 0))
                    continue
                next(wait)
                try:
                    out.append((k, *call(send, {"key": k, "payload": p}, attempts)))
                except Exception as e:  # noqa: BLE001 - whatever a transport raises is that request's row
                    out.append((k, -1, f"{type(e).__name__}: {e}", attempts))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i,
                t in enumerate((pa.string(), pa.int32(), pa.string(), pa.int32()))],
                names=["key", "status", "body", "attempts"])

    return requests.select(requests[key].cast("string").alias("key"),
        requests[payload].cast("string").alias("payload")).repartition(lanes).mapInArrow(run,
        "key string, status int, body string, attempts int")
