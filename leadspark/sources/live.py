"""Pages fetched from the network into a table; off unless called. Everything else in the engine works on the table."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

FIELDS = "url string, html string, error string"


def error_kind(e: BaseException) -> str:
    """ssl_error, timeout, http_error, connection_error or unknown_error."""
    import socket
    import ssl
    import urllib.error

    reason = getattr(e, "reason", e)
    if isinstance(reason, ssl.SSLError):
        return "ssl_error"
    if isinstance(reason, (TimeoutError, socket.timeout)):
        return "timeout"
    if isinstance(e, urllib.error.HTTPError):
        return "http_error"
    return "connection_error" if isinstance(e, OSError) else "unknown_error"


def fetch(urls: DataFrame, per_second: float = 3.0, timeout: float = 10.0, most_bytes: int = 5_000_000) -> DataFrame:
    """(url, html, error) of the urls, each once. The rate holds for the whole job: it is divided by the number of partitions."""
    parts = max(1, urls.rdd.getNumPartitions())
    pause = parts / per_second

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import urllib.request

        last = 0.0
        for b in batches:
            out: dict[str, list] = {"url": [], "html": [], "error": []}
            for u in b.column(0).to_pylist():
                time.sleep(max(0.0, last + pause - time.monotonic()))
                last = time.monotonic()
                html = error = None
                try:
                    with urllib.request.urlopen(urllib.request.Request(u, headers={"User-Agent": "leadspark"}), timeout=timeout) as r:  # noqa: S310
                        html = r.read(most_bytes).decode(r.headers.get_content_charset() or "utf-8", "replace")
                except Exception as e:  # noqa: BLE001 - classified and passed on
                    error = error_kind(e)
                for k, v in (("url", u), ("html", html), ("error", error)):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("url", pa.string()), ("html", pa.string()), ("error", pa.string())]))

    return urls.select("url").distinct().coalesce(parts).mapInArrow(run, FIELDS)
