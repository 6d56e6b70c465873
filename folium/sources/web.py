"""Pages over HTTP: one task a host at a time, a pause between requests, a few attempts with growing waits."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.operators import html

#: Seconds between two requests to a host and for one to answer; attempts, and seconds that each failed one adds.
PAUSE, TIMEOUT, ATTEMPTS, BACKOFF = 1.5, 30.0, 3, 2.0


def get(url: str, timeout: float = TIMEOUT) -> str:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "folium"}), timeout=timeout) as r:  # noqa: S310
        return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")


def fetch(urls: DataFrame, url: str = "url", *, fetcher: Callable[[str, float], str] = get, pause: float = PAUSE, timeout: float = TIMEOUT, attempts: int = ATTEMPTS, backoff: float = BACKOFF, hosts_at_once: int = 64) -> DataFrame:
    """urls' columns with html and error: null html where every attempt failed, and why. Null addresses are left out.

    Rows are divided by host, so the pause holds for each host however many executors there are. A task that is lost
    asks again; write the result before using it twice.
    """
    host = F.regexp_extract(F.col(url), r"^[a-zA-Z]+://([^/]+)", 1)
    rows = urls.where(F.col(url).isNotNull()).repartition(hosts_at_once, host).sortWithinPartitions(host, url)
    at = urls.columns.index(url)
    names = [*urls.columns, "html", "error"]

    def one(u: str) -> tuple[str | None, str | None]:
        why = None
        for k in range(1, attempts + 1):
            try:
                return fetcher(u, timeout), None
            except (OSError, ValueError, urllib.error.URLError) as e:
                why = f"{type(e).__name__}: {e}"
                if k < attempts:
                    time.sleep(backoff * k)
        return None, why

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, float] = {}
        for whole in batches:
            for k in range(0, whole.num_rows, 32):
                b = whole.slice(k, 32)
                got = []
                for u in b.column(at).to_pylist():
                    h = u.split("/")[2] if u.count("/") > 1 else ""
                    wait = last.get(h, 0.0) + pause - time.monotonic()
                    if wait > 0:
                        time.sleep(wait)
                    got.append(one(u))
                    last[h] = time.monotonic()
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(b.num_columns)], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=names)

    schema = urls.schema.add("html", "string").add("error", "string")
    return rows.mapInArrow(run, schema)


def year_documents(spark: SparkSession, index_urls: list[str], languages: list[str], max_docs: int | None = None, **how: object) -> DataFrame:
    """Documents of all bulletins that index pages link to, in each language; pages that fail or hold nothing are left out."""
    index = fetch(spark.createDataFrame([(u,) for u in index_urls], "url string"), **how)
    pages = fetch(html.language_pages(html.index_links(index.where("html IS NOT NULL")), languages, max_docs), **how)
    return html.documents(pages.where("html IS NOT NULL").drop("error")).where(F.size("paragraphs") > 0)
