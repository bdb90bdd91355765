"""Paged feeds as a Spark data source.

``fetch(offset, limit)`` is supplied by the caller and returns one page as a list of records; it runs inside
tasks. The length of a feed isn't known before it is read. So its end is found first, by asking for pages at
doubling distances and halving the last step, and the pages up to there are divided among tasks. With ``partitions=1``
one task reads the feed in order instead; whatever lies behind the first end of the feed is discarded, so the result is the same.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pelagia.runtime import stage

Fetch = Callable[[int, int], list[dict]]

# Request parameters of the two feed styles.
FEED_PARAMETERS = {
    "offset": {"limit": "limit", "offset": "offset",
               "fixed": {"hasCoordinate": "true", "basisOfRecord": "HUMAN_OBSERVATION"}},
    "from": {"limit": "size", "offset": "from", "fixed": {}},
}


def feed_parameters(style: str, offset: int, limit: int) -> dict:
    """Query parameters of one request."""
    names = FEED_PARAMETERS[style]
    return {names["limit"]: limit, names["offset"]: offset, **names["fixed"]}


@dataclass
class PageRange(InputPartition):
    first: int
    pages: int | None


def _last_page(fetch: Fetch, page_size: int, pages: int, on_error: str) -> int:
    """Number of pages up to an empty one, at most ``pages``, found with about 2 log2 of that many requests."""
    def begins(page: int) -> bool:
        try:
            return len(fetch(page * page_size, page_size)) > 0
        except Exception:
            if on_error == "raise":
                raise
            return False

    low, high = -1, 0  # a page that is known to have records, and the one to ask for
    while high < pages and begins(high):
        low, high = high, max(1, 2 * high)
    high = min(high, pages)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if begins(middle) else (low, middle)
    return high


def _paged_source(fetch: Fetch, page_size: int, target: int, stop: str, partitions: int, on_error: str):
    class PageReader(DataSourceReader):
        def partitions(self):
            if partitions == 1:
                return [PageRange(0, None)]
            pages = _last_page(fetch, page_size, math.ceil(target / page_size), on_error)
            step = max(1, math.ceil(pages / partitions))
            return [PageRange(at, min(step, pages - at)) for at in range(0, pages, step)] or [PageRange(0, 1)]

        def read(self, partition: PageRange):
            page, got = partition.first, 0
            offset = page * page_size
            while got < target and (partition.pages is None or page < partition.first + partition.pages):
                try:
                    records = list(fetch(offset, page_size))
                    # divided, a short page is filled up, since the next one begins at its declared place
                    while partition.pages is not None and stop == "empty" and 0 < len(records) < page_size:
                        more = list(fetch(offset + len(records), page_size - len(records)))
                        if not more:
                            break
                        records += more
                except Exception:
                    if on_error == "raise":
                        raise
                    records = []
                if not records:
                    yield (page, -1, 0, None, None)
                    return
                # rows before the page: those received, or divided those of full pages
                before = got if partition.pages is None else page * page_size
                for position, record in enumerate(records):
                    yield (page, position, len(records), before, json.dumps(record, default=str))
                if stop == "short" and len(records) < page_size:
                    return
                page, got = page + 1, got + len(records)
                # in order, go on behind the rows received; divided, pages have their declared size
                offset = offset + len(records) if partition.pages is None else page * page_size

    class PagedFeed(DataSource):
        @classmethod
        def name(cls):
            return "paged_feed"

        def schema(self):
            return "page bigint, position bigint, page_rows bigint, before bigint, record string"

        def reader(self, schema):
            return PageReader()

    return PagedFeed


def read_paged(spark: SparkSession, fetch: Fetch, page_size: int = 1000, target: int = 50_000,
               stop: str = "empty", cap: bool = False, partitions: int | None = None, on_error: str = "raise") -> DataFrame:
    """``(page, position, record)`` with one JSON text per record.

    ``stop="empty"`` ends at the first empty page, ``"short"`` also at a page shorter than ``page_size``;
    fetching ends once ``target`` rows are there, and ``cap`` cuts the result to exactly ``target`` rows.
    A failing fetch is an error unless ``on_error="stop"``, which treats it as an empty page. ``partitions`` is the number of
    tasks that share the pages, the session's parallelism unless given; 1 reads the feed in order, without asking for its end.
    """
    if stop not in ("empty", "short"):
        raise ValueError(f"unknown stop rule {stop!r}")
    partitions = partitions or spark.sparkContext.defaultParallelism
    spark.dataSource.register(_paged_source(fetch, page_size, target, stop, partitions, on_error))
    pages = stage(spark.read.format("paged_feed").load(), "pages")
    rows = pages.where(F.col("position") >= 0)
    if partitions > 1:
        full = page_size if stop == "short" else 1
        end = pages.where(F.col("page_rows") < full).agg(F.min("page").alias("end")).first()["end"]
        if end is not None:
            rows = rows.where(F.col("page") <= end)
    if cap:
        rows = rows.where(F.col("before") + F.col("position") < target)
    return rows.select("page", "position", "record")


def _columns_of(shape: str | None) -> str:
    """The schema for reading records of a merged variant shape: numbers with a point are doubles, what differs is text."""
    if shape is None or not shape.startswith("OBJECT<"):
        return ""
    shape = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", shape)
    shape = re.sub(r"(?<![\w`])(VARIANT|VOID|FLOAT)(?![\w`])", lambda m: "DOUBLE" if m[1] == "FLOAT" else "STRING", shape)
    return re.sub(r"(?<![\w`])OBJECT<", "STRUCT<", shape)


def records_to_table(records: DataFrame, schema: str | None = None) -> DataFrame:
    """JSON records to columns, with ``page`` and ``position`` kept.

    Without a ``schema`` the columns are the union of the keys of all records, in alphabetical order, found by one aggregate that
    merges the shapes of all records; a key missing from a record is null, and one whose values have several types is text.
    """
    if schema is None:
        value = F.try_parse_json("record")
        objects = F.when(F.schema_of_variant(value).startswith("OBJECT<"), value)  # others have no keys
        shape = records.agg(F.schema_of_variant_agg(objects).alias("shape")).first()["shape"]
        schema = _columns_of(shape)
        if not schema:
            return records.select("page", "position")
    parsed = records.withColumn("_r", F.from_json("record", schema))
    return parsed.select("page", "position", "_r.*")
