"""Services that answer in pages, as a Spark data source: pages are fetched by tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tessarea.sources.features import answer


def counted(page) -> int:
    """The number in an answer to a count request: {"count": n}, or a list with one record of one value."""
    record = page[0] if isinstance(page, list) else page
    return int(record["count"] if "count" in record else next(iter(record.values())))


def rows_of(page, kind: str) -> tuple[list[dict], bool]:
    """The records of a page, and whether the service says that there are more."""
    if kind == "features":
        return [{**(f.get("attributes") or f.get("properties") or {})} for f in page.get("features", [])], bool(page.get("exceededTransferLimit"))
    return list(page), False


class Pages(InputPartition):
    def __init__(self, first: int, pages: int | None):
        super().__init__(None)
        self.first, self.pages = first, pages


class _Reader(DataSourceReader):
    """With ``total``, or what the url ``count`` answers, a partition for each ``together`` pages; without, one that goes on until a page is short and no more are announced."""

    def __init__(self, schema: StructType, options: Mapping[str, str]):
        self.names = schema.names
        self.types = [f.dataType.typeName() for f in schema.fields]
        self.url, self.kind = options["url"], options.get("kind", "records")
        self.limit, self.total, self.together = int(options.get("limit", "1000")), options.get("total"), int(options.get("together", "10"))
        self.count, self.tries, self.wait = options.get("count"), int(options.get("tries", "5")), float(options.get("wait", "0.5"))

    def fetch(self, url: str):
        return answer(url, self.tries, self.wait)

    def partitions(self) -> list[InputPartition]:
        total = self.total if self.total is not None else counted(self.fetch(self.count)) if self.count else None
        if total is None:
            return [Pages(0, None)]
        pages = -(-int(total) // self.limit)
        return [Pages(p, min(self.together, pages - p)) for p in range(0, pages, self.together)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        page = 0
        while partition.pages is None or page < partition.pages:
            found, more = rows_of(self.fetch(self.url.replace("{offset}", str((partition.first + page) * self.limit)).replace("{limit}", str(self.limit))), self.kind)
            for r in found:
                yield tuple(self._value(r.get(n), t) for n, t in zip(self.names, self.types, strict=True))
            page += 1
            if partition.pages is None and len(found) < self.limit and not more:
                return

    @staticmethod
    def _value(v, kind: str):
        if v is None:
            return None
        if kind == "string":
            return v if isinstance(v, str) else json.dumps(v)
        return int(v) if kind in ("long", "integer") else float(v) if kind == "double" else v


class PagedSource(DataSource):
    """Options: url with {offset} and {limit}, which should name an order, so that pages neither overlap nor leave rows out; kind "records" (a list) or "features";
    limit; total, if known, or count, a url that answers it; together (pages a task); tries and wait (seconds before the second try). The schema is given by the reader's user."""

    @classmethod
    def name(cls) -> str:
        return "tessarea_pages"

    def schema(self) -> str:
        raise ValueError("a schema must be given")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)


def read_paged(spark: SparkSession, url: str, schema: str, **options: str) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return spark.read.format(PagedSource.name()).schema(schema).options(url=url, **options).load()


def read_portal(spark: SparkSession, portal: Mapping[str, str], schema: str) -> DataFrame:
    """By ``portal_type``: socrata (records in pages), arcgis (features in pages) or csv; another type is an error."""
    kind = portal.get("portal_type")
    paged = {k: portal[k] for k in ("limit", "total", "together", "count", "tries", "wait") if k in portal}
    if kind == "socrata":
        return read_paged(spark, portal["url"], schema, kind="records", **paged)
    if kind == "arcgis":
        return read_paged(spark, portal["url"], schema, kind="features", **paged)
    if kind == "csv":
        return spark.read.csv(portal["url"], header=True, schema=schema)
    raise ValueError(f"unknown portal_type {kind}")
