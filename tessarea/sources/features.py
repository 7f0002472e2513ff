"""Services of features with object ids: planned by their count, typed by their field list, read again after faults, and followed as a stream."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# The protocol's field types; others are read as strings.
KINDS = {"OID": "long", "Integer": "long", "SmallInteger": "long", "BigInteger": "long", "Double": "double", "Single": "double", "Date": "timestamp"}


def answer(url: str, tries: int = 5, wait: float = 0.5, timeout: float = 60.0):
    """The JSON behind a url; faults of the line or of the service are tried again, each time after twice the wait. An error in the answer is one too."""
    for k in range(tries):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as found:
                page = json.loads(found.read().decode("utf-8"))
            if isinstance(page, dict) and "error" in page:
                raise OSError(f"{url}: {page['error']}")
            return page
        except (OSError, ValueError) as e:
            lasting = isinstance(e, urllib.error.HTTPError) and 400 <= e.code < 500 and e.code not in (408, 429)
            if lasting or k == tries - 1:
                raise
            time.sleep(wait * 2**k)
    raise OSError(url)


class Service:
    """A layer's address and how it is asked."""

    def __init__(self, options):
        self.url, self.where, self.wait, self.tries = options["url"].rstrip("/"), options.get("where", "1=1"), float(options.get("wait", "0.5")), int(options.get("tries", "5"))
        self.geometry, self.limit = options.get("geometry", "false") == "true", int(options.get("limit", "0"))
        about = answer(f"{self.url}?f=json", self.tries, self.wait)
        self.id = about.get("objectIdField") or next(f["name"] for f in about["fields"] if f["type"].endswith("OID"))
        self.fields = [(f["name"], KINDS.get(f["type"].removeprefix("esriFieldType"), "string")) for f in about["fields"] if not f["type"].endswith("Geometry")]
        self.limit = min(x for x in (self.limit or 10**9, int(about.get("maxRecordCount") or 1000)))

    def ddl(self) -> str:
        return ", ".join([*[f"`{n}` {k}" for n, k in self.fields], *(["x double", "y double"] if self.geometry else [])])

    def ask(self, **more) -> dict:
        return answer(f"{self.url}/query?{urlencode({'where': self.where, 'f': 'json'} | more)}", self.tries, self.wait)

    def count(self) -> int:
        return int(self.ask(returnCountOnly="true")["count"])

    def last(self) -> int | None:
        """The largest object id."""
        found = self.ask(outFields=self.id, orderByFields=f"{self.id} DESC", resultRecordCount="1", returnGeometry="false").get("features") or []
        return int(found[0]["attributes"][self.id]) if found else None

    def rows(self, features: list, names: list[str]) -> Iterator[tuple]:
        kinds = dict(self.fields)
        for f in features:
            values = {**f.get("attributes", {})}
            place = f.get("geometry") or {}
            if self.geometry:
                values |= {"x": place.get("x"), "y": place.get("y")}
            yield tuple(_typed(values.get(n), kinds.get(n, "double")) for n in names)


def _typed(v, kind: str):
    if v is None:
        return None
    if kind == "timestamp":  # milliseconds since 1970
        return datetime.fromtimestamp(v / 1000, timezone.utc)
    if kind == "string":
        return v if isinstance(v, str) else json.dumps(v)
    return int(v) if kind == "long" else float(v)


class Range(InputPartition):
    """Pages from ``first`` by place, or rows with object ids above ``low`` up to ``high``."""

    def __init__(self, first: int = 0, pages: int = 0, low: int | None = None, high: int | None = None):
        super().__init__(None)
        self.first, self.pages, self.low, self.high = first, pages, low, high


class _Reader(DataSourceReader):
    """A partition for each ``together`` pages of what the service counts, in the order of object ids, so that pages neither overlap nor leave rows out."""

    def __init__(self, schema: StructType, options):
        self.service, self.names, self.together = Service(options), schema.names, int(options.get("together", "10"))

    def partitions(self) -> list[InputPartition]:
        pages = -(-self.service.count() // self.service.limit)
        return [Range(p, min(self.together, pages - p)) for p in range(0, pages, self.together)]

    def read(self, partition: Range | None) -> Iterator[tuple]:
        s = self.service
        for page in range(partition.first, partition.first + partition.pages) if partition else ():
            asked = {"outFields": "*", "orderByFields": s.id, "resultOffset": page * s.limit, "resultRecordCount": s.limit, "returnGeometry": str(s.geometry).lower()}
            found = s.ask(**asked).get("features") or []
            yield from s.rows(found, self.names)


class _Stream(DataSourceStreamReader):
    """Offsets are object ids: a batch has the rows above the former last id, in ranges of ids of a page's size."""

    def __init__(self, schema: StructType, options):
        self.service, self.names = Service(options), schema.names

    def initialOffset(self) -> dict:
        return {"id": -1}

    def latestOffset(self) -> dict:
        last = self.service.last()
        return {"id": -1 if last is None else last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        size = self.service.limit
        return [Range(low=low, high=min(low + size, end["id"])) for low in range(start["id"], end["id"], size)]

    def read(self, partition: Range) -> Iterator[tuple]:
        s = self.service
        inside = f"({s.where}) AND {s.id} > {partition.low} AND {s.id} <= {partition.high}"
        found = s.ask(where=inside, outFields="*", orderByFields=s.id, returnGeometry=str(s.geometry).lower()).get("features") or []
        yield from s.rows(found, self.names)

    def commit(self, end: dict) -> None:
        pass


class FeatureSource(DataSource):
    """Options: url of the layer, where, geometry ("true" adds x and y), limit (rows a page, at most the service's), together (pages a task), tries, wait (seconds before the second try)."""

    @classmethod
    def name(cls) -> str:
        return "tessarea_features"

    def schema(self) -> str:
        return Service(self.options).ddl()

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(schema, self.options)


def read_layer(spark: SparkSession, url: str, **options: str) -> DataFrame:
    """All features of a layer, with the types that the service names."""
    spark.dataSource.register(FeatureSource)
    return spark.read.format(FeatureSource.name()).options(url=url, **options).load()


def follow_layer(spark: SparkSession, url: str, **options: str) -> DataFrame:
    """The layer as a stream: each batch has the features that came since the one before; a restarted query goes on where its checkpoint ends."""
    spark.dataSource.register(FeatureSource)
    return spark.readStream.format(FeatureSource.name()).options(url=url, **options).load()
