"""A statistics server's lists, analytics tables and data values as Spark data sources.

Lists have one partition a page, analytics one a planned unit, data values one a batch, so that requests run side by
side on the executors; the rows of a unit are in the order in which the server gave them, and `unit` orders the units, so
the result does not depend on how many ran at a time. A failed task asks for its unit again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .rest import Client, Refused

PAGE = 500
_TOO_LARGE = ("E7128", "E7151")  # fixed values: the server's codes for a result beyond its limits


def api_base(url: str) -> str:
    """The API's address below a server's, with `/api` once."""
    plain = url.strip().rstrip("/").removesuffix("/api")
    if not plain.startswith(("http://", "https://")):
        raise ValueError(f"not an http address: {url}")
    return f"{plain}/api"


def client_of(options: dict) -> Client:
    import base64

    header = None
    if options.get("token"):
        header = f"ApiToken {options['token']}"
    elif options.get("user"):
        header = "Basic " + base64.b64encode(f"{options['user']}:{options.get('password', '')}".encode()).decode()
    return Client(api_base(options["server"]), header=header, retries=int(options.get("retries", 3)), pause=float(options.get("pause", 0.5)))


def query(parts: list[tuple[str, str]]) -> str:
    from urllib.parse import urlencode

    return "?" + urlencode(parts)


def ask(client: Client, item: dict) -> Iterator[dict]:
    """The answers to one request for values: {indicators, periods or range, level, root, breakdown}. While the server says that the result
    is too large, the periods are halved, then the indicators."""
    when = [("startDate", item["range"][0]), ("endDate", item["range"][1])] if item.get("range") else [("dimension", "pe:" + ";".join(item["periods"]))]
    where = f"ou:LEVEL-{item['level']}" + (f";{item['root']}" if item.get("root") else "")
    parts = [("dimension", "dx:" + ";".join(item["indicators"])), *when, ("dimension", where), ("includeNumDen", "true"), ("skipRounding", "true"), ("includeMetadataDetails", "true"), ("displayProperty", "NAME")]
    if item.get("breakdown"):
        parts.append(("dimension", item["breakdown"]))
    try:
        yield client.get("analytics.json" + query(parts))
        return
    except Refused as e:
        if e.status != 409 or not any(code in str(e) for code in _TOO_LARGE):
            raise
        for key in ("periods", "indicators"):
            if len(item.get(key) or []) > 1:
                break
        else:
            raise ValueError(f"{item['indicators'][0]} at level {item['level']} is too large for the server by itself: {e}") from e
    half = len(item[key]) // 2
    yield from ask(client, item | {key: item[key][:half]})
    yield from ask(client, item | {key: item[key][half:]})


class _Part(InputPartition):
    def __init__(self, number: int, item: object):
        super().__init__(number)
        self.item = item


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)


class ListReader(_Reader):
    def _page(self, number: int) -> dict:
        fields = [(k, v) for k, v in json.loads(self.options.get("query", "[]"))]
        return client_of(self.options).get(f"{self.options['list']}.json" + query([*fields, ("page", str(number)), ("pageSize", str(self.options.get("page", PAGE)))]))

    def partitions(self) -> list[InputPartition]:
        pages = (self._page(1).get("pager") or {}).get("pageCount", 1)
        return [_Part(n, n) for n in range(1, int(pages) + 1)]

    def read(self, partition: InputPartition):
        found = self._page(partition.item).get(self.options["list"])
        if not isinstance(found, list):
            raise ValueError(f"the response has no list {self.options['list']}")
        for n, x in enumerate(found):
            yield partition.item, n, json.dumps(x, ensure_ascii=False, separators=(",", ":"))


class AnalyticsReader(_Reader):
    def partitions(self) -> list[InputPartition]:
        return [_Part(n, item) for n, item in enumerate(json.loads(self.options["units"]))]

    def read(self, partition: InputPartition):
        for n, answer in enumerate(ask(client_of(self.options), partition.item)):
            yield partition.value, n, json.dumps(answer, ensure_ascii=False)


class ValueReader(_Reader):
    """One partition a batch {elements, start, end, roots, since}."""

    def partitions(self) -> list[InputPartition]:
        return [_Part(n, item) for n, item in enumerate(json.loads(self.options["batches"]))]

    def read(self, partition: InputPartition):
        item = partition.item
        parts = [("dataElement", x) for x in item["elements"]] + [("orgUnit", x) for x in item["roots"]] + [("children", "true"), ("startDate", item["start"]), ("endDate", item["end"])]
        if item.get("since"):
            parts += [("lastUpdated", item["since"]), ("includeDeleted", "true")]
        for v in client_of(self.options).get("dataValueSets.json" + query(parts)).get("dataValues") or []:
            yield partition.value, *(v.get(k) for k in ("dataElement", "period", "orgUnit", "categoryOptionCombo", "attributeOptionCombo")), None if v.get("value") is None else str(v["value"]), bool(v.get("deleted"))


def _source(title: str, shape: str, kind: type[_Reader]) -> type[DataSource]:
    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return title

        def schema(self) -> str:
            return shape

        def reader(self, schema) -> DataSourceReader:
            return kind(self.options)

    return Source


Lists = _source("unit_list", "page int, nth int, text string", ListReader)
Analytics = _source("unit_analytics", "unit int, nth int, text string", AnalyticsReader)
Values = _source("unit_values", "unit int, element string, period string, orgUnit string, option string, attribute string, value string, deleted boolean", ValueReader)


def register(spark) -> None:
    for source in (Lists, Analytics, Values):
        spark.dataSource.register(source)


def raster_file(location: str, cache, client: Client, refresh: bool = False) -> str:
    """A raster's local file: a path as it is, or a URL's copy in the cache, which is only kept if it is a TIFF."""
    if "://" not in location:
        return location
    held = None if refresh else cache.get(location)
    if held is None:
        held = client.call(location)
        if held[:4] not in (b"II*\0", b"MM\0*"):
            raise ValueError(f"no TIFF file: {location}")
        cache.put(location, held)
    return cache._paths(location)[0]
