"""Paginated listings as a data source: each page of a collection is fetched by offset mark; filters go to the service.

The transport is a function from a URL path and parameters to decoded JSON, so tests and offline runs bring their own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition

Fetch = Callable[[str, dict[str, str]], dict]
#: Filterable columns and the service's parameters for them (fixed values).
PARAMETERS = {"congress": "congress", "docClass": "docClass"}


def since_timestamp(since: str) -> str:
    """A date alone means its first instant."""
    return f"{since}T00:00:00Z" if len(since) == 10 else since


def pages(fetch: Fetch, path: str, params: dict[str, str], items: str) -> Iterator[dict]:
    """Items of all pages; a page names the next one, if there is one."""
    mark: str | None = "*"
    while mark:
        answer = fetch(path, {**params, "offsetMark": mark})
        yield from answer.get(items) or []
        mark = answer.get("nextOffsetMark") if answer.get("nextPage") else None


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str], fetch: Fetch, schema_names: list[str]):
        self.options, self.fetch, self.names, self.params = options, fetch, schema_names, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in PARAMETERS:
                self.params[PARAMETERS[f.attribute[0]]] = str(f.value)
            elif isinstance(f, GreaterThanOrEqual) and f.attribute == ("lastModified",):
                self.params["since"] = since_timestamp(str(f.value))
            yield f  # checked again by Spark

    def partitions(self) -> list[InputPartition]:
        """One per collection: a listing's pages can only be read in order."""
        return [InputPartition(c) for c in self.options.get("collections", "").split(",") if c]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        params = dict(self.params)
        path = f"collections/{partition.value}" + (f"/{params.pop('since')}" if "since" in params else "")
        for x in pages(self.fetch, path, {"pageSize": self.options.get("pagesize", "1000"), **params}, self.options.get("items", "packages")):
            yield tuple(None if x.get(n) is None else str(x[n]) for n in self.names)


def listing_source(fetch: Fetch) -> type[DataSource]:
    """A data source class for `spark.dataSource.register`, reading with the given transport."""

    class Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return "listing"

        def schema(self) -> str:
            return "packageId string, title string, congress string, docClass string, dateIssued string, lastModified string"

        def reader(self, schema) -> ListingReader:
            return ListingReader(dict(self.options), fetch, [f.name for f in schema])

    return Listing


def register_listing(spark: SparkSession, fetch: Fetch) -> None:
    """Register the source under `listing`, with filter pushdown into Python sources switched on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(listing_source(fetch))


def folder_fetch(folder: str) -> Fetch:
    """A transport over saved answers: `<path with _>-<offset mark>.json`."""

    def fetch(path: str, params: dict[str, str]) -> dict:
        name = path.replace("/", "_").replace(":", "-")
        mark = "first" if params["offsetMark"] == "*" else params["offsetMark"]
        with open(f"{folder}/{name}-{mark}.json", encoding="utf-8") as f:
            return json.load(f)

    return fetch
