"""Tables behind a paging web service. The fetcher is passed in: executors call it, one page or batch of ids a row."""

from __future__ import annotations

import json
import math
import re
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, Not
from pyspark.sql.types import ArrayType, BooleanType, DataType, FractionalType, IntegralType, StructType

Fetch = Callable[[str], Iterable[dict]]


def condition(equal: dict[str, str] | None = None, between: dict[str, tuple[float, float]] | None = None) -> str:
    """The service's form of predicates, so that it returns matching rows only: `and(eq(a,x),ge(b,1),le(b,2))`."""
    parts = [f"eq({k},{v})" for k, v in sorted((equal or {}).items())]
    for k, (lo, hi) in sorted((between or {}).items()):
        parts += [f"ge({k},{lo})", f"le({k},{hi})"]
    return f"and({','.join(parts)})" if len(parts) > 1 else "".join(parts)


def _fetched(requests: DataFrame, fetch: Fetch, schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for request in pdf["request"]:
                yield pd.DataFrame({"row": [json.dumps(r) for r in fetch(request)]}, dtype=object)

    return requests.select("request").mapInPandas(run, "row string").select(F.from_json("row", schema).alias("r")).select("r.*")


def read_pages(spark: SparkSession, fetch: Fetch, table: str, where: str, total: int, schema: str, page: int = 25_000) -> DataFrame:
    """The `total` rows of a table that match `where`, a request `table/?where&limit(page,start)` a page, pages spread over tasks."""
    pages = spark.range(0, total, page, numPartitions=max(1, min(-(-total // page), 10_000)))
    ask = F.concat(F.lit(f"{table}/?{where}&limit({page},"), F.col("id").cast("string"), F.lit(")"))
    return _fetched(pages.select(ask.alias("request")), fetch, schema)


def read_by_ids(ids: DataFrame, fetch: Fetch, table: str, key: str, schema: str, batch: int = 2_000) -> DataFrame:
    """Rows of the listed ids (id), a request `table/?in(key,(a,b,...))` a batch of them; ids are dealt by hash, so no list is gathered."""
    some = ids.select(F.col("id").cast("string").alias("id")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        for pdf in batches:
            held += pdf["id"].tolist()
            while len(held) >= batch:
                yield pd.DataFrame({"request": [f"{table}/?in({key},({','.join(held[:batch])}))"]})
                held = held[batch:]
        if held:
            yield pd.DataFrame({"request": [f"{table}/?in({key},({','.join(held)}))"]})

    return _fetched(some.mapInPandas(run, "request string"), fetch, schema)


class Reply(NamedTuple):
    """What a request gives: rows, and their place in all that match as the service states it (`items 0-24999/61234`)."""

    rows: list[dict]
    content_range: str


Ask = Callable[[str], Reply]


def total_of(content_range: str) -> int:
    """The number of all matching rows in a content range."""
    found = re.search(r"(\d+)-(\d+)/(\d+)$", content_range.strip())
    if not found:
        raise ValueError(f"no content range: {content_range!r}")
    return int(found.group(3))


def term(f: Filter) -> str | None:
    """The service's form of a filter that Spark pushes; None where it has none."""
    if isinstance(f, Not):
        inner = term(f.child)
        return None if inner is None or not isinstance(f.child, EqualTo | In) else f"not({inner})"
    name = ".".join(f.attribute) if hasattr(f, "attribute") else ""
    value = getattr(f, "value", None)
    simple = isinstance(value, str | int | float) and not isinstance(value, bool) and (not isinstance(value, float) or math.isfinite(value))
    marks = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}
    if type(f) in marks and simple:
        return f"{marks[type(f)]}({name},{quote(str(value), safe='')})"
    if isinstance(f, In) and f.value and all(isinstance(v, str | int) and not isinstance(v, bool) for v in f.value):
        return f"in({name},({','.join(quote(str(v), safe='') for v in f.value)}))"
    return None


@dataclass
class Pages(InputPartition):
    """Pages from first (included) to stop of a request."""

    request: str
    first: int
    stop: int


class PagedReader(DataSourceReader):
    """Reads pages of a service's table; what Spark filters by becomes part of every request."""

    def __init__(self, ask: Ask, options: dict[str, str], schema: StructType):
        self.ask, self.schema, self.terms = ask, schema, []
        self.table, self.page = options["table"], int(options.get("page", 25_000))
        self.tasks, self.attempts, self.wait = int(options.get("tasks", 1_000)), int(options.get("attempts", 4)), float(options.get("wait", 1.0))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            pushed = term(f)
            if pushed:
                self.terms.append(pushed)
            if not pushed or isinstance(f, Not):  # a service's not() keeps rows without the field, Spark's doesn't
                yield f

    def request(self) -> str:
        where = f"and({','.join(sorted(self.terms))})" if len(self.terms) > 1 else "".join(self.terms)
        return f"{self.table}/?{where}&" if where else f"{self.table}/?"

    def asked(self, request: str, rows: int, start: int) -> Reply:
        """A page, asked for again if the service fails, after a pause that doubles each time."""
        for attempt in range(self.attempts):
            try:
                return self.ask(f"{request}limit({rows},{start})")
            except Exception:
                if attempt + 1 == self.attempts:
                    raise
                time.sleep(self.wait * 2**attempt)
        raise AssertionError("attempts must be one or more")

    def partitions(self) -> list[Pages]:
        """The service tells in its first reply how many rows match; their pages are dealt to tasks."""
        request = self.request()
        count = -(-total_of(self.asked(request, 1, 0).content_range) // self.page)
        each = max(1, -(-count // self.tasks))
        return [Pages(request, at, min(count, at + each)) for at in range(0, count, each)] or [Pages(request, 0, 0)]

    def read(self, part: Pages) -> Iterator[tuple]:
        for page in range(part.first, part.stop):
            for row in self.asked(part.request, self.page, page * self.page).rows:
                yield tuple(_as(row.get(f.name), f.dataType) for f in self.schema.fields)


def _as(value: object, kind: DataType) -> object:
    """A value of a reply as its column's type; services give numbers as text, and single values where several are allowed."""
    if value is None:
        return None
    if isinstance(kind, ArrayType):
        return [_as(v, kind.elementType) for v in (value if isinstance(value, list) else [value])]
    if isinstance(kind, BooleanType):
        return str(value).lower() in ("true", "1")
    if isinstance(kind, IntegralType):
        return int(value)
    if isinstance(kind, FractionalType):
        return float(value)
    return str(value)


def register_service(spark: SparkSession, name: str, ask: Ask, columns: str) -> None:
    """A service as a format of this session: spark.read.format(name).option("table", ...).load().

    ask answers one request; it runs on executors (and once on the driver, for the number of rows). Comparisons and lists of
    values that a query filters by reach the service with every request, so that it sends matching rows alone; other filters
    stay with Spark. Options: page (rows of a request), tasks, attempts, wait (seconds before the second attempt).
    """

    class Service(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return columns

        def reader(self, schema: StructType) -> PagedReader:
            return PagedReader(ask, dict(self.options), schema)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Service)


GENOMES = "genome_id string, genome_name string, genus string, species string, superkingdom string, kingdom string, genome_quality string, genome_status string, genetic_code int, taxon_lineage_ids array<int>, taxon_lineage_names array<string>, owner string, public boolean, contigs int, cds int, genome_quality_flags array<string>, reference_genome string, checkm_completeness double, checkm_contamination double, fine_consistency double"
TAXONOMY = "taxon_id int, taxon_name string, taxon_rank string, genetic_code int, division string"


def good_genomes(genomes: DataFrame, rank: str = "genus", min_completeness: float = 80.0, max_contamination: float = 1.0) -> DataFrame:
    """Public genomes of good quality that have a rank name, are whole or shotgun assemblies of bacteria or archaea, and either
    references or complete, clean and consistent enough. The single conditions can be pushed to the service; the choice between
    reference and quality stays with Spark."""
    sound = F.col("checkm_contamination").between(0, max_contamination) & F.col("checkm_completeness").between(min_completeness, 100) & F.col("fine_consistency").between(85, 100)
    plain = (F.col("genome_quality") == "Good") & F.col("genome_status").isin("Complete", "WGS") & F.col("superkingdom").isin("Bacteria", "Archaea") & F.col("public")
    named = F.col(rank).isNotNull() & ~F.col(rank).isin("", "null")
    return genomes.where(plain & named & ((F.col("reference_genome").isNotNull() & (F.col("reference_genome") != "")) | sound))
