"""Pages of a report as files of JSON, with an index that is written last.

    register(spark)
    pages.write.format("report_pages").option("path", folder).option("base", "families").mode("overwrite").save()

pages: page int, first string, last string, body string (JSON of the page). Each page is a file <base>-0001.json of its number,
its neighbours, their number and its rows; <base>-index.json lists all of them. Tasks write under names of their own; only a
commit puts the pages of the attempts that count in their places and then writes the index, so whoever reads by the index
never meets half a report, and a failed one leaves nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .fasta import _system


def paged(rows: DataFrame, number: str, order: str, size: int) -> DataFrame:
    """(page, first, last, body): rows that are numbered from 1 in column `number`, `size` a page; first and last are by column `order`.

    A page is one row, and its rows one group: bounded by `size`.
    """
    body = F.sort_array(F.collect_list(F.struct(number, *(c for c in rows.columns if c != number))))
    of = F.floor((F.col(number) - 1) / size).cast("int") + 1
    out = rows.groupBy(of.alias("page")).agg(body.alias("rows"))
    at = lambda i: F.element_at("rows", i)[order].cast("string")
    return out.select("page", at(1).alias("first"), at(-1).alias("last"), F.to_json("rows").alias("body"))


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: page, first, last and file of each."""

    pages: list[tuple[int, str, str, str]]


class ReportWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.base, self.overwrite = options["path"].rstrip("/"), options.get("base", "page"), overwrite
        self.drafts = f"{self.path}/.drafts-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Written:
        system, drafts = _system(self.drafts)
        system.create_dir(drafts, recursive=True)
        done = []
        for row in rows:
            file = f"{drafts}/{uuid.uuid4().hex}"
            with system.open_output_stream(file) as out:
                out.write(row["body"].encode())
            done.append((row["page"], row["first"], row["last"], file))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _system(self.path)
        system.create_dir(folder, recursive=True)
        pages = sorted(p for m in messages if m for p in m.pages)
        numbers = [p[0] for p in pages]
        if len(set(numbers)) < len(numbers):
            self.abort(messages)
            raise ValueError("a page was given twice")
        index = f"{folder}/{self.base}-index.json"
        if system.get_file_info(index).type != pa.fs.FileType.NotFound:
            if not self.overwrite:
                self.abort(messages)
                raise FileExistsError(index)
            old = json.loads(system.open_input_stream(index).read())
            system.delete_file(index)  # from here on there is no report, until the new index is there
            for page in old["pages"]:
                system.delete_file(f"{folder}/{page['file']}")
        name = lambda n: f"{self.base}-{n:04d}.json"
        listed = []
        for k, (n, first, last, draft) in enumerate(pages):
            head = {"page": n, "num_pages": len(pages), "prev": name(numbers[k - 1]) if k else None, "next": name(numbers[k + 1]) if k + 1 < len(pages) else None}
            with system.open_input_stream(draft) as body, system.open_output_stream(f"{folder}/{name(n)}") as out:
                out.write(json.dumps(head)[:-1].encode() + b', "rows": ')
                while chunk := body.read(1 << 20):
                    out.write(chunk)
                out.write(b"}")
            listed.append({"page": n, "file": name(n), "first": first, "last": last})
        with system.open_output_stream(f"{index}.draft") as out:
            out.write(json.dumps({"pages": listed}).encode())
        system.move(f"{index}.draft", index)
        self._tidy()

    def abort(self, messages: list[Written | None]) -> None:
        self._tidy()

    def _tidy(self) -> None:
        system, drafts = _system(self.drafts)
        if system.get_file_info(drafts).type != pa.fs.FileType.NotFound:
            system.delete_dir(drafts)


class ReportPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "report_pages"

    def schema(self) -> str:
        return "page int, first string, last string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> ReportWriter:
        return ReportWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReportPages)
