"""Result tables that are replaced together.

The tables of a folder are written as a new version beside the old one, and a pointer file is
made when all are there.  Readers follow the newest pointer, so they see all tables of one
version or all of the other.  A run that fails leaves the pointer, and with it the old tables,
as they were.

A pointer is a new file with the next number, never a changed one: creating a file that is not
there is atomic on every file system, and of two writers one finds its number taken, reads what
the other has published and takes the next.  A pointer that is not written to its end does not
count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from riskweave.sources.files import Folder

POINTERS = "_published"
VERSIONS = "_versions"
KEEP = 2


class Publication:
    """The published tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = Folder(spark, folder)

    def _numbers(self) -> list[int]:
        names = self.folder.names(POINTERS)
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _pointer(self, number: int) -> str:
        return f"{POINTERS}/{number:012d}.json"

    def _state(self) -> tuple[int, dict[str, str]]:
        """The highest number taken, and the folder of each table by the newest whole pointer."""
        numbers = self._numbers()
        for number in reversed(numbers):
            try:
                return numbers[-1], json.loads(self.folder.read(self._pointer(number)))
            except json.JSONDecodeError:
                continue
        return (numbers[-1] if numbers else 0), {}

    def tables(self) -> dict[str, str]:
        """Path of each table's present version."""
        return {name: f"{self.folder.path}/{at}" for name, at in self._state()[1].items()}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.tables()[name])

    def replace(self, frames: Mapping[str, DataFrame]) -> None:
        """Write the tables and then publish them all at once; other tables stay."""
        version = f"{VERSIONS}/{uuid.uuid4().hex}"
        try:
            for name, frame in frames.items():
                frame.write.parquet(f"{self.folder.path}/{version}/{name}")
        except BaseException:
            self.folder.delete(version)
            raise
        while True:
            number, tables = self._state()
            tables |= {name: f"{version}/{name}" for name in frames}
            if self.folder.create(self._pointer(number + 1), json.dumps(tables)):
                return

    def prune(self, keep: int = KEEP) -> None:
        """Delete what only pointers before the last ``keep`` name.

        Jobs that still read those versions would fail, so keep as many as runs may overlap.
        """
        numbers = self._numbers()
        old, present = numbers[:-keep], numbers[-keep:]
        named = {n: self._named(n) for n in numbers}
        wanted = set().union(*(named[n] for n in present)) if present else set()
        for number in old:
            for at in named[number] - wanted:
                self.folder.delete(at)
            self.folder.delete(self._pointer(number))

    def _named(self, number: int) -> set[str]:
        try:
            return set(json.loads(self.folder.read(self._pointer(number))).values())
        except json.JSONDecodeError:
            return set()


def publish_views(rows: DataFrame, views: Mapping[str, str | tuple[str, str]]) -> None:
    """Replace catalog views that are selections of the same rows, all at once.

    ``views`` gives each name, its parts in backticks, its select list, or select list and condition.  The rows are written
    as a table of a new name; one view, ``<first view>__rows``, points to it, and replacing that
    view is the one step that readers see.  The version before stays for jobs that still read
    it; older ones are dropped.
    """
    spark = rows.sparkSession
    current = _longer(next(iter(views)), "__rows")
    earlier = _versions(spark, current)
    table = _longer(current, f"_{max(earlier, default=0) + 1:08d}")
    rows.write.mode("overwrite").format("parquet").saveAsTable(table)
    spark.sql(f"create or replace view {current} as select * from {table}")
    for name, selection in views.items():
        columns, test = (selection, "true") if isinstance(selection, str) else selection
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"drop table {name}")
        spark.sql(f"create or replace view {name} as select {columns} from {current} where {test}")
    for old in earlier[:-1]:
        spark.sql(f"drop table {_longer(current, f'_{old:08d}')}")


def _longer(name: str, ending: str) -> str:
    """A name in backticks with a longer last part."""
    return f"{name[:-1]}{ending}`"


def _versions(spark: SparkSession, current: str) -> list[int]:
    """Numbers of the tables of rows written so far, ascending."""
    prefix, _, name = current[:-1].rpartition("`")
    among = f"in {prefix[:-1]}" if prefix else ""
    rows = spark.sql(f"show tables {among} like '{name}_*'").collect()
    endings = (r.tableName[len(name) + 1:] for r in rows)
    return sorted(int(e) for e in endings if e.isdigit())
