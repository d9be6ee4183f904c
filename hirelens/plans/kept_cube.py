"""The market cube kept by day: a new day adds its own cells, and the cube is summed from cells, never from postings."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.analyses import city_cells, cube_of, whole_cells
from hirelens.sources.versions import FOLDER, CommitConflict, Versions
from hirelens.workspace import at_once, listed, remove

MEASURES = ["n", "paid", "total"]
SCHEMAS = {
    "by_city": "group string, city string, experience string, n long, paid long, total double",
    "over_cities": "group string, experience string, n long, paid long, total double",
}


class KeptCube:
    """Cells below `path`, a folder for each day and for each folded month; a version names those that count.

    Counts and sums can be merged, so the cube over any range of days is the sum of their cells. A folded month holds the sums of
    its days and is read in their place while it is made of just the folders that these days have now. Writers commit by
    compare-and-swap, and readers see the version committed last.
    """

    def __init__(self, spark: SparkSession, path: str, tries: int = 10) -> None:
        self.spark, self.path, self.tries, self.versions = spark, path, tries, Versions(spark, path)

    def _entry(self) -> tuple[int, dict]:
        number, entry = self.versions.last()
        return number, entry or {"days": {}, "months": {}}

    def _commit(self, change: Callable[[dict], dict]) -> None:
        """Make a version that is the last one with a change, also if others commit in between."""
        for _ in range(self.tries):
            number, entry = self._entry()
            try:
                self.versions.commit(number, change(entry))
                return
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.tries} other changes of {self.path} came first")

    def _write(self, cells: dict[str, DataFrame]) -> str:
        folder = uuid.uuid4().hex
        at_once([lambda k=kind: cells[k].write.parquet(f"{self.path}/{folder}/{k}") for kind in SCHEMAS])
        return folder

    def _read(self, folders: list[str]) -> dict[str, DataFrame]:
        if not folders:
            return {kind: self.spark.createDataFrame([], schema) for kind, schema in SCHEMAS.items()}
        return {kind: self.spark.read.schema(schema).parquet(*[f"{self.path}/{folder}/{kind}" for folder in folders])
                for kind, schema in SCHEMAS.items()}

    def put_day(self, day: datetime.date, postings: DataFrame) -> None:
        """Let the day have the cells of these postings (group, location, experience, salary_normalized), also if there are none.

        Only the postings are read. Putting a day again replaces its cells.
        """
        folder = self._write({"by_city": city_cells(postings), "over_cities": whole_cells(postings)})
        self._commit(lambda entry: entry | {"days": entry["days"] | {day.isoformat(): folder}})

    def drop_day(self, day: datetime.date) -> None:
        """Let the day have no cells."""
        self._commit(lambda entry: entry | {"days": {d: f for d, f in entry["days"].items() if d != day.isoformat()}})

    def days(self) -> list[datetime.date]:
        return sorted(map(datetime.date.fromisoformat, self._entry()[1]["days"]))

    @staticmethod
    def _by_month(entry: dict) -> dict[str, dict[str, str]]:
        months: dict[str, dict[str, str]] = {}
        for day, folder in sorted(entry["days"].items()):
            months.setdefault(day[:7], {})[day] = folder
        return months

    def fold(self) -> list[str]:
        """Sum up the days of each month that has several and is not folded as they are now; return those months."""
        entry, folded = self._entry()[1], {}
        for month, days in self._by_month(entry).items():
            if len(days) > 1 and entry["months"].get(month, {}).get("days") != days:
                cells = self._read(list(days.values()))
                sums = {kind: df.groupBy([c for c in df.columns if c not in MEASURES]).agg(*[F.sum(m).alias(m) for m in MEASURES])
                        for kind, df in cells.items()}
                folded[month] = {"days": days, "folder": self._write(sums)}
        if folded:
            # A day that is put in between makes its month's sums stale, and they are not read then.
            self._commit(lambda entry: entry | {"months": entry["months"] | folded})
        return sorted(folded)

    def folders(self, first: datetime.date | None = None, last: datetime.date | None = None) -> list[str]:
        """The folders whose cells make up a range of days, both ends included: months where they can stand for all their days."""
        entry, found = self._entry()[1], []
        for month, days in self._by_month(entry).items():
            inside = {day: folder for day, folder in days.items()
                      if (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())}
            sums = entry["months"].get(month)
            found += [sums["folder"]] if sums and sums["days"] == inside else inside.values()
        return found

    def cube(self, first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
        """`market_cube` of the postings of a range of days, or of all days."""
        cells = self._read(self.folders(first, last))
        return cube_of(cells["by_city"], cells["over_cities"])

    def drop_unused(self) -> list[str]:
        """Remove folders that no day and no fresh month has; call it only while nobody writes or reads an earlier version."""
        entry = self._entry()[1]
        months = self._by_month(entry)
        used = {FOLDER, *entry["days"].values(), *[m["folder"] for name, m in entry["months"].items() if m["days"] == months.get(name)]}
        gone = sorted(name for name in listed(self.spark, self.path) if name not in used)
        for name in gone:
            remove(self.spark, f"{self.path}/{name}")
        return gone
