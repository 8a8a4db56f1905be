"""Predictions laid out by day in versions that are published by one small file."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.guards import DataCheckError
from barloom.session import stage
from barloom.sinks.upsert import KEYS, upsert_rows

RUN_KEYS = ["prediction_run_id", "as_of_date", "model_name"]
DAY = "as_of_day"
NO_DAY = "none"


def _day() -> Column:
    return F.coalesce(F.date_format("as_of_date", "yyyy-MM-dd"), F.lit(NO_DAY)).alias(DAY)


class RunStore:
    """A stored predictions table with keyed upsert on (prediction_run_id, ticker).

    ``rows/commit=c/as_of_day=d`` holds the rows of a day as commit c wrote them, ``runs/commit=c`` is
    the run directory of what it wrote: rows and clock range per run, day and model. Files are never
    changed. A version is the list of live days with the commit of each, one line a day; it is
    written under another name and renamed, and the highest number is current. A write that dies before
    the rename leaves only files that no version names, so the version before stays whole; two writers
    of one version cannot both win.

    An upsert reads and rewrites the days on which its runs are stored, found in the run directory,
    and the days of its own rows. Lists of days reach the driver; they are bounded by the calendar.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path.rstrip("/")

    # Versions -------------------------------------------------------------------------------------

    def _files(self):
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/versions")
        return folder.getFileSystem(self._spark._jsc.hadoopConfiguration()), folder

    def versions(self) -> list[int]:
        files, folder = self._files()
        if not files.exists(folder):
            return []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def days(self, version: int | None = None) -> dict[str, str]:
        """Live days of a version (default: the current one) and the commit that wrote each."""
        known = self.versions()
        if not known:
            raise DataCheckError(f"{self._path} holds no published version")
        number = known[-1] if version is None else version
        if number not in known:
            raise DataCheckError(f"{self._path} holds no version {number}")
        lines = self._spark.read.text(f"{self._path}/versions/{number:012d}").collect()
        return dict(r["value"].split("\t") for r in lines if r["value"])

    def _publish(self, number: int, days: dict[str, str]) -> None:
        files, folder = self._files()
        make = self._spark._jvm.org.apache.hadoop.fs.Path
        waiting, final = make(folder, f"_{uuid.uuid4().hex}"), make(folder, f"{number:012d}")
        out = files.create(waiting, False)
        out.write("".join(f"{d}\t{c}\n" for d, c in sorted(days.items())).encode())
        out.close()
        if files.exists(final) or not files.rename(waiting, final):
            files.delete(waiting, False)
            raise DataCheckError(f"another writer has published version {number} of {self._path}")

    # Reading --------------------------------------------------------------------------------------

    def _rows(self, live: dict[str, str]) -> DataFrame:
        """Rows of live days; only their folders are listed, and a filter on the day prunes them further."""
        if not live:
            return self._spark.read.parquet(f"{self._path}/rows").drop("commit", DAY).limit(0)
        base = f"{self._path}/rows"
        # A day may come back as a date; as text it is the name that the version lists.
        return self._spark.read.option("basePath", base).parquet(
            *(f"{base}/commit={c}/{DAY}={d}" for d, c in sorted(live.items()))) \
            .withColumn(DAY, F.col(DAY).cast("string"))

    def rows(self, version: int | None = None) -> DataFrame:
        return self._rows(self.days(version)).drop("commit", DAY)

    def _runs(self, live: dict[str, str]) -> DataFrame:
        """The directory rows that live commits wrote for live days."""
        pairs = self._spark.createDataFrame(sorted(live.items()), f"{DAY} string, commit string")
        base = f"{self._path}/runs"
        held = self._spark.read.option("basePath", base).parquet(
            *(f"{base}/commit={c}" for c in sorted(set(live.values()))))
        # One pair per day.
        return held.join(F.broadcast(pairs), [DAY, "commit"], "left_semi")

    def runs(self, version: int | None = None) -> DataFrame:
        """(prediction_run_id, as_of_date, model_name, row_count, first_created_at, last_created_at)."""
        return self._runs(self.days(version)).drop("commit", DAY)

    def run(self, run_id: str, version: int | None = None) -> DataFrame:
        """Rows of one run; the directory tells its days, which prune the scan."""
        live = self.days(version)
        days = self._days_of(self._runs(live).filter(F.col("prediction_run_id") == run_id))
        return self._on(days, live).filter(F.col("prediction_run_id") == run_id)

    def _days_of(self, runs: DataFrame) -> list[str]:
        return sorted(r[DAY] for r in runs.select(_day()).distinct().collect())

    def _on(self, days: list[str], live: dict[str, str]) -> DataFrame:
        found = self._rows({d: live[d] for d in days if d in live})
        return (found.filter(F.col(DAY).isin(days)) if DAY in found.columns else found).drop("commit", DAY)

    def latest_run_id(self, version: int | None = None) -> str | None:
        """Run with the newest row; ties go to the greater run id. Only the directory is read."""
        row = self.runs(version).groupBy("prediction_run_id").agg(
            F.max("last_created_at").alias("last_at")).orderBy(
            F.desc("last_at"), F.desc("prediction_run_id")).first()
        return None if row is None else row["prediction_run_id"]

    def latest(self, version: int | None = None) -> DataFrame:
        run_id = self.latest_run_id(version)
        return self.rows(version).limit(0) if run_id is None else self.run(run_id, version)

    def newest_of(self, ticker: str, limit: int, version: int | None = None) -> DataFrame:
        """The days that can hold the newest ``limit`` rows of a ticker, as rows of that ticker.

        Days are read from the newest clock on, twice as many each time, until the days not read
        are older than the rows found.
        """
        live = self.days(version)
        runs = self._runs(live).select(DAY, "last_created_at")
        days = runs.groupBy(DAY).agg(F.max("last_created_at").alias("last_at")) \
            .orderBy(F.desc_nulls_last("last_at")).collect()
        n = limit
        while True:
            found = self._on([r[DAY] for r in days[:n]], live).filter(F.col("ticker") == ticker)
            if n >= len(days):
                return found
            newest = found.orderBy(F.desc_nulls_last("created_at")).select("created_at").limit(limit).collect()
            last = newest[-1]["created_at"] if len(newest) == limit else None
            if last is not None and (days[n]["last_at"] is None or days[n]["last_at"] < last):
                return found
            n *= 2

    # Writing --------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """A commit with the rows of whole days and their part of the directory."""
        commit = uuid.uuid4().hex
        base = f"{self._path}/rows/commit={commit}"
        # Rebalancing evens out task sizes, so that a large day is written by several tasks.
        rows.withColumn(DAY, _day()).hint("rebalance", DAY).write.partitionBy(DAY).parquet(base)
        written = self._spark.read.schema(rows.schema).parquet(base)
        runs = written.groupBy(*RUN_KEYS).agg(
            F.count("*").alias("row_count"), F.min("created_at").alias("first_created_at"),
            F.max("created_at").alias("last_created_at"))
        runs.withColumn(DAY, _day()).write.parquet(f"{self._path}/runs/commit={commit}")
        return commit, self._days_of(written)

    def create(self, rows: DataFrame) -> int:
        """First load, as version 1; keys must be unique."""
        if self.versions():
            raise DataCheckError(f"{self._path} holds a table already")
        commit, days = self._write(rows)
        self._publish(1, {d: commit for d in days})
        return 1

    def upsert(self, incoming: DataFrame, position: str = "position", now: Column | None = None) -> int:
        """Insert or replace by key; of two incoming rows with one key the later ``position`` wins.

        Replaced rows lie on the days that the directory names for the incoming runs, wherever the
        incoming rows themselves belong. The incoming rows are staged first, so that a clock or run id
        in them is evaluated once. Returns the new version.
        """
        current = self.versions()[-1:]
        if not current:
            raise DataCheckError(f"{self._path} holds no table")
        live = self.days(current[0])
        incoming = stage(incoming, "incoming")
        stored = self._runs(live).join(
            incoming.select("prediction_run_id").distinct(), "prediction_run_id", "left_semi")
        touched = set(self._days_of(stored)) | set(self._days_of(incoming))
        before = self._on(sorted(touched & live.keys()), live)
        commit, days = self._write(upsert_rows(before, incoming, KEYS, position, now))
        self._publish(current[0] + 1, {d: c for d, c in live.items() if d not in touched}
                      | {d: commit for d in days})
        return current[0] + 1

    def vacuum(self, keep: int = 2) -> int:
        """Remove all but the newest ``keep`` versions and the commits only they name.

        To be called when no write is under way: its commit has no version yet.
        """
        files, folder = self._files()
        known = self.versions()
        kept = {c for v in known[-keep:] for c in self.days(v).values()}
        make, removed = self._spark._jvm.org.apache.hadoop.fs.Path, 0
        for version in known[:-keep]:
            files.delete(make(folder, f"{version:012d}"), False)
        for kind in ("rows", "runs"):
            for held in files.listStatus(make(f"{self._path}/{kind}")):
                if held.getPath().getName().removeprefix("commit=") not in kept:
                    files.delete(held.getPath(), True)
                    removed += 1
        return removed
