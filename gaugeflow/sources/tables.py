"""The four tables: readings, monthly summary, recorded findings and the ingestion log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas
from gaugeflow.functions.period import Period, month_of
from gaugeflow.operators.merge import unreplaced
from gaugeflow.sources.snapshots import MONTH, Snapshot, SnapshotTable


class MeterTables:
    """Snapshot tables in the folder of a catalog database, or in `root`."""

    def __init__(self, spark: SparkSession, database: str = "meters", root: str | None = None):
        self.spark = spark
        self.database = database
        self.root = root

    def create(self) -> MeterTables:
        if self.root is None:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
            self.root = self.spark.catalog.getDatabase(self.database).locationUri
        return self

    def table(self, name: str) -> SnapshotTable:
        columns, sort, by_month = {
            "readings": (schemas.READINGS_DDL, schemas.READING_KEY, True),
            "monthly_summary": (schemas.MONTHLY_SUMMARY_DDL, schemas.METER, True),
            "monthly_discrepancy": (schemas.MONTHLY_DISCREPANCY_DDL, schemas.METER, True),
            "ingestion_log": (schemas.INGESTION_LOG_DDL, ["source_file"], False),
        }[name]
        return SnapshotTable(self.spark, f"{self.root}/{name}", columns, sort, by_month)

    @property
    def names(self) -> list[str]:
        return ["readings", "monthly_summary", "monthly_discrepancy", "ingestion_log"]

    @property
    def readings(self) -> DataFrame:
        return self.table("readings").read()

    @property
    def monthly_summary(self) -> DataFrame:
        return self.table("monthly_summary").read()

    @property
    def monthly_discrepancy(self) -> DataFrame:
        return self.table("monthly_discrepancy").read()

    @property
    def ingestion_log(self) -> DataFrame:
        return self.table("ingestion_log").read()

    def register_views(self) -> None:
        """Temporary views of the present snapshots, for SQL."""
        for name in self.names:
            self.table(name).read().createOrReplaceTempView(name)

    def append_readings(self, readings: DataFrame) -> None:
        self.table("readings").append(readings.withColumn(MONTH, month_of(F.col("recorded_at"))))

    def insert_readings(self, choose: Callable[[DataFrame], DataFrame], months: list[str]) -> DataFrame:
        """Append what `choose` makes of the stored readings of some months; gives the rows appended.

        If other readings come in meanwhile, it is asked again.
        """
        table = self.table("readings")
        added: dict[str, list[str]] = {}

        def make(base: Snapshot) -> dict[str, list[str]] | None:
            rows = choose(table.read(base, months)).withColumn(MONTH, month_of(F.col("recorded_at")))
            added.clear()
            added.update(table.write(rows))
            return base.plus(added) if added else None

        table.change(make)
        return table.read(Snapshot(0, added))

    def append_log(self, entries: DataFrame) -> None:
        self.table("ingestion_log").append(entries)

    def _upsert(self, name: str, rows: DataFrame, key: list[str]) -> None:
        """Replace rows by key; only the months of the new rows are read and written.

        The new rows are written once, to a folder that the next snapshot names as it is, whatever
        happens to the table meanwhile; of stored rows those that they do not replace are written
        anew, so that a month lies in two folders at most.
        """
        table = self.table(name)
        added = table.write(rows)
        incoming = table.read(Snapshot(0, added)) if added else None

        def make(base: Snapshot) -> dict[str, list[str]] | None:
            if not added:
                return None
            merged = {month: list(parts) for month, parts in added.items()}
            held = [month for month in added if base.parts.get(month)]
            if held:
                replaced = incoming.filter(F.col(MONTH).isin(held))
                for month, parts in table.write(unreplaced(table.read(base, held), replaced, key)).items():
                    merged[month] += parts
            return {**base.parts, **merged}

        table.change(make)

    def upsert_summary(self, summary: DataFrame, period: Period | None = None) -> None:
        rows = summary.withColumn("computed_at", F.localtimestamp())
        self._upsert("monthly_summary", rows, schemas.SUMMARY_KEY)

    def upsert_findings(self, findings: DataFrame, period: Period | None = None) -> None:
        rows = findings.withColumn("detected_at", F.localtimestamp())
        self._upsert("monthly_discrepancy", rows, schemas.FINDING_KEY)

    def compact(self, most_folders: int = 8) -> dict[str, list[str]]:
        """Rewrite crowded months of the tables kept by month."""
        return {name: self.table(name).compact(most_folders) for name in self.names}

    def expire(self, keep: int = 10, older_than_hours: float = 24.0) -> dict[str, int]:
        """Remove old snapshots and their folders; gives the folders removed per table."""
        return {name: self.table(name).expire(keep, older_than_hours) for name in self.names}
