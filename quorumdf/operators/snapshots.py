"""Versions of several tables that change together.

A version is one row of a manifest: its number and the folders that each table
consists of.  The row is written last, as one file that appears by one rename, so a
reader sees all tables of a version or none, and one that has begun goes on reading
the folders it found.  Publishing a number that is already there does nothing: a
batch that runs twice changes nothing.  There is one writer at a time; folders of a
writer that died are never named by a manifest.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorumdf.streaming.jobs import scratch

MANIFEST = "number long, tables map<string, array<string>>"


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def latest(self) -> tuple[int, dict[str, list[str]]]:
        """The newest number (-1 before the first) and the folders of each table."""
        try:
            rows = self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1, {}
        row = rows.orderBy(F.desc("number")).first()
        return (row.number, dict(row.tables)) if row else (-1, {})

    def table(self, name: str, schema: str | T.StructType) -> DataFrame:
        """A table of the newest version; empty where no version has it."""
        folders = self.latest()[1].get(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def stage(self, name: str, df: DataFrame) -> str:
        """Write a table's new contents, which nobody sees before they are published; the folder."""
        folder = f"{self.root}/{name}/{uuid.uuid4().hex[:12]}"
        df.write.parquet(folder)
        return folder

    def publish(self, number: int, replace: dict[str, DataFrame] | None = None, append: dict[str, DataFrame] | None = None, staged: dict[str, str] | None = None) -> bool:
        """Write the tables' new contents or further rows and name them all in one version, with those staged before; false if it is there already."""
        last, tables = self.latest()
        if number <= last:
            return False
        for whole, parts in ((True, replace or {}), (False, append or {})):
            for name, df in parts.items():
                folder = self.stage(name, df)
                tables[name] = [folder] if whole else [*tables.get(name, []), folder]
        tables.update({name: [folder] for name, folder in (staged or {}).items()})
        row = self.spark.createDataFrame([(number, tables)], MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return True


def settled(df: DataFrame) -> DataFrame:
    """The rows written once to the scratch folder, for steps that read them several times: what they derive from isn't made anew."""
    folder = f"{scratch(df.sparkSession)}/settled-{uuid.uuid4().hex[:12]}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
