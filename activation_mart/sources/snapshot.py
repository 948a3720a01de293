"""The master table as a row of complete snapshots."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MasterStore:
    """Versioned snapshots of the master under one folder.

    A run reads version n and writes n + 1 to a folder of its own; the new
    version counts once its line is in the commit log. A run that fails leaves
    the previous version in force. One run at a time writes.

    With ``buckets`` the snapshots are tables bucketed by account (``table`` is
    the name prefix), so that joins on the account key leave the master in place.
    """

    def __init__(
        self, spark: SparkSession, root: str, buckets: int | None = None, table: str = "account_master"
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.table = table

    @property
    def _log(self) -> str:
        return f"{self.root}/commits"

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("version bigint, folder string, source string").parquet(self._log)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _latest(self):
        commits = self._commits()
        if commits is None:
            return None
        return commits.agg(F.max(F.struct("version", "folder", "source")).alias("last")).first()["last"]

    def version(self) -> int:
        """Number of the version in force, 0 before the first."""
        last = self._latest()
        return last["version"] if last else 0

    def read(self) -> DataFrame:
        last = self._latest()
        if last is None:
            raise ValueError(f"no master under {self.root}")
        if last["source"] and self.spark.catalog.tableExists(last["source"]):
            return self.spark.table(last["source"])
        return self.spark.read.parquet(last["folder"])

    def write(self, master: DataFrame) -> int:
        version = self.version() + 1
        folder = f"{self.root}/v{version:08d}-{uuid.uuid4().hex[:8]}"
        source = None
        if self.buckets:
            source = f"{self.table}_{folder.rsplit('/', 1)[1].replace('-', '_')}"
            (
                master.repartition(self.buckets, "AccountKey")
                .write.bucketBy(self.buckets, "AccountKey")
                .sortBy("AccountKey")
                .option("path", folder)
                .saveAsTable(source)
            )
        else:
            master.write.parquet(folder)
        self.spark.createDataFrame(
            [(version, folder, source)], "version bigint, folder string, source string"
        ).coalesce(1).write.mode("append").parquet(self._log)
        return version
