"""Named source tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import config


class Sources:
    """Source tables by name, from parquet folders, catalog tables or frames."""

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names=config.SOURCE_SCHEMAS) -> "Sources":
        """One parquet table per name under ``root``."""
        return cls(spark, {n: lambda n=n: spark.read.parquet(f"{root}/{n}") for n in names})

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: Mapping[str, str]) -> "Sources":
        """Catalog tables of any database, e.g. ``{'bank': 'ops.bank'}``."""
        return cls(spark, {n: lambda t=t: spark.table(t) for n, t in tables.items()})

    @classmethod
    def from_places(cls, spark: SparkSession, root: str | None, tables: Mapping[str, str]) -> "Sources":
        """Catalog tables where named, all others from a folder, if there is one."""
        folder = cls.from_parquet(spark, root)._loaders if root else {}
        return cls(spark, folder | cls.from_tables(spark, tables)._loaders)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> "Sources":
        return cls(spark, {n: lambda f=f: f for n, f in frames.items()})

    def holding(self, **frames: DataFrame) -> "Sources":
        """The same sources, with frames in place of some tables: rows and columns that a run still needs."""
        out = Sources(self.spark, self._loaders)
        out._frames = self._frames | frames
        return out

    def get(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._loaders:
                raise KeyError(f"no source named {name!r}; known: {sorted(self._loaders)}")
            self._frames[name] = _checked(name, self._loaders[name]())
        return self._frames[name]

    __getitem__ = get


def source_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(config.SOURCE_SCHEMAS[name])


def _checked(name: str, df: DataFrame) -> DataFrame:
    if name in config.SOURCE_SCHEMAS:
        present = {c.lower() for c in df.columns}
        missing = [c for c in source_schema(name).names if c.lower() not in present]
        if missing:
            raise ValueError(f"source {name!r} lacks columns {missing}")
    return df


def activity_type_order(spark: SparkSession) -> DataFrame:
    """The eight activity types in report order."""
    rows = [(number, *row) for number, row in enumerate(config.ACTIVITY_TYPE_ORDER, start=1)]
    return spark.createDataFrame(
        rows,
        "id int, ActivationActivityTypeKey int, ActicationActivityOrder int, "
        "IsActive boolean, ActivityTypeDesc string",
    )
