"""Dimensions that change while streams run: whole versions, picked up at the border of a batch.

A version holds every dimension table. Its tables are written first; one file of one row then states
their paths and makes the version valid, so a reader sees all of its tables or none. A batch notes the
version it reads before it reads it: run again, it joins the same rows and writes the same result.

One writer publishes at a time; a second one that publishes the same number fails. Versions and notes
are kept: how long a batch may be run again is for the owner of the folder to say.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_VERSION = "version int, paths map<string,string>"


class DimensionVersions:
    """Versions of the dimension tables below a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _stated(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _state(self, row: tuple, schema: str, path: str, mode: str) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode(mode).parquet(path)

    def newest(self) -> int:
        """Number of the newest version, 0 if there is none."""
        rows = self._stated(f"{self.root}/versions/*", _VERSION)
        return 0 if rows is None else rows.agg(F.max("version")).first()[0] or 0

    def publish(self, dims: Mapping[str, DataFrame]) -> int:
        """Write a version and make it the newest; tables not given stay as they were."""
        number = self.newest() + 1
        paths = self._paths(number - 1) if number > 1 else {}
        for name, frame in dims.items():
            paths[name] = f"{self.root}/tables/{name}-{uuid.uuid4().hex}"
            frame.write.parquet(paths[name])
        self._state((number, paths), _VERSION, f"{self.root}/versions/{number:08d}", "errorifexists")
        return number

    def _paths(self, number: int) -> dict[str, str]:
        rows = self._stated(f"{self.root}/versions/{number:08d}", _VERSION)
        found = None if rows is None else rows.first()
        if found is None:
            raise ValueError(f"no version {number} of the dimensions in {self.root}")
        return found["paths"]

    def read(self, number: int) -> dict[str, DataFrame]:
        return {name: self.spark.read.parquet(path) for name, path in self._paths(number).items()}

    def pinned(self, batch: str) -> int:
        """The version a batch reads: the newest when it first asks, the same when it is run again."""
        path = f"{self.root}/pins/{batch}"
        noted = self._stated(path, "version int")
        row = None if noted is None else noted.first()
        if row is None:
            self._state((self.newest(),), "version int", path, "overwrite")
            return self.pinned(batch)
        return row["version"]
