"""Versioned tables as immutable Parquet snapshots and a log of versions.

Each write goes to a folder of its own. It becomes visible only when its log row
is appended, so a failed or half-done write is never read and earlier versions
stay readable. One writer per table at a time is assumed.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.catalog import RowCountMismatch, check_rows
from marquee.sources.files import list_files

_LOG = (
    "version bigint, written_at timestamp, operation string, rows bigint, "
    "path string, partition_by array<string>, schema string"
)


class VersionNotFound(LookupError):
    """A version that the log does not hold."""


@dataclass(frozen=True)
class SnapshotTable:
    spark: SparkSession
    root: str

    def log(self) -> DataFrame:
        """All versions, with operation, time, row count, folder, partition columns and schema."""
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def history(self, limit: int | None = None) -> DataFrame:
        """Versions, newest first."""
        newest = self.log().orderBy(F.desc("version"))
        return newest if limit is None else newest.limit(limit)

    def read(self, version: int | None = None) -> DataFrame:
        """The latest version, or the given one."""
        return self._open(self._entry(version))

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = (), operation: str = "overwrite") -> int:
        """Store a new version and return its number."""
        spread = df.hint("rebalance", *partition_by) if partition_by else df
        return self._commit(spread, partition_by, operation)

    def compact(self, target_bytes: int = 128 * 1024 * 1024) -> int:
        """Rewrite the latest version into files of about the target size, as a new version.

        Files are cut by ranges of partition values and a hash of each row's place, so a
        large partition, or a large group of equal rows, is spread over several tasks
        while a small partition stays in one.
        """
        entry = self._entry(None)
        stored = list_files(self.spark, entry["path"], "*.parquet").agg(F.sum("bytes")).first()[0] or 0
        files = max(1, math.ceil(stored / target_bytes))
        partition_by = entry["partition_by"]
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        placed = self._open(entry).withColumn("_place", place).repartitionByRange(files, *partition_by, "_place")
        return self._commit(placed.drop("_place"), partition_by, "compact", expected=entry["rows"])

    def check(self, version: int | None = None) -> None:
        """Raise unless a version still holds the rows its log entry states."""
        entry = self._entry(version)
        check_rows(self._open(entry), entry["rows"], f"{self.root} version {entry['version']}")

    def _open(self, entry) -> DataFrame:
        """Rows of a version with exactly the column types that were written."""
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(entry["path"]).select(*[f"`{c}`" for c in schema.names])

    def _entry(self, version: int | None):
        log = self.log()
        wanted = log if version is None else log.filter(F.col("version") == version)
        entry = wanted.orderBy(F.desc("version")).first()
        if entry is None:
            raise VersionNotFound(f"{self.root} has no version {'yet' if version is None else version}")
        return entry

    def _commit(self, df: DataFrame, partition_by: Sequence[str], operation: str, expected: int | None = None) -> int:
        newest = self.log().agg(F.max("version")).first()[0]
        version = 0 if newest is None else newest + 1
        path = f"{self.root}/data/v{version}-{uuid.uuid4().hex[:8]}"
        # counted by the tasks that write, above any shuffle, so a task that is run again counts once
        written = Observation()
        writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        rows = written.get["rows"]
        if expected not in (None, rows):
            raise RowCountMismatch(f"{path}: {expected} rows expected, {rows} rows stored")
        entry = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.current_timestamp().alias("written_at"),
            F.lit(operation).alias("operation"),
            F.lit(rows).cast("bigint").alias("rows"),
            F.lit(path).alias("path"),
            F.array(*[F.lit(c) for c in partition_by]).cast("array<string>").alias("partition_by"),
            F.lit(df.schema.json()).alias("schema"),
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return version
