"""Cutting a plan by storing its rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read back.

    For a frame that is used several times; the files outlive any executor.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(df: DataFrame) -> None:
    """Gives back the disk of a frame from ``stored`` that nothing reads any more."""
    files = df.inputFiles()
    if files:
        none = df.sparkSession.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
        none.write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)
