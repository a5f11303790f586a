"""Managed tables in the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.files import write_parquet

class RowCountMismatch(RuntimeError):
    """A stored table that does not hold the rows it was given."""


def use_schema(spark: SparkSession, name: str, location: str | None = None, catalog: str | None = None) -> None:
    """Create a schema unless it exists, and make it current, in the given catalog or the current one."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")
    spark.catalog.setCurrentDatabase(name)


def save_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), only_touched: bool = False, path: str | None = None
) -> None:
    """Overwrite a managed table, schema included.

    With ``only_touched`` an existing partitioned table keeps the partitions that
    get no new rows, and its schema.
    """
    spark = df.sparkSession
    if only_touched and spark.catalog.tableExists(name):
        # insertInto takes the mode from the session only; a write to the table's place has it as its own option
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
        ordered = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in spark.table(name).schema])
        write_parquet(ordered, place, partition_by, only_touched=True)
        spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
        return
    writer = _spread(df, partition_by).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> None:
    """Overwrite a table whose rows lie in buckets of the keys, sorted by them.

    Two such tables with equal keys and bucket counts are joined without a shuffle. A bucket
    is one file, written by one task.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}").orderBy("tableName")


def presence(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Which of the tables exist: table_name, present."""
    entries = [
        F.struct(F.lit(n).alias("table_name"), F.lit(spark.catalog.tableExists(n)).alias("present")) for n in names
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def check_rows(stored: DataFrame, expected: int, name: str) -> None:
    """Raise unless a stored table holds the expected number of rows."""
    found = stored.count()
    if found != expected:
        raise RowCountMismatch(f"{name}: {expected} rows written, {found} rows stored")
