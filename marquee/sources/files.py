"""Parquet by path, and file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.columns import is_missing


class TableNotReadable(RuntimeError):
    """A table path that cannot be opened."""


def read_parquet(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """A Parquet table, or TableNotReadable naming it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise TableNotReadable(f"cannot load {name or path} from {path}") from error


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), only_touched: bool = False) -> None:
    """Overwrite a Parquet path; ``only_touched`` leaves partitions without new rows as they are.

    Rows are regrouped by partition value. The rebalance hint lets adaptive execution
    split a large partition over several tasks and merge small ones into one file.
    """
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a path: path, name, bytes, modified. Only metadata is read, never contents."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return listed.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def rows_by_file(df: DataFrame) -> DataFrame:
    """Files that the rows of a frame come from: path, name, bytes, modified, rows.

    The file of each row is in its metadata; Parquet tells it without reading a column.
    """
    meta = [F.col(f"_metadata.{c}").alias(n) for c, n in
            (("file_path", "path"), ("file_name", "name"), ("file_size", "bytes"), ("file_modification_time", "modified"))]
    return df.select(*meta).groupBy("path", "name", "bytes", "modified").agg(F.count(F.lit(1)).alias("rows"))


def schema_report(df: DataFrame) -> DataFrame:
    """Columns of a frame as rows, with what they hold: position, column_name, type, nullable, filled, empty.

    ``empty`` counts nulls and empty texts. All columns are counted in one aggregate.
    """
    fields = df.schema.fields
    missing = [is_missing(f"`{f.name}`", f.dataType.simpleString()) for f in fields]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(m).alias(f"c{i}") for i, m in enumerate(missing)])
    entries = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"),
            (F.col("rows") - F.col(f"c{i}")).alias("filled"), F.col(f"c{i}").alias("empty"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*entries)))


def between_dates(df: DataFrame, first: str, last: str, column: str = "sale_date") -> DataFrame:
    """Rows of a date range, given as ISO texts, with the year and month it implies.

    A table partitioned by sale_year and sale_month then opens only those folders.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    year, month = F.col("sale_year"), F.col("sale_month")
    months = (year * 12 + month).between(F.year(low) * 12 + F.month(low), F.year(high) * 12 + F.month(high))
    return df.filter(F.col(column).between(low, high) & year.between(F.year(low), F.year(high)) & months)
