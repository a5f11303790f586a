"""Raw delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas

_BOM = "\ufeff"
_DAMAGED = "_damaged"


def read_delimited(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``;``-separated UTF-8 text with a header; every column is read as text.

    ``multi_line`` allows line breaks inside quoted fields. Such a file cannot be
    split, so it is for the small film catalogue only. Several files in a folder
    must agree on the header; a file that does not raises an error.
    """
    return _reader(spark).option("multiLine", multi_line).csv(path)


def _reader(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("sep", ";")
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
    )


def normalised(df: DataFrame, identifiers: bool = True) -> DataFrame:
    """The frame under names without byte order mark and outer blanks.

    ``identifiers`` also folds their case and joins their words by underscores.
    """
    names = [" ".join(name.replace(_BOM, " ").split()) for name in df.columns]
    if identifiers:
        names = ["_".join(name.casefold().split()) for name in names]
    if len(set(names)) < len(names):
        twice = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after cleaning: {', '.join(twice)}")
    return df.toDF(*names)


def read_films(spark: SparkSession, path: str) -> DataFrame:
    return _checked(read_delimited(spark, path, multi_line=True), schemas.RAW_FILM)


def read_customers(spark: SparkSession, path: str, damaged: Observation | None = None) -> DataFrame:
    return _checked(read_lines(spark, path, damaged), schemas.RAW_CUSTOMER)


def read_tickets(spark: SparkSession, path: str, damaged: Observation | None = None) -> DataFrame:
    return _checked(read_lines(spark, path, damaged), schemas.RAW_TICKET)


def read_lines(spark: SparkSession, path: str, damaged: Observation | None = None) -> DataFrame:
    """The whole rows of a file with one row a line; the file can be split.

    A line with too few or too many fields, such as a piece of a row that has a line break
    in a quoted field, is no row: it is left out, and ``damaged`` learns in the reading pass how
    many lines were ``read`` and ``damaged``, and how many had a ``first_field``. Without ``damaged`` such a line raises an error.
    """
    marked = damaged_lines(spark, path)
    broken = F.col(_DAMAGED).isNotNull()
    # Spark refuses to read the damaged lines alone, so each check also looks at the first column
    first = F.col(f"`{marked.columns[0]}`")
    if damaged is None:
        fault = F.concat(F.lit("damaged line: "), F.substring(_DAMAGED, 1, 200), F.lit(" in row "), F.coalesce(first, F.lit("")))
        return marked.filter(F.when(broken, F.raise_error(fault).cast("boolean")).otherwise(F.lit(True))).drop(_DAMAGED)
    seen = marked.observe(
        damaged, F.count(F.lit(1)).alias("read"), F.count_if(broken).alias("damaged"), F.count(first).alias("first_field")
    )
    return seen.filter(~broken).drop(_DAMAGED)


def damaged_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a file under its header, and the line itself in ``_damaged`` where it is no whole row."""
    names = read_delimited(spark, path).columns
    kinds = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _DAMAGED]])
    reader = _reader(spark).schema(kinds).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _DAMAGED)
    # a line that is read for one column only is not taken apart, and so not found to be damaged
    return reader.option("columnPruning", False).csv(path)


def write_delimited(df: DataFrame, path: str) -> None:
    """The same format back to files, text kept to the last blank."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", ";")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _checked(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    cleaned = normalised(df)
    absent = [c for c in expected if c not in cleaned.columns]
    if absent:
        raise ValueError(f"columns missing from the header: {', '.join(absent)}")
    return cleaned
