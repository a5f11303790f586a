"""The whole run: raw files to staging, star tables, and stored KPI tables."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.plans import kpi, star
from marquee.sources import catalog, delimited, files
from marquee.sources.snapshots import SnapshotTable

STAR_TABLES = ("dim_film", "dim_customer", "dim_date", "fact_ticket")

#: Rows of a bucket on average; one task sorts a bucket, so this bounds its memory.
BUCKET_ROWS = 400_000


@dataclass(frozen=True)
class Star:
    """The four tables; ``account`` learns what cleaning refused once the fact has been written."""

    dim_film: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    fact_ticket: DataFrame
    account: Observation


def stage(spark: SparkSession, raw: str, staging: str) -> dict[str, dict[str, int]]:
    """Raw CSV files to Parquet, one folder per table.

    Damaged lines are left out; for each table with one row a line, the result tells how many lines
    were read and how many were damaged.
    """
    files.write_parquet(delimited.read_films(spark, f"{raw}/Film.csv"), f"{staging}/film")
    told = {}
    for name, read, file in (
        ("customer", delimited.read_customers, "Customer.csv"), ("ticket", delimited.read_tickets, "Ticket.csv"),
    ):
        damaged = Observation()
        files.write_parquet(read(spark, f"{raw}/{file}", damaged), f"{staging}/{name}")
        told[name] = damaged.get
    return told


def build_star(film: DataFrame, customer: DataFrame, ticket: DataFrame, **customer_options) -> Star:
    """The star from raw text tables; nothing is computed yet."""
    account = Observation()
    return Star(
        star.build_dim_film(film),
        star.build_dim_customer(customer, **customer_options),
        star.build_dim_date(ticket),
        star.build_fact_ticket(ticket, account=account),
        account,
    )


def store_star(spark: SparkSession, built: Star, root: str) -> dict[str, SnapshotTable]:
    """One new version of each star table; the fact is partitioned by year and month."""
    tables = {name: SnapshotTable(spark, f"{root}/{name}") for name in STAR_TABLES}
    for name, stored in tables.items():
        df = getattr(built, name)
        if name == "fact_ticket":
            stored.overwrite(star.with_sale_month(df), schemas.FACT_PARTITIONS)
        else:
            stored.overwrite(df)
    return tables


def store_for_customers(fact: DataFrame, customers: DataFrame, schema: str, root: str, buckets: int | None = None, slices: int = 4) -> None:
    """Fact and customers as catalog tables in equal buckets of customer and slice.

    Their join needs no shuffle, however often it is made. The tickets of a customer are dealt over
    ``slices``, and each customer has a row in every slice, so that a customer with a large part of all
    tickets does not fill one bucket. Unless ``buckets`` is given, their number follows the row counts,
    which Parquet tells without reading a column.
    """
    if buckets is None:
        buckets = max(1, math.ceil(max(fact.count(), customers.count() * slices) / BUCKET_ROWS))
    piece = F.pmod(F.xxhash64("order_id", "ticket_id"), F.lit(slices)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    for df, name, part in ((fact, "fact_ticket", piece), (customers, "dim_customer", every)):
        catalog.save_bucketed(df.withColumn("slice", part), f"{schema}.{name}", ("customer_id", "slice"), buckets, f"{root}/{name}")


def sales_with_customers(spark: SparkSession, schema: str) -> DataFrame:
    """Every stored ticket beside its customer; tickets of unknown customers stay."""
    fact, customers = (spark.table(f"{schema}.{n}") for n in ("fact_ticket", "dim_customer"))
    return fact.join(customers, ["customer_id", "slice"], "left").drop("slice")


def export_kpis(spark: SparkSession, sales, films: DataFrame, customers: DataFrame, root: str) -> dict[str, SnapshotTable]:
    """One new version of each exported KPI table."""
    reports = {
        "analytics_revenue_daily": kpi.revenue_daily(sales),
        "analytics_top_films": kpi.top_films(sales, films),
        "analytics_customer_age": kpi.customer_age(sales, customers),
    }
    tables = {name: SnapshotTable(spark, f"{root}/{name}") for name in reports}
    for name, report in reports.items():
        tables[name].overwrite(report)
    return tables
