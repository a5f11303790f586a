
from __future__ import annotations

import pathlib
import sys
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_HERE = str(pathlib.Path(__file__).resolve().parent)
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

import oracle
from marquee import schemas
from marquee.functions import columns as C
from marquee.functions.amounts import exact_sum
from marquee.operators import quality
from marquee.operators.lineage import stored
from marquee.operators.rows import measures_as_rows
from marquee.plans import extended, feeds, full_run, kpi, star
from marquee.plans import order_lines as shop
from marquee.session import scratch_path
from marquee.sources import catalog, delimited, files
from marquee.sources.snapshots import SnapshotTable

# the training-data part may be absent as a whole; a fault inside it must show
llm = None
if all(find_spec(name) for name in ("corpus_pipeline", "marquee.llm")):
    import corpus_pipeline
    from marquee.llm import queries as llm

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return kpi.revenue_daily(shop.order_sales(spark, "/root/testdata/sf0.001"))


# --- reports ------------------------------------------------------------------


def _sales(report: Callable) -> Query:
    return lambda spark, d: report(shop.order_sales(spark, d))


def _films(report: Callable) -> Query:
    return lambda spark, d: report(shop.order_sales(spark, d), shop.films(spark, d))


def _customers(report: Callable) -> Query:
    return lambda spark, d: report(shop.order_sales(spark, d), shop.customers(spark, d))


def _events(report: Callable) -> Query:
    return lambda spark, d: report(shop.event_sales(spark, d))


def _calendar(*by: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        sales = shop.order_sales(spark, d)
        return extended.by_calendar(sales, star.dim_date_of(sales.orders.select("sale_date")), *by)

    return run


# --- cleaning -----------------------------------------------------------------


def fact_ticket(spark: SparkSession, d: str) -> DataFrame:
    return star.build_fact_ticket(shop.raw_tickets(spark, d))


def fact_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of the fact, with the account of rows that cleaning refused."""
    account = Observation("tickets")
    fact = star.build_fact_ticket(shop.raw_tickets(spark, d), account=account, columns=quality.CHECKED)
    return quality.fact_checks(fact, account)


def customer_checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.customer_checks(star.build_dim_customer(shop.raw_customers(spark, d)))


def session_labels(spark: SparkSession, d: str) -> DataFrame:
    """Sessions with unreadable show times under a label of their own."""
    fact = star.build_fact_ticket(shop.raw_tickets(spark, d), null_session=schemas.UNKNOWN)
    return quality.frequencies(fact, "show_session")


def gender_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Gender codes with the Vietnamese forms included."""
    customers = star.build_dim_customer(shop.raw_customers(spark, d), genders=schemas.GENDER_CODES_VI)
    return quality.frequencies(customers, "gender")


def address_split(spark: SparkSession, d: str) -> DataFrame:
    address = F.col("address")
    raw = shop.raw_customers(spark, d)
    parts = raw.select(*[C.address_part(address, i).alias(n) for i, n in enumerate(("street", "district", "city"))])
    return parts.groupBy("district", "city").agg(
        F.count(F.lit(1)).alias("rows"), F.min("street").alias("first_street")
    )


def number_from_text(spark: SparkSession, d: str) -> DataFrame:
    number = C.first_number(F.col("props"))
    return shop.table(spark, d, "events").groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias("rows"))


def prefix_channel(spark: SparkSession, d: str) -> DataFrame:
    label = C.channel(F.col("customerid"))
    return shop.raw_customers(spark, d).groupBy(label.alias("customer_type")).agg(F.count(F.lit(1)).alias("rows"))


# --- quality ------------------------------------------------------------------


def _profile(make: Callable[[SparkSession, str], DataFrame], name: str) -> Query:
    return lambda spark, d: quality.profile(make(spark, d), name)


def _table(name: str) -> Query:
    return lambda spark, d: shop.table(spark, d, name)


def row_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.shape({n: shop.table(spark, d, n) for n in ("lineitem", "orders", "customer", "part")})


def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.distinct_counts(shop.table(spark, d, "lineitem"), "l_partkey", "l_orderkey")


def date_range(spark: SparkSession, d: str) -> DataFrame:
    return quality.date_range(shop.order_sales(spark, d).orders, "sale_date")


def invalid_counters(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_positive(
        shop.table(spark, d, "customer").select(F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation")),
        "balance", "nation",
    )


def preview(spark: SparkSession, d: str) -> DataFrame:
    """First rows of a dimension in key order."""
    return shop.table(spark, d, "customer").orderBy("c_custkey").limit(10)


# --- files and tables ---------------------------------------------------------


def csv_tickets(spark: SparkSession, d: str) -> DataFrame:
    """Raw tickets, quotes and separators in their texts, through ticket files and the cleaning steps, summed per session."""
    path = scratch_path(spark, "ticket-csv")
    raw = shop.raw_tickets(spark, d).withColumn("cashier", F.concat("cashier", F.lit('"A"; B')))
    delimited.write_delimited(raw, path)
    fact = star.build_fact_ticket(delimited.read_tickets(spark, path))
    return fact.groupBy("show_session", "is_couple_seat", "has_popcorn").agg(
        F.count(F.lit(1)).alias("so_ve"), F.count("total").alias("so_tong"), F.count("sale_hour").alias("so_gio"),
        exact_sum(F.col("ticket_price")).cast("double").alias("gia"),
        F.count_if(F.col("cashier").endswith('"A"; B')).alias("quoted"),
    )


def csv_customers(spark: SparkSession, d: str) -> DataFrame:
    """Raw customers through a customer file and its profile, with the count of damaged lines.

    Jobs carry quotes and separators; some addresses have a line break, which this format cannot hold.
    """
    path = scratch_path(spark, "customer-csv")
    raw = shop.raw_customers(spark, d).withColumn("job", F.concat(F.lit('"x"; '), "job"))
    broken = F.col("address").contains(" / CANADA / ")
    delimited.write_delimited(raw.withColumn("address", F.when(broken, F.replace("address", F.lit(" / "), F.lit("\n"))).otherwise(F.col("address"))), path)
    damaged = Observation()
    profile = stored(quality.profile(delimited.read_customers(spark, path, damaged), "customer"), "customer-profile")
    seen = damaged.get
    line = [("customer", "(damaged lines)", seen["read"], seen["damaged"], seen["damaged"] > 0)]
    return profile.unionByName(spark.createDataFrame(line, profile.schema))


def csv_films(spark: SparkSession, d: str) -> DataFrame:
    """Raw films through a film file with quotes and line breaks, and the film dimension."""
    path = scratch_path(spark, "film-csv")
    delimited.write_delimited(shop.raw_films(spark, d), path)
    return star.build_dim_film(delimited.read_films(spark, path))


def csv_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents through multi-line files, compared by digest; only blanks are taken off the header's names."""
    path = scratch_path(spark, "document-csv")
    texts = shop.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias(" Doc Id "), "text")
    delimited.write_delimited(texts, path)
    back = delimited.normalised(delimited.read_delimited(spark, path, multi_line=True), identifiers=False)
    return back.select(F.col("Doc Id").alias("doc_id"), F.length("text").alias("chars"), F.md5("text").alias("digest"))


def _monthly_sales(spark: SparkSession, d: str) -> DataFrame:
    orders = shop.order_sales(spark, d).orders.select("order_id", "customer_id", "sale_date", "total")
    return star.with_sale_month(orders)


def _monthly_report(orders: DataFrame) -> DataFrame:
    return orders.groupBy("sale_year", "sale_month").agg(
        F.count(F.lit(1)).alias("so_don"), exact_sum(F.col("total")).cast("double").alias("doanh_thu")
    )


def snapshot_read(spark: SparkSession, d: str) -> DataFrame:
    """Version 0 of a table after a second version replaced it."""
    table = SnapshotTable(spark, scratch_path(spark, "snapshot"))
    orders = _monthly_sales(spark, d)
    table.overwrite(orders, schemas.FACT_PARTITIONS)
    table.overwrite(_monthly_report(orders))
    return _monthly_report(table.read(0))


def snapshot_history(spark: SparkSession, d: str) -> DataFrame:
    """Version log of a table, newest first."""
    table = SnapshotTable(spark, scratch_path(spark, "history"))
    orders = _monthly_sales(spark, d)
    table.overwrite(orders, schemas.FACT_PARTITIONS)
    table.overwrite(_monthly_report(orders))
    table.compact()
    return table.history(10).select("version", "operation", "rows")


def compacted_read(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned table after compaction."""
    table = SnapshotTable(spark, scratch_path(spark, "compact"))
    table.overwrite(_monthly_sales(spark, d), schemas.FACT_PARTITIONS)
    table.compact(4 * 1024 * 1024)
    table.check()
    return _monthly_report(table.read())


def pruned_month(spark: SparkSession, d: str) -> DataFrame:
    """A date range of a partitioned table; only its months are opened."""
    path = scratch_path(spark, "monthly")
    files.write_parquet(_monthly_sales(spark, d), path, schemas.FACT_PARTITIONS)
    stored = files.read_parquet(spark, path, "monthly orders")
    return _monthly_report(files.between_dates(stored, "1997-11-15", "1998-02-10"))


def partition_replaced(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned table after only its months of 1998 were written again, with doubled totals."""
    path = scratch_path(spark, "replaced")
    orders = _monthly_sales(spark, d)
    files.write_parquet(orders, path, schemas.FACT_PARTITIONS)
    newer = orders.filter(F.col("sale_year") == 1998).withColumn("total", F.col("total") * 2)
    files.write_parquet(newer, path, schemas.FACT_PARTITIONS, only_touched=True)
    return _monthly_report(files.read_parquet(spark, path))


def _in_schema(spark: SparkSession, work: Callable[[str, str], DataFrame]) -> DataFrame:
    """Stored rows of ``work(schema, root)``, done in a schema of its own that is dropped afterwards."""
    before, home = spark.catalog.currentDatabase(), spark.catalog.currentCatalog()
    root = scratch_path(spark, "schema")
    schema = f"marquee_{root[-12:]}"
    catalog.use_schema(spark, schema, root, home)
    try:
        return stored(work(schema, root), "tables")
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


def catalog_tables(spark: SparkSession, d: str) -> DataFrame:
    """Star tables saved in the catalog and read back by name."""

    def work(schema: str, root: str) -> DataFrame:
        orders = _monthly_sales(spark, d)
        catalog.save_table(orders, f"{schema}.fact_order")
        catalog.save_table(orders, f"{schema}.fact_order", schemas.FACT_PARTITIONS)
        catalog.save_table(star.dim_date_of(orders.select("sale_date")), f"{schema}.dim_date")
        present = catalog.presence(spark, [f"{schema}.fact_order", f"{schema}.dim_date", f"{schema}.dim_film"])
        named = present.select(F.split("table_name", r"\.")[1].alias("table_name"), "present")
        listed = catalog.list_tables(spark, schema).select(F.col("tableName").alias("table_name"), F.lit(True).alias("listed"))
        rows = quality.shape({n: spark.table(f"{schema}.{n}") for n in ("fact_order", "dim_date")})
        return named.join(listed, "table_name", "left").join(rows, "table_name", "left")

    return _in_schema(spark, work)


def file_listing(spark: SparkSession, d: str) -> DataFrame:
    """Files of all tables by name, with the rows that each of them gives."""
    tables = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
    parts = [files.rows_by_file(shop.table(spark, d, n)) for n in tables]
    listed = reduce(DataFrame.unionByName, parts)
    return listed.select("name", (F.col("bytes") > 0).alias("has_bytes"), F.col("modified").isNotNull().alias("dated"), "rows")


def schema_report(spark: SparkSession, d: str) -> DataFrame:
    """Columns of the fact with their types and what they hold."""
    return files.schema_report(fact_ticket(spark, d))


def kpi_export(spark: SparkSession, d: str) -> DataFrame:
    """The three exported reports, read back from their stored versions, as one long list of numbers."""
    tables = full_run.export_kpis(
        spark, shop.order_sales(spark, d), shop.films(spark, d), shop.customers(spark, d), scratch_path(spark, "kpi")
    )
    keys = {"analytics_revenue_daily": ["sale_date"], "analytics_top_films": ["film_name"], "analytics_customer_age": ["age_group", "gender"]}
    return reduce(DataFrame.unionByName, [measures_as_rows(tables[n].read(), n, *k) for n, k in keys.items()])


def star_store(spark: SparkSession, d: str) -> DataFrame:
    """The stored star after a full run over raw tables: tickets and revenue by rating and gender."""

    def work(schema: str, root: str) -> DataFrame:
        built = full_run.build_star(shop.raw_films(spark, d), shop.raw_customers(spark, d), shop.raw_tickets_with_customers(spark, d))
        star_tables = full_run.store_star(spark, built, scratch_path(spark, "star"))
        full_run.store_for_customers(star_tables["fact_ticket"].read(), star_tables["dim_customer"].read(), schema, root)
        return kpi.rating_by_gender(full_run.sales_with_customers(spark, schema), star_tables["dim_film"].read())

    return _in_schema(spark, work)


def training_queries() -> dict[str, Query]:
    return {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}


def queries() -> dict[str, Query]:
    return {
        # overview and revenue
        "summary": _sales(kpi.summary),
        "revenue_daily_v1": _sales(kpi.revenue_daily_orders),
        "revenue_daily": _sales(kpi.revenue_daily),
        "revenue_ma7": _sales(lambda s: feeds.revenue_series(kpi.revenue_daily(s))),
        "weekend_v1": _sales(kpi.weekend_compare),
        "weekend_share": _sales(kpi.weekend_share),
        # films
        "top_films_v1": _films(kpi.top_films_by_price),
        "top_films": _films(kpi.top_films),
        "top10_feed": _films(lambda s, f: feeds.film_bars(kpi.top_films(s, f))),
        "top5_feed": _films(lambda s, f: feeds.top_film_bars(kpi.top_films(s, f))),
        "rating_mix": _films(kpi.rating_mix),
        "rating_mix_known": _films(lambda s, f: feeds.rating_slices(kpi.rating_mix(s, f))),
        "rating_mix_all": _films(lambda s, f: feeds.rating_slices(kpi.rating_mix(s, f), with_unknown=True)),
        # customers
        "customer_gender": _customers(kpi.customer_gender),
        "customer_age": _customers(kpi.customer_age),
        "age_gender_pivot": _customers(kpi.age_gender_pivot),
        "top_districts": _customers(kpi.top_districts),
        # shows, rooms, seats, popcorn
        "sessions_by_hour": _events(kpi.sessions_by_hour),
        "session_rollup": _events(lambda s: kpi.session_rollup(kpi.sessions_by_hour(s))),
        "session_feed": _events(lambda s: feeds.session_bars(kpi.sessions_by_hour(s))),
        "room_seat_v1": _sales(kpi.room_seat_plain),
        "room_seat": _sales(kpi.room_seat),
        "seat_type": _sales(kpi.seat_type),
        "popcorn": _sales(kpi.popcorn),
        # star schema
        "fact_ticket": fact_ticket,
        "dim_customer": lambda s, d: star.build_dim_customer(shop.raw_customers(s, d)),
        "dim_film": lambda s, d: star.build_dim_film(shop.raw_films(s, d)),
        "dim_date": lambda s, d: star.build_dim_date(shop.raw_tickets(s, d)),
        "session_labels": session_labels,
        "gender_mapped": gender_mapped,
        "address_split": address_split,
        "number_from_text": number_from_text,
        "prefix_channel": prefix_channel,
        # quality
        "null_profile": _profile(_table("documents"), "documents"),
        "null_profile_labels": _profile(_table("labels"), "labels"),
        "null_profile_tickets": _profile(shop.raw_tickets, "ticket"),
        "row_counts": row_counts,
        "freq_slot_type": lambda s, d: quality.frequencies(shop.order_sales(s, d).tickets, "slot_type"),
        "freq_age_group": lambda s, d: quality.frequencies(shop.customers(s, d), "age_group", by_value=True),
        "distinct_counts": distinct_counts,
        "date_range": date_range,
        "invalid_counters": invalid_counters,
        "fact_checks": fact_checks,
        "customer_checks": customer_checks,
        "preview": preview,
        # files and tables
        "csv_tickets": csv_tickets,
        "csv_customers": csv_customers,
        "csv_films": csv_films,
        "csv_documents": csv_documents,
        "snapshot_read": snapshot_read,
        "snapshot_history": snapshot_history,
        "compacted_read": compacted_read,
        "pruned_month": pruned_month,
        "partition_replaced": partition_replaced,
        "catalog_tables": catalog_tables,
        "file_listing": file_listing,
        "schema_report": schema_report,
        "kpi_export": kpi_export,
        "star_store": star_store,
        # beyond the six groups
        "genre_films": lambda s, d: extended.genre_films(shop.films(s, d)),
        "genre_explode": _films(extended.genre_sales),
        "star_by_weekday": _calendar("day_of_week", "day_name"),
        "star_by_quarter": _calendar("year", "quarter"),
        "cohort_retention": _sales(extended.cohort_retention),
        "cohort_matrix": _sales(lambda s: extended.cohort_matrix(extended.cohort_retention(s))),
        "rfm": _sales(extended.rfm),
        "revenue_dedup": _sales(extended.revenue_per_order),
        "popcorn_corr": _sales(extended.popcorn_correlation),
        "by_ticket_type": _sales(kpi.ticket_type),
        # training-data operators
        **training_queries(),
    }


def oracle_sql() -> dict[str, str]:
    return {**oracle.statements(), **(llm.oracle_sql() if llm else {})}
