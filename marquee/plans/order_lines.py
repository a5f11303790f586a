"""The star schema over an order / line-item warehouse.

A line item stands for a ticket, its order for the order, a part for a film. Two
views are offered: typed sales for the KPIs, and raw text tables with the flaws of
hand-kept files, as input for the cleaning steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import columns as C
from marquee.operators.tally import SplitSales

# Market segments read as gender codes.
SEGMENT_GENDERS = {"Male": ["MACHINERY", "FURNITURE"], "Female": ["BUILDING"]}
UNRATED_TYPE = "ECONOMY"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _title(part_key: str) -> Column:
    return F.concat(F.lit("Film #"), F.col(part_key).cast("string"))


# --- typed view ---------------------------------------------------------------


def order_sales(spark: SparkSession, folder: str) -> SplitSales:
    """Tickets from lineitem, order attributes from orders."""
    day = F.col("o_orderdate").cast("date")
    tickets = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("ticket_id"),
        _title("l_partkey").alias("film_name"),
        F.col("l_linestatus").alias("slot_type"),
        (F.col("l_suppkey") % 10).cast("int").alias("room"),
        (F.col("l_returnflag") == "R").alias("has_popcorn"),
        F.col("l_extendedprice").alias("ticket_price"),
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day.alias("sale_date"),
        C.is_weekend(day).alias("is_weekend"),
        F.col("o_orderpriority").alias("ticket_type"),
        F.col("o_totalprice").alias("total"),
    )
    return SplitSales(tickets, orders)


def event_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets with a show hour, from events; one row per ticket."""
    hour, day = F.hour("ts"), F.col("ts").cast("date")
    timed = table(spark, folder, "events").withColumns({"show_hour": hour, "sale_date": day})
    return timed.select(
        F.col("event_id").alias("order_id"),
        F.col("event_id").alias("ticket_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("film_name"),
        "sale_date",
        C.is_weekend(F.col("sale_date")).alias("is_weekend"),
        "show_hour",
        C.show_session(F.col("show_hour")).alias("show_session"),
        F.col("value").alias("ticket_price"),
        F.col("value").alias("total"),
    )


def films(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        _title("p_partkey").alias("film_name"),
        F.col("p_brand").alias("director"),
        F.when(F.col("p_type") != UNRATED_TYPE, F.col("p_type")).alias("rating"),
        F.col("p_size").alias("duration"),
        F.concat_ws(", ", "p_type", F.replace("p_name", F.lit(" "), F.lit(", "))).alias("listed_in"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    age = C.age_in(2019, F.make_date((F.lit(1950) + F.col("c_custkey") % 65).cast("int"), F.lit(1), F.lit(1)))
    aged = _customers_with_place(spark, folder).withColumn("age_2019", age)
    return aged.select(
        F.col("c_custkey").alias("customer_id"),
        "age_2019",
        C.age_group(F.col("age_2019")).alias("age_group"),
        C.gender_label(F.col("c_mktsegment"), SEGMENT_GENDERS).alias("gender"),
        F.col("n_name").alias("district"),
        F.col("r_name").alias("city"),
    )


def _customers_with_place(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, folder, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))


# --- raw text view ------------------------------------------------------------


def raw_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a raw ticket row: all text, padded, with gaps and bad values."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    order_day = F.col("o_orderdate").cast("date")
    iso, local = order_day.cast("string"), F.date_format(order_day, "dd/MM/yyyy")
    clock = F.concat(F.lpad((F.col("l_partkey") % 24).cast("string"), 2, "0"), F.lit(":15:00"))
    show = F.concat(F.lpad((quantity % 24).cast("string"), 2, "0"), F.lit(":30"))
    joined = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        F.col("l_orderkey").cast("string").alias("orderid"),
        F.concat(F.lit(" NV"), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("cashier"),
        F.when(line == 7, "n/a").otherwise(F.concat_ws(" ", iso, clock)).alias("saledate"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).alias("total"),
        F.when(~((line == 1) & (F.col("o_orderpriority") == "5-LOW")), F.col("o_custkey").cast("string")).alias("customerid"),
        line.cast("string").alias("ticketcode"),
        F.when(quantity == 50, local).otherwise(iso).alias("date"),
        F.when(line == 2, "abc").when(line == 3, F.lit(None)).otherwise(show).alias("time"),
        F.col("l_returnflag").alias("slot"),
        F.when(line == 4, "VIP").otherwise((F.col("l_suppkey") % 10).cast("string")).alias("room"),
        F.concat(F.lit(" "), _title("l_partkey"), F.lit("  ")).alias("film"),
        F.when(F.col("l_linestatus") == "F", "ĐƠN").when(line == 5, "đôi ").otherwise(" ĐÔI").alias("slot_type"),
        F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("ticket_type"),
        F.when(quantity == 49, "0").when(quantity == 48, "x")
        .otherwise(F.col("l_extendedprice").cast("string")).alias("ticket_price"),
        F.when(F.col("l_returnflag") == "R", " Có ").when(F.col("l_returnflag") == "A", "Không").alias("popcorn"),
    ).select(*schemas.RAW_TICKET)


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer twice, with differing jobs, as raw text rows."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    born = F.make_date(
        (F.lit(1950) + key % 65).cast("int"), (key % 12 + 1).cast("int"), (key % 28 + 1).cast("int")
    )
    dob = (
        F.when(nation == 3, "1/5/2000").when(nation == 4, "31/02/1999").when(nation == 5, "")
        .when(nation == 6, F.lit(None)).otherwise(F.date_format(born, "dd/MM/yyyy"))
    )
    street = F.concat(F.lit("Street "), key.cast("string"))
    address = (
        F.when(nation == 7, F.concat_ws("/", street, "n_name")).when(nation == 8, F.lit(None))
        .otherwise(F.concat_ws(" / ", street, "n_name", "r_name"))
    )
    segment = F.col("c_mktsegment")
    gender = (
        F.when(segment == "MACHINERY", "m").when(segment == "FURNITURE", "Male")
        .when(segment == "BUILDING", "FEMALE").when(segment == "AUTOMOBILE", "Nam")
    )
    twice = _customers_with_place(spark, folder).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    known = ~((F.col("copy") == 1) & (nation == 9))
    return twice.select(
        F.when(known, F.concat(_customer_prefix(), key.cast("string"))).alias("customerid"),
        dob.alias("dob"),
        gender.alias("gender"),
        address.alias("address"),
        F.when(F.col("copy") == 1, F.concat(F.lit("A "), segment)).otherwise(segment).alias("job"),
    ).select(*schemas.RAW_CUSTOMER)


def _customer_prefix() -> Column:
    return F.when(F.col("c_nationkey") % 2 == 0, schemas.ONLINE_PREFIX).otherwise("C")


def raw_tickets_with_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The raw tickets under the ids of the raw customers; every tenth customer's tickets have an id no one has."""
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("customerid"),
        F.concat(F.when(F.col("c_custkey") % 10 == 0, "X").otherwise(_customer_prefix()), F.col("c_custkey").cast("string")).alias("known_id"),
    )
    met = raw_tickets(spark, folder).join(people, "customerid", "left")
    return met.withColumn("customerid", F.col("known_id")).select(*schemas.RAW_TICKET)


def raw_films(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a raw film row; the smallest size has no title."""
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("show_id"),
        F.when(size > 1, F.concat(F.lit("  "), _title("p_partkey"), F.lit(" "))).alias("film_name"),
        F.concat(F.col("p_brand"), F.lit(" ")).alias("director"),
        F.lit("A, B").alias("cast"),
        F.lit(" Vietnam").alias("country"),
        F.lit("2019").alias("release_year"),
        F.concat(F.lit(" "), F.col("p_type")).alias("rating"),
        F.when(size % 5 == 0, "Not Available").otherwise(F.concat(size.cast("string"), F.lit(" minutes"))).alias("duration"),
        F.concat_ws(", ", "p_type", F.replace("p_name", F.lit(" "), F.lit(", "))).alias("listed_in"),
        F.concat(F.lit('"'), F.col("p_name"), F.lit('"; new\nline')).alias("description"),
    ).select(*schemas.RAW_FILM)
