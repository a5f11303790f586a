"""Raw text tables to the star schema: three dimensions and one fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import columns as C
from marquee.operators.rows import keep_one


def build_dim_customer(
    raw: DataFrame,
    year: int = 2019,
    genders: Mapping[str, Sequence[str]] = schemas.GENDER_CODES,
    null_label: str | None = None,
) -> DataFrame:
    """One row per customer id; ages are counted in ``year``."""
    dob = F.try_to_date("dob", "dd/MM/yyyy")
    parsed = raw.withColumnsRenamed({"customerid": "customer_id"}).dropna(subset=["customer_id"])
    typed = parsed.withColumn("dob", dob).withColumn("age_2019", C.age_in(year, F.col("dob")))
    return keep_one(
        typed.select(
            "customer_id",
            "dob",
            "age_2019",
            C.age_group(F.col("age_2019"), null_label).alias("age_group"),
            C.gender_label(F.col("gender"), genders).alias("gender"),
            C.address_part(F.col("address"), 1).alias("district"),
            C.address_part(F.col("address"), 2).alias("city"),
            "job",
            C.channel(F.col("customer_id")).alias("customer_type"),
        ),
        "customer_id",
    )


def build_dim_film(raw: DataFrame) -> DataFrame:
    """One row per title, with the running time in minutes."""
    texts = [F.trim(c).alias(c) for c in ("film_name", "country", "director", "rating")]
    films = raw.select(*texts, C.first_number(F.col("duration")).alias("duration"))
    return keep_one(films.dropna(subset=["film_name"]), "film_name")


def build_dim_date(tickets: DataFrame) -> DataFrame:
    """One row per screening date of the raw tickets, in date order."""
    dates = tickets.select(F.try_to_date("date").alias("sale_date"))
    return dim_date_of(dates)


def dim_date_of(dates: DataFrame) -> DataFrame:
    """Calendar attributes of the distinct, non-null dates in ``sale_date``."""
    day = F.col("sale_date")
    return (
        dates.filter(day.isNotNull())
        .select("sale_date")
        .distinct()
        .select(
            "sale_date",
            F.dayofmonth(day).alias("day"),
            F.month(day).alias("month"),
            F.year(day).alias("year"),
            C.iso_weekday(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.weekofyear(day).alias("week_of_year"),
            F.quarter(day).alias("quarter"),
            C.iso_weekday(day).isin(6, 7).alias("is_weekend"),
        )
        .orderBy("sale_date")
    )


def _refusals() -> dict[str, Column]:
    """Why a raw ticket is left out, in the order in which it is told; texts are the raw ones, others typed."""
    return {
        "no_order": F.col("order_id").isNull(),
        "no_customer": F.col("customer_id").isNull(),
        "no_film": F.col("film_name").isNull(),
        "no_date": F.col("sale_date").isNull(),
        "no_price": F.col("ticket_price").isNull(),
        "price_not_positive": F.col("ticket_price") <= 0,
    }


def build_fact_ticket(
    raw: DataFrame, null_session: str | None = None, dedupe: bool = False, account: Observation | None = None,
    zone: str | None = None, columns: Sequence[str] = tuple(schemas.FACT_TICKET.names),
) -> DataFrame:
    """One row per sold ticket. Narrow: no shuffle unless ``dedupe`` drops equal rows.

    ``sale_date`` is the date of the screening; the hour of sale comes from ``saledate``. It is
    the hour that the text shows, unless ``zone`` is given: then a text with an offset counts as
    the hour of that moment in the zone, and a text without one as the zone's own time.

    Rows without order, customer, film, date or a positive price are dropped. ``account`` learns in the
    pass that reads the rows how many came in, went out, and were refused for which reason;
    each refused row counts once, under its first reason. What is counted keeps Spark from leaving out columns
    by itself, so a caller that needs a few of them names them in ``columns``.
    """
    if zone is None:
        sold = F.hour(F.col("saledate").try_cast("timestamp_ntz"))
    else:
        sold = _hour_in(F.col("saledate"), zone)
    fields = {
        "order_id": F.col("orderid"),
        "ticket_id": F.col("ticketcode"),
        "customer_id": F.col("customerid"),
        "film_name": F.trim("film"),
        "sale_date": F.try_to_date("date"),
        "sale_hour": sold,
        "time": F.col("time"),
        "show_hour": C.hour_of_clock(F.col("time")),
        "slot": F.col("slot"),
        "room": C.whole_number(F.col("room")),
        "slot_type": F.trim("slot_type"),
        "is_couple_seat": C.is_couple(F.col("slot_type")),
        "ticket_type": F.trim("ticket_type"),
        "ticket_price": C.finite_number(F.col("ticket_price")),
        "total": C.finite_number(F.col("total")),
        "has_popcorn": C.is_yes(F.col("popcorn")),
        "cashier": F.trim("cashier"),
        "total_given": F.coalesce(F.trim("total") != "", F.lit(False)),
    }
    told = {"order_id", "customer_id", "film_name", "sale_date", "ticket_price", "total", "total_given"}
    needed = told.union(columns, ["show_hour"] if "show_session" in columns else [])
    fact = raw.select(*[field.alias(name) for name, field in fields.items() if name in needed])
    reason = F
    for name, holds in _refusals().items():
        reason = reason.when(holds, name)
    fact = fact.withColumn("refused", reason)
    if account is not None:
        kept = F.col("refused").isNull()
        fact = fact.observe(
            account,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(kept).alias("rows_out"),
            *[F.count_if(F.col("refused") == name).alias(name) for name in _refusals()],
            F.count_if(kept & F.col("total_given") & F.col("total").isNull()).alias("total_unreadable"),
        )
    derived = {
        "is_weekend": C.is_weekend(F.col("sale_date")),
        "show_session": C.show_session(F.col("show_hour"), null_session) if "show_hour" in needed else F.lit(None),
    }
    kept = fact.filter("refused IS NULL").withColumns(derived).select(*columns)
    return kept.distinct() if dedupe else kept


def _hour_in(text: Column, zone: str) -> Column:
    """The hour of a date and time in a zone; what the text itself says counts unless it has an offset."""
    offset = F.regexp_extract(text, r"(?i)(Z|[+-]\d{2}:?\d{2})\s*$", 1)
    local = text.try_cast("timestamp_ntz")
    moment = text.try_cast("timestamp")
    there = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz")))
    return F.when(offset != "", F.hour(there)).otherwise(F.hour(local))


def with_sale_month(fact: DataFrame) -> DataFrame:
    """Add the partition columns sale_year and sale_month."""
    return fact.withColumns({"sale_year": F.year("sale_date"), "sale_month": F.month("sale_date")})
