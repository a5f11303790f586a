"""KPI reports. Each takes sales (and dimensions) and returns a DataFrame.

Sales are summed to the join key before a dimension is joined: a dimension then
meets one row per film or customer instead of one per ticket. Amounts named
``doanh_thu`` or ``tong_chi_tieu`` add the order total once per ticket, as the
reports have always done; ``extended.revenue_per_order`` counts it once per order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.amounts import ratio, rounded, share
from marquee.operators.rows import align, top
from marquee.operators.tally import MEASURES, Sales, order_cells, price, regroup, revenue, summed, tally, ticket_measures
from marquee.operators.trends import with_change


def _tickets() -> Column:
    return F.col("tickets")


def _total(digits: int = 0) -> Column:
    return rounded(revenue(), digits)


def _total_per_row() -> Column:
    return ratio(revenue(), F.col("total_count"))


def _total_per_ticket(digits: int = 0) -> Column:
    return ratio(revenue(), _tickets(), digits)


def _mean_price() -> Column:
    return ratio(price(), F.col("price_count"))


# --- overview -----------------------------------------------------------------


def summary(sales: Sales) -> DataFrame:
    """One row: orders, tickets, customers, films, revenue, mean price, first and last date.

    Tickets are shuffled once, by order. Each cell then gives one row that carries its
    measures, and one row per customer and film; equal ones merge inside each task, so all
    distinct counts come out of one narrow aggregate.
    """
    cells, one_per_order = order_cells(sales)
    keys = {"customer": F.array("customer_id"), "film": F.col("films")} | ({} if one_per_order else {"order": F.array("order_id")})

    def named(kind: str, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))

    lists = [F.transform(values, partial(named, kind)) for kind, values in keys.items()]
    whole = F.array(named("all", F.lit(None)))
    held = [*MEASURES, "sale_date", "order_id"]
    rows = cells.select(*held, F.explode(F.concat(whole, *lists)).alias("of"))
    only = F.col("of.kind") == "all"
    rows = rows.select("of.*", *[F.when(only, F.col(c)).alias(c) for c in held])
    merged = regroup(rows, "kind", "key", first=F.min("sale_date"), last=F.max("sale_date"), orders=F.count("order_id"))

    def distinct(kind: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col("key").isNotNull())

    whole = merged.agg(
        (F.max("orders") if one_per_order else distinct("order")).alias("tong_don_hang"),
        distinct("customer").alias("tong_khach_hang"), distinct("film").alias("tong_phim"),
        F.min("first").alias("ngay_dau"), F.max("last").alias("ngay_cuoi"), *summed(),
    )
    return whole.select(
        F.coalesce("tong_don_hang", F.lit(0)).alias("tong_don_hang"),
        F.coalesce(_tickets(), F.lit(0)).alias("tong_ve_ban"),
        "tong_khach_hang",
        "tong_phim",
        _total().alias("tong_doanh_thu_vnd"),
        _mean_price().alias("gia_ve_tb_vnd"),
        "ngay_dau",
        "ngay_cuoi",
    )


# --- revenue over time --------------------------------------------------------


def revenue_daily_orders(sales: Sales) -> DataFrame:
    """Tickets, distinct orders and revenue per day."""
    daily = regroup(
        ticket_measures(sales, "sale_date", "order_id"), "sale_date", so_don=F.count_distinct("order_id")
    )
    return daily.select("sale_date", _tickets().alias("so_ve"), "so_don", _total().alias("doanh_thu")).orderBy("sale_date")


def revenue_daily(sales: Sales) -> DataFrame:
    """Tickets and revenue per day, with the day before and the change."""
    daily = tally(sales, "sale_date").select("sale_date", _tickets().alias("so_ve"), _total().alias("doanh_thu"))
    return with_change(daily, "doanh_thu", "doanh_thu_ngay_truoc", "tang_giam").orderBy("sale_date")


def weekend_compare(sales: Sales) -> DataFrame:
    """Weekend against weekdays: tickets, orders, revenue, mean price, revenue per day."""
    return regroup(
        ticket_measures(sales, "is_weekend", "order_id", "sale_date"),
        "is_weekend",
        tong_don=F.count_distinct("order_id"),
        days=F.count_distinct("sale_date"),
    ).select(
        _day_label(),
        _tickets().alias("tong_ve"),
        "tong_don",
        _total().alias("tong_doanh_thu"),
        _mean_price().alias("gia_ve_tb"),
        ratio(revenue(), F.col("days")).alias("dt_tb_moi_ngay"),
    )


def weekend_share(sales: Sales) -> DataFrame:
    """Weekend against weekdays: tickets, revenue and its fraction of the whole."""
    return tally(sales, "is_weekend").select(
        _day_label(),
        _tickets().alias("tong_ve"),
        _total().alias("tong_doanh_thu"),
        share(F.round(revenue(), 0), 2, scale=1).alias("ty_le_doanh_thu"),
    )


def _day_label() -> Column:
    label = F.when(F.col("is_weekend"), schemas.WEEKEND_LABEL).otherwise(schemas.WEEKDAY_LABEL)
    return label.alias("loai_ngay")


# --- films --------------------------------------------------------------------


def rating_by_gender(sales: DataFrame, films: DataFrame) -> DataFrame:
    """Tickets and revenue per film rating and customer gender; sales without a known customer under null.

    ``sales`` are tickets that have met their customers.
    """
    per_film = tally(sales, "film_name", "gender")
    catalogue = films.select(F.trim("film_name").alias("title"), "rating")
    met = per_film.join(catalogue, F.trim(per_film["film_name"]) == catalogue["title"], "left")
    mixed = regroup(met.withColumn("genre", F.coalesce("rating", F.lit(schemas.UNKNOWN))), "genre", "gender")
    return mixed.select("genre", "gender", _tickets().alias("so_ve"), _total().alias("doanh_thu")).orderBy("genre", "gender")


def _with_film(sales: Sales, films: DataFrame, *attributes: str) -> DataFrame:
    """Measures per film beside film attributes; films not in the catalogue stay."""
    per_film = tally(sales, "film_name")
    catalogue = films.select(F.trim("film_name").alias("title"), *attributes)
    return per_film.join(catalogue, F.trim(per_film["film_name"]) == catalogue["title"], "left").drop("title")


def top_films_by_price(sales: Sales, films: DataFrame, k: int = 10) -> DataFrame:
    """Films by revenue, with the mean ticket price."""
    per_film = regroup(_with_film(sales, films, "rating", "duration"), "film_name", "rating", "duration")
    listed = per_film.select(
        "film_name", "rating", "duration",
        _tickets().alias("so_ve"), _total().alias("doanh_thu"), _mean_price().alias("gia_tb"),
    )
    return top(listed, k, F.desc("doanh_thu"), "film_name", "rating", "duration")


def top_films(sales: Sales, films: DataFrame, k: int = 10) -> DataFrame:
    """Films by revenue, with the revenue per ticket."""
    per_film = regroup(_with_film(sales, films, "rating", "duration"), "film_name", "rating", "duration")
    listed = per_film.select(
        "film_name", "rating", "duration",
        _tickets().alias("so_ve"), _total(2).alias("doanh_thu"), _total_per_ticket(2).alias("gia_tb"),
    )
    return top(listed, k, F.desc("doanh_thu"), "film_name", "rating", "duration")


def rating_mix(sales: Sales, films: DataFrame) -> DataFrame:
    """Tickets, revenue and ticket share per film rating (reported as ``genre``)."""
    rated = _with_film(sales, films, "rating").withColumn("genre", F.coalesce("rating", F.lit(schemas.UNKNOWN)))
    return (
        regroup(rated, "genre")
        .select("genre", _tickets().alias("so_ve"), _total().alias("doanh_thu"), share(_tickets()).alias("pct_ve"))
        .orderBy(F.desc("so_ve"), "genre")
    )


# --- customers ----------------------------------------------------------------


def _with_customer(sales: Sales, customers: DataFrame, *attributes: str) -> DataFrame:
    """Measures per customer beside customer attributes; unknown customers stay."""
    return tally(sales, "customer_id").join(customers.select("customer_id", *attributes), "customer_id", "left")


def _by_customer_group(sales: Sales, customers: DataFrame, *by: str) -> DataFrame:
    joined = _with_customer(sales, customers, *by)
    return regroup(joined, *by, so_khach=F.count("customer_id"))


def customer_gender(sales: Sales, customers: DataFrame) -> DataFrame:
    """Customers, tickets, spend and spend per ticket by gender."""
    return (
        _by_customer_group(sales, customers, "gender")
        .select("gender", "so_khach", _tickets().alias("so_ve"), _total().alias("tong_chi_tieu"),
                _total_per_ticket().alias("chi_tieu_tb_moi_ve"))
        .orderBy(F.desc("so_ve"), "gender")
    )


def customer_age(sales: Sales, customers: DataFrame) -> DataFrame:
    """The same by age group and gender, youngest first."""
    place = F
    for position, label in enumerate(schemas.AGE_ORDER[:-1]):
        place = place.when(F.col("age_group") == label, position)
    return (
        _by_customer_group(sales, customers, "age_group", "gender")
        .select("age_group", "gender", "so_khach", _tickets().alias("so_ve"), _total().alias("tong_chi_tieu"),
                _total_per_ticket().alias("chi_tieu_tb_moi_ve"))
        .orderBy(place.otherwise(len(schemas.AGE_ORDER) - 1), "gender", "age_group")
    )


def age_gender_pivot(
    sales: Sales, customers: DataFrame, genders: Sequence[str] = tuple(schemas.GENDER_ORDER)
) -> DataFrame:
    """Tickets per age group, one column per gender; every age group is present."""
    by_both = regroup(_with_customer(sales, customers, "age_group", "gender"), "age_group", "gender")
    table = by_both.groupBy("age_group").pivot("gender", list(genders)).agg(F.sum("tickets"))
    return align(table, "age_group", schemas.AGE_ORDER, fill=0)


def top_districts(sales: Sales, customers: DataFrame, k: int = 15) -> DataFrame:
    """Districts by revenue, with the spend per customer."""
    listed = _by_customer_group(sales, customers, "district", "city").select(
        "district", "city", "so_khach", _tickets().alias("so_ve"), _total().alias("doanh_thu"),
        ratio(revenue(), F.col("so_khach")).alias("chi_tieu_tb_khach"),
    )
    return top(listed, k, F.desc("doanh_thu"), "district", "city")


# --- shows, rooms, seats ------------------------------------------------------


def sessions_by_hour(sales: Sales) -> DataFrame:
    """Tickets, revenue and ticket share per session and show hour."""
    return (
        tally(sales, "show_session", "show_hour")
        .select("show_session", "show_hour", _tickets().alias("so_ve"), _total().alias("doanh_thu"),
                share(_tickets()).alias("pct_ve"))
        .orderBy("show_hour", "show_session")
    )


def session_rollup(by_hour: DataFrame) -> DataFrame:
    """Tickets per session from ``sessions_by_hour``; all sessions, in day order."""
    summed_up = by_hour.groupBy("show_session").agg(F.sum("so_ve").alias("so_ve"))
    return align(summed_up, "show_session", schemas.SESSION_ORDER)


def room_seat_plain(sales: Sales) -> DataFrame:
    """Tickets, revenue and mean order total per room and seat type."""
    return (
        tally(sales, "room", "slot_type")
        .select("room", "slot_type", _tickets().alias("so_ve"), _total().alias("doanh_thu"),
                _total_per_row().alias("gia_tb"))
        .orderBy("room", F.desc("doanh_thu"), "slot_type")
    )


def room_seat(sales: Sales) -> DataFrame:
    """The same with the share of revenue and the revenue per ticket."""
    return (
        tally(sales, "room", "slot_type")
        .select("room", "slot_type", _tickets().alias("so_ve"), _total().alias("doanh_thu"),
                _total_per_row().alias("gia_tb"), share(revenue()).alias("pct_revenue"),
                _total_per_ticket().alias("revenue_per_ticket"))
        .orderBy(F.desc("doanh_thu"), "room", "slot_type")
    )


def _breakdown(sales: Sales, by: str, label: Column, mean: str) -> DataFrame:
    return (
        tally(sales, by)
        .select(label, _tickets().alias("so_ve"), _total().alias("doanh_thu"), _total_per_row().alias(mean),
                share(_tickets()).alias("pct_ve"), share(revenue()).alias("pct_revenue"),
                _total_per_ticket().alias("revenue_per_ticket"))
    )


def seat_type(sales: Sales) -> DataFrame:
    """Tickets, revenue, means and shares per seat type."""
    rows = _breakdown(sales, "slot_type", F.col("slot_type"), "gia_tb")
    return rows.orderBy(F.desc("so_ve"), "slot_type")


def ticket_type(sales: Sales) -> DataFrame:
    """Tickets, revenue, means and shares per ticket type."""
    rows = _breakdown(sales, "ticket_type", F.col("ticket_type"), "gia_tb")
    return rows.orderBy(F.desc("so_ve"), "ticket_type")


def popcorn(sales: Sales) -> DataFrame:
    """Tickets, revenue, means and shares with and without popcorn."""
    label = F.when(F.col("has_popcorn"), schemas.POPCORN_LABEL).otherwise(schemas.NO_POPCORN_LABEL)
    rows = _breakdown(sales, "has_popcorn", label.alias("trang_thai"), "gia_ve_tb")
    return rows.orderBy(F.desc("so_ve"), "trang_thai")
