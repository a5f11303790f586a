"""Additive ticket measures at any grain.

Every KPI asks for the same few sums (tickets, order total, ticket price) by some
keys. They are additive, so they can be summed early, before a join or a shuffle
moves the rows, and summed again at the grain of the report. A film, customer or
order that holds a large part of all tickets then travels as one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.amounts import high_part, joined, low_part, rest_part, usable
from marquee.operators.sizing import fits_broadcast


@dataclass(frozen=True)
class SplitSales:
    """Sales whose order-level columns (total, customer, date) sit in a table of their own.

    ``tickets`` has one row per ticket and carries ``order_id``; ``orders`` has one row
    per ``order_id`` and carries ``total``. A plain DataFrame stands for sales that
    are already joined.
    """

    tickets: DataFrame
    orders: DataFrame


Sales = DataFrame | SplitSales

MEASURES = (
    "tickets", "total_high", "total_low", "total_rest", "total_count",
    "price_high", "price_low", "price_rest", "price_count",
)


def ticket_measures(sales: Sales, *columns: str) -> DataFrame:
    """The given columns beside additive measures, at ticket grain or coarser.

    Measures: tickets, and for both total and price a high part, a low part, the rest and
    a count (see ``amounts``). Unused ones are pruned
    from the plan. The rows are input for an aggregate: how many tickets one row
    stands for is not fixed.

    Split sales are joined in one of three ways. Small order tables are broadcast.
    Otherwise, without ticket columns, tickets are summed per order first: the join
    then reuses that shuffle and no order is hot. With ticket columns such a sum would
    cost a second shuffle, so tickets are joined as they are; adaptive execution splits
    an order that fills a whole partition.
    """
    if isinstance(sales, DataFrame):
        return _per_ticket(sales, columns)
    wanted = dict.fromkeys(("order_id", "total", *columns))
    orders = sales.orders.select(*[c for c in wanted if c in sales.orders.columns])
    own = [c for c in columns if c in sales.tickets.columns and c != "order_id"]
    if own or fits_broadcast(orders):
        tickets = sales.tickets.select("order_id", *own, "ticket_id", "ticket_price")
        return _per_ticket(tickets.join(orders, "order_id"), columns)
    return _per_order(sales.tickets, orders, columns)


def order_cells(sales: Sales) -> tuple[DataFrame, bool]:
    """Measures with order_id, customer_id, sale_date and a list ``films``, and whether there is one row per order.

    Split sales are summed per order before the join, the films of an order as a set, which is no
    longer than the catalogue; joined sales keep their rows.
    """
    columns = ("order_id", "customer_id", "sale_date")
    if isinstance(sales, DataFrame):
        return _per_ticket(sales, (*columns, "film_name")).withColumn("films", F.array("film_name")), False
    orders = sales.orders.select(*columns, "total")
    return _per_order(sales.tickets, orders, (*columns, "films"), films=F.collect_set("film_name")), True


def tally(sales: Sales, *by: str) -> DataFrame:
    """One row per combination of ``by`` with the summed measures."""
    return regroup(ticket_measures(sales, *by), *by)


def regroup(measures: DataFrame, *by: str, **more: Column) -> DataFrame:
    """Sum measures to a coarser grain, with further aggregates by name."""
    return measures.groupBy(*by).agg(*summed(), *[c.alias(n) for n, c in more.items()])


def summed() -> list[Column]:
    return [F.sum(name).alias(name) for name in MEASURES]


def revenue() -> Column:
    """The order total behind summed measures."""
    return joined(F.col("total_high"), F.col("total_low"), F.col("total_rest"))


def price() -> Column:
    """The ticket price behind summed measures."""
    return joined(F.col("price_high"), F.col("price_low"), F.col("price_rest"))


def _per_ticket(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    total, price = F.col("total"), F.col("ticket_price")
    return rows.withColumns({"total": usable(total), "ticket_price": usable(price)}).select(
        *columns,
        _present("ticket_id").alias("tickets"),
        high_part(total).alias("total_high"),
        low_part(total).alias("total_low"),
        rest_part(total).alias("total_rest"),
        _present("total").alias("total_count"),
        high_part(price).alias("price_high"),
        low_part(price).alias("price_low"),
        rest_part(price).alias("price_rest"),
        _present("ticket_price").alias("price_count"),
    )


def _per_order(tickets: DataFrame, orders: DataFrame, columns: tuple[str, ...], **more: Column) -> DataFrame:
    """Sum the tickets of an order before the join, so no order is a hot join key; ``more`` names further aggregates."""
    price = usable(F.col("ticket_price"))
    sums = tickets.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ticket_id").alias("tickets"),
        F.sum(high_part(price)).alias("price_high"),
        F.sum(low_part(price)).alias("price_low"),
        F.sum(rest_part(price)).alias("price_rest"),
        F.count(price).alias("price_count"),
        *[c.alias(n) for n, c in more.items()],
    )
    total, rows = F.col("total"), F.col("rows")
    return sums.join(orders, "order_id").withColumn("total", usable(total)).select(
        *columns,
        "tickets",
        (high_part(total) * rows).alias("total_high"),
        (low_part(total) * rows).alias("total_low"),
        (rest_part(total) * rows.cast("decimal(12,0)")).alias("total_rest"),
        (_present("total") * rows).alias("total_count"),
        "price_high",
        "price_low",
        "price_rest",
        "price_count",
    )


def _present(column: str) -> Column:
    return F.col(column).isNotNull().cast("long")
