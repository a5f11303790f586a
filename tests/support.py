"""Helpers shared by the tests."""

from __future__ import annotations

import datetime
import random

import duckdb

from marquee.operators.tally import SplitSales

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    """Rows with sorted columns and text values, in any order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


TICKET_SCHEMA = "order_id bigint, ticket_id int, film_name string, slot_type string, room int, has_popcorn boolean, ticket_price double"
ORDER_SCHEMA = "order_id bigint, customer_id bigint, sale_date date, is_weekend boolean, ticket_type string, total double"


def make_sales(seed=7, orders=60, tickets=400, hot=0.4):
    """Tickets and orders as plain rows; one order, film and customer hold a large part."""
    pick = random.Random(seed)
    start = datetime.date(2019, 5, 1)
    order_rows = []
    for key in range(orders):
        day = start + datetime.timedelta(days=pick.randrange(40))
        customer = 1 if pick.random() < hot else pick.randrange(15)
        total = None if pick.random() < 0.1 else round(pick.uniform(-20, 500), 2)
        order_rows.append((key, customer, day, day.isoweekday() >= 6, pick.choice(["A", "B"]), total))
    ticket_rows = []
    for number in range(tickets):
        order = 3 if pick.random() < hot else pick.randrange(orders)
        film = "hot" if pick.random() < hot else f" film {pick.randrange(12)}"
        price = None if pick.random() < 0.05 else round(pick.uniform(1, 90), 2)
        ticket = None if pick.random() < 0.05 else number
        ticket_rows.append((order, ticket, film, pick.choice(["ĐÔI", "ĐƠN"]), pick.randrange(3), pick.random() < 0.3, price))
    return ticket_rows, order_rows


def split_sales(spark, ticket_rows, order_rows):
    return SplitSales(
        spark.createDataFrame(ticket_rows, TICKET_SCHEMA), spark.createDataFrame(order_rows, ORDER_SCHEMA)
    )


def joined_sales(spark, ticket_rows, order_rows):
    split = split_sales(spark, ticket_rows, order_rows)
    return split.tickets.join(split.orders, "order_id")
