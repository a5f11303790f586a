"""Measures and KPIs on skewed, gappy sales against plain Python."""

import collections
from decimal import ROUND_HALF_UP, Decimal

import pytest

from marquee.operators.tally import SplitSales, price, revenue, tally
from marquee.plans import extended, kpi
from support import as_dicts, joined_sales, make_sales, rows_of, split_sales

TICKETS, ORDERS = make_sales()
ORDER = {r[0]: r for r in ORDERS}
# order_id, ticket_id, film, slot, room, popcorn, price, customer, day, weekend, type, total
FLAT = [t + ORDER[t[0]][1:] for t in TICKETS]
SHAPES = ["joined", "broadcast", "shuffled"]


@pytest.fixture(params=SHAPES)
def sales(request, spark, conf):
    if request.param == "shuffled":
        conf(spark__sql__autoBroadcastJoinThreshold="-1")
    make = joined_sales if request.param == "joined" else split_sales
    return make(spark, TICKETS, ORDERS)


def money(values):
    kept = [Decimal(str(v)) for v in values if v is not None]
    return sum(kept) if kept else None


def half_up(value, digits=0):
    return None if value is None else float(value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def mean(values, count, digits=0):
    total = money(values)
    return None if total is None or not count else half_up(total / count, digits)


def groups(key):
    found = collections.defaultdict(list)
    for row in FLAT:
        found[key(row)].append(row)
    return found


@pytest.mark.parametrize("by, key", [
    (["sale_date"], lambda r: (r[8],)),
    (["customer_id"], lambda r: (r[7],)),
    (["film_name", "slot_type"], lambda r: (r[2], r[3])),
    (["order_id", "room"], lambda r: (r[0], r[4])),
    ([], lambda r: ()),
])
def test_tally(sales, by, key):
    got = tally(sales, *by).select(*by, "tickets", revenue().alias("total"), "total_count", "price_count")
    expected = {
        k: (sum(r[1] is not None for r in rows), money(r[11] for r in rows),
            sum(r[11] is not None for r in rows), sum(r[6] is not None for r in rows))
        for k, rows in groups(key).items()
    }
    assert {r[: len(by)]: r[len(by):] for r in rows_of(got)} == expected


def test_summary(sales):
    row = as_dicts(kpi.summary(sales))[0]
    assert row == {
        "tong_don_hang": len({r[0] for r in FLAT}), "tong_ve_ban": sum(r[1] is not None for r in FLAT),
        "tong_khach_hang": len({r[7] for r in FLAT}), "tong_phim": len({r[2] for r in FLAT}),
        "tong_doanh_thu_vnd": half_up(money(r[11] for r in FLAT)),
        "gia_ve_tb_vnd": mean([r[6] for r in FLAT], sum(r[6] is not None for r in FLAT)),
        "ngay_dau": min(r[8] for r in FLAT), "ngay_cuoi": max(r[8] for r in FLAT),
    }


def test_summary_shuffles_tickets_once(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    ticket_rows, order_rows = make_sales()
    split = split_sales(spark, ticket_rows, order_rows)
    for name in ("tickets", "orders"):
        getattr(split, name).write.parquet(f"{tmp_path}/{name}")
    stored = SplitSales(*(spark.read.parquet(f"{tmp_path}/{n}") for n in ("tickets", "orders")))
    result = kpi.summary(stored)
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # tickets by order, orders by order, then the merged keys and one row
    assert plan.count("SortMergeJoin") == 1 and plan.count("hashpartitioning(order_id") == 2 and plan.count("Exchange") == 4
    assert rows_of(result) == rows_of(kpi.summary(joined_sales(spark, ticket_rows, order_rows)))


def test_no_sales_summed_up(spark):
    empty = SplitSales(*(df.limit(0) for df in (split_sales(spark, *make_sales()).tickets, split_sales(spark, *make_sales()).orders)))
    assert rows_of(kpi.summary(empty)) == [(0, 0, 0, 0, None, None, None, None)]


def test_amounts_that_are_none_do_not_stop_a_report(spark):
    ticket_rows, order_rows = make_sales(orders=8, tickets=40)
    odd = [(*r[:5], v) for r, v in zip(order_rows, (float("nan"), float("inf"), 1e300, 0.004, 1.125, None, 2e15, -0.5))]
    sold = [(*r[:6], float("nan") if n % 5 == 0 else 0.0015) for n, r in enumerate(ticket_rows)]
    totals = {r[0]: Decimal(repr(r[5])) for r in odd if r[5] is not None and abs(r[5]) < 2**53}
    wanted = sum(totals.get(r[0], 0) for r in sold)
    for sales in (split_sales(spark, sold, odd), joined_sales(spark, sold, odd)):
        row = tally(sales).select(revenue().alias("total"), price().alias("price"), "total_count", "price_count").first()
        assert (row["total"], row["price"]) == (wanted, Decimal("0.0015") * 32)
        assert (row["total_count"], row["price_count"]) == (sum(r[0] in totals for r in sold), 32)
    assert rows_of(kpi.summary(split_sales(spark, sold, odd))) == rows_of(kpi.summary(joined_sales(spark, sold, odd)))


def test_weekend_compare(sales):
    got = {r["loai_ngay"]: r for r in as_dicts(kpi.weekend_compare(sales))}
    for weekend, rows in groups(lambda r: r[9]).items():
        row = got["Cuối tuần" if weekend else "Ngày thường"]
        assert row["tong_don"] == len({r[0] for r in rows})
        assert row["dt_tb_moi_ngay"] == mean([r[11] for r in rows], len({r[8] for r in rows}))


def test_revenue_change_adds_up(sales):
    rows = as_dicts(kpi.revenue_daily(sales))
    assert [r["sale_date"] for r in rows] == sorted(r["sale_date"] for r in rows)
    assert rows[0]["tang_giam"] is None
    known = [r for r in rows if r["doanh_thu"] is not None]
    if len(known) == len(rows):
        assert sum(r["tang_giam"] for r in rows[1:]) == rows[-1]["doanh_thu"] - rows[0]["doanh_thu"]


def test_films_keep_unmatched_and_join_trimmed(spark, sales):
    films = spark.createDataFrame(
        [("hot ", "R", 90), ("film 1", "PG", 80), ("film 2", None, 70)], "film_name string, rating string, duration int"
    )
    rating = {"hot": "R", " film 1": "PG"}
    mix = {r["genre"]: r["so_ve"] for r in as_dicts(kpi.rating_mix(sales, films))}
    expected = {k: sum(r[1] is not None for r in rows) for k, rows in groups(lambda r: rating.get(r[2], "Unknown")).items()}
    assert mix == expected
    best = rows_of(kpi.top_films(sales, films, k=3))
    by_film = sorted(
        ((half_up(money(r[11] for r in rows), 2), film) for film, rows in groups(lambda r: r[2]).items()),
        key=lambda p: (-p[0], p[1]),
    )
    assert [(r[4], r[0]) for r in best] == by_film[:3]


def test_film_listed_twice_counts_twice(spark, sales):
    films = spark.createDataFrame([("hot", "R", 90), ("hot", "R", 90)], "film_name string, rating string, duration int")
    mix = {r["genre"]: r["so_ve"] for r in as_dicts(kpi.rating_mix(sales, films))}
    assert mix["R"] == 2 * sum(r[1] is not None for r in FLAT if r[2] == "hot")


def test_customers(spark, sales):
    people = [(c, "Male" if c % 2 else "Female", "20-29" if c < 5 else "50+", f"d{c % 4}", "x") for c in range(12)]
    customers = spark.createDataFrame(
        people, "customer_id bigint, gender string, age_group string, district string, city string"
    )
    gender = {c: g for c, g, *_ in people}
    got = {r["gender"]: r for r in as_dicts(kpi.customer_gender(sales, customers))}
    for label, rows in groups(lambda r: gender.get(r[7])).items():
        tickets = sum(r[1] is not None for r in rows)
        assert got[label]["so_khach"] == len({r[7] for r in rows})
        assert got[label]["so_ve"] == tickets
        assert got[label]["chi_tieu_tb_moi_ve"] == mean([r[11] for r in rows], tickets)
    pivot = rows_of(kpi.age_gender_pivot(sales, customers))
    assert [r[0] for r in pivot] == ["Dưới 20", "20-29", "30-39", "40-49", "50+"]
    assert pivot[0][1:] == (0, 0, 0) and pivot[2][1:] == (0, 0, 0)
    known = [r for r in FLAT if r[7] < 12 and r[1] is not None]
    assert sum(sum(r[1:]) for r in pivot) == len(known)
    districts = rows_of(kpi.top_districts(sales, customers, k=2))
    assert len(districts) == 2


def test_shares_sum_to_hundred(sales):
    for report in (kpi.room_seat, kpi.seat_type, kpi.popcorn, kpi.ticket_type):
        rows = as_dicts(report(sales))
        assert abs(sum(r["pct_revenue"] for r in rows) - 100) <= 0.01 * len(rows)
        assert sum(r["so_ve"] for r in rows) == sum(r[1] is not None for r in FLAT)


def test_revenue_per_order(sales):
    once = {r[0]: r[11] for r in FLAT}
    row = as_dicts(extended.revenue_per_order(sales))[0]
    assert row["so_don"] == len(once)
    assert row["doanh_thu_don"] == half_up(money(once.values()))
    assert row["doanh_thu"] == half_up(money(r[11] for r in FLAT))


def test_popcorn_correlation(sales):
    pairs = [(float(r[5]), r[11]) for r in FLAT if r[11] is not None]
    n = len(pairs)
    mx, my = sum(x for x, _ in pairs) / n, sum(y for _, y in pairs) / n
    cov = sum((x - mx) * (y - my) for x, y in pairs)
    spread = (sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs)) ** 0.5
    row = as_dicts(extended.popcorn_correlation(sales))[0]
    assert row["so_ve"] == n
    assert row["tuong_quan"] == pytest.approx(cov / spread, abs=1e-6)


def test_cohorts(sales):
    months = collections.defaultdict(set)
    for r in FLAT:
        months[r[7]].add(r[8].year * 12 + r[8].month - 1)
    counts = collections.Counter((min(m), x - min(m)) for m in months.values() for x in m)
    got = extended.cohort_retention(sales)
    rows = {(r["cohort"].year * 12 + r["cohort"].month - 1, r["thang_thu"]): r["so_khach"] for r in as_dicts(got)}
    assert rows == counts
    wide = as_dicts(extended.cohort_matrix(got, months=[0, 1]))
    assert sum(r["m0"] + r["m1"] + r["later"] for r in wide) == sum(counts.values())
    short = as_dicts(extended.cohort_matrix(got, months=[0]))
    assert sum(r["m0"] + r["later"] for r in short) == sum(counts.values())


def test_hot_order_is_split_in_the_join(spark, conf, tmp_path):
    """An order with most of the tickets must not stay in one join task."""
    tickets = [(3 if i % 4 else i % 50, i, f"f{i % 900}", "A", 1, True, 1.0) for i in range(60_000)]
    orders = [(k, k, ORDERS[0][2], False, "A", 2.0) for k in range(50)]
    made = split_sales(spark, tickets, orders)
    made.tickets.repartition(16).write.parquet(f"{tmp_path}/t")
    stored = type(made)(spark.read.parquet(f"{tmp_path}/t"), made.orders)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    )
    df = tally(stored, "film_name")
    assert sum(r["tickets"] for r in df.collect()) == 60_000
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
