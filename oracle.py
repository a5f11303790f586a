"""Each query again as SQL over the plain tables, for an independent engine.

Written from the meaning of the query, not from the Spark plan. Amounts are summed
as decimals, and ratios are rounded half up in whole numbers, so both engines must
agree to the last digit.
"""

from __future__ import annotations



def _exact(amount: str) -> str:
    """A double as the decimal that its text says."""
    return f"CAST(CAST({amount} AS VARCHAR) AS DECIMAL(24,6))"


FACT = f"""
WITH fact AS (
  SELECT l_orderkey AS order_id, l_linenumber AS ticket_id, o_custkey AS customer_id,
         'Film #' || l_partkey AS film_name, CAST(o_orderdate AS DATE) AS sale_date,
         isodow(o_orderdate) >= 6 AS is_weekend, l_linestatus AS slot_type,
         l_returnflag = 'R' AS has_popcorn, CAST(l_suppkey % 10 AS INTEGER) AS room,
         o_orderpriority AS ticket_type,
         {_exact('l_extendedprice')} AS ticket_price, {_exact('o_totalprice')} AS total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), films AS (
  SELECT 'Film #' || p_partkey AS film_name, nullif(p_type, 'ECONOMY') AS rating,
         p_size AS duration, p_type || ', ' || replace(p_name, ' ', ', ') AS listed_in
  FROM part
), people AS (
  SELECT c_custkey AS customer_id, n_name AS district, r_name AS city,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Male'
              WHEN c_mktsegment = 'BUILDING' THEN 'Female' ELSE 'Other' END AS gender,
         CASE WHEN 69 - c_custkey % 65 < 20 THEN 'Dưới 20' WHEN 69 - c_custkey % 65 < 30 THEN '20-29'
              WHEN 69 - c_custkey % 65 < 40 THEN '30-39' WHEN 69 - c_custkey % 65 < 50 THEN '40-49'
              ELSE '50+' END AS age_group
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), shows AS (
  SELECT event_id AS ticket_id, CAST(hour(ts) AS INTEGER) AS show_hour, {_exact('value')} AS total,
         CASE WHEN hour(ts) < 12 THEN 'Sáng' WHEN hour(ts) < 17 THEN 'Chiều'
              WHEN hour(ts) < 20 THEN 'Tối sớm' ELSE 'Tối muộn' END AS show_session
  FROM events
)"""


def _half_up(part: str, whole: str, digits: int) -> str:
    """part / whole for whole numbers >= 0, rounded half up."""
    return f"CAST((2 * ({part}) * {10 ** digits} + ({whole})) // (2 * ({whole})) AS DOUBLE) / {10 ** digits}.0"


def _units(amount: str) -> str:
    """A decimal of six places in whole units of the last one."""
    return f"CAST(({amount}) * 1000000 AS HUGEINT)"


def _mean(total: str, count: str, digits: int = 0) -> str:
    return _half_up(_units(total), f"CAST({count} AS HUGEINT) * 1000000", digits)


def _money(total: str, digits: int = 0) -> str:
    return f"CAST(ROUND({total}, {digits}) AS DOUBLE)"


PCT_TICKETS = _half_up("CAST(so_ve AS HUGEINT) * 100", "CAST(SUM(so_ve) OVER () AS HUGEINT)", 2)
PCT_REVENUE = _half_up(_units("revenue") + " * 100", _units("SUM(revenue) OVER ()"), 2)
REVENUE = _money("SUM(total)")

DAILY = f"""{FACT}, daily AS (
  SELECT sale_date, COUNT(ticket_id) AS so_ve, {REVENUE} AS doanh_thu FROM fact GROUP BY sale_date
), trend AS (
  SELECT *, LAG(doanh_thu) OVER (ORDER BY sale_date) AS doanh_thu_ngay_truoc FROM daily
)"""

TOP_FILMS = f"""{FACT}, best AS (
  SELECT t.film_name, f.rating, f.duration, COUNT(t.ticket_id) AS so_ve, {_money('SUM(t.total)', 2)} AS doanh_thu,
         {_mean('SUM(t.total)', 'COUNT(t.ticket_id)', 2)} AS gia_tb
  FROM fact t LEFT JOIN films f ON t.film_name = f.film_name GROUP BY ALL
  ORDER BY doanh_thu DESC, film_name LIMIT 10
)"""

RATINGS = f"""{FACT}, mix AS (
  SELECT COALESCE(f.rating, 'Unknown') AS genre, COUNT(t.ticket_id) AS so_ve, {_money('SUM(t.total)')} AS doanh_thu
  FROM fact t LEFT JOIN films f ON t.film_name = f.film_name GROUP BY 1
)"""
SLICE = (
    "genre, so_ve, doanh_thu / 1e6 AS doanh_thu_trieu, "
    + _half_up("CAST(so_ve AS HUGEINT) * 100", "CAST(SUM(so_ve) OVER () AS HUGEINT)", 1)
    + " AS pct"
)


def _by_people(group: str, mean: str, total: str = "tong_chi_tieu") -> str:
    return f"""{FACT}
SELECT {group}, COUNT(DISTINCT t.customer_id) AS so_khach, COUNT(ticket_id) AS so_ve,
       {_money('SUM(total)')} AS {total}, {mean}
FROM fact t LEFT JOIN people p ON t.customer_id = p.customer_id GROUP BY {group}"""


PER_TICKET = _mean("SUM(total)", "COUNT(ticket_id)") + " AS chi_tieu_tb_moi_ve"

HOURS = f"""{FACT}, hours AS (
  SELECT show_session, show_hour, COUNT(ticket_id) AS so_ve, {REVENUE} AS doanh_thu FROM shows GROUP BY 1, 2
)"""


def _breakdown(key: str, label: str, mean: str) -> str:
    return f"""{FACT}, grouped AS (
  SELECT {key}, COUNT(ticket_id) AS so_ve, SUM(total) AS revenue, COUNT(total) AS filled FROM fact GROUP BY {key}
)
SELECT {label}, so_ve, {_money('revenue')} AS doanh_thu, {_mean('revenue', 'filled')} AS {mean},
       {PCT_TICKETS} AS pct_ve, {PCT_REVENUE} AS pct_revenue, {_mean('revenue', 'so_ve')} AS revenue_per_ticket
FROM grouped"""


# The tickets, customers and films that the cleaning steps must produce.
CLEAN = """
WITH tickets AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS ticket_id,
         CAST(o_custkey AS VARCHAR) AS customer_id, 'Film #' || l_partkey AS film_name,
         CAST(o_orderdate AS DATE) AS sale_date, isodow(o_orderdate) >= 6 AS is_weekend,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey % 24 AS INTEGER) END AS sale_hour,
         CASE WHEN l_linenumber = 2 THEN 'abc'
              WHEN l_linenumber <> 3 THEN lpad(CAST(CAST(l_quantity AS INTEGER) % 24 AS VARCHAR), 2, '0') || ':30' END AS time,
         CASE WHEN l_linenumber NOT IN (2, 3) THEN CAST(l_quantity AS INTEGER) % 24 END AS show_hour,
         l_returnflag AS slot,
         CASE WHEN l_linenumber <> 4 THEN CAST(l_suppkey % 10 AS INTEGER) END AS room,
         CASE WHEN l_linestatus = 'F' THEN 'ĐƠN' WHEN l_linenumber = 5 THEN 'đôi' ELSE 'ĐÔI' END AS slot_type,
         l_linestatus <> 'F' AS is_couple_seat, o_orderpriority AS ticket_type,
         l_extendedprice AS ticket_price, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total,
         l_returnflag = 'R' AS has_popcorn, 'NV' || l_suppkey AS cashier
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_quantity < 48 AND NOT (l_linenumber = 1 AND o_orderpriority = '5-LOW')
), sessions AS (
  SELECT *, CASE WHEN show_hour < 12 THEN 'Sáng' WHEN show_hour < 17 THEN 'Chiều'
                 WHEN show_hour < 20 THEN 'Tối sớm' ELSE 'Tối muộn' END AS show_session
  FROM tickets
), born AS (
  SELECT *, CASE WHEN c_nationkey NOT IN (3, 4, 5, 6)
                 THEN make_date(1950 + c_custkey % 65, 1 + c_custkey % 12, 1 + c_custkey % 28) END AS dob
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), clients AS (
  SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'WEBS' ELSE 'C' END || c_custkey AS customer_id, dob,
         CAST(2019 - year(dob) AS INTEGER) AS age_2019,
         CASE WHEN 2019 - year(dob) < 20 THEN 'Dưới 20' WHEN 2019 - year(dob) < 30 THEN '20-29'
              WHEN 2019 - year(dob) < 40 THEN '30-39' WHEN 2019 - year(dob) < 50 THEN '40-49' ELSE '50+' END AS age_group,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Male'
              WHEN c_mktsegment = 'BUILDING' THEN 'Female' ELSE 'Other' END AS gender,
         CASE WHEN c_nationkey <> 8 THEN n_name END AS district,
         CASE WHEN c_nationkey NOT IN (7, 8) THEN r_name END AS city,
         CASE WHEN c_nationkey = 9 THEN c_mktsegment ELSE least(c_mktsegment, 'A ' || c_mktsegment) END AS job,
         CASE WHEN c_nationkey % 2 = 0 THEN 'Online' ELSE 'Offline' END AS customer_type, c_mktsegment
  FROM born
), titles AS (
  SELECT 'Film #' || p_partkey AS film_name, 'Vietnam' AS country, p_brand AS director, p_type AS rating,
         CASE WHEN p_size % 5 <> 0 THEN p_size END AS duration
  FROM part WHERE p_size > 1
)"""

FACT_COLUMNS = [
    ("order_id", "string"), ("ticket_id", "string"), ("customer_id", "string"), ("film_name", "string"),
    ("sale_date", "date"), ("is_weekend", "boolean"), ("sale_hour", "int"), ("time", "string"),
    ("show_hour", "int"), ("show_session", "string"), ("slot", "string"), ("room", "int"),
    ("slot_type", "string"), ("is_couple_seat", "boolean"), ("ticket_type", "string"),
    ("ticket_price", "double"), ("total", "double"), ("has_popcorn", "boolean"), ("cashier", "string"),
]


def _dates(source: str, condition: str = "TRUE") -> str:
    return f"""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS sale_date, CAST(day(o_orderdate) AS INTEGER) AS day,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, dayname(o_orderdate) AS day_name,
       monthname(o_orderdate) AS month_name, CAST(week(o_orderdate) AS INTEGER) AS week_of_year,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter, isodow(o_orderdate) >= 6 AS is_weekend
FROM {source} WHERE {condition}"""


def _profile(source: str, name: str, missing: dict[str, str]) -> str:
    """Rows of a profile; ``missing`` gives the condition of a missing cell per column."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, COUNT(*) AS rows, "
        f"COUNT(*) FILTER ({condition}) AS null_or_empty, COUNT(*) FILTER ({condition}) > 0 AS flagged FROM {source}"
        for column, condition in missing.items()
    )


def _value_counts(source: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", {c} AS item, CAST(COUNT(*) AS VARCHAR) AS value FROM {source} GROUP BY {c}"
        for c in columns
    )


def _filled(column: str, kind: str) -> str:
    return f"{column} IS NOT NULL" + (f" AND {column} <> ''" if kind == "string" else "")


def _long(source: str, report: str, item: str, *measures: str) -> str:
    """The numbers of a report as rows."""
    return " UNION ALL ".join(
        f"SELECT '{report}' AS report, {item} AS item, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM {source}" for m in measures
    )


MONTHLY = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS sale_year, CAST(month(o_orderdate) AS INTEGER) AS sale_month,
       COUNT(*) AS so_don, CAST(SUM(CAST(CAST({total} AS VARCHAR) AS DECIMAL(24,6))) AS DOUBLE) AS doanh_thu
FROM orders WHERE {condition} GROUP BY 1, 2"""

COHORT = f"""{FACT}, visits AS (
  SELECT DISTINCT customer_id, year(sale_date) * 12 + month(sale_date) - 1 AS m FROM fact
  WHERE customer_id IS NOT NULL AND sale_date IS NOT NULL
), firsts AS (
  SELECT customer_id, m, MIN(m) OVER (PARTITION BY customer_id) AS f FROM visits
), counted AS (
  SELECT f, CAST(m - f AS INTEGER) AS thang_thu, COUNT(*) AS so_khach FROM firsts GROUP BY 1, 2
), sized AS (
  SELECT *, MAX(CASE WHEN thang_thu = 0 THEN so_khach END) OVER (PARTITION BY f) AS size FROM counted
)"""
COHORT_DATE = "make_date(f // 12, f % 12 + 1, 1) AS cohort"


def _calendar(*by: str) -> str:
    parts = {
        "day_of_week": "CAST(isodow(sale_date) AS INTEGER)", "day_name": "dayname(sale_date)",
        "year": "CAST(year(sale_date) AS INTEGER)", "quarter": "CAST(quarter(sale_date) AS INTEGER)",
    }
    keys = ", ".join(f"{parts[b]} AS {b}" for b in by)
    return f"""{FACT}, grouped AS (
  SELECT {keys}, COUNT(DISTINCT sale_date) AS so_ngay, COUNT(ticket_id) AS so_ve, {REVENUE} AS doanh_thu
  FROM fact GROUP BY ALL
) SELECT *, {PCT_TICKETS} AS pct_ve FROM grouped"""


def statements() -> dict[str, str]:
    raw_ticket_missing = {
        "orderid": "FALSE", "cashier": "FALSE", "saledate": "FALSE", "total": "o_orderstatus = 'P'",
        "customerid": "l_linenumber = 1 AND o_orderpriority = '5-LOW'", "ticketcode": "FALSE", "date": "FALSE",
        "time": "l_linenumber = 3", "slot": "FALSE", "room": "FALSE", "film": "FALSE", "slot_type": "FALSE",
        "ticket_type": "FALSE", "ticket_price": "FALSE", "popcorn": "l_returnflag NOT IN ('R', 'A')",
    }
    raw_customer_missing = {
        "customerid": "copy = 1 AND c_nationkey = 9", "dob": "c_nationkey IN (5, 6)",
        "gender": "c_mktsegment NOT IN ('MACHINERY', 'FURNITURE', 'BUILDING', 'AUTOMOBILE')",
        "address": "c_nationkey = 8", "job": "FALSE",
    }
    joined = "lineitem JOIN orders ON l_orderkey = o_orderkey"
    twice = "(SELECT * FROM customer, (VALUES (0), (1)) AS copies(copy))"
    whole = f"(SELECT * FROM {twice} WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_name = 'CANADA'))"
    return {
        "summary": f"""{FACT}
SELECT COUNT(DISTINCT order_id) AS tong_don_hang, COUNT(ticket_id) AS tong_ve_ban,
       COUNT(DISTINCT customer_id) AS tong_khach_hang, COUNT(DISTINCT film_name) AS tong_phim,
       {REVENUE} AS tong_doanh_thu_vnd, {_mean('SUM(ticket_price)', 'COUNT(ticket_price)')} AS gia_ve_tb_vnd,
       MIN(sale_date) AS ngay_dau, MAX(sale_date) AS ngay_cuoi FROM fact""",
        "revenue_daily_v1": f"""{FACT}
SELECT sale_date, COUNT(ticket_id) AS so_ve, COUNT(DISTINCT order_id) AS so_don, {REVENUE} AS doanh_thu
FROM fact GROUP BY sale_date""",
        "revenue_daily": f"{DAILY} SELECT *, ROUND(doanh_thu - doanh_thu_ngay_truoc, 0) AS tang_giam FROM trend",
        "revenue_ma7": f"""{DAILY}
SELECT CAST(sale_date AS VARCHAR) AS ngay, doanh_thu / 1e6 AS doanh_thu_trieu, so_ve,
       CASE WHEN COUNT(doanh_thu) OVER w = 7 THEN AVG(doanh_thu) OVER w / 1e6 END AS doanh_thu_ma7
FROM daily WINDOW w AS (ORDER BY sale_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "weekend_v1": f"""{FACT}
SELECT CASE WHEN is_weekend THEN 'Cuối tuần' ELSE 'Ngày thường' END AS loai_ngay, COUNT(ticket_id) AS tong_ve,
       COUNT(DISTINCT order_id) AS tong_don, {REVENUE} AS tong_doanh_thu,
       {_mean('SUM(ticket_price)', 'COUNT(ticket_price)')} AS gia_ve_tb,
       {_mean('SUM(total)', 'COUNT(DISTINCT sale_date)')} AS dt_tb_moi_ngay
FROM fact GROUP BY is_weekend""",
        "weekend_share": f"""{FACT}, base AS (
  SELECT is_weekend, COUNT(ticket_id) AS tong_ve, ROUND(SUM(total), 0) AS revenue FROM fact GROUP BY is_weekend
)
SELECT CASE WHEN is_weekend THEN 'Cuối tuần' ELSE 'Ngày thường' END AS loai_ngay, tong_ve,
       CAST(revenue AS DOUBLE) AS tong_doanh_thu,
       {_half_up('CAST(revenue AS HUGEINT)', 'CAST(SUM(revenue) OVER () AS HUGEINT)', 2)} AS ty_le_doanh_thu
FROM base""",
        "top_films_v1": f"""{FACT}
SELECT t.film_name, f.rating, f.duration, COUNT(t.ticket_id) AS so_ve, {_money('SUM(t.total)')} AS doanh_thu,
       {_mean('SUM(t.ticket_price)', 'COUNT(t.ticket_price)')} AS gia_tb
FROM fact t LEFT JOIN films f ON t.film_name = f.film_name GROUP BY ALL
ORDER BY doanh_thu DESC, film_name LIMIT 10""",
        "top_films": f"{TOP_FILMS} SELECT * FROM best",
        "top10_feed": f"{TOP_FILMS} SELECT film_name, doanh_thu / 1e6 AS doanh_thu_trieu FROM best",
        "top5_feed": f"""{TOP_FILMS}
SELECT substring(film_name, 1, 20) AS film_short, doanh_thu / 1e6 AS doanh_thu_trieu
FROM best ORDER BY doanh_thu DESC, film_name LIMIT 5""",
        "rating_mix": f"{RATINGS} SELECT *, {PCT_TICKETS} AS pct_ve FROM mix",
        "rating_mix_known": f"{RATINGS} SELECT {SLICE} FROM mix WHERE genre <> 'Unknown'",
        "rating_mix_all": f"{RATINGS} SELECT {SLICE} FROM mix",
        "customer_gender": _by_people("gender", PER_TICKET),
        "customer_age": _by_people("age_group, gender", PER_TICKET),
        "age_gender_pivot": f"""{FACT}
SELECT a.age_group, COUNT(ticket_id) FILTER (gender = 'Female') AS "Female",
       COUNT(ticket_id) FILTER (gender = 'Male') AS "Male", COUNT(ticket_id) FILTER (gender = 'Other') AS "Other"
FROM (VALUES ('Dưới 20'), ('20-29'), ('30-39'), ('40-49'), ('50+')) AS a(age_group)
LEFT JOIN (fact t JOIN people p ON t.customer_id = p.customer_id) ON a.age_group = p.age_group GROUP BY 1""",
        "top_districts": _by_people(
            "district, city",
            _mean("SUM(total)", "COUNT(DISTINCT t.customer_id)") + " AS chi_tieu_tb_khach",
            "doanh_thu",
        ) + " ORDER BY doanh_thu DESC, district, city LIMIT 15",
        "sessions_by_hour": f"{HOURS} SELECT *, {PCT_TICKETS} AS pct_ve FROM hours",
        "session_rollup": f"""{HOURS}
SELECT s.show_session, CAST(SUM(so_ve) AS BIGINT) AS so_ve
FROM (VALUES ('Sáng'), ('Chiều'), ('Tối sớm'), ('Tối muộn')) AS s(show_session)
LEFT JOIN hours h ON h.show_session = s.show_session GROUP BY 1""",
        "session_feed": f"{HOURS} SELECT show_hour || 'h' AS gio, show_session, so_ve FROM hours",
        "room_seat_v1": f"""{FACT}
SELECT room, slot_type, COUNT(ticket_id) AS so_ve, {REVENUE} AS doanh_thu,
       {_mean('SUM(total)', 'COUNT(total)')} AS gia_tb FROM fact GROUP BY room, slot_type""",
        "room_seat": f"""{FACT}, grouped AS (
  SELECT room, slot_type, COUNT(ticket_id) AS so_ve, SUM(total) AS revenue, COUNT(total) AS filled FROM fact GROUP BY 1, 2
)
SELECT room, slot_type, so_ve, {_money('revenue')} AS doanh_thu, {_mean('revenue', 'filled')} AS gia_tb,
       {PCT_REVENUE} AS pct_revenue, {_mean('revenue', 'so_ve')} AS revenue_per_ticket FROM grouped""",
        "seat_type": _breakdown("slot_type", "slot_type", "gia_tb"),
        "by_ticket_type": _breakdown("ticket_type", "ticket_type", "gia_tb"),
        "popcorn": _breakdown(
            "has_popcorn",
            "CASE WHEN has_popcorn THEN 'Có bắp rang' ELSE 'Không bắp rang' END AS trang_thai",
            "gia_ve_tb",
        ),
        "fact_ticket": f"{CLEAN} SELECT * FROM sessions",
        "dim_customer": f"{CLEAN} SELECT * EXCLUDE (c_mktsegment) FROM clients",
        "dim_film": f"{CLEAN} SELECT * FROM titles",
        "dim_date": _dates("lineitem JOIN orders ON l_orderkey = o_orderkey", "l_quantity <> 50"),
        "session_labels": f"""{CLEAN}
SELECT CASE WHEN show_hour IS NULL THEN 'Unknown' ELSE show_session END AS show_session, COUNT(*) AS count
FROM sessions GROUP BY 1""",
        "gender_mapped": f"""{CLEAN}
SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Male' ELSE gender END AS gender, COUNT(*) AS count
FROM clients GROUP BY 1""",
        "address_split": """
SELECT CASE WHEN c_nationkey <> 8 THEN n_name END AS district,
       CASE WHEN c_nationkey NOT IN (7, 8) THEN r_name END AS city, 2 * COUNT(*) AS rows,
       MIN(CASE WHEN c_nationkey <> 8 THEN 'Street ' || c_custkey END) AS first_street
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
        "number_from_text": """
SELECT CAST(nullif(regexp_extract(props, '[0-9]+'), '') AS INTEGER) AS number, COUNT(*) AS rows
FROM events GROUP BY 1""",
        "prefix_channel": f"""
SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'Online' ELSE 'Offline' END AS customer_type, COUNT(*) AS rows
FROM {twice} GROUP BY 1""",
        "null_profile": _profile("documents", "documents", {
            "doc_id": "doc_id IS NULL", "text": "coalesce(text, '') = ''", "lang": "coalesce(lang, '') = ''",
            "source": "coalesce(source, '') = ''", "n_chars": "n_chars IS NULL"}),
        "null_profile_labels": _profile("labels", "labels", {
            c: f"{c} IS NULL" for c in ("doc_id", "quality", "toxic")}),
        "null_profile_tickets": _profile(joined, "ticket", raw_ticket_missing),
        "row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS rows, {n} AS columns FROM {t}"
            for t, n in (("lineitem", 11), ("orders", 6), ("customer", 5), ("part", 6))),
        "freq_slot_type": "SELECT l_linestatus AS slot_type, COUNT(*) AS count FROM lineitem GROUP BY 1",
        "freq_age_group": f"{FACT} SELECT age_group, COUNT(*) AS count FROM people GROUP BY 1",
        "distinct_counts": """
SELECT 'l_partkey' AS column_name, COUNT(DISTINCT l_partkey) AS distinct_values FROM lineitem
UNION ALL SELECT 'l_orderkey', COUNT(DISTINCT l_orderkey) FROM lineitem""",
        "date_range": """
SELECT CAST(MIN(o_orderdate) AS DATE) AS min_sale_date, CAST(MAX(o_orderdate) AS DATE) AS max_sale_date FROM orders""",
        "invalid_counters": """
SELECT COUNT(*) FILTER (c_acctbal <= 0) AS invalid_balance, COUNT(*) FILTER (c_nationkey <= 0) AS invalid_nation
FROM customer""",
        "fact_checks": f"""{CLEAN}
SELECT 'date_range' AS "check", 'min' AS item, CAST(MIN(sale_date) AS VARCHAR) AS value FROM sessions
UNION ALL SELECT 'date_range', 'max', CAST(MAX(sale_date) AS VARCHAR) FROM sessions
UNION ALL SELECT 'distinct', 'film_name', CAST(COUNT(DISTINCT film_name) AS VARCHAR) FROM sessions
UNION ALL SELECT 'distinct', 'customer_id', CAST(COUNT(DISTINCT customer_id) AS VARCHAR) FROM sessions
UNION ALL SELECT 'not_positive', 'ticket_price', CAST(COUNT(*) FILTER (ticket_price <= 0) AS VARCHAR) FROM sessions
UNION ALL SELECT 'not_positive', 'total', CAST(COUNT(*) FILTER (total <= 0) AS VARCHAR) FROM sessions
UNION ALL {_value_counts('sessions', 'slot_type', 'show_session')}
UNION ALL SELECT 'account', item, CAST(CASE item
    WHEN 'rows_in' THEN COUNT(*) WHEN 'rows_out' THEN COUNT(*) FILTER (known AND l_quantity < 48)
    WHEN 'no_customer' THEN COUNT(*) FILTER (NOT known) WHEN 'no_date' THEN COUNT(*) FILTER (known AND l_quantity = 50)
    WHEN 'price_not_positive' THEN COUNT(*) FILTER (known AND l_quantity = 49)
    WHEN 'no_price' THEN COUNT(*) FILTER (known AND l_quantity = 48) ELSE 0 END AS VARCHAR)
FROM (SELECT *, NOT (l_linenumber = 1 AND o_orderpriority = '5-LOW') AS known FROM {joined}) AS raw,
     (VALUES ('rows_in'), ('rows_out'), ('no_order'), ('no_customer'), ('no_film'), ('no_date'), ('no_price'),
             ('price_not_positive'), ('total_unreadable')) AS items(item)
GROUP BY item""",
        "customer_checks": f"{CLEAN} {_value_counts('clients', 'gender', 'age_group', 'customer_type')}",
        "preview": "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
        "csv_tickets": f"""{CLEAN}
SELECT show_session, is_couple_seat, has_popcorn, COUNT(*) AS so_ve, COUNT(total) AS so_tong,
       COUNT(sale_hour) AS so_gio, CAST(SUM({_exact('ticket_price')}) AS DOUBLE) AS gia, COUNT(*) AS quoted
FROM sessions GROUP BY 1, 2, 3""",
        "csv_customers": _profile(whole, "customer", raw_customer_missing) + f"""
UNION ALL SELECT 'customer', '(damaged lines)', COUNT(*) + 2 * COUNT(*) FILTER (broken), 3 * COUNT(*) FILTER (broken), COUNT(*) FILTER (broken) > 0
FROM (SELECT c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name = 'CANADA') AS broken FROM {twice})""",
        "csv_films": f"{CLEAN} SELECT * FROM titles",
        "csv_documents": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(length(text) AS INTEGER) AS chars, md5(text) AS digest FROM documents""",
        "snapshot_read": MONTHLY.format(total="o_totalprice", condition="TRUE"),
        "snapshot_history": """
SELECT CAST(0 AS BIGINT) AS version, 'overwrite' AS operation, COUNT(*) AS rows FROM orders
UNION ALL SELECT CAST(v AS BIGINT), op, COUNT(DISTINCT (year(o_orderdate), month(o_orderdate)))
FROM orders, (VALUES (1, 'overwrite'), (2, 'compact')) AS later(v, op) GROUP BY v, op""",
        "compacted_read": MONTHLY.format(total="o_totalprice", condition="TRUE"),
        "pruned_month": MONTHLY.format(
            total="o_totalprice", condition="o_orderdate >= DATE '1997-11-15' AND o_orderdate < DATE '1998-02-11'"),
        "partition_replaced": MONTHLY.format(
            total="o_totalprice * (CASE WHEN year(o_orderdate) = 1998 THEN 2 ELSE 1 END)", condition="TRUE"),
        "catalog_tables": """
SELECT 'fact_order' AS table_name, TRUE AS present, TRUE AS listed, COUNT(*) AS rows, 6 AS columns FROM orders
UNION ALL SELECT 'dim_date', TRUE, TRUE, COUNT(DISTINCT CAST(o_orderdate AS DATE)), 10 FROM orders
UNION ALL SELECT 'dim_film', FALSE, NULL, NULL, NULL""",
        "file_listing": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS name, TRUE AS has_bytes, TRUE AS dated, COUNT(*) AS rows FROM {t}"
            for t in ("region nation customer supplier part orders lineitem events documents embeddings "
                      "pages benchmark labels conversations").split()),
        "schema_report": f"{CLEAN} " + " UNION ALL ".join(
            f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS type, "
            f"{name not in ('slot_type', 'is_couple_seat', 'has_popcorn', 'show_session')} AS nullable, "
            f"COUNT(*) FILTER ({_filled(name, kind)}) AS filled, COUNT(*) FILTER (NOT ({_filled(name, kind)})) AS empty FROM sessions"
            for i, (name, kind) in enumerate(FACT_COLUMNS)),
        "kpi_export": f"{TOP_FILMS}, daily AS (" + f"{DAILY} SELECT *, ROUND(doanh_thu - doanh_thu_ngay_truoc, 0) AS tang_giam FROM trend), ages AS ("
        + _by_people("age_group, gender", PER_TICKET) + ") "
        + " UNION ALL ".join([
            _long("daily", "analytics_revenue_daily", "CAST(sale_date AS VARCHAR)", "so_ve", "doanh_thu", "doanh_thu_ngay_truoc", "tang_giam"),
            _long("best", "analytics_top_films", "film_name", "duration", "so_ve", "doanh_thu", "gia_tb"),
            _long("ages", "analytics_customer_age", "coalesce(age_group, '') || '|' || coalesce(gender, '')", "so_khach", "so_ve", "tong_chi_tieu", "chi_tieu_tb_moi_ve"),
        ]),
        "star_store": f"""{CLEAN}, sold AS (
  SELECT t.*, c.c_mktsegment AS segment, coalesce(c.c_custkey % 10 <> 0, FALSE) AS known
  FROM sessions t LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = t.customer_id
)
SELECT COALESCE(f.rating, 'Unknown') AS genre,
       CASE WHEN NOT known THEN NULL WHEN segment IN ('MACHINERY', 'FURNITURE') THEN 'Male' WHEN segment = 'BUILDING' THEN 'Female' ELSE 'Other' END AS gender,
       COUNT(t.ticket_id) AS so_ve, {_money(f"SUM({_exact('t.total')})")} AS doanh_thu
FROM sold t LEFT JOIN titles f ON t.film_name = f.film_name GROUP BY 1, 2""",
        "genre_films": f"""{FACT}
SELECT genre, COUNT(*) AS so_phim
FROM (SELECT DISTINCT film_name, trim(unnest(string_split(listed_in, ','))) AS genre FROM films) GROUP BY genre""",
        "genre_explode": f"""{FACT}, genres AS (
  SELECT DISTINCT film_name, trim(unnest(string_split(listed_in, ','))) AS genre FROM films
)
SELECT coalesce(genre, 'Unknown') AS genre, COUNT(DISTINCT t.film_name) AS so_phim, COUNT(ticket_id) AS so_ve, {REVENUE} AS doanh_thu
FROM fact t LEFT JOIN genres g ON t.film_name = g.film_name GROUP BY 1""",
        "star_by_weekday": _calendar("day_of_week", "day_name"),
        "star_by_quarter": _calendar("year", "quarter"),
        "cohort_retention": f"""{COHORT}
SELECT {COHORT_DATE}, thang_thu, so_khach,
       {_half_up('CAST(so_khach AS HUGEINT) * 100', 'CAST(size AS HUGEINT)', 2)} AS pct_giu_lai FROM sized""",
        "cohort_matrix": f"""{COHORT}
SELECT {COHORT_DATE}, """ + ", ".join(
            f"CAST(coalesce(SUM(so_khach) FILTER (thang_thu = {m}), 0) AS BIGINT) AS m{m}" for m in range(13)
        ) + ", CAST(coalesce(SUM(so_khach) FILTER (thang_thu > 12), 0) AS BIGINT) AS later FROM counted GROUP BY f",
        "rfm": f"""{FACT}, per_order AS (
  SELECT customer_id, order_id, MAX(sale_date) AS sale_date, MIN(total) AS total FROM fact GROUP BY 1, 2
), spend AS (
  SELECT customer_id, MAX(sale_date) AS last_date, COUNT(order_id) AS so_don, SUM(total) AS spend
  FROM per_order WHERE customer_id IS NOT NULL GROUP BY customer_id
), scored AS (
  SELECT *, md5(CAST(customer_id AS VARCHAR)) AS d FROM spend
)
SELECT customer_id, last_date, so_don, CAST(spend AS DOUBLE) AS chi_tieu,
       CAST(ntile(5) OVER r AS INTEGER) AS r, CAST(ntile(5) OVER f AS INTEGER) AS f, CAST(ntile(5) OVER m AS INTEGER) AS m,
       CAST(ntile(5) OVER r AS VARCHAR) || CAST(ntile(5) OVER f AS VARCHAR) || CAST(ntile(5) OVER m AS VARCHAR) AS rfm
FROM scored WINDOW r AS (ORDER BY last_date, d, customer_id), f AS (ORDER BY so_don, d, customer_id),
                   m AS (ORDER BY spend, d, customer_id)""",
        "revenue_dedup": f"""{FACT}, per_order AS (
  SELECT order_id, COUNT(ticket_id) AS n, SUM(total) AS s, MIN(total) AS one FROM fact GROUP BY order_id
)
SELECT COUNT(order_id) AS so_don, CAST(SUM(n) AS BIGINT) AS so_ve, {_money('SUM(s)')} AS doanh_thu,
       {_money('SUM(one)')} AS doanh_thu_don FROM per_order""",
        "popcorn_corr": f"""{FACT}
SELECT COUNT(*) AS so_ve, ROUND(corr(CAST(has_popcorn AS INTEGER), CAST(total AS DOUBLE)), 6) AS tuong_quan FROM fact""",
    }
