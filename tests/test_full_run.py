"""Hand-written raw files through the whole run."""

import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators import quality
from marquee.plans import full_run, kpi, star
from support import as_dicts, rows_of

FILMS = """show_id;film name;director;cast;country;release_year;rating;duration;listed_in;Description
s1;HỒI KẾT;"Anthony, Joe";x;United States;2019;PG-13;181 minutes;"Action, Drama";"One; two
three"
s2; VỢ BA ;Ash;y; Vietnam ;2018; R ;96 minutes;Drama;plain
s3;MÙA THU;Dũng;z;Vietnam;2019;PG-13;Not Available;"Romance, Drama";plain
s4;;nobody;z;Vietnam;2019;G;10 minutes;Drama;no title
s5;MÙA THU;Dũng;z;Vietnam;2019;PG-13;Not Available;"Romance, Drama";a second row
"""
CUSTOMERS = """customerid;DOB;gender;address;job
WEBS001;15/03/2000;m;1 Le Loi / Quận 1 / HCM;Student
C002;31/12/1999;FEMALE;2 Hai Ba/Quận 3;Nurse
C003;1/5/2000;Nam;;Cook
C004;31/02/1999;;a/b/c/d;
C005;;F;x/ y /z;Cook
C006;01/01/1989;M;x/y/z;Clerk
C006;01/01/1989;M;x/y/z;Baker
C007;01/01/1969;M;x/y/z;Clerk
;01/01/1990;M;x/y/z;Ghost
"""
TICKETS = """orderid;cashier;saledate;total;customerid;ticketcode;date;time;slot;room;film;slot type;ticket type;ticket price;popcorn
o1; A ;2019-05-03 18:45:10;90000;WEBS001;t1;2019-05-03;11:59;s1;1; HỒI KẾT ;ĐƠN; Thường ;45000;Có
o1; A ;2019-05-03 18:45:10;90000;WEBS001;t2;2019-05-03;12:00;s1;1;HỒI KẾT;ĐÔI ;Thường;45000; Có 
o2;B;bad;50000;C002;t3;2019-05-04;16:59;s2;x;VỢ BA;đôi;Thường;50000;Không
o3;B;;;C003;t4;2019-05-05;17:00;s2;2;KHÔNG CÓ;ĐƠN;VIP;60000;
o4;B;2019-05-06;70000;C999;t5;2019-05-06;abc;s2;2;MÙA THU;ĐƠN;VIP;70000;Có
o5;B;2019-05-06;1;C002;t6;2019-05-06;20:00;s2;2;MÙA THU;ĐƠN;VIP;0;Có
o6;B;2019-05-06;1;C002;t7;2019-05-06;20:00;s2;2;MÙA THU;ĐƠN;VIP;-1;Có
o7;B;2019-05-06;1;C002;t8;2019-05-06;20:00;s2;2;MÙA THU;ĐƠN;VIP;x;Có
;B;2019-05-06;1;C002;t9;2019-05-06;20:00;s2;2;MÙA THU;ĐƠN;VIP;5;Có
o8;B;2019-05-06;1;;t10;2019-05-06;20:00;s2;2;MÙA THU;ĐƠN;VIP;5;Có
o9;B;2019-05-06;1;C002;t11;15/05/2019;20:00;s2;2;MÙA THU;ĐƠN;VIP;5;Có
o10;B;2019-05-06;1;C002;t12;2019-05-07;20:00;s2;2;;ĐƠN;VIP;5;Có
"""


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cinema")
    for name, text in (("Film", FILMS), ("Customer", CUSTOMERS), ("Ticket", TICKETS)):
        (folder / f"{name}.csv").write_text(text, encoding="utf-8-sig")
    full_run.stage(spark, str(folder), f"{folder}/staging")
    staged = [spark.read.parquet(f"{folder}/staging/{n}") for n in ("film", "customer", "ticket")]
    built = full_run.build_star(*staged)
    return built, full_run.store_star(spark, built, f"{folder}/star"), str(folder)


def test_schemas(run):
    built, *_ = run
    for name in full_run.STAR_TABLES:
        wanted = getattr(schemas, name.upper())
        got = getattr(built, name).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in wanted]


def test_films(run):
    built, *_ = run
    assert sorted(rows_of(built.dim_film)) == [
        ("HỒI KẾT", "United States", "Anthony, Joe", "PG-13", 181),
        ("MÙA THU", "Vietnam", "Dũng", "PG-13", None),
        ("VỢ BA", "Vietnam", "Ash", "R", 96),
    ]


def test_customers(run):
    built, *_ = run
    got = {r["customer_id"]: r for r in as_dicts(built.dim_customer)}
    assert set(got) == {"WEBS001", "C002", "C003", "C004", "C005", "C006", "C007"}
    first = got["WEBS001"]
    assert (first["age_2019"], first["age_group"], first["gender"], first["district"], first["city"], first["customer_type"]) == (
        19, "Dưới 20", "Male", "Quận 1", "HCM", "Online")
    assert (got["C002"]["age_group"], got["C002"]["district"], got["C002"]["city"]) == ("20-29", "Quận 3", None)
    for key in ("C003", "C004", "C005"):
        assert (got[key]["dob"], got[key]["age_group"]) == (None, "50+")
    assert (got["C003"]["gender"], got["C004"]["gender"], got["C005"]["gender"]) == ("Other", "Other", "Female")
    assert (got["C006"]["job"], got["C006"]["age_group"], got["C007"]["age_group"]) == ("Baker", "30-39", "50+")


def test_other_year_and_null_label(spark, run):
    _, _, folder = run
    raw = spark.read.parquet(f"{folder}/staging/customer")
    got = {r["customer_id"]: r["age_group"] for r in as_dicts(star.build_dim_customer(raw, year=2030, null_label="?"))}
    assert got["WEBS001"] == "30-39" and got["C003"] == "?"


def test_fact(run):
    built, *_ = run
    got = {r["ticket_id"]: r for r in as_dicts(built.fact_ticket)}
    assert set(got) == {"t1", "t2", "t3", "t4", "t5"}
    assert [got[t]["show_session"] for t in ("t1", "t2", "t3", "t4", "t5")] == ["Sáng", "Chiều", "Chiều", "Tối sớm", "Tối muộn"]
    assert [got[t]["is_couple_seat"] for t in ("t1", "t2", "t3")] == [False, True, True]
    assert [got[t]["has_popcorn"] for t in ("t1", "t2", "t3", "t4")] == [True, True, False, False]
    assert [got[t]["is_weekend"] for t in ("t1", "t3", "t4", "t5")] == [False, True, True, False]
    assert (got["t1"]["sale_hour"], got["t3"]["sale_hour"], got["t5"]["sale_hour"]) == (18, None, 0)
    assert (got["t1"]["film_name"], got["t1"]["cashier"], got["t1"]["ticket_type"]) == ("HỒI KẾT", "A", "Thường")
    assert got["t3"]["room"] is None and got["t4"]["total"] is None


def test_unreadable_show_time_can_have_its_own_label(spark, run):
    _, _, folder = run
    fact = star.build_fact_ticket(spark.read.parquet(f"{folder}/staging/ticket"), null_session="?")
    assert {r["ticket_id"]: r["show_session"] for r in as_dicts(fact)}["t5"] == "?"


def test_equal_rows_can_be_dropped(spark, run):
    _, _, folder = run
    raw = spark.read.parquet(f"{folder}/staging/ticket")
    twice = raw.unionByName(raw)
    assert star.build_fact_ticket(twice).count() == 10
    assert star.build_fact_ticket(twice, dedupe=True).count() == 5


def test_dates(run):
    built, *_ = run
    got = as_dicts(built.dim_date)
    assert [r["sale_date"].day for r in got] == [3, 4, 5, 6, 7]
    assert got[1] == {
        "sale_date": datetime.date(2019, 5, 4), "day": 4, "month": 5, "year": 2019, "day_of_week": 6,
        "day_name": "Saturday", "month_name": "May", "week_of_year": 18, "quarter": 2, "is_weekend": True,
    }


def test_stored_star_gives_the_same_reports(spark, run):
    built, stored, folder = run
    fact = stored["fact_ticket"].read()
    assert fact.count() == 5 and {"sale_year", "sale_month"} <= set(fact.columns)
    for report in (kpi.summary, kpi.revenue_daily, kpi.sessions_by_hour, kpi.popcorn):
        assert rows_of(report(fact)) == rows_of(report(built.fact_ticket))
    mix = {r["genre"]: r["so_ve"] for r in as_dicts(kpi.rating_mix(fact, stored["dim_film"].read()))}
    assert mix == {"PG-13": 3, "R": 1, "Unknown": 1}
    tables = full_run.export_kpis(spark, fact, stored["dim_film"].read(), stored["dim_customer"].read(), f"{folder}/kpi")
    assert rows_of(tables["analytics_top_films"].read())[0][:2] == ("HỒI KẾT", "PG-13")
    assert tables["analytics_customer_age"].history().first()["rows"] == 4


def test_summary_values(run):
    built, *_ = run
    row = as_dicts(kpi.summary(built.fact_ticket))[0]
    assert (row["tong_don_hang"], row["tong_ve_ban"], row["tong_doanh_thu_vnd"], row["gia_ve_tb_vnd"]) == (4, 5, 300000.0, 54000.0)


def test_rollup_lists_every_session(run):
    built, *_ = run
    rolled = rows_of(kpi.session_rollup(kpi.sessions_by_hour(built.fact_ticket)))
    assert rolled == [("Sáng", 1), ("Chiều", 2), ("Tối sớm", 1), ("Tối muộn", 1)]


def test_refused_rows_add_up(spark, run):
    _, _, folder = run
    raw = spark.read.parquet(f"{folder}/staging/ticket")
    lost = raw.limit(1).withColumns({"total": F.lit("12,5"), "customerid": F.lit("C1"), "ticket_price": F.lit("2e15")})
    worse = raw.limit(1).withColumns({"customerid": F.lit(None).cast("string"), "date": F.lit("x")})
    account = Observation()
    fact = star.build_fact_ticket(raw.unionByName(lost).unionByName(worse), account=account)
    found = {r["item"]: int(r["value"]) for r in as_dicts(quality.fact_checks(fact, account)) if r["check"] == "account"}
    assert found["rows_in"] == raw.count() + 2 and found["rows_out"] == 6 and found["total_unreadable"] == 1
    reasons = [v for k, v in found.items() if k not in ("rows_in", "rows_out", "total_unreadable")]
    assert len(reasons) == 6 and sum(reasons) == found["rows_in"] - found["rows_out"]


def test_hour_of_sale_in_a_zone(spark, run):
    _, _, folder = run
    raw = spark.read.parquet(f"{folder}/staging/ticket").filter("ticketcode = 't1'")
    texts = ["2019-05-03T18:45:10+07:00", "2019-05-03 18:45:10", "2019-05-03T18:45:10Z", "n/a", None]
    for zone, hours in ((None, [18, 18, 18, None, None]), ("UTC", [11, 18, 18, None, None]), ("Asia/Ho_Chi_Minh", [18, 18, 1, None, None])):
        for text, hour in zip(texts, hours):
            fact = star.build_fact_ticket(raw.withColumn("saledate", F.lit(text).cast("string")), zone=zone)
            assert fact.first()["sale_hour"] == hour, (zone, text)


def test_checks(run):
    built, *_ = run
    checks = {(r["check"], r["item"]): r["value"] for r in as_dicts(quality.fact_checks(built.fact_ticket))}
    assert checks[("date_range", "min")] == "2019-05-03" and checks[("distinct", "film_name")] == "4"
    assert checks[("slot_type", "ĐƠN")] == "3" and checks[("not_positive", "total")] == "0"
    people = {(r["check"], r["item"]): r["value"] for r in as_dicts(quality.customer_checks(built.dim_customer))}
    assert people[("customer_type", "Online")] == "1" and people[("gender", "Male")] == "3"
