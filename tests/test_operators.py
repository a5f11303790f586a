import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import quality, rows
from marquee.operators.ranking import with_ntiles
from marquee.operators.trends import with_change, with_trailing_mean
from marquee.plans import extended, feeds
from support import as_dicts, rows_of


def ntile(keys, tiles):
    small, longer = divmod(len(keys), tiles)
    out, tile = {}, 1
    sizes = [small + 1] * longer + [small] * (tiles - longer)
    at = 0
    for tile, size in enumerate(sizes, 1):
        out.update({k: tile for k in keys[at: at + size]})
        at += size
    return out


@pytest.mark.parametrize("size", [0, 1, 3, 5, 999])
@pytest.mark.parametrize("rows_per_band", [1, 100, 1_000_000])
def test_ntiles_equal_a_full_sort(spark, size, rows_per_band):
    """A third of all values are equal, and another value is common."""
    pick = random.Random(size)
    data = [(k, 5 if pick.random() < 0.35 else 9 if pick.random() < 0.1 else pick.randrange(-500, 500)) for k in range(size)]
    df = spark.createDataFrame(data, "k bigint, v bigint").withColumn("w", -F.col("v").cast("decimal(24,2)"))
    got = with_ntiles(df, "k", 5, {"a": "v", "b": "w"}, rows_per_band=rows_per_band)
    digest = {k: hashlib.md5(str(k).encode()).hexdigest() for k, _ in data}
    up = ntile([k for k, _ in sorted(data, key=lambda r: (r[1], digest[r[0]], r[0]))], 5)
    down = ntile([k for k, _ in sorted(data, key=lambda r: (-r[1], digest[r[0]], r[0]))], 5)
    assert {r["k"]: (r["a"], r["b"]) for r in got.collect()} == {k: (up[k], down[k]) for k, _ in data}


@pytest.mark.parametrize("rows_per_band", [10, 1_000_000])
def test_ntiles_keep_null_scores_first(spark, rows_per_band):
    df = spark.range(300).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 40).alias("v"))
    got = {r["id"]: r["t"] for r in with_ntiles(df, "id", 5, {"t": "v"}, rows_per_band=rows_per_band).collect()}
    assert len(got) == 300 and all((got[i] == 1) == (i % 5 == 0) for i in got)


def test_ntiles_spread_a_frequent_value(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    plan = with_ntiles(df, "id", 4, {"t": "v"}, rows_per_band=100)
    cells = plan.select("*").groupBy("t").count().collect()
    assert sorted(r["count"] for r in cells) == [5000] * 4


def test_keep_one_takes_the_smallest_row(spark):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 3, "p"), (None, 1, "n"), (None, 0, "m")]
    df = spark.createDataFrame(data, "k string, n int, s string")
    expected = {("a", 1, "y"), ("b", None, "q"), (None, 0, "m")}
    for parts in (1, 5):
        assert set(rows_of(rows.keep_one(df.repartition(parts), "k"))) == expected
    assert set(rows_of(rows.keep_one(df.select("k"), "k"))) == {("a",), ("b",), (None,)}


def test_keep_one_sorts_dealt_rows_only(spark):
    """One input task with many copies of a key: rows are shuffled before the aggregate that sorts them, and again by key."""
    df = spark.range(0, 5000, 1, 1).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("v"))
    kept = rows.keep_one(df, "k")
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "RebalancePartitions" in kept._jdf.queryExecution().optimizedPlan().toString() and plan.count("SortAggregate") == 2
    assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    assert sorted(rows_of(kept)) == [(0, "0"), (1, "1"), (2, "1001")]


def test_align_labels(spark):
    df = spark.createDataFrame([("b", 2), ("zz", 9)], "label string, n bigint")
    assert rows_of(rows.align(df, "label", ["a", "b"])) == [("a", None), ("b", 2)]
    assert rows_of(rows.align(df, "label", ["a", "b"], fill=0)) == [("a", 0), ("b", 2)]


def test_top_is_stable(spark):
    df = spark.createDataFrame([(k, 5) for k in "dbca"], "k string, v int")
    assert [r[0] for r in rows.top(df, 2, F.desc("v"), "k").collect()] == ["a", "b"]


def daily(spark, values):
    start = datetime.date(2019, 5, 1)
    data = [(start + datetime.timedelta(days=2 * i), v, 1) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "sale_date date, doanh_thu double, so_ve bigint")


def test_change_over_rows(spark):
    got = with_change(daily(spark, [10.0, 4.0, None, 7.0]), "doanh_thu", "p", "d").orderBy("sale_date")
    assert [(r["p"], r["d"]) for r in got.collect()] == [(None, None), (10.0, -6.0), (4.0, None), (None, None)]


@pytest.mark.parametrize("count", [6, 7, 8])
def test_trailing_mean_needs_all_rows(spark, count):
    got = with_trailing_mean(daily(spark, [float(i) for i in range(count)]), "doanh_thu", "m").orderBy("sale_date")
    assert [r["m"] for r in got.collect()] == [None] * min(6, count) + [3.0 + i for i in range(max(0, count - 6))]


def test_trailing_mean_with_a_gap(spark):
    values = [1.0] * 3 + [None] + [1.0] * 8
    means = [r["doanh_thu_ma7"] for r in feeds.revenue_series(daily(spark, values)).collect()]
    assert means == [None] * 10 + [1e-6] * 2


def test_profile(spark):
    df = spark.createDataFrame([("", 1, "x"), (None, None, "y")], "a string, `b c` int, `d.e` string")
    got = {r["column_name"]: (r["rows"], r["null_or_empty"], r["flagged"]) for r in as_dicts(quality.profile(df, "t"))}
    assert got == {"a": (2, 2, True), "b c": (2, 1, True), "d.e": (2, 0, False)}


def test_shape_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 0)], "k string, n int")
    assert rows_of(quality.shape({"t": df})) == [("t", 3, 2)]
    assert dict(rows_of(quality.distinct_counts(df, "k", "n"))) == {"k": 2, "n": 3}
    assert rows_of(quality.frequencies(df, "k")) == [("a", 2), (None, 1)]
    assert rows_of(quality.not_positive(df, "n")) == [(1,)]


def test_genres(spark):
    films = spark.createDataFrame(
        [("a ", "Action, Drama"), ("b", "Drama,Drama ,"), ("c", None)], "film_name string, listed_in string"
    )
    assert sorted(rows_of(extended.genres_of(films))) == [("a", "Action"), ("a", "Drama"), ("b", "Drama")]
    assert rows_of(extended.genre_films(films)) == [("Drama", 2), ("Action", 1)]
