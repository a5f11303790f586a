"""Reports beyond the six KPI groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.amounts import exact_sum, ratio, rounded, share
from marquee.operators.lineage import stored
from marquee.operators.ranking import with_ntiles
from marquee.operators.tally import Sales, regroup, revenue, summed, tally, ticket_measures


def genres_of(films: DataFrame) -> DataFrame:
    """One row per film and genre of the comma list ``listed_in``: title, genre."""
    names = F.transform(F.split("listed_in", ","), lambda name: F.trim(name))
    split = films.select(F.trim("film_name").alias("title"), F.explode(F.array_distinct(names)).alias("genre"))
    return split.filter(F.col("genre") != "")


def genre_films(films: DataFrame) -> DataFrame:
    """Films per genre, most frequent first."""
    counted = genres_of(films).groupBy("genre").agg(F.count(F.lit(1)).alias("so_phim"))
    return counted.orderBy(F.desc("so_phim"), "genre")


def genre_sales(sales: Sales, films: DataFrame) -> DataFrame:
    """Tickets and revenue per genre; a film counts once for each of its genres, or as Unknown."""
    per_film = tally(sales, "film_name")
    genres = genres_of(films)
    joined = per_film.join(genres, F.trim(per_film["film_name"]) == genres["title"], "left")
    named = joined.withColumn("genre", F.coalesce("genre", F.lit(schemas.UNKNOWN)))
    return (
        regroup(named, "genre", so_phim=F.count_distinct(F.trim("film_name")))
        .select("genre", "so_phim", F.col("tickets").alias("so_ve"), rounded(revenue()).alias("doanh_thu"))
        .orderBy(F.desc("doanh_thu"), "genre")
    )


def by_calendar(sales: Sales, dates: DataFrame, *by: str) -> DataFrame:
    """Days, tickets and revenue by attributes of the date dimension."""
    joined = tally(sales, "sale_date").join(dates.select("sale_date", *by), "sale_date", "left")
    return (
        regroup(joined, *by, so_ngay=F.count("sale_date"))
        .select(*by, "so_ngay", F.col("tickets").alias("so_ve"), rounded(revenue()).alias("doanh_thu"),
                share(F.col("tickets")).alias("pct_ve"))
        .orderBy(*by)
    )


def cohort_retention(sales: Sales) -> DataFrame:
    """Customers by month of first visit and months since, with the share still active.

    Visits are first reduced to one row per customer and month, so a customer's window
    holds no more rows than the calendar has months. Tickets without a customer or a date
    belong to no cohort.
    """
    month = (F.year("sale_date") * 12 + F.month("sale_date") - 1).alias("month")
    visits = ticket_measures(sales, "customer_id", "sale_date").filter(
        F.col("customer_id").isNotNull() & F.col("sale_date").isNotNull()
    ).select("customer_id", month).distinct()
    first = F.min("month").over(Window.partitionBy("customer_id"))
    since = F.col("month") - F.col("first")
    counted = (
        visits.withColumn("first", first).groupBy("first", since.alias("thang_thu")).agg(F.count(F.lit(1)).alias("so_khach"))
    )
    size = F.max(F.when(F.col("thang_thu") == 0, F.col("so_khach"))).over(Window.partitionBy("first"))
    year, month_of_year = F.floor(F.col("first") / 12).cast("int"), (F.col("first") % 12 + 1).cast("int")
    return counted.select(
        F.make_date(year, month_of_year, F.lit(1)).alias("cohort"),
        "thang_thu",
        "so_khach",
        ratio(F.col("so_khach") * 100, size, 2).alias("pct_giu_lai"),
    ).orderBy("cohort", "thang_thu")


def cohort_matrix(retention: DataFrame, months: Sequence[int] = tuple(range(13))) -> DataFrame:
    """Retention with one column of customers per month since the first visit, and one for all other months."""
    since, count = F.col("thang_thu"), F.col("so_khach")
    cells = [F.sum(F.when(since == m, count)).alias(f"m{m}") for m in months]
    later = F.sum(F.when(~since.isin(*months), count)).alias("later")
    return retention.groupBy("cohort").agg(*cells, later).na.fill(0).orderBy("cohort")


def rfm(sales: Sales, tiles: int = 5) -> DataFrame:
    """Recency, frequency and spend per customer, an order's total counted once, each scored 1 (low) to ``tiles`` (high)."""
    visits = ticket_measures(sales, "customer_id", "order_id", "sale_date", "total").filter(F.col("customer_id").isNotNull())
    orders = visits.groupBy("customer_id", "order_id").agg(F.max("sale_date").alias("sale_date"), F.min("total").alias("total"))
    customers = orders.groupBy("customer_id").agg(
        F.max("sale_date").alias("last_date"), F.count("order_id").alias("so_don"), F.coalesce(exact_sum(F.col("total")), F.lit(0)).alias("spend")
    )
    scores = {"r": "last_date", "f": "so_don", "m": "spend"}
    return with_ntiles(stored(customers, "rfm"), "customer_id", tiles, scores).select(
        "customer_id", "last_date", "so_don", F.col("spend").cast("double").alias("chi_tieu"),
        "r", "f", "m", F.concat("r", "f", "m").alias("rfm"),
    )


def revenue_per_order(sales: Sales) -> DataFrame:
    """Revenue with the order total counted once per order, beside once per ticket."""
    per_order = regroup(ticket_measures(sales, "order_id", "total"), "order_id", order_total=F.min("total"))
    return per_order.agg(
        F.count("order_id").alias("so_don"), exact_sum(F.col("order_total")).alias("once"), *summed()
    ).select(
        "so_don", F.col("tickets").alias("so_ve"), rounded(revenue()).alias("doanh_thu"),
        rounded(F.col("once")).alias("doanh_thu_don"),
    )


def popcorn_correlation(sales: Sales) -> DataFrame:
    """Correlation of the popcorn flag with the order total over tickets, to 6 digits.

    The mean is taken out before the moments are summed, so large totals keep their
    digits. Null where the flag or the total does not vary.
    """
    rows = ticket_measures(sales, "has_popcorn", "total").filter(F.col("has_popcorn").isNotNull() & F.col("total").isNotNull())
    count = F.col("total_count").cast("double")
    mean = rows.agg(F.try_divide(F.sum(F.col("total") * count), F.sum(count))).scalar()
    flag, away = F.col("has_popcorn").cast("double"), F.col("total") - mean
    moments = rows.agg(
        F.sum(count).alias("n"), F.sum(flag * count).alias("x"), F.sum(away * count).alias("y"),
        F.sum(away * away * count).alias("yy"), F.sum(flag * away * count).alias("xy"), F.max(F.abs("total")).alias("most"),
    )
    n, x, y, yy, xy = (F.col(c) for c in ("n", "x", "y", "yy", "xy"))
    share, level = F.try_divide(x, n), F.try_divide(y, n)
    spread = F.sqrt(share * (1 - share)) * F.sqrt(F.greatest(F.try_divide(yy, n) - level * level, F.lit(0.0)))
    # below that, totals only differ by rounding
    varies = spread > F.col("most") * 1e-14
    return moments.select(
        F.coalesce(n, F.lit(0.0)).cast("long").alias("so_ve"),
        F.when(varies, F.round((F.try_divide(xy, n) - share * level) / spread, 6)).alias("tuong_quan"),
    )
