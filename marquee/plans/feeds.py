"""Data behind the charts, built from KPI results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.amounts import millions, share
from marquee.operators.trends import with_trailing_mean


def revenue_series(revenue_daily: DataFrame) -> DataFrame:
    """Day as text, revenue in millions, tickets and the 7-row mean in millions."""
    smooth = with_trailing_mean(revenue_daily, "doanh_thu", "mean")
    return smooth.orderBy(F.asc_nulls_last("sale_date")).select(
        F.col("sale_date").cast("string").alias("ngay"),
        millions(F.col("doanh_thu")).alias("doanh_thu_trieu"),
        "so_ve",
        millions(F.col("mean")).alias("doanh_thu_ma7"),
    )


def film_bars(top_films: DataFrame) -> DataFrame:
    """Revenue in millions per top film, smallest first."""
    return top_films.orderBy(F.asc_nulls_last("doanh_thu"), F.desc("film_name")).select(
        "film_name", millions(F.col("doanh_thu")).alias("doanh_thu_trieu")
    )


def top_film_bars(top_films: DataFrame, k: int = 5, width: int = 20) -> DataFrame:
    """The k best films with a shortened title, smallest first."""
    best = top_films.orderBy(F.desc_nulls_last("doanh_thu"), "film_name").limit(k)
    return best.orderBy(F.asc_nulls_last("doanh_thu"), F.desc("film_name")).select(
        F.substring("film_name", 1, width).alias("film_short"), millions(F.col("doanh_thu")).alias("doanh_thu_trieu")
    )


def rating_slices(rating_mix: DataFrame, with_unknown: bool = False) -> DataFrame:
    """Percent of the shown tickets per rating, with revenue in millions."""
    shown = rating_mix if with_unknown else rating_mix.filter(F.col("genre") != schemas.UNKNOWN)
    return shown.select(
        "genre", "so_ve", millions(F.col("doanh_thu")).alias("doanh_thu_trieu"), share(F.col("so_ve"), 1).alias("pct")
    ).orderBy(F.desc("so_ve"), "genre")


def session_bars(sessions_by_hour: DataFrame) -> DataFrame:
    """Tickets per show hour, labelled ``9h``."""
    return sessions_by_hour.orderBy(F.asc_nulls_last("show_hour"), "show_session").select(
        F.concat(F.col("show_hour").cast("string"), F.lit("h")).alias("gio"), "show_session", "so_ve"
    )
